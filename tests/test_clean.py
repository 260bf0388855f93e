import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cotejo.functions import clean
from cotejo.operators import setops, shape


def apply(spark, function, *texts, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("c"))).collect()]


def test_null_markers(spark):
    texts = (" x ", "", "NaT", "N/A", "<NA>", None, " none　", "nano")
    assert apply(spark, clean.null_markers, *texts) == ["x", None, None, None, None, None, None, "nano"]
    kept = apply(spark, lambda c: clean.null_markers(c, clean.NULL_MARKERS[:5]), "n/a", "<NA>", "Null")
    assert kept == ["n/a", "<NA>", None]


def test_null_markers_twice_changes_nothing(spark):
    texts = (" x ", "nan ", " a b ", "NULL")
    once = apply(spark, clean.null_markers, *texts)
    assert apply(spark, clean.null_markers, *once) == once


def test_dates(spark):
    day, none = dt.datetime(2025, 2, 5), dt.datetime(1900, 1, 1)
    texts = ("05/02/2025", "5/2/2025", "31/02/2025", "2025-02-05", None)
    assert apply(spark, clean.parse_date_sentinel, *texts) == [day, day, none, none, none]


def test_numbers(spark):
    texts = ("12", "IMPORTE", None, "nan", "1d", "1f", " 3 ", "1e3", "inf", "0x1p3", ".5", "5.")
    assert apply(spark, clean.to_number, *texts) == [
        12, None, None, None, None, None, 3, 1000, float("inf"), None, 0.5, 5,
    ]


def test_integers(spark):
    assert apply(spark, clean.to_integer, "3", "3.0", "x", None) == [3, 3, None, None]
    assert apply(spark, lambda c: clean.to_integer(c, "null"), "3.5", "4") == [None, 4]
    with pytest.raises(PySparkException):
        apply(spark, clean.to_integer, "3.5")


def test_currency(spark):
    assert apply(spark, clean.parse_currency, "$1,234.50", "-$5", None) == [1234.5, -5.0, None]
    with pytest.raises(PySparkException):
        apply(spark, clean.parse_currency, "abc")


def test_amount_needs_numbers(spark):
    df = spark.createDataFrame([("2.5", "4")], "p string, q string")
    assert df.select(clean.line_amount("p", "q")).first()[0] == 10.0
    with pytest.raises(PySparkException):
        spark.createDataFrame([("2.5d", "4")], "p string, q string").select(clean.line_amount("p", "q")).collect()


def test_strip_key(spark):
    assert apply(spark, clean.strip_key, "A 1", "A 1\t", None) == ["A1", "A1", "nan"]


def test_formats(spark):
    assert apply(spark, clean.format_currency, 1234.5, -1234.5, None, 0.125, kind="double") == [
        "$1,234.50", "$-1,234.50", "", "$0.12",
    ]
    assert apply(spark, clean.format_percent, 16.6666, None, -0.5, 1234.0, kind="double") == [
        "16.67%", "", "-0.50%", "1234.00%",
    ]


def test_hour_stamps(spark):
    texts = ("2025-09-19-08", "2025-02-31-08", "2025-09-19-24", "2025-09-19", None)
    stamp = dt.datetime(2025, 9, 19, 8)
    assert apply(spark, clean.parse_hour_stamp, *texts) == [stamp, None, None, None, None]
    assert apply(spark, clean.hour_stamp, stamp, kind="timestamp_ntz") == ["2025-09-19-08"]
    assert apply(spark, clean.dashed_date, "1/2/2025") == ["1-2-2025"]


def test_identifiers(spark):
    names = (" Número  de Orden ", "2024 total", "a--b", "UUID Descripción")
    tidy = ["n_mero_de_orden", "col_2024_total", "a_b", "uuid_descripci_n"]
    assert [clean.normalize_identifier(n) for n in names] == tidy
    assert apply(spark, clean.normalize_identifier_column, *names) == tidy


def test_headers(spark):
    assert clean.normalize_header(" Folio  Fiscal ") == "folio fiscal"
    assert apply(spark, clean.normalize_header_column, " Folio  Fiscal ") == ["folio fiscal"]


def test_series_folio(spark):
    df = spark.createDataFrame([("A", "1"), (None, "1"), ("A", ""), ("", None)], "s string, f string")
    assert [r[0] for r in df.select(clean.series_folio("s", "f")).collect()] == ["A-1", "1", "A", ""]


def test_dates_by_name(spark):
    df = spark.createDataFrame([(None, None, None)], "fecha_x timestamp_ntz, update_note string, other string")
    row = clean.fill_dates_by_name(df).first()
    assert tuple(row) == (dt.datetime(1900, 1, 1), "1900-01-01 00:00:00", None)


def test_shape(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "`a  b` int, `Unnamed: 0` int, `Unnamed` int, `unnamed x` int")
    assert shape.clean_table(df).columns == ["a b", "unnamed x"]
    assert shape.drop_unnamed(df).columns == ["a  b"]
    assert shape.project_existing(df, ["unnamed x", "zz", "a  b"]).columns == ["unnamed x", "a  b"]
    assert shape.resolve_column(spark.createDataFrame([(1, 2)], "x int, `Estado CR` int"), "estado") == "Estado CR"
    with pytest.raises(ValueError):
        shape.resolve_column(df, "estado")
    with pytest.raises(ValueError):
        shape.with_identifiers(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))
    assert not shape.has_values(spark.createDataFrame([(None, None)], "a int, b int"))
    assert shape.has_values(df)


def test_union_by_position(spark):
    first = spark.createDataFrame([(1, "x")], "a int, b string")
    narrow = spark.createDataFrame([(2,)], "z int")
    got = setops.union_by_position([first, narrow])
    assert got.columns == ["a", "b"] and sorted(map(tuple, got.collect()), key=str) == [(1, "x"), (2, None)]
    with pytest.raises(ValueError):
        setops.union_by_position([narrow, first])


def test_concat_by_header(spark):
    frames = [spark.createDataFrame([(1, 2)], s) for s in ("a int, b int", "b int, a int", "a int, c int")]
    groups = setops.concat_by_header(frames)
    assert [sorted(map(tuple, g.collect())) for g in groups] == [[(1, 2), (2, 1)], [(1, 2)]]
