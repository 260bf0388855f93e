import datetime as dt

import pytest

from cotejo.operators import checks, filters, report

P, C = dt.datetime(2025, 6, 1, 10), dt.datetime(2025, 7, 1, 10)
BEFORE, CUT = dt.date(2025, 6, 29), dt.date(2025, 6, 30)


@pytest.fixture
def view(spark):
    data = [
        (BEFORE, P, 100.0, "Pagado"), (BEFORE, C, 150.0, "Pagado"), (CUT, P, 50.0, "Pendiente"), (CUT, C, 25.0, "Pendiente"),
        (None, C, 7.0, "Nuevo"), (CUT, C, 9.0, None), (CUT, dt.datetime(2025, 1, 1), 1000.0, "Pagado"), (CUT, C, None, "Cero"),
    ]
    return spark.createDataFrame(data, "fechaaltatrunc date, file_date timestamp_ntz, importe double, `Estado CR` string")


def test_split_by_cutoff(view):
    got = {r["status"]: (r["raw"], r["before"], r["after"]) for r in report.status_split(view, CUT).collect()}
    assert got == {
        "Pagado": (1250.0, 250.0, 1000.0), "Pendiente": (75.0, None, 75.0), "Nuevo": (7.0, None, None), "Cero": (0.0, None, 0.0),
    }


def test_comparison(view):
    compared = report.snapshot_compare(view, P, C, CUT)
    raw = {r["status"]: (r["previous"], r["current"]) for r in compared.filter("period = 'raw'").collect()}
    assert raw == {"Pagado": (100.0, 150.0), "Pendiente": (50.0, 25.0), "Nuevo": (0.0, 7.0), "Cero": (0.0, 0.0)}
    assert compared.filter("period = 'before'").count() == 1
    totals = report.snapshot_totals(compared)
    rows = {(r["period"], r["status"]): r for r in totals.collect()}
    assert rows["raw", "Nuevo"]["delta_pct"] is None and rows["raw", "Pagado"]["delta_pct"] == 50.0
    total = rows["raw", "Total"]
    assert (total["previous"], total["current"], total["delta"], total["total_period"]) == (150.0, 182.0, 32.0, 332.0)
    assert round(total["delta_pct"], 2) == 21.33
    shown = {r["status"]: r for r in report.snapshot_formatted(totals.filter("period = 'raw'")).collect()}
    assert (shown["Total"]["delta_pct"], shown["Pendiente"]["delta"], shown["Nuevo"]["delta_pct"]) == ("21.33%", "$-25.00", "")
    top = [r["status"] for r in report.snapshot_top(totals, "raw").collect()]
    assert top == ["Pagado", "Pendiente", "Nuevo", "Cero", "Total"]
    assert [r["status"] for r in report.snapshot_top(totals, "raw", 2).collect()] == ["Pagado", "Pendiente", "Total"]
    with pytest.raises(ValueError):
        report.snapshot_compare(view, P, P, CUT)


def test_total_percentage_of_nothing(spark):
    frame = spark.createDataFrame([("raw", "x", 0.0, 5.0)], "period string, status string, previous double, current double")
    assert {r["delta_pct"] for r in report.snapshot_totals(frame).collect()} == {None}


def test_text_amounts(spark):
    frame = spark.createDataFrame([(BEFORE, "12.5", "a"), (BEFORE, "x", "a")], "fechaaltatrunc date, importe string, estado string")
    assert report.status_split(frame, CUT).first()["raw"] == 12.5


def test_rollup_report(spark):
    frame = spark.createDataFrame([("g", "x", 1.0), ("g", "y", 2.0)], "g string, d string, a double")
    got = {(r["group_label"], r["detail_label"]): r["amount"] for r in report.rollup_report(frame, "g", "d", "a").collect()}
    assert got == {("g", "x"): 1.0, ("g", "y"): 2.0, ("g", "Subtotal"): 3.0, ("Grand total", ""): 3.0}


def test_payment_split(rows):
    frame = rows("folio_fiscal string, importe string", ("f", "12"), ("f", "IMPORTE"), ("f", None), ("f", "nan"), ("f", "1d"), (None, "12"))
    accepted, rejected = filters.split_payments(frame)
    assert [r["importe"] for r in accepted.collect()] == [12.0]
    assert accepted.count() + rejected.count() == frame.count()
    assert filters.flag_payments(frame).filter("accepted").count() == 1


def test_status_filters(rows):
    frame = rows("s string", (None,), ("Cancelado",), ("Pagado",), ("Vigente",))
    assert [r["s"] for r in filters.not_cancelled(frame, "s").collect()] == [None, "Pagado", "Vigente"]
    assert [r["s"] for r in filters.active_only(frame, "s").collect()] == ["Vigente"]


def test_page_alerts(spark):
    schema = "dataset string, pages long"
    previous = spark.createDataFrame([("a", 10), ("b", 10), ("c", 10)], schema)
    current = spark.createDataFrame([("a", 8), ("b", 0), ("d", 3), ("c", 10)], schema)
    got = {r["dataset"]: r["finding"] for r in checks.partial_extract_alert(current, previous).collect()}
    assert got == {"a": "partial", "b": "no data"}
    kept = {r["dataset"]: r["pages"] for r in checks.next_page_counts(current, previous).collect()}
    assert kept == {"a": 8, "b": 10, "c": 10, "d": 3}


def test_range_overflow(spark):
    ranges = spark.createDataFrame([(dt.date(2025, 1, 1), dt.date(2025, 1, 31)), (dt.date(2025, 1, 31), dt.date(2025, 2, 2))], "start date, end date")
    days = [dt.datetime(2025, 1, 31, 23)] * 60 + [dt.datetime(2025, 1, 1)] * 41 + [dt.datetime(2025, 2, 3)] * 99
    rows = spark.createDataFrame([(d,) for d in days], "ts timestamp_ntz")
    assert [(r["start"].day, r["hits"]) for r in checks.range_overflow(ranges, rows, "ts").collect()] == [(1, 101)]
    backwards = ranges.selectExpr("`end` as start", "start as `end`").filter("start > `end`")
    odd = ranges.unionByName(ranges).unionByName(backwards)
    assert [(r["start"].day, r["hits"]) for r in checks.range_overflow(odd, rows, "ts").collect()] == [(1, 101)]


def test_last_range_is_extended(rows):
    frame = rows("`DATE START` string, `DATE END` string", ("1/1/2025", "31/1/2025"), ("1/2/2025", "2/2/2025"), (None, "x"))
    got = checks.extend_last_range(frame, "9/2/2025", "_row_no").orderBy("_row_no")
    assert [r["DATE END"] for r in got.collect()] == ["31/1/2025", "9/2/2025", "x"]
