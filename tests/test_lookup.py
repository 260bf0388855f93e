import dataclasses
import logging
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from cotejo.operators import dedup, files, lookup, ranges
from cotejo.operators.skew import join_unique
from cotejo.plans import integrate
from cotejo.plans.invoices import load_invoices

SPEC = lookup.LookupSpec(("k",), ("r",), ("u",))


def left(rows, *keys):
    return rows("k string", *[(k,) for k in keys]).drop("_row_no")


def as_dict(df, key="k", value="u"):
    return {r[key]: r[value] for r in df.collect()}


def test_single_many_miss(rows):
    right = rows("r string, u string", ("A", "U1"), ("B", "U2"), ("B", "U1"), ("C", None), ("C", "U9"), (None, "U0"))
    got = lookup.populate(left(rows, "A", "B", "C", "D", None), right, SPEC)
    assert as_dict(got) == {"A": "U1", "B": "U2,U1", "C": "nan,U9", "D": "no localizado", None: "no localizado"}
    assert got.columns == ["k", "u"] and got.count() == 5


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_parts_give_the_same_text(rows, width):
    right = rows("r string, u string", *[("A" if i % 3 else "B", str(i)) for i in range(50)])
    got = as_dict(lookup.populate(left(rows, "A", "B"), right, SPEC, part_width=width))
    assert got == {
        "A": ",".join(str(i) for i in range(50) if i % 3),
        "B": ",".join(str(i) for i in range(50) if not i % 3),
    }


def test_parts_are_bounded(rows):
    right = rows("r string, u string", *[("A", str(i)) for i in range(50)])
    parts = lookup.collapse_parts(right, SPEC, part_width=8)
    assert max(r["_rows"] for r in parts.collect()) == 8 and parts.count() == 7


def test_row_count_is_kept(rows):
    right = rows("r string, u string", ("A", "1"), ("A", "2"))
    assert lookup.populate(left(rows, "A", "A", "B"), right, SPEC).count() == 3


def test_missing_column_leaves_the_table(rows, caplog):
    frame = left(rows, "A")
    with caplog.at_level(logging.WARNING):
        assert lookup.populate(frame, rows("x string", ("A",)), SPEC) is frame
    assert "missing columns" in caplog.text


def test_tables_of_one_pass_are_told_apart(rows):
    """Values of several tables, equal places in the order and missing ones; every column in its own order."""
    frame = left(rows, "A", "B", "C", "no localizado")
    one = rows("r string, u string, v string", ("A", "2", "x"), ("A", "1", "y"), ("B", None, ""), (None, "9", "9")).withColumn("_row_no", F.lit(5))
    two = rows("q string, w string, p string", ("A", "w", "10"), ("C", "", "x"), ("no localizado", "l", "1"), ("Z", "z", "2"))
    first, second = lookup.LookupSpec(("k",), ("r",), ("u", "v")), lookup.LookupSpec(("k",), ("q",), ("w",), ("p",))
    got = lookup.populate_all(frame, [(one, first), (two, second)])
    none = "no localizado"
    assert {tuple(r[c] for c in ("k", "u", "v", "w", "p")) for r in got.collect()} == {
        ("A", "1,2", "x,y", "w", 10.0), ("B", "nan", "", none, None), ("C", none, none, "", None), (none, none, none, "l", 1.0),
    }


def test_values_are_joined_up_once(rows):
    """Rows of keys that nobody asks for go before any value is gathered, and the rest is gathered in one list per key."""
    right = rows("r string, u string, v string", ("A", "1", "x"), ("Z", "2", "y"))
    plan = plan_of(lookup.populate(left(rows, "A"), right, lookup.LookupSpec(("k",), ("r",), ("u", "v"))))
    plan = plan.split("== Initial Plan ==")[-1]
    assert "LeftSemi" in plan[plan.index("ObjectHashAggregate") :] and plan.count("ObjectHashAggregate") == 2


def test_bad_specs(rows):
    with pytest.raises(ValueError):
        lookup.LookupSpec(("a", "b"), ("a",), ("u",))
    clash = rows("k string, u string", ("A", "old")).drop("_row_no")
    right = rows("r string, u string", ("A", "new"))
    with pytest.raises(ValueError):
        lookup.populate(clash, right, SPEC)
    assert as_dict(lookup.populate(clash, right, SPEC, overwrite=True)) == {"A": "new"}


def test_key_of_the_same_name_stays(rows):
    right = rows("k string, u string", ("A", "1"))
    spec = dataclasses.replace(SPEC, right=("k",))
    assert lookup.populate(left(rows, "A"), right, spec).columns == ["k", "u"]


def test_penalty_needs_exactly_one_row(rows):
    right = rows("r string, p string", ("A", "10"), ("B", "10"), ("B", "20"), ("D", "x"))
    spec = lookup.LookupSpec(("k",), ("r",), (), single_numbers=("p",))
    got = as_dict(lookup.populate(left(rows, "A", "B", "C", "D"), right, spec), value="p")
    assert got == {"A": 10.0, "B": None, "C": None, "D": None}


def test_two_key_lookup(rows):
    frame = rows("k string, n double", ("A", 1.0), ("A", 2.0)).drop("_row_no")
    right = rows("r string, m double, u string", ("A", 1.0, "x"), ("B", 2.0, "y"))
    got = lookup.populate(frame, right, lookup.LookupSpec(("k", "n"), ("r", "m"), ("u",)))
    assert as_dict(got, "n") == {1.0: "x", 2.0: "no localizado"}


def test_first_match_and_null_match(rows):
    frame = rows("Factura string", ("F1",), (None,), ("F9",)).drop("_row_no")
    xml = rows("Folio string, v string", ("F1", "a"), ("F1", "b"), (None, "n"))
    assert as_dict(lookup.join_first(frame, xml, "Factura", "Folio"), "Factura", "v") == {"F1": "a", None: "n", "F9": None}
    strict = lookup.join_first(frame, xml, "Factura", "Folio", match_nulls=False)
    assert as_dict(strict, "Factura", "v") == {"F1": "a", None: None, "F9": None}


def test_null_is_never_listed(rows):
    frame = rows("UUID string, s string", ("u1", "Vigente"), (None, "Vigente"), ("u2", None)).drop("_row_no")
    listed = rows("uuid string", (None,), ("u1",), ("u1",))
    got = lookup.mark_listed(frame, "UUID", listed, "uuid", "s", "Cancelado")
    assert as_dict(got, "UUID", "s") == {"u1": "Cancelado", None: "Vigente", "u2": None}


def test_backfill(rows):
    accounts = rows(
        "`Folio fiscal` string, `Orden de suministro` string, `Estado de la factura` string, Total string, n int",
        ("F1", None, "Pagado", "$1,000.00", 1),
        ("F1", "X", None, "$2", 2),
        ("F2", None, "Pagado", "$3", 3),
        (None, None, "Pagado", "$4", 4),
        ("F3", "Y", "Pagado", "$5", 5),
        ("F3", None, "Cancelado", "$6", 6),
    )
    invoices = rows("UUID string, Referencia string", ("F1", "R1"), ("F3", "R3"))
    got = integrate.clean_accounts(accounts, invoices)
    assert as_dict(got, "n", "Orden de suministro") == {1: "R1", 2: "R1", 3: "no localizado", 4: None, 5: "Y"}
    assert as_dict(got, "n", "Total") == {1: 1000.0, 2: 2.0, 3: 3.0, 4: 4.0, 5: 5.0}


def test_clean_invoices(rows):
    invoices = rows(
        "Referencia string, Factura string, Total double, `UUID Descripción` string, n int",
        ("A 1", "F", 1.0, "Vigente", 1),
        ("A 1", "F ", 1.0, "Vigente", 2),
        ("A1", "F", 1.0, "Vigente", 3),
        ("B", "F", 1.0, None, 4),
        ("C", None, 1.0, "Vigente", 5),
        ("D", "F", 1.0, "Cancelado", 6),
    )
    got = {r["n"]: (r["Referencia"], r["Factura"]) for r in integrate.clean_invoices(invoices).collect()}
    assert got == {1: ("A1", "F"), 5: ("C", "nan")}


def test_rows_of_a_prefix_are_dealt_to_tasks(spark, rows):
    """Few short rows that give many: one folio asked for 1,000 times with 40 files, and others, don't end up in one task."""
    wanted = spark.range(1003).selectExpr("id", "CASE WHEN id < 1000 THEN 'f' WHEN id = 1000 THEN 'g1' WHEN id = 1001 THEN 'none' END AS Folio")
    files = spark.range(50).selectExpr("concat(if(id < 40, 'F', 'G'), id) AS name", "concat('/', id) AS path")
    got = lookup.prefix_rows(wanted, "Folio", files, "name", "path")
    seen = got.withColumn("task", F.spark_partition_id()).collect()
    files_of_g1 = sum(f"G{i}".startswith("G1") for i in range(40, 50))
    assert got.columns == ["id", "Folio", "path"] and len({(r["id"], r["path"]) for r in seen}) == len(seen) == 40_000 + files_of_g1
    assert len({r["task"] for r in seen if r["Folio"] == "f"}) > 3


@pytest.mark.parametrize("parts", [None, 3, 40])
def test_prefixes(rows, parts):
    wanted = rows("Folio string", ("f-1",), (" F-10 ",), ("zz",), (None,)).drop("_row_no")
    names = rows("name string, path string", ("F-1.pdf", "/a"), ("F-10.pdf", "/b"), ("g.pdf", "/c"), (None, "/d"))
    found = lookup.prefix_matches(wanted, "Folio", names, "name", "path", ("_row_no",), 9, parts)
    assert as_dict(found, "Folio", "matches") == {"f-1": ["/a", "/b"], " F-10 ": ["/b"], "zz": None, None: None}
    many = rows("name string, path string", *[(f"x{i:02}", f"/{i:02}") for i in range(9)])
    one = rows("Folio string", ("X",)).drop("_row_no")
    short = lookup.prefix_matches(one, "Folio", many, "name", "path", ("_row_no",), 5, parts).first()
    assert (short["found"], short["matches"]) == (9, [f"/{i:02}" for i in range(5)])
    listed = lookup.prefix_rows(one, "Folio", many, "name", "path", parts)
    assert listed.columns == ["Folio", "path"] and sorted(r["path"] for r in listed.collect()) == [f"/{i:02}" for i in range(9)]


@pytest.mark.parametrize("parts", [2, 7, 64])
def test_prefixes_against_every_pair(spark, parts):
    rng = random.Random(parts)
    texts = ["".join(rng.choice("abÁ-") for _ in range(rng.randint(0, 6))) for _ in range(300)]
    names = [(t + rng.choice(["", "x", ".pdf"]), f"/{i}") for i, t in enumerate(texts)] + [("hot.pdf", f"/h{i}") for i in range(400)]
    keys = sorted({"".join(rng.choice("abá-") for _ in range(rng.randint(0, 5))) for _ in range(60)} | {"", "hot", "hot.pdf", "hot.pdf2", "zz"})
    wanted = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "Folio string, n int")
    files = spark.createDataFrame(names, "name string, path string")
    got = lookup.prefix_rows(wanted, "Folio", files, "name", "path", parts)
    assert sorted(map(tuple, got.collect())) == sorted((k, i, p) for i, k in enumerate(keys) for n, p in names if n.lower().startswith(k))


def test_a_hot_name_fills_several_ranges(spark):
    files = spark.range(4000).selectExpr("if(id % 3 = 0, 'hot.pdf', concat('n', id)) name", "concat('/', id) path")
    edges = ranges.bounds(files, "name", ["path"], 32)
    held = files.groupBy(ranges.dealt("name", edges, ["name", "path"]).alias("r")).count().collect()
    assert len(held) > 25 and max(r["count"] for r in held) < 4 * 4000 / 32
    keys = files.select(F.col("name").alias("k")).distinct()
    plan = plan_of(lookup.prefix_rows(keys, "k", files, "name", "path", 32))
    assert "explode(set" not in plan.split("_path")[0] and not any("collect_list" in x and "_path" in x for x in plan.split("\n"))


def test_keys_behind_all_names_fill_ranges_of_their_own(spark):
    files = spark.range(500).selectExpr("concat('n', id) name", "concat('/', id) path")
    wanted = spark.range(5000).selectExpr("concat('z', id) Folio")
    scanned = lookup.prefix_rows(wanted, "Folio", files, "name", "path", 20)
    edges = re.findall(r"z\d+", plan_of(scanned))
    assert scanned.count() == 0 and len(set(edges)) > 10


def test_bounds_of_few_and_repeated_texts(spark):
    none = spark.createDataFrame([], "t string, p string")
    assert ranges.bounds(none, "t", ["p"]) == [""]
    few = spark.createDataFrame([("b", "1"), ("a", "2"), (None, "3")], "t string, p string")
    assert ranges.bounds(few, "t", ["p"], 8) == ["a", "b"]
    counted = few.select("t", ranges.below("t", ["a", "a", "b"]).alias("n"), ranges.below("t", ["a", "a", "b"], False).alias("m")).collect()
    assert {(r["t"], r["n"], r["m"]) for r in counted if r["t"]} == {("a", 2, 0), ("b", 3, 2)}


def test_fallback_order(rows):
    work = rows("a string, b string, n int", ("k1", "k2", 1), (None, "k2", 2), ("nan", "", 3), ("k3", "k1", 4))
    results = rows("x string, y string, st string, v string",
                   ("k1", "k7", "Cancelado ayer", "c"), ("k9", "k2", "Activo", "first"), ("k2", None, None, "later"))
    got = lookup.fallback_lookup(work, ("a", "b"), results, ("x", "y"), "st", ("v",), ("_row_no",))
    found = {r["n"]: (r["priority"], r["v"]) for r in got.collect()}
    assert found == {1: (1, "first"), 2: (1, "first"), 3: (None, None), 4: (None, None)}


def test_fallback_keeps_repeated_work_rows(rows):
    work = rows("a string, b string", ("k1", "k2"), ("k1", "k2"), (None, None), (None, None)).drop("_row_no")
    results = rows("x string, st string, v string", ("k2", "Activo", "hit"))
    got = lookup.fallback_lookup(work, ("a", "b"), results, ("x",), "st", ("v",), ("_row_no",))
    assert sorted(map(tuple, got.collect()), key=str) == [("k1", "k2", 1, "hit")] * 2 + [(None, None, None, None)] * 2


def test_unasked_keys_are_not_joined_up(spark, rows):
    """A million right rows under labels for missing keys leave before their values are gathered."""
    from pyspark.sql import functions as F

    left = rows("k string", ("a",), (None,))
    hit = rows("k string, v string", ("a", "x"), ("a", "y"))
    missed = spark.range(1_000_000).select(
        F.when(F.col("id") % 2 == 0, F.lit("no localizado")).otherwise(F.lit("nan")).alias("k"), F.lit("z").alias("v"), F.col("id").alias("_row_no")
    )
    spec = lookup.LookupSpec(("k",), ("k",), ("v",))
    right = hit.unionByName(missed)
    assert [r["v"] for r in lookup.collapse([(right, spec)], wanted=left.select("k")).collect()] == ["x,y"]
    got = lookup.populate(left, right, spec)
    assert sorted((r["k"] or "", r["v"]) for r in got.collect()) == [("", "no localizado"), ("a", "x,y")]


def test_join_refuses_columns_on_both_sides(rows):
    from cotejo.operators.skew import join_unique

    with pytest.raises(ValueError):
        join_unique(rows("k int, v int", (1, 2)).drop("_row_no"), ["k"], rows("q int, v int", (1, 3)).drop("_row_no"), ["q"])


def test_new_documents(rows):
    docs = rows("UUID string, Folio string, Archivo string, n int",
                ("u1", "f", "a", 1), (None, "g", "b", 2), (None, "h", "c", 3), ("u2", "h", "c", 4), ("u2", "i", "d", 5))
    known = rows("UUID string, Folio string, Archivo string", ("u1", "x", "x"), (None, "g", "b"))
    assert sorted(r["n"] for r in lookup.new_documents(docs, known).collect()) == [3, 4, 5]


def test_missing_and_unexpected_files(rows):
    ranges = rows("`DATE START` string, `DATE END` string",
                  ("01/01/2025", "31/01/2025"), ("01/02/2025", "28/02/2025"), ("01/03/2025", "31/03/2025"), ("x", None))
    expected = files.expected_exports(ranges, "me")
    names = [f"[FacturaVsCR][me][{a}][{b}].xls" for a, b in
             [("01-01-2025", "31-01-2025"), ("01-02-2025", "28-02-2025"), ("01-03-2025", "31-03-2025")]]
    present = rows("name string", (names[0],), (names[2],), ("stray.xls",)).drop("_row_no")
    assert [r["expected_name"] for r in files.missing_files(expected, present).collect()] == [names[1]]
    assert [r["name"] for r in files.unexpected_files(expected, present).collect()] == ["stray.xls"]
    assert sorted(r["name"] for r in files.present_files(expected, present).collect()) == [names[0], names[2]]


def test_load_invoices(rows):
    first = rows("Referencia string, Factura string, `UUID Descripción` string", ("R1", "F1", "Vigente"), ("R2", "F2", "Vigente"))
    second = rows("a string, b string", ("R3", "F1")).drop("_row_no")
    xml = rows("Folio string, UUID string, Importe double", ("F1", "u1", 5.0), ("F1", "u1", 7.0))
    status = rows("uuid string, estado string", ("u1", "Cancelado"), (None, "Cancelado"))
    got = load_invoices([first.drop("_row_no"), second], xml, status)
    assert {r["Referencia"]: (r["UUID"], r["Importe"], r["UUID Descripción"]) for r in got.collect()} == {
        "R1": ("u1", 5.0, "Cancelado"), "R2": (None, None, "Vigente"), "R3": ("u1", 5.0, "Cancelado")}


def test_dedup_limits_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_of(dedup.dedup_first(frame, ["k"], ["id"]))
    partial, exchange = plan.index("WindowGroupLimit"), plan.index("Exchange")
    assert partial < exchange < plan.rindex("WindowGroupLimit")


def test_hot_key_is_split_among_tasks(spark, tmp_path):
    """A key with a third of the left rows: adaptive execution marks the join as skewed and cuts it up."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
        frame = spark.range(0, 60000, 1, 8).select(key.alias("k"), "id")
        right = spark.range(0, 60000, 2, 4).select(F.col("id").alias("r"), (F.col("id") % 5).alias("v"))
        right = right.groupBy("r").agg(F.max("v").alias("v"))
        joined = join_unique(frame, ["k"], right, ["r"])
        path = str(tmp_path / "joined")
        assert joined.count() == 60000
        joined.write.parquet(path)
        joined.collect()
        assert "skew=true" in plan_of(joined)
        assert spark.read.parquet(path).filter("k = 0 and v = 0").count() == 20000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
