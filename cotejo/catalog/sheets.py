"""Sheets with a header somewhere below the top, one per order, and the payment feed that reads such sheets."""

from pyspark.sql import functions as F

from cotejo.catalog.registry import register
from cotejo.operators.shape import require_columns
from cotejo.plans import payments
from cotejo.session import shared_folder
from cotejo.sources import sheets


def _cells(*values):
    return F.array(*[F.lit(v) if v is None or isinstance(v, str) else v.cast("string") for v in values])


def _catalog_rows(t):
    """Nought to two title rows, a header (in one of three forms), two data rows."""
    key = F.col("o_orderkey")
    title = _cells("Reporte", None, None, None)
    header = (
        F.when(key % 7 == 0, _cells("Clave", "Valor", None, None))
        .when(key % 2 == 0, _cells("Folio", "Monto", "Nota", None))
        .otherwise(_cells("Nota", "Monto", None, "Folio"))
    )
    data = []
    for i in range(2):
        folio, amount = F.concat(F.lit("A-"), key.cast("string"), F.lit(f"-{i}")), F.col("o_custkey") * 10 + i
        data.append(
            F.when(key % 2 == 0, _cells(folio, amount, "n", None)).otherwise(_cells("n", amount, None, folio))
        )
    rows = F.concat(F.array_repeat(title, (key % 3).cast("int")), F.array(header, *data))
    return t["orders"].select(F.format_string("sheet%d.csv", key).alias("file"), F.posexplode(rows).alias("pos", "cells"))


DATA = """
    SELECT 'sheet' || o_orderkey || '.csv' AS file, o_orderkey % 3 + 1 + i AS pos, 'A-' || o_orderkey || '-' || i AS "Folio",
           CAST(o_custkey * 10 + i AS VARCHAR) AS "Monto", o_orderkey
    FROM orders, (VALUES (0), (1)) v(i)"""


@register(
    f"""SELECT file, CAST(pos AS INT) AS pos, "Folio", "Monto" FROM ({DATA}) WHERE o_orderkey % 7 <> 0
        UNION ALL
        SELECT 'sheet' || o_orderkey || '.csv', CAST(n AS INT), NULL, NULL FROM orders, generate_series(1, 4) g(n)
        WHERE o_orderkey % 7 = 0 AND n <= o_orderkey % 3 + 2"""
)
def header_locate(t):
    rows = _catalog_rows(t)
    names = ["Folio", "Monto"]
    return sheets.rows_below(rows, sheets.locate_by_names(rows, names), names)


EXACT = ["Folio", "Monto", "Nota"]


@register(
    f"""SELECT file, CAST(pos AS INT) AS pos, "Folio", "Monto", 'n' AS "Nota" FROM ({DATA})
        WHERE o_orderkey % 7 <> 0 AND o_orderkey % 2 = 0"""
)
def header_exact(t):
    rows = _catalog_rows(t)
    return sheets.rows_below(rows, sheets.locate_exact(rows, EXACT), EXACT)


@register("""SELECT 'sheet' || o_orderkey || '.csv' AS file FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 2 = 1""")
def header_rejects(t):
    rows = _catalog_rows(t)
    return sheets.rejected_files(rows, sheets.locate_exact(rows, EXACT))


def _notice_rows(t):
    """A sheet per notice: a title, a header written in several ways, three data rows, a repeated header."""
    key = F.col("o_orderkey")
    folio = F.when(key % 4 == 0, F.lit("Folio  Fiscal (UUID)")).otherwise(F.lit(" FOLIO FISCAL "))
    header = F.when(key % 13 == 0, _cells("Folio", "Referencia", "Importe", "CLC")).otherwise(
        _cells(folio, "Referencia", "IMPORTE", "clc")
    )
    uuid = F.concat(F.lit("U"), (F.col("o_custkey") % 100).cast("string"))
    rows = F.array(
        _cells("Aviso de pago", None, None, None),
        header,
        _cells(F.concat(F.lit(" "), uuid, F.lit(" ")), key, F.col("o_custkey"), "c1"),
        _cells(F.when(key % 3 == 0, F.lit("NaT")), key, "5", "null"),
        _cells(uuid, key, F.when(key % 2 == 0, F.lit("12.50")).otherwise(F.lit("12,50")), "c3"),
        header,
    )
    return t["in_notices"].select(F.col("name").alias("file"), F.posexplode(rows).alias("pos", "cells"))


NOTICES = """
    lines AS (
        SELECT name AS file, o_orderkey, i + 2 AS pos,
               CASE WHEN i = 0 THEN ' U' || (o_custkey % 100) || ' ' WHEN i = 2 THEN 'U' || (o_custkey % 100)
                    WHEN i = 1 THEN CASE WHEN o_orderkey % 3 = 0 THEN 'NaT' END
                    ELSE CASE WHEN o_orderkey % 4 = 0 THEN 'Folio  Fiscal (UUID)' ELSE ' FOLIO FISCAL ' END END AS folio_fiscal,
               CASE WHEN i = 3 THEN 'Referencia' ELSE CAST(o_orderkey AS VARCHAR) END AS referencia,
               CASE i WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN '5'
                      WHEN 2 THEN CASE WHEN o_orderkey % 2 = 0 THEN '12.50' ELSE '12,50' END ELSE 'IMPORTE' END AS importe,
               CASE i WHEN 0 THEN 'c1' WHEN 1 THEN 'null' WHEN 2 THEN 'c3' ELSE 'clc' END AS clc
        FROM in_notices, (VALUES (0), (1), (2), (3)) v(i) WHERE o_orderkey % 13 <> 0)"""


@register(f"""WITH {NOTICES} SELECT file, CAST(pos AS INT) AS pos, folio_fiscal, referencia, importe, clc FROM lines""")
def header_tokens(t):
    return sheets.read_notices(_notice_rows(t))


FEED = f"""
    WITH {NOTICES},
    chosen AS (
        SELECT arg_min(name, o_orderkey) AS file FROM in_notices WHERE name LIKE '%.xlsx' AND name LIKE '% Notice %'
        GROUP BY name[:23]),
    read AS (
        SELECT CASE WHEN lower(trim(folio_fiscal)) NOT IN ('nat') THEN trim(folio_fiscal) END AS folio_fiscal,
               referencia, importe, clc, file AS file_name, pos FROM lines WHERE file IN (SELECT file FROM chosen)),
    accepted AS (SELECT * REPLACE (CAST(importe AS DOUBLE) AS importe) FROM read
                 WHERE regexp_full_match(importe, '[0-9]+([.][0-9]+)?') AND folio_fiscal IS NOT NULL),
    target AS (
        SELECT name AS file_name, 'U' || (o_custkey % 100) AS folio_fiscal, 'old' AS referencia,
               CAST(-1 AS DOUBLE) AS importe, 'old' AS clc FROM in_notices WHERE o_orderkey % 6 = 2)"""


INSERTED = f"""
    {FEED} SELECT file_name, folio_fiscal, referencia, importe, clc FROM target
UNION ALL
SELECT file_name, folio_fiscal, referencia, importe, nullif(clc, 'null') FROM accepted a
WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.file_name = a.file_name AND t.folio_fiscal = a.folio_fiscal)
QUALIFY row_number() OVER (PARTITION BY file_name, folio_fiscal ORDER BY pos) = 1"""


@register(INSERTED)
def payments_feed(t):
    return _feed(t)[0]


@register(
    f"""{FEED} SELECT file_name, folio_fiscal, referencia, importe, clc FROM read
        WHERE NOT regexp_full_match(importe, '[0-9]+([.][0-9]+)?') OR folio_fiscal IS NULL"""
)
def payments_rejected(t):
    return _feed(t)[1].drop("_row_no")


def _stored(t):
    root = shared_folder(t.spark, "notices")
    return payments.stored_notices(t["in_notices"], _notice_rows(t), root, "Notice", "o_orderkey")


@register(
    f"""{FEED} SELECT count(*) AS rows, count(*) FILTER (WHERE regexp_full_match(importe, '[0-9]+([.][0-9]+)?') AND folio_fiscal IS NOT NULL) AS accepted,
               count(*) FILTER (WHERE folio_fiscal IS NULL) AS without_folio,
               count(*) FILTER (WHERE NOT regexp_full_match(importe, '[0-9]+([.][0-9]+)?')) AS without_amount FROM read"""
)
def payments_counted(t):
    counts = _stored(t)[2]
    return t.spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()])


@register(INSERTED)
def payments_stored(t):
    return payments.insert_notices(_target(t), _stored(t)[0])


def _feed(t):
    return payments.payments_feed(t["in_notices"], _notice_rows(t), _target(t), "Notice", "o_orderkey")


def _target(t):
    return t["in_notices"].filter("o_orderkey % 6 = 2").select(
        F.col("name").alias("file_name"),
        F.concat(F.lit("U"), (F.col("o_custkey") % 100).cast("string")).alias("folio_fiscal"),
        F.lit("old").alias("referencia"),
        F.lit(-1.0).alias("importe"),
        F.lit("old").alias("clc"),
    )


@register("""SELECT CAST(o_orderkey AS VARCHAR) AS "Folio", o_custkey FROM orders""")
def work_list(t):
    rows = t["orders"].select(F.col("o_orderkey").cast("string").alias("Folio"), "o_custkey")
    return require_columns(rows, ["Folio"])
