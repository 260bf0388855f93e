"""Registry of queries and the stand-in inputs they run on.

The domain tables (orders, invoices, accounts, ...) are projections of the star-schema tables. They are written once in
SQL that both Spark and the checking engine read; the work under test happens after them.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

ORDER_ID = "'OS-' || CAST({k} AS STRING)"
LINE_NO = "(l_partkey * 1000000 + l_suppkey % 1000000) * 100 + CAST(l_quantity AS BIGINT)"
# One part of a lookup covers the row numbers of this many parts (the unit of LINE_NO above).
LINE_PART_WIDTH = 50 * 100_000_000
LINE_UUID = "'U' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING)"
MONEY_TEXT = """'$' || CASE WHEN l_extendedprice >= 1000
    THEN CAST(CAST(floor(l_extendedprice / 1000) AS BIGINT) AS STRING) || ',' ||
         lpad(CAST(CAST(floor(l_extendedprice) AS BIGINT) % 1000 AS STRING), 3, '0')
    ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) END
    || '.' || lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 100 AS STRING), 2, '0')"""
HOUR_TEXT = "substring(CAST(ts AS STRING), 1, 10) || '-' || substring(CAST(ts AS STRING), 12, 2)"

INPUTS = {
    "in_orders": f"""
        SELECT {ORDER_ID.format(k="o_orderkey")} AS numero_orden_suministro,
               o_totalprice AS precio_unitario,
               CAST(o_orderkey % 7 + 1 AS STRING) AS cantidad_solicitada,
               'R-' || CAST(o_custkey AS STRING) AS orden_remision,
               o_orderpriority AS numero_contrato,
               o_orderkey AS _row_no
        FROM <orders>""",
    "in_invoices": f"""
        SELECT CASE WHEN l_linenumber = 2 THEN ' OS- ' || CAST(l_orderkey AS STRING) || ' '
                    ELSE {ORDER_ID.format(k="l_orderkey")} END AS "Referencia",
               CASE WHEN l_linenumber % 3 = 0 THEN 'F ' ELSE 'F' END || CAST(l_linenumber AS STRING) AS "Factura",
               l_extendedprice AS "Total",
               CASE WHEN l_linestatus = 'F' THEN 'Vigente' WHEN l_linenumber = 4 THEN NULL
                    ELSE 'Cancelado' END AS "UUID Descripción",
               {LINE_UUID} AS "UUID",
               'A-' || CAST(l_partkey AS STRING) AS "Folio",
               {LINE_NO} AS _row_no
        FROM <lineitem>""",
    "in_accounts": f"""
        SELECT CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE {LINE_UUID} END AS "Folio fiscal",
               CASE WHEN l_linenumber = 1 THEN NULL ELSE {ORDER_ID.format(k="l_orderkey")} END
                   AS "Orden de suministro",
               CASE WHEN l_returnflag = 'R' THEN 'Cancelado' WHEN l_linenumber = 3 THEN NULL
                    WHEN l_returnflag = 'A' THEN 'Pagado' ELSE 'En revision' END AS "Estado de la factura",
               {MONEY_TEXT} AS "Total",
               {LINE_NO} AS _row_no
        FROM <lineitem>""",
    "in_penalties": f"""
        SELECT {ORDER_ID.format(k="l_orderkey")} AS "ORDEN DE SUMINISTRO",
               CASE WHEN l_linenumber = 5 THEN 'sin pena' ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS "PENA",
               'OF-' || CAST(l_suppkey AS STRING) AS "OFICIO",
               {LINE_NO} AS _row_no
        FROM <lineitem> WHERE l_returnflag = 'R'""",
    "in_history": f"""
        SELECT {ORDER_ID.format(k="o_orderkey")} AS numero_orden_suministro,
               CAST(DATE '2024-01-01' + CAST(o_orderkey % 5 AS INT) AS TIMESTAMP_NTZ) AS file_date,
               CASE WHEN o_orderkey % 50 = 7 THEN NULL ELSE o_orderstatus END AS estado_de_la_factura,
               o_totalprice AS importe,
               CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS fechaaltatrunc
        FROM <orders>""",
    "in_lines": f"""
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_extendedprice,
               l_returnflag, l_shipdate, {LINE_NO} AS _row_no
        FROM <lineitem>""",
    "in_files": f"""
        SELECT '/drop/' || event_type || '/' || CASE WHEN event_id % 40 = 0 THEN '~' ELSE '' END
               || CASE WHEN event_id % 25 = 0 THEN 'copy ' ELSE '' END || {HOUR_TEXT}
               || 'h ' || lpad(CAST(event_id AS STRING), 12, '0')
               || CASE event_type WHEN 'error' THEN '.tmp' WHEN 'signup' THEN '.XLS' ELSE '.xlsx' END AS path,
               event_type AS category, CASE WHEN user_id % 30 = 3 THEN NULL ELSE user_id END AS owner,
               CASE WHEN user_id % 8 = 7 THEN NULL ELSE user_id % 8 END AS office, ts AS modified
        FROM <events>""",
    "in_notices": """
        SELECT substring(CAST(o_orderdate AS STRING), 1, 10) || ' ' ||
               lpad(CAST(o_orderkey % 3 AS STRING), 2, '0') || '-30 ' ||
               CASE WHEN o_orderkey % 11 = 0 THEN 'notice ' ELSE 'Notice ' END ||
               CAST(o_orderkey AS STRING) || CASE WHEN o_orderkey % 5 < 2 THEN '.pdf' ELSE '.xlsx' END AS name,
               o_orderkey, o_custkey
        FROM <orders>""",
}


class Tables:
    """The star-schema tables of one folder and the stand-ins built from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getitem__(self, name: str) -> DataFrame:
        if name in INPUTS:
            return self.sql(INPUTS[name])
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Shared SQL on the raw tables, written ``<table>``."""
        used = {t: self[t] for t in TABLES if f"<{t}>" in text}
        query = text.replace('"', "`")
        for name in used:
            query = query.replace(f"<{name}>", f"{{{name}}}")
        return self.spark.sql(query, **used)


def check_sql(text: str) -> str:
    """Shared or checking SQL in the checking engine's dialect, with the stand-ins it mentions put in front."""
    body = _dialect(text)
    named = [name for name in INPUTS if name in text]
    if not named:
        return body
    inputs = ", ".join(f"{name} AS ({_dialect(INPUTS[name])})" for name in named)
    stripped = body.lstrip()
    if stripped.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {inputs}, {stripped[len('WITH RECURSIVE'):]}"
    if stripped.upper().startswith("WITH"):
        return f"WITH {inputs}, {stripped[len('WITH'):]}"
    return f"WITH {inputs} {stripped}"


def _dialect(text: str) -> str:
    result = text.replace("TIMESTAMP_NTZ", "TIMESTAMP")
    for name in TABLES:
        result = result.replace(f"<{name}>", name)
    return result


def register(sql: str | None = None, name: str | None = None):
    """Register ``function(tables)`` under its own name, with its checking SQL where there is one."""

    def add(function: Callable[[Tables], DataFrame]):
        key = name or function.__name__
        QUERIES[key] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            SQL[key] = check_sql(sql)
        return function

    return add
