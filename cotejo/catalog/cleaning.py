"""Cleaning, typing and column-shaping queries."""

from pyspark.sql import functions as F

from cotejo.catalog.registry import register
from cotejo.functions import clean
from cotejo.operators import filters, setops, shape
from cotejo.sources import datasets
from cotejo.values import PAYMENT_NULL_MARKERS

NUMBER_TEXT = """CASE CAST(event_id % 8 AS INT) WHEN 0 THEN CAST(user_id AS STRING) WHEN 1 THEN 'IMPORTE' WHEN 2 THEN NULL
    WHEN 3 THEN 'nan' WHEN 4 THEN '1d' WHEN 5 THEN ' ' || CAST(user_id AS STRING) || '.5 ' WHEN 6 THEN '1e3'
    ELSE '-' || CAST(user_id AS STRING) END"""
MARKER_TEXT = """CASE CAST(event_id % 9 AS INT) WHEN 0 THEN ' x ' WHEN 1 THEN '' WHEN 2 THEN 'NaT' WHEN 3 THEN ' N/A'
    WHEN 4 THEN '<NA>' WHEN 5 THEN 'None ' WHEN 6 THEN 'NULL' WHEN 7 THEN 'nano' ELSE event_type END"""
DATE_TEXT = """CASE CAST(o_orderkey % 6 AS INT) WHEN 0 THEN '31/02/2025' WHEN 1 THEN '2025-02-05' WHEN 2 THEN NULL
    WHEN 3 THEN lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || '/' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0')
                || '/' || CAST(year(o_orderdate) AS STRING)
    ELSE CAST(day(o_orderdate) AS STRING) || '/' || CAST(month(o_orderdate) AS STRING) || '/'
         || CAST(year(o_orderdate) AS STRING) END"""
PAYMENT = f"""
    SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'F-' || CAST(user_id AS STRING) END AS folio_fiscal,
           {NUMBER_TEXT} AS importe FROM <events>"""
VALID = "regexp_full_match(trim(importe), '[+-]?[0-9]+([.][0-9]+)?(e[0-9]+)?') AND folio_fiscal IS NOT NULL"


@register(
    f"""SELECT event_id, CASE WHEN lower(trim(raw)) NOT IN ('', 'nat', 'nan', 'none', 'null', 'n/a', '<na>')
              THEN trim(raw) END AS text,
              CASE WHEN lower(trim(raw)) NOT IN ('', 'nat', 'nan', 'none', 'null') THEN trim(raw) END AS payment_text
       FROM (SELECT event_id, {MARKER_TEXT} AS raw FROM events)"""
)
def null_markers(t):
    raw = t.sql(f"SELECT event_id, {MARKER_TEXT} AS raw FROM <events>")
    return raw.select(
        "event_id",
        clean.null_markers("raw").alias("text"),
        clean.null_markers("raw", PAYMENT_NULL_MARKERS).alias("payment_text"),
    )


@register(
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 6 IN (0, 1, 2) THEN TIMESTAMP '1900-01-01'
              ELSE date_trunc('day', o_orderdate) END AS parsed FROM orders"""
)
def parse_date_sentinel(t):
    raw = t.sql(f"SELECT o_orderkey, {DATE_TEXT} AS raw FROM <orders>")
    return raw.select("o_orderkey", clean.parse_date_sentinel("raw").alias("parsed"))


@register(
    f"""SELECT event_id, CASE WHEN regexp_full_match(trim(raw), '[+-]?[0-9]+([.][0-9]+)?(e[0-9]+)?')
              THEN TRY_CAST(trim(raw) AS DOUBLE) END AS number
       FROM (SELECT event_id, {NUMBER_TEXT} AS raw FROM events)"""
)
def to_number(t):
    raw = t.sql(f"SELECT event_id, {NUMBER_TEXT} AS raw FROM <events>")
    return raw.select("event_id", clean.to_number("raw").alias("number"))


@register(
    f"""SELECT event_id, CASE WHEN n = floor(n) THEN CAST(n AS BIGINT) END AS lenient,
              CAST(floor(n) AS BIGINT) AS strict
       FROM (SELECT event_id, CASE WHEN regexp_full_match(trim(raw), '[+-]?[0-9]+([.][0-9]+)?(e[0-9]+)?')
                    THEN TRY_CAST(trim(raw) AS DOUBLE) END AS n
             FROM (SELECT event_id, {NUMBER_TEXT} AS raw FROM events))"""
)
def to_integer(t):
    """The strict mode fails on fractions (tested in pytest), so here it gets the texts of the whole parts."""
    raw = t.sql(f"SELECT event_id, {NUMBER_TEXT} AS raw FROM <events>")
    whole = F.coalesce(F.floor(clean.to_number("raw")).cast("string"), F.col("raw"))
    return raw.select(
        "event_id",
        clean.to_integer("raw", on_fraction="null").alias("lenient"),
        clean.to_integer(whole).alias("strict"),
    )


@register(
    """SELECT doc_id, regexp_replace(text, '[\\s\\x0b\\x1c-\\x1f\\x85\\p{Z}]+', '', 'g') AS key FROM documents
       UNION ALL SELECT -1 - l_orderkey, CASE WHEN l_returnflag = 'R' THEN 'nan' ELSE l_linestatus || l_linenumber END
       FROM lineitem"""
)
def strip_key(t):
    spaced = F.concat_ws("\t ", "l_linestatus", "l_linenumber")
    short = t["lineitem"].select(
        (F.lit(-1) - F.col("l_orderkey")).alias("doc_id"), F.when(F.col("l_returnflag") != "R", spaced).alias("text")
    )
    texts = t["documents"].select("doc_id", "text").unionByName(short)
    return texts.select("doc_id", clean.strip_key("text").alias("key"))


@register("""SELECT l_orderkey, l_partkey, l_extendedprice AS plus, -l_extendedprice AS minus FROM lineitem""")
def parse_currency(t):
    text = F.concat(F.lit("$"), F.format_number("l_extendedprice", 2))
    return t["lineitem"].select(
        "l_orderkey",
        "l_partkey",
        clean.parse_currency(text).alias("plus"),
        clean.parse_currency(F.concat(F.lit("-"), text)).alias("minus"),
    )


@register(
    """SELECT numero_orden_suministro, file_date,
              coalesce(fechaaltatrunc, DATE '1900-01-01') AS fechaaltatrunc,
              coalesce(CASE WHEN importe > 200000 THEN 'late' END, '1900-01-01 00:00:00') AS update_note,
              estado_de_la_factura FROM in_history"""
)
def date_sentinel_by_name(t):
    rows = t["in_history"].withColumn("update_note", F.when(F.col("importe") > 200000, F.lit("late"))).drop("importe")
    return clean.fill_dates_by_name(rows)


@register(
    """SELECT o_orderkey, regexp_replace(regexp_replace(regexp_replace(lower(trim(n)), '[^a-z0-9_]', '_', 'g'),
              '_+', '_', 'g'), '^([0-9])', 'col_\\1') AS identifier
       FROM (SELECT o_orderkey, ' ' || o_orderpriority || '--Número ' || o_orderstatus || ' ' AS n FROM orders
             UNION ALL SELECT p_partkey, p_name || '(' || p_brand || ')' FROM part)"""
)
def normalize_identifier(t):
    names = t["orders"].select(
        "o_orderkey", F.concat(F.lit(" "), "o_orderpriority", F.lit("--Número "), "o_orderstatus", F.lit(" ")).alias("n")
    )
    parts = t["part"].select("p_partkey", F.concat("p_name", F.lit("("), "p_brand", F.lit(")")))
    return names.union(parts).select("o_orderkey", clean.normalize_identifier_column("n").alias("identifier"))


@register(
    """SELECT doc_id, lower(trim(regexp_replace(text, '[\\s\\x0b\\x1c-\\x1f\\x85\\p{Z}]+', ' ', 'g'))) AS header
       FROM documents"""
)
def normalize_header(t):
    return t["documents"].select("doc_id", clean.normalize_header_column("text").alias("header"))


@register(
    """SELECT c_custkey AS "Customer key", c_name AS "Name", c_acctbal AS "Balance" FROM customer"""
)
def clean_table(t):
    raw = t["customer"].select(
        F.col("c_custkey").alias(" Customer   key "),
        F.lit(None).cast("string").alias("Unnamed: 1"),
        F.col("c_name").alias("Name"),
        F.col("c_nationkey").alias("Unnamed"),
        F.col("c_acctbal").alias("Balance "),
        F.col("c_mktsegment").alias("unnamed extra"),
    )
    return shape.drop_unnamed(shape.clean_table(raw))


@register("""SELECT o_totalprice, o_orderkey FROM orders""")
def project_existing(t):
    return shape.project_existing(t["orders"], ["o_totalprice", "o_missing", "o_orderkey"])


@register("""SELECT * EXCLUDE (o_custkey, o_orderpriority) FROM orders""")
def drop_if_present(t):
    return t["orders"].drop("o_custkey", "o_orderpriority", "razon_social")


@register(
    """SELECT *, TIMESTAMP '2024-01-31 10:00:00' AS file_date, 'orders.parquet' AS source FROM orders"""
)
def stamp_snapshot(t):
    from cotejo.plans.integrate import stamp

    # The scan may be one file or a folder of parts; the table's own name is the same either way.
    table = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+\.parquet)(/[^/]*)?$", 1)
    return t["orders"].select("*", stamp("2024-01-31 10:45:00").alias("file_date"), table.alias("source"))


@register("""SELECT o_orderkey, o_orderstatus AS portal_o_orderstatus, o_totalprice AS portal_o_totalprice FROM orders""")
def prefix_rename(t):
    rows = t["orders"].select("o_orderkey", "o_orderstatus", "o_totalprice")
    return shape.prefix_columns(rows, ["o_orderstatus", "o_totalprice", "absent"], "portal_")


@register("""SELECT estado_de_la_factura AS status, numero_orden_suministro AS order_id, count(*) AS n
             FROM in_history GROUP BY 1, 2""")
def resolve_column(t):
    rows = t["in_history"]
    status, order = shape.resolve_column(rows, "estado"), shape.resolve_column(rows, "numero", "orden")
    return rows.groupBy(F.col(status).alias("status"), F.col(order).alias("order_id")).agg(F.count("*").alias("n"))


@register(
    """SELECT l_orderkey, l_partkey, CASE WHEN s <> '' AND f <> '' THEN s || '-' || f
              ELSE coalesce(nullif(f, ''), nullif(s, ''), '') END AS folio
       FROM (SELECT l_orderkey, l_partkey,
                    CASE l_returnflag WHEN 'A' THEN 'S' WHEN 'N' THEN '' END AS s,
                    CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN '' ELSE '00' || l_partkey END AS f
             FROM lineitem)"""
)
def series_folio(t):
    series = F.when(F.col("l_returnflag") == "A", F.lit("S")).when(F.col("l_returnflag") == "N", F.lit(""))
    folio = F.when(F.col("l_linenumber") == 2, F.lit("")).when(
        F.col("l_linenumber") != 1, F.concat(F.lit("00"), F.col("l_partkey").cast("string"))
    )
    return t["lineitem"].select("l_orderkey", "l_partkey", clean.series_folio(series, folio).alias("folio"))


def _payments(t):
    return t.sql(PAYMENT)


@register(
    f"""SELECT event_id, folio_fiscal, TRY_CAST(trim(importe) AS DOUBLE) AS importe
        FROM ({PAYMENT.replace("<events>", "events")}) WHERE coalesce({VALID}, false)"""
)
def split_valid(t):
    return filters.split_payments(_payments(t))[0]


@register(f"""SELECT * FROM ({PAYMENT.replace("<events>", "events")}) WHERE NOT coalesce({VALID}, false)""")
def split_rejected(t):
    return filters.split_payments(_payments(t))[1]


@register(
    """SELECT o_orderkey AS id, CAST(o_totalprice AS DOUBLE) AS amount, o_orderstatus AS state FROM orders
       UNION ALL SELECT l_orderkey, l_extendedprice, NULL FROM lineitem"""
)
def union_by_position(t):
    first = t["orders"].select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("state"))
    return setops.union_by_position([first, t["lineitem"].select("l_orderkey", "l_extendedprice")])


@register(
    """SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, NULL AS nation FROM customer
       UNION ALL SELECT s_name, s_acctbal, NULL, s_nationkey FROM supplier"""
)
def union_by_name(t):
    customers = t["customer"].select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    suppliers = t["supplier"].select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return setops.union_by_name([customers, suppliers])


@register(
    """SELECT 0 AS header_id, o_orderkey AS id, o_totalprice AS amount, NULL AS note FROM orders WHERE o_orderstatus <> 'P'
       UNION ALL SELECT 1, o_orderkey, NULL, o_orderpriority FROM orders WHERE o_orderstatus = 'P'"""
)
def concat_by_header(t):
    orders = t["orders"]
    frames = [
        orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount")),
        orders.filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("note")),
        orders.filter("o_orderstatus = 'O'").select(F.col("o_totalprice").alias("amount"), F.col("o_orderkey").alias("id")),
    ]
    groups = setops.concat_by_header(frames)
    return setops.union_by_name([g.withColumn("header_id", F.lit(i)) for i, g in enumerate(groups)])


@register(
    """SELECT c_name AS "Name", c_acctbal AS "Balance", NULL AS "Nation" FROM customer
       UNION ALL SELECT s_name, s_acctbal, s_nationkey FROM supplier"""
)
def multi_sheet_union(t):
    customers = t["customer"].select(
        F.col("c_name").alias(" Name"), F.lit("x").alias("Unnamed: 1"), F.col("c_acctbal").alias("Balance")
    )
    suppliers = t["supplier"].select(
        F.col("s_name").alias("Name"), F.col("s_nationkey").alias("Nation "), F.col("s_acctbal").alias("Balance")
    )
    return datasets.union_sheets([customers, suppliers])


@register("""SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders""")
def history_scan(t):
    return datasets.scan_history_sheets(t.spark, t.folder, "orders.parquet").select("o_orderkey", "o_orderstatus", "o_totalprice")
