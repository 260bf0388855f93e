"""Lookups, de-duplication, integration and history queries."""

from pyspark.sql import functions as F

from cotejo.catalog.registry import LINE_PART_WIDTH, ORDER_ID, register
from cotejo.operators import checks, dedup, filters, history, lookup
from cotejo.plans import integrate as plan
from cotejo.plans.invoices import load_invoices as invoice_load
from cotejo.plans.run_all import Inputs, stored_orders
from cotejo.session import shared_folder
from cotejo.sinks.snapshots import HistoryTable
from cotejo.values import HISTORY_KEY

WIDE = {"part_width": LINE_PART_WIDTH}
SNAPSHOT = "2024-01-31 10:45:00"

# Checking SQL shared by several queries.
UNIQUE_INVOICES = """
    single AS (
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY "Referencia", "Factura" ORDER BY _row_no) AS rn FROM (
                SELECT * REPLACE (regexp_replace("Referencia", '\\s+', '', 'g') AS "Referencia",
                                  regexp_replace("Factura", '\\s+', '', 'g') AS "Factura")
                FROM in_invoices WHERE "UUID Descripción" = 'Vigente')) WHERE rn = 1)"""
BACKFILLED = """
    kept AS (SELECT * FROM in_accounts WHERE "Estado de la factura" IS DISTINCT FROM 'Cancelado'),
    found AS (SELECT "UUID", string_agg("Referencia", ',' ORDER BY _row_no, "Referencia") AS ref FROM single GROUP BY 1),
    fills AS (
        SELECT DISTINCT k."Folio fiscal" AS folio, coalesce(f.ref, 'no localizado') AS ref
        FROM kept k LEFT JOIN found f ON k."Folio fiscal" = f."UUID"
        WHERE k."Orden de suministro" IS NULL AND k."Folio fiscal" IS NOT NULL),
    accounts_done AS (
        SELECT k."Folio fiscal", coalesce(f.ref, k."Orden de suministro") AS "Orden de suministro",
               k."Estado de la factura",
               CAST(replace(replace(k."Total", '$', ''), ',', '') AS DOUBLE) AS "Total", k._row_no
        FROM kept k LEFT JOIN fills f ON k."Folio fiscal" = f.folio)"""
PRICED = """
    priced AS (
        SELECT *, precio_unitario * CAST(cantidad_solicitada AS DOUBLE) AS "Importe" FROM in_orders)"""


@register(
    """SELECT numero_orden_suministro, precio_unitario, cantidad_solicitada,
              precio_unitario * CAST(cantidad_solicitada AS DOUBLE) AS "Importe" FROM in_orders"""
)
def line_amount(t):
    columns = ("numero_orden_suministro", "precio_unitario", "cantidad_solicitada", "Importe")
    return plan.with_amount(t["in_orders"]).select(*columns)


@register("""SELECT * FROM in_invoices WHERE "UUID Descripción" = 'Vigente'""")
def active_only(t):
    return filters.active_only(t["in_invoices"], "UUID Descripción")


@register("""SELECT * FROM in_accounts WHERE "Estado de la factura" IS DISTINCT FROM 'Cancelado'""")
def not_cancelled(t):
    return filters.not_cancelled(t["in_accounts"], "Estado de la factura")


@register(
    """WITH r AS (
        SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY _row_no, CAST(l_partkey AS VARCHAR)) AS parts,
               string_agg(coalesce(CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, 'nan'), ','
                          ORDER BY _row_no, l_returnflag) AS flags
        FROM in_lines GROUP BY 1)
       SELECT o_orderkey, o_custkey, coalesce(parts, 'no localizado') AS parts, coalesce(flags, 'no localizado') AS flags
       FROM orders LEFT JOIN r ON o_orderkey = l_orderkey"""
)
def populate_single_key(t):
    lines = t["in_lines"].select(
        "l_orderkey",
        F.col("l_partkey").alias("parts"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flags"),
        "_row_no",
    )
    spec = lookup.LookupSpec(("o_orderkey",), ("l_orderkey",), ("parts", "flags"))
    return lookup.populate(t["orders"].select("o_orderkey", "o_custkey"), lines, spec, **WIDE)


@register(
    """WITH r AS (
        SELECT o_orderkey, o_totalprice, string_agg(o_orderpriority, ',' ORDER BY o_orderkey) AS priority
        FROM orders GROUP BY 1, 2),
       l AS (SELECT l_orderkey, l_linenumber,
                    CASE WHEN l_linenumber > 3 THEN o_totalprice ELSE l_extendedprice END AS amount
             FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)
       SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, amount,
              coalesce(priority, 'no localizado') AS priority
       FROM l LEFT JOIN r ON l_orderkey = o_orderkey AND amount = o_totalprice"""
)
def populate_multi_key(t):
    orders = t["orders"].select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("priority"))
    lines = (
        t["lineitem"]
        .join(orders.select("o_orderkey", "o_totalprice"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .select(
            "l_orderkey",
            F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
            F.when(F.col("l_linenumber") > 3, F.col("o_totalprice")).otherwise(F.col("l_extendedprice")).alias("amount"),
        )
    )
    spec = lookup.LookupSpec(("l_orderkey", "amount"), ("o_orderkey", "o_totalprice"), ("priority",))
    return lookup.populate(lines, orders, spec, order="o_orderkey")


@register(
    """SELECT l_orderkey, floor(_row_no / 5000000000)::BIGINT AS part, count(*) AS part_rows,
              string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY _row_no, CAST(l_partkey AS VARCHAR)) AS parts
       FROM in_lines GROUP BY 1, 2"""
)
def lookup_parts(t):
    lines = t["in_lines"].select("l_orderkey", F.col("l_partkey").alias("parts"), "_row_no")
    spec = lookup.LookupSpec(("o_orderkey",), ("l_orderkey",), ("parts",))
    parts = lookup.collapse_parts(lines, spec, **WIDE)
    return parts.select("l_orderkey", F.col("_part").alias("part"), F.col("_rows").alias("part_rows"), "parts")


@register(
    """SELECT count(*) AS left_rows, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey))
              AS matched_rows,
              count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)) AS unmatched_rows
       FROM orders"""
)
def populate_metrics(t):
    spec = lookup.LookupSpec(("o_orderkey",), ("l_orderkey",), ("l_partkey",))
    return lookup.populate_metrics(t["orders"], t["lineitem"], spec)


@register(
    f"""WITH {UNIQUE_INVOICES}, {PRICED},
       notes AS (SELECT numero_orden_suministro, "Importe", string_agg(orden_remision, ',' ORDER BY _row_no) AS note
                 FROM priced GROUP BY 1, 2)
       SELECT s.*, coalesce(note, 'no localizado') AS orden_remision
       FROM single s LEFT JOIN notes n ON s."Referencia" = n.numero_orden_suministro AND s."Total" = n."Importe" """
)
def clean_invoices(t):
    return plan.clean_invoices(t["in_invoices"], plan.with_amount(t["in_orders"]), **WIDE)


@register(
    f"""WITH {PRICED},
       all_invoices AS (
        SELECT * FROM in_invoices UNION ALL
        SELECT numero_orden_suministro, 'X 1', "Importe", 'Vigente', 'X' || numero_orden_suministro, 'X', -_row_no FROM priced
        WHERE _row_no % 3 = 0),
       {UNIQUE_INVOICES.replace("FROM in_invoices", "FROM all_invoices")},
       notes AS (SELECT numero_orden_suministro, "Importe", string_agg(orden_remision, ',' ORDER BY _row_no) AS note
                 FROM priced GROUP BY 1, 2)
       SELECT s.*, coalesce(note, 'no localizado') AS orden_remision
       FROM single s LEFT JOIN notes n ON s."Referencia" = n.numero_orden_suministro AND s."Total" = n."Importe" """
)
def clean_invoices_matched(t):
    """As ``clean_invoices``, with an invoice over the whole amount for every third order."""
    priced, invoices = plan.with_amount(t["in_orders"]), t["in_invoices"]
    order = F.col("numero_orden_suministro")
    whole = priced.filter("_row_no % 3 = 0").select(
        order.alias("Referencia"), F.lit("X 1").alias("Factura"), F.col("Importe").alias("Total"), F.lit("Vigente").alias("UUID Descripción"),
        F.concat(F.lit("X"), order).alias("UUID"), F.lit("X").alias("Folio"), (-F.col("_row_no")).alias("_row_no"),
    )
    return plan.clean_invoices(invoices.unionByName(whole), priced, **WIDE)


@register(f"""WITH {UNIQUE_INVOICES}, {BACKFILLED} SELECT * FROM accounts_done""")
def backfill_order_key(t):
    return plan.clean_accounts(t["in_accounts"], plan.unique_invoices(t["in_invoices"]), **WIDE)


@register(
    f"""WITH {UNIQUE_INVOICES}, {BACKFILLED}, {PRICED},
       bills AS (SELECT "Referencia", string_agg("UUID", ',' ORDER BY _row_no, "UUID") AS "UUID",
                        string_agg("Folio", ',' ORDER BY _row_no, "Folio") AS "Folio" FROM single GROUP BY 1),
       states AS (SELECT "Orden de suministro" AS o,
                         string_agg(coalesce("Estado de la factura", 'nan'), ','
                                    ORDER BY _row_no, coalesce("Estado de la factura", 'nan')) AS st
                  FROM accounts_done WHERE "Orden de suministro" IS NOT NULL GROUP BY 1),
       fines AS (SELECT "ORDEN DE SUMINISTRO" AS o, string_agg("PENA", ',' ORDER BY _row_no, "PENA") AS pena,
                        string_agg("OFICIO", ',' ORDER BY _row_no, "OFICIO") AS oficio FROM in_penalties GROUP BY 1)
       SELECT p.numero_orden_suministro, p.precio_unitario, p.cantidad_solicitada, p.orden_remision, p.numero_contrato,
              p._row_no, p."Importe", coalesce(b."UUID", 'no localizado') AS "UUID",
              coalesce(b."Folio", 'no localizado') AS "Folio",
              coalesce(s.st, 'no localizado') AS "Estado de la factura",
              TRY_CAST(f.pena AS DOUBLE) AS "PENA", coalesce(f.oficio, 'no localizado') AS "OFICIO",
              TIMESTAMP '2024-01-31 10:00:00' AS file_date
       FROM priced p LEFT JOIN bills b ON p.numero_orden_suministro = b."Referencia"
       LEFT JOIN states s ON p.numero_orden_suministro = s.o
       LEFT JOIN fines f ON p.numero_orden_suministro = f.o"""
)
def integrate_orders(t):
    inputs = (t["in_orders"], t["in_invoices"], t["in_accounts"], t["in_penalties"])
    return plan.integrate(*inputs, SNAPSHOT, **WIDE).orders


def _xml_lines(t):
    """Two XML lines per part; the first one is kept."""
    return t["part"].select(
        F.explode(F.array(F.lit(1), F.lit(2))).alias("line_no"),
        F.when(F.col("p_partkey") % 13 != 0, F.concat(F.lit("F"), F.col("p_partkey").cast("string"))).alias("Folio"),
        F.concat(F.lit("U"), F.col("p_partkey").cast("string")).alias("UUID"),
        F.concat_ws(" ", "p_name", "line_no").alias("Descripcion"),
        (F.col("p_partkey") * 2 + F.col("line_no")).alias("_row_no"),
    ).drop("line_no")


def _catalog(t):
    """Invoices by part; every eleventh lacks its number."""
    return t["in_lines"].select(
        F.col("l_orderkey").alias("Referencia"),
        F.when(F.col("l_partkey") % 11 != 0, F.concat(F.lit("F"), F.col("l_partkey").cast("string"))).alias("Factura"),
        F.col("l_extendedprice").alias("Total"),
        F.when(F.col("l_returnflag") == "R", F.lit("Cancelado")).otherwise(F.lit("Vigente")).alias("UUID Descripción"),
    )


def _tax_status(t):
    return t["part"].select(
        F.when(F.col("p_partkey") % 10 != 0, F.concat(F.lit("U"), F.col("p_partkey").cast("string"))).alias("uuid"),
        F.when(F.col("p_size") % 2 == 0, F.lit("Cancelado")).otherwise(F.lit("Vigente")).alias("estado"),
    )


CATALOG_SQL = """
    lines AS (
        SELECT CASE WHEN p_partkey % 13 <> 0 THEN 'F' || p_partkey END AS "Folio", 'U' || p_partkey AS "UUID",
               p_name || ' ' || n AS "Descripcion", p_partkey * 2 + n AS r
        FROM part, (VALUES (1), (2)) v(n)),
    firsts AS (SELECT "Folio", "UUID", "Descripcion" FROM lines
               QUALIFY row_number() OVER (PARTITION BY "Folio" ORDER BY r) = 1),
    catalog AS (
        SELECT l_orderkey AS "Referencia", CASE WHEN l_partkey % 11 <> 0 THEN 'F' || l_partkey END AS "Factura",
               l_extendedprice AS "Total", CASE l_returnflag WHEN 'R' THEN 'Cancelado' ELSE 'Vigente' END AS state
        FROM in_lines),
    joined AS (SELECT c.*, f.* FROM catalog c LEFT JOIN firsts f ON c."Factura" IS NOT DISTINCT FROM f."Folio"),
    struck AS (SELECT DISTINCT 'U' || p_partkey AS uuid FROM part WHERE p_size % 2 = 0 AND p_partkey % 10 <> 0)"""


@register(f"""WITH {CATALOG_SQL} SELECT * EXCLUDE (state), state AS "UUID Descripción" FROM joined""")
def invoice_xml_join(t):
    return lookup.join_first(_catalog(t), _xml_lines(t), "Factura", "Folio").drop("_row_no")


@register(
    f"""WITH {CATALOG_SQL} SELECT "Referencia", "UUID",
        CASE WHEN "UUID" IN (SELECT uuid FROM struck) THEN 'Cancelado' ELSE state END AS "UUID Descripción"
        FROM joined"""
)
def mark_cancelled(t):
    joined = lookup.join_first(_catalog(t), _xml_lines(t), "Factura", "Folio")
    listed = _tax_status(t).filter("estado = 'Cancelado'")
    marked = lookup.mark_listed(joined, "UUID", listed, "uuid", "UUID Descripción", "Cancelado")
    return marked.select("Referencia", "UUID", "UUID Descripción")


@register(
    f"""WITH {CATALOG_SQL} SELECT * EXCLUDE (state),
        CASE WHEN "UUID" IN (SELECT uuid FROM struck) THEN 'Cancelado' ELSE state END AS "UUID Descripción"
        FROM joined"""
)
def load_invoices(t):
    stacked = _catalog(t)
    returned = F.col("UUID Descripción") == "Cancelado"
    other = stacked.filter(returned).toDF("order", "invoice", "amount", "state")
    return invoice_load([stacked.filter(~returned), other], _xml_lines(t), _tax_status(t)).drop("_row_no")


KEY = ["l_orderkey", "l_linenumber"]


@register(
    """SELECT * FROM in_lines QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY _row_no) = 1"""
)
def dedup_first(t):
    return dedup.dedup_first(t["in_lines"], KEY)


@register(
    """SELECT * FROM in_lines
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY _row_no DESC) = 1"""
)
def dedup_last(t):
    return dedup.dedup_last(t["in_lines"], KEY)


@register(
    """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, count(*) FILTER (WHERE n > 1) AS duplicated_keys
       FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"""
)
def duplicate_count(t):
    return dedup.duplicate_count(t["lineitem"], KEY)


def _target_and_batch(t):
    lines = t["in_lines"]
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    return dedup.dedup_first(lines.filter(F.col("l_shipdate") < cut), KEY), lines.filter(F.col("l_shipdate") >= cut)


INSERT = """
    WITH target AS (SELECT * FROM in_lines WHERE l_shipdate < TIMESTAMP '1998-01-01'
                    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY _row_no) = 1),
         batch AS (SELECT * FROM in_lines WHERE l_shipdate >= TIMESTAMP '1998-01-01'
                   QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY _row_no {order}) = 1)
    SELECT * FROM target UNION ALL
    SELECT * FROM batch b WHERE NOT EXISTS (
        SELECT 1 FROM target t WHERE t.l_orderkey = b.l_orderkey AND t.l_linenumber = b.l_linenumber)"""


@register(INSERT.format(order="DESC"))
def insert_if_absent(t):
    return history.insert_if_absent(*_target_and_batch(t), KEY, keep="last")


@register(INSERT.format(order="ASC"))
def insert_if_absent_first(t):
    return history.insert_if_absent(*_target_and_batch(t), KEY, keep="first")


@register(
    """SELECT numero_orden_suministro, estado_de_la_factura, fechaaltatrunc FROM in_history
       WHERE estado_de_la_factura IS NULL OR fechaaltatrunc IS NULL"""
)
def pk_check(t):
    rows = t["in_history"].select("numero_orden_suministro", "estado_de_la_factura", "fechaaltatrunc")
    return history.split_null_keys(rows, ["Estado de la factura", "fechaAltaTrunc"])[1]


def _snapshot_sheets(t):
    """Two snapshot sheets with raw text, overlapping keys and a column that is dropped at load."""
    day = "CAST(day({d}) AS STRING) || '/' || CAST(month({d}) AS STRING) || '/' || CAST(year({d}) AS STRING)"
    first = t.sql(
        f"""SELECT CASE WHEN o_orderkey % 23 <> 5 THEN {ORDER_ID.format(k="o_orderkey")} END AS numero_orden_suministro,
                   CAST(DATE '2024-01-01' + CAST(o_orderkey % 3 AS INT) AS TIMESTAMP_NTZ) AS file_date,
                   CASE WHEN o_orderkey % 9 = 0 THEN ' N/A ' ELSE {day.format(d="o_orderdate")} END
                       AS fecha_autorizacion,
                   CAST(o_orderkey % 90 AS STRING) || '.0' AS precio_unitario,
                   CASE WHEN o_orderkey % 4 = 0 THEN 'x' ELSE CAST(o_custkey AS STRING) END AS cantidad_solicitada,
                   CAST(o_totalprice AS STRING) AS "Importe", ' ' || o_orderpriority || ' ' AS numero_contrato,
                   o_orderstatus AS razon_social, CAST(o_orderkey AS STRING) AS "Unnamed: 7",
                   o_orderkey AS _row_no FROM <orders>"""
    )
    second = t.sql(
        f"""SELECT {ORDER_ID.format(k="o_orderkey - o_orderkey % 2")} AS numero_orden_suministro,
                   CAST(DATE '2024-01-03' + CAST(o_orderkey % 2 AS INT) AS TIMESTAMP_NTZ) AS file_date,
                   '7' AS precio_unitario, CASE WHEN o_custkey % 3 = 0 THEN '' ELSE 'none' END AS cantidad_solicitada,
                   'nan' AS "Importe", 'null' AS numero_contrato, CAST(o_custkey AS STRING) AS "PENA",
                   o_orderkey + 1000000000000 AS _row_no FROM <orders>"""
    )
    return [first, second]


@register(
    """WITH sheets AS (
        SELECT CASE WHEN o_orderkey % 23 <> 5 THEN 'OS-' || CAST(o_orderkey AS VARCHAR) END AS k, CAST(DATE '2024-01-01' + CAST(o_orderkey % 3 AS INT) AS TIMESTAMP) AS d,
               CASE WHEN o_orderkey % 9 = 0 THEN TIMESTAMP '1900-01-01' ELSE date_trunc('day', o_orderdate) END AS f,
               o_orderkey % 90 AS p, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey END AS q,
               o_totalprice AS i, o_orderpriority AS c, NULL AS pena, o_orderkey AS r FROM orders
        UNION ALL
        SELECT 'OS-' || CAST(o_orderkey - o_orderkey % 2 AS VARCHAR), CAST(DATE '2024-01-03' + CAST(o_orderkey % 2 AS INT) AS TIMESTAMP),
               TIMESTAMP '1900-01-01', 7, NULL, NULL, NULL, CAST(o_custkey AS DOUBLE), o_orderkey + 1000000000000 FROM orders),
       batch AS (SELECT * FROM sheets WHERE k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k, d ORDER BY r DESC) = 1),
       target AS (SELECT numero_orden_suministro AS k, file_date AS d, importe AS i FROM in_history)
       SELECT k AS numero_orden_suministro, d AS file_date, NULL AS fecha_autorizacion, NULL AS precio_unitario,
              NULL AS cantidad_solicitada, i AS importe, NULL AS numero_contrato, NULL AS pena, false AS rejected FROM target
       UNION ALL
       SELECT k, d, f, p, q, i, c, pena, false FROM batch
       WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.k = batch.k AND t.d = batch.d)
       UNION ALL SELECT k, d, f, p, q, i, c, pena, true FROM sheets WHERE k IS NULL"""
)
def load_history(t):
    target = t["in_history"].select("numero_orden_suministro", "file_date", "importe")
    loaded, rejected = history.load_history_split(target, _snapshot_sheets(t))
    flagged = loaded.withColumn("rejected", F.lit(False)).unionByName(rejected.withColumn("rejected", F.lit(True)))
    return flagged.drop("_row_no")


@register(
    """SELECT count(*) AS rows, count(*) FILTER (WHERE "UUID Descripción" = 'Vigente') AS active,
              count(*) FILTER (WHERE "UUID Descripción" = 'Cancelado') AS cancelled,
              count(*) FILTER (WHERE "UUID Descripción" IS NULL) AS without_status,
              count(*) FILTER (WHERE regexp_matches("Referencia", '\\s')) AS spaced_keys
       FROM in_invoices"""
)
def quality_metrics(t):
    status = F.col("UUID Descripción")
    return checks.quality_metrics(
        t["in_invoices"],
        active=status == "Vigente",
        cancelled=status == "Cancelado",
        without_status=status.isNull(),
        spaced_keys=F.col("Referencia").rlike(r"\s"),
    )


def _work_and_results(t):
    """Customers as work rows with three keys, orders as search results."""
    work = t["customer"].select(
        F.col("c_custkey").alias("row_id"),
        F.when(F.col("c_custkey") % 4 != 0, F.concat(F.lit("F"), F.col("c_custkey").cast("string"))).alias("factura"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("nan"))
        .otherwise(F.concat(F.lit("U"), F.col("c_nationkey").cast("string")))
        .alias("Folio fiscal"),
        F.concat(F.lit("OS-"), (F.col("c_custkey") * 2).cast("string")).alias("Orden de Suministro"),
    )
    work = work.unionByName(work.filter("row_id % 10 = 0"))  # repeated rows
    results = t["orders"].select(
        F.concat(F.lit("F"), F.col("o_custkey").cast("string")).alias("factura"),
        F.concat(F.lit("U"), (F.col("o_orderkey") % 40).cast("string")).alias("folio"),
        F.concat(F.lit("OS-"), F.col("o_orderkey").cast("string")).alias("orden"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Cancelado por proveedor")).otherwise(F.lit("Activo")).alias("estado"),
        F.col("o_orderkey").alias("result_id"),
    )
    return work, results


WORK_KEYS = ("factura", "Folio fiscal", "Orden de Suministro")
RESULT_KEYS = ("factura", "folio", "orden")
FALLBACK = """
    WITH work AS (
        SELECT c_custkey AS row_id, CASE WHEN c_custkey % 4 <> 0 THEN 'F' || c_custkey END AS factura,
               CASE WHEN c_custkey % 3 = 0 THEN 'nan' ELSE 'U' || c_nationkey END AS "Folio fiscal",
               'OS-' || (c_custkey * 2) AS "Orden de Suministro"
        FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey % 10 = 0)),
    alive AS (SELECT * FROM orders WHERE o_orderstatus <> 'F'),
    keys AS (
        SELECT k, min(o_orderkey) AS id FROM (
            SELECT 'F' || o_custkey AS k, o_orderkey FROM alive UNION ALL
            SELECT 'U' || (o_orderkey % 40), o_orderkey FROM alive UNION ALL
            SELECT 'OS-' || o_orderkey, o_orderkey FROM alive) GROUP BY 1),
    terms AS (
        SELECT row_id, 0 AS p, factura AS k FROM work UNION ALL
        SELECT row_id, 1, nullif("Folio fiscal", 'nan') FROM work UNION ALL
        SELECT row_id, 2, "Orden de Suministro" FROM work),
    hits AS (SELECT row_id, min(p) AS priority, arg_min(id, p) AS result_id FROM terms JOIN keys USING (k) {where} GROUP BY 1)
    SELECT w.*, CAST(h.priority AS BIGINT) AS priority, h.result_id FROM work w LEFT JOIN hits h USING (row_id)"""


def _fallback(t, work_keys=WORK_KEYS):
    work, results = _work_and_results(t)
    return lookup.fallback_lookup(work, work_keys, results, RESULT_KEYS, "estado", ("result_id",), ("result_id",))


@register(FALLBACK.format(where=""))
def fallback_lookup(t):
    return _fallback(t)


@register(f"""SELECT * FROM ({FALLBACK.format(where="")}) WHERE priority IS NULL""")
def fallback_unmatched(t):
    return _fallback(t).filter("priority is null")


@register(FALLBACK.format(where="WHERE p = 2").replace("CAST(h.priority AS BIGINT)", "CAST(h.priority - 2 AS BIGINT)"))
def fallback_order_only(t):
    return _fallback(t, ("Orden de Suministro",))


def _prefix_inputs(t):
    """Customer names as files, invoice numbers of two lengths as prefixes; some in upper case, some unknown."""
    name = F.format_string("Customer#%06d", F.col("o_custkey") % 2000)
    longer = F.format_string("Customer#%09d", F.col("o_orderkey"))
    wanted = t["orders"].select(
        "o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.upper(longer)).otherwise(F.concat(name, F.lit(" "))).alias("Folio")
    )
    files = t["customer"].select(
        F.concat("c_name", F.lit(".PDF")).alias("name"), F.concat(F.lit("/pdf/"), "c_name").alias("path"), "c_custkey"
    )
    return wanted, files


PREFIX = """
    WITH wanted AS (
        SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN upper(printf('Customer#%09d', o_orderkey))
                                ELSE printf('Customer#%06d', o_custkey % 2000) || ' ' END AS "Folio" FROM orders),
    keys AS (SELECT DISTINCT lower(trim("Folio")) AS k FROM wanted),
    hits AS (
        SELECT k, list('/pdf/' || c_name ORDER BY c_custkey) AS paths
        FROM keys JOIN customer ON starts_with(lower(c_name), k) GROUP BY 1)
    SELECT o_orderkey, "Folio", {columns} FROM wanted LEFT JOIN hits ON lower(trim("Folio")) = k WHERE {where}"""


def _prefix(t):
    wanted, files = _prefix_inputs(t)
    return lookup.prefix_matches(wanted, "Folio", files, "name", "path", ("c_custkey",))


@register(PREFIX.format(columns="paths[1] AS path", where="paths IS NOT NULL"))
def prefix_match_first(t):
    matched = _prefix(t).filter("matches is not null")
    return matched.select("o_orderkey", "Folio", F.element_at("matches", 1).alias("path"))


@register(PREFIX.format(columns="CAST(len(paths) AS BIGINT) AS listed, unnest(paths) AS path", where="len(paths) > 1"))
def prefix_match_dups(t):
    """Folios with several files: how many, and a row for each."""
    several = _prefix(t).filter(F.col("found") > 1).select("o_orderkey", "Folio", F.col("found").alias("listed"))
    return lookup.prefix_rows(several, "Folio", _prefix_inputs(t)[1], "name", "path")


@register(PREFIX.format(columns="1 AS missing", where="paths IS NULL").replace(", 1 AS missing", ""))
def prefix_unmatched(t):
    return _prefix(t).filter("matches is null").drop("matches", "found")


@register(
    """WITH docs AS (
        SELECT CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE 'U' || l_partkey END AS "UUID",
               'A-' || l_suppkey AS "Folio", 'f' || (l_orderkey % 500) || '.xml' AS "Archivo", l_orderkey, _row_no FROM in_lines),
       known AS (
        SELECT CASE WHEN p_partkey % 5 = 0 THEN 'U' || p_partkey END AS "UUID",
               'A-' || (p_partkey % 50) AS "Folio", 'f' || (p_partkey % 500) || '.xml' AS "Archivo" FROM part)
       SELECT * FROM docs d
       WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k."UUID" = d."UUID")
         AND NOT EXISTS (SELECT 1 FROM known k WHERE k."Folio" = d."Folio" AND k."Archivo" = d."Archivo")"""
)
def new_documents_only(t):
    docs = t["in_lines"].select(
        F.when(F.col("l_partkey") % 9 != 0, F.concat(F.lit("U"), F.col("l_partkey").cast("string"))).alias("UUID"),
        F.concat(F.lit("A-"), F.col("l_suppkey").cast("string")).alias("Folio"),
        F.format_string("f%d.xml", F.col("l_orderkey") % 500).alias("Archivo"),
        "l_orderkey",
        "_row_no",
    )
    known = t["part"].select(
        F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("U"), F.col("p_partkey").cast("string"))).alias("UUID"),
        F.concat(F.lit("A-"), (F.col("p_partkey") % 50).cast("string")).alias("Folio"),
        F.format_string("f%d.xml", F.col("p_partkey") % 500).alias("Archivo"),
    )
    return lookup.new_documents(docs, known)


def _stage_inputs(t):
    """Catalog rows numbered by part, XML lines and tax status of the parts."""
    catalog = t["in_invoices"].drop("UUID", "Factura", "Folio").withColumn("Factura", F.concat(F.lit("F"), _part_of("_row_no")))
    return catalog, _xml_lines(t).drop("Descripcion"), _tax_status(t)


def _part_of(row_no):
    return F.floor(F.col(row_no) / 100_000_000).cast("string")


@register(
    f"""WITH {CATALOG_SQL.replace("catalog AS", "unused AS").split("joined AS")[0].rstrip().rstrip(",")},
       struck AS (SELECT DISTINCT 'U' || p_partkey AS uuid FROM part WHERE p_size % 2 = 0 AND p_partkey % 10 <> 0),
       stacked AS (
        SELECT "Referencia", 'F' || CAST(floor(_row_no / 100000000) AS BIGINT) AS "Factura", "Total",
               "UUID Descripción" AS state, _row_no FROM in_invoices),
       loaded AS (
        SELECT c."Referencia", c."Factura", c._row_no, f."UUID", f."Folio",
               CASE WHEN f."UUID" IN (SELECT uuid FROM struck) THEN 'Cancelado' ELSE state END AS state
        FROM stacked c LEFT JOIN firsts f ON c."Factura" IS NOT DISTINCT FROM f."Folio"),
       single AS (
        SELECT * FROM (SELECT * REPLACE (regexp_replace("Referencia", '\\s+', '', 'g') AS "Referencia") FROM loaded
                       WHERE state = 'Vigente')
        QUALIFY row_number() OVER (PARTITION BY "Referencia", "Factura" ORDER BY _row_no) = 1),
       {BACKFILLED},
       bills AS (SELECT "Referencia", string_agg(coalesce("UUID", 'nan'), ',' ORDER BY _row_no, coalesce("UUID", 'nan')) AS uuid,
                        string_agg(coalesce("Folio", 'nan'), ',' ORDER BY _row_no, coalesce("Folio", 'nan')) AS folio
                 FROM single GROUP BY 1),
       states AS (SELECT "Orden de suministro" AS o,
                         string_agg(coalesce("Estado de la factura", 'nan'), ','
                                    ORDER BY _row_no, coalesce("Estado de la factura", 'nan')) AS st
                  FROM accounts_done WHERE "Orden de suministro" IS NOT NULL GROUP BY 1),
       fines AS (SELECT "ORDEN DE SUMINISTRO" AS o, string_agg("PENA", ',' ORDER BY _row_no, "PENA") AS pena,
                        string_agg("OFICIO", ',' ORDER BY _row_no, "OFICIO") AS oficio FROM in_penalties GROUP BY 1),
       batch AS (
        SELECT p.numero_orden_suministro, TIMESTAMP '2024-01-04 00:00:00' AS file_date,
               CAST(p.cantidad_solicitada AS BIGINT) AS cantidad_solicitada,
               p.precio_unitario * CAST(p.cantidad_solicitada AS DOUBLE) AS importe,
               nullif(coalesce(b.uuid, 'no localizado'), 'nan') AS uuid,
               nullif(coalesce(b.folio, 'no localizado'), 'nan') AS folio,
               nullif(coalesce(s.st, 'no localizado'), 'nan') AS estado_de_la_factura, TRY_CAST(f.pena AS DOUBLE) AS pena,
               coalesce(f.oficio, 'no localizado') AS oficio
        FROM in_orders p LEFT JOIN bills b ON p.numero_orden_suministro = b."Referencia"
        LEFT JOIN states s ON p.numero_orden_suministro = s.o LEFT JOIN fines f ON p.numero_orden_suministro = f.o)
       SELECT numero_orden_suministro, file_date, estado_de_la_factura, importe, NULL AS cantidad_solicitada, NULL AS uuid,
              NULL AS folio, NULL AS pena, NULL AS oficio FROM in_history
       UNION ALL
       SELECT numero_orden_suministro, file_date, estado_de_la_factura, importe, cantidad_solicitada, uuid, folio, pena, oficio
       FROM batch b WHERE NOT EXISTS (SELECT 1 FROM in_history h WHERE h.numero_orden_suministro = b.numero_orden_suministro
                                      AND h.file_date = b.file_date)"""
)
def chained_stages(t):
    """Invoice load, integration and history load through stored stages; started once more, the run reads them back."""
    catalog, xml, status = _stage_inputs(t)
    inputs = Inputs(t["in_orders"], t["in_accounts"], t["in_penalties"], [catalog], xml, status)
    root = shared_folder(t.spark, "stages")
    for _ in range(2):
        orders = stored_orders(t.spark, inputs, root, "2024-01-04-00", "2024-01-04 00:59:00", resume=True, **WIDE)
    batch = orders.drop("precio_unitario", "orden_remision", "numero_contrato")
    return history.load_history(t["in_history"].drop("fechaaltatrunc"), [batch]).drop("_row_no")


@register(
    """SELECT numero_orden_suministro, file_date, estado_de_la_factura, CASE WHEN p = 2 THEN importe + 1 ELSE importe END AS importe,
              fechaaltatrunc
       FROM (SELECT *, CAST(substring(numero_orden_suministro, 4) AS BIGINT) % 4 AS p FROM in_history) WHERE p < 3"""
)
def history_commits(t):
    """Two appends that share half of their keys, and a third under an id that was published before."""
    table = HistoryTable(t.spark, shared_folder(t.spark, "history"))
    quarter = F.expr("CAST(substring(numero_orden_suministro, 4) AS BIGINT) % 4")
    raised = t["in_history"].withColumn("importe", F.col("importe") + 1)
    table.append(t["in_history"].filter(quarter < 2), HISTORY_KEY, "one", ["importe"])
    table.append(raised.filter(quarter.isin(1, 2)), HISTORY_KEY, "two", ["importe"])
    table.append(raised.filter(quarter == 3), HISTORY_KEY, "two", ["importe"])
    return table.read()


@register(
    """WITH batch AS (SELECT *, CAST(substring(numero_orden_suministro, 4) AS BIGINT) AS n FROM in_history)
       SELECT numero_orden_suministro, file_date, estado_de_la_factura, importe + CASE WHEN n % 3 = 2 THEN 1 ELSE 0 END AS importe,
              fechaaltatrunc FROM batch"""
)
def history_known_keys(t):
    """Appends to an indexed history: two thirds of the keys, then one snapshot's, then all; what is known is never changed."""
    table = HistoryTable(t.spark, shared_folder(t.spark, "history"), buckets=8)
    number = F.expr("CAST(substring(numero_orden_suministro, 4) AS BIGINT)")
    raised = t["in_history"].withColumn("importe", F.col("importe") + 1)
    table.append(t["in_history"].filter(number % 3 < 2), HISTORY_KEY, "two thirds", ["importe"])
    table.append(raised.filter((number % 3 == 2) & (number % 5 == 0)), HISTORY_KEY, "one snapshot", ["importe"])
    table.append(raised, HISTORY_KEY, "all", ["importe"])
    return table.read()
