"""Snapshot comparison, roll-up and SQL-folder queries."""

from pathlib import Path

from pyspark.sql import functions as F

from cotejo.catalog.registry import register
from cotejo.operators import history, report
from cotejo.plans.sql_folder import folder_report, run_sql_folder
from cotejo.session import shared_folder
from cotejo.sinks.snapshots import HistoryTable
from cotejo.values import HISTORY_KEY

CUTOFF = "1998-06-30"
PREVIOUS, CURRENT = "2024-01-02", "2024-01-04"
LOOKUP_ORDERS = tuple(f"OS-{n}" for n in (4, 9, 104, 209, 1004, 1209, 5004, 9999, 14994, 14999))
QUERY_FOLDER = Path(__file__).parent / "sql"

COMPARED = f"""
    cmp AS (
        SELECT period, estado_de_la_factura AS status,
               coalesce(sum(importe) FILTER (WHERE file_date = TIMESTAMP '{PREVIOUS}'), 0) AS previous,
               coalesce(sum(importe) FILTER (WHERE file_date = TIMESTAMP '{CURRENT}'), 0) AS current
        FROM in_history JOIN (VALUES ('raw'), ('before'), ('after')) v(period)
             ON period = 'raw' OR (period = 'before' AND fechaaltatrunc < DATE '{CUTOFF}')
                OR (period = 'after' AND fechaaltatrunc >= DATE '{CUTOFF}')
        WHERE file_date IN (TIMESTAMP '{PREVIOUS}', TIMESTAMP '{CURRENT}') AND estado_de_la_factura IS NOT NULL
        GROUP BY 1, 2)"""
TOTALS = f"""{COMPARED},
    tot AS (
        SELECT period, CASE WHEN grouping(status) = 1 THEN 'Total' ELSE status END AS status,
               grouping(status) = 1 AS is_total, sum(previous) AS previous, sum(current) AS current
        FROM cmp GROUP BY GROUPING SETS ((period, status), (period))),
    full_tot AS (
        SELECT period, status, is_total, round(previous, 2) AS previous, round(current, 2) AS current,
               round(current - previous, 2) AS delta,
               round(CASE WHEN previous <> 0 THEN (current - previous) / previous * 100 END, 6) AS delta_pct,
               round(previous + current, 2) AS total_period
        FROM tot)"""


def _rounded(df, digits=2, **others):
    """Sums of doubles depend on the order of the rows in their last bits."""
    return df.withColumns(
        {n: F.round(n, others.get(n, digits)) for n, kind in df.dtypes if kind == "double"}
    )


@register(
    f"""SELECT estado_de_la_factura AS status, round(sum(importe), 2) AS raw,
               round(sum(importe) FILTER (WHERE fechaaltatrunc < DATE '{CUTOFF}'), 2) AS before,
               round(sum(importe) FILTER (WHERE fechaaltatrunc >= DATE '{CUTOFF}'), 2) AS after
        FROM in_history WHERE estado_de_la_factura IS NOT NULL GROUP BY 1"""
)
def status_split_by_cutoff(t):
    return _rounded(report.status_split(t["in_history"], CUTOFF))


def _compared(t):
    return report.snapshot_compare(t["in_history"], PREVIOUS, CURRENT, CUTOFF)


def _totals(t):
    return report.snapshot_totals(_compared(t))


@register(f"""WITH {COMPARED} SELECT period, status, round(previous, 2) AS previous, round(current, 2) AS current FROM cmp""")
def snapshot_compare(t):
    return _rounded(_compared(t))


def _kept(t):
    """The history in three appends, each with its sums."""
    table = HistoryTable(t.spark, shared_folder(t.spark, "history"), sums={})
    third = F.expr("CAST(substring(numero_orden_suministro, 4) AS BIGINT) % 3")
    for i in range(3):
        table.append(t["in_history"].filter(third <= i), HISTORY_KEY, f"part {i}", ["importe"])
    return table


@register(f"""WITH {COMPARED} SELECT period, status, round(previous, 2) AS previous, round(current, 2) AS current FROM cmp""")
def snapshot_compare_summaries(t):
    """The comparison read from the sums that appends left; rows of the history aren't read."""
    return _rounded(report.snapshot_compare(_kept(t).summaries(), PREVIOUS, CURRENT, CUTOFF))


@register(
    f"""SELECT numero_orden_suministro, estado_de_la_factura, importe FROM in_history
        WHERE file_date = (SELECT max(file_date) FROM in_history) AND numero_orden_suministro IN {LOOKUP_ORDERS}"""
)
def latest_snapshot_from_log(t):
    """The lookup in the newest snapshot, which the log of appends names."""
    return history.lookup_orders(_kept(t).latest(), LOOKUP_ORDERS)


@register(f"""WITH {TOTALS} SELECT * FROM full_tot""")
def snapshot_compare_totals(t):
    return _rounded(_totals(t), delta_pct=6)


@register(
    f"""WITH {TOTALS} SELECT * FROM full_tot ORDER BY period, is_total, current DESC, status"""
)
def snapshot_top(t):
    return _rounded(report.snapshot_top(_totals(t)), delta_pct=6)


@register(
    f"""WITH {TOTALS} SELECT period, status, '$' || format('{{:,.2f}}', previous) AS previous,
               '$' || format('{{:,.2f}}', current) AS current, '$' || format('{{:,.2f}}', delta) AS delta,
               coalesce(format('{{:.2f}}%', delta_pct), '') AS delta_pct FROM full_tot"""
)
def snapshot_formatted(t):
    return report.snapshot_formatted(_rounded(_totals(t), delta_pct=6))


@register("""SELECT DISTINCT file_date FROM in_history WHERE file_date IS NOT NULL""")
def distinct_snapshots(t):
    return report.snapshots(t["in_history"]).orderBy("file_date")


@register(
    f"""SELECT numero_orden_suministro, estado_de_la_factura, importe FROM in_history
        WHERE file_date = (SELECT max(file_date) FROM in_history) AND numero_orden_suministro IN {LOOKUP_ORDERS}"""
)
def latest_snapshot_lookup(t):
    return history.latest_snapshot_lookup(t["in_history"], LOOKUP_ORDERS)


@register(
    """SELECT CASE WHEN grouping(o_orderpriority) = 1 THEN 'Grand total' ELSE o_orderpriority END AS group_label,
              CASE WHEN grouping(o_orderpriority) = 1 THEN '' WHEN grouping(o_orderstatus) = 1 THEN 'Subtotal'
                   ELSE o_orderstatus END AS detail_label, round(sum(o_totalprice), 2) AS amount
       FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)"""
)
def rollup_report(t):
    return _rounded(report.rollup_report(t["orders"], "o_orderpriority", "o_orderstatus", "o_totalprice"))


@register(
    """SELECT 'by_status.sql' AS file, 'ok' AS status,
              (SELECT count(*) FROM (SELECT DISTINCT estado_de_la_factura FROM in_history)) AS result_rows
       UNION ALL SELECT 'empty.sql', 'empty', NULL
       UNION ALL SELECT 'large_orders.sql', 'ok', (SELECT count(*) FROM in_history WHERE importe > 250000)
       UNION ALL SELECT 'latest_snapshot.sql', 'ok', (SELECT count(*) FROM in_history
                        WHERE file_date = (SELECT max(file_date) FROM in_history))
       UNION ALL SELECT 'not_a_number.sql', 'error', NULL
       UNION ALL SELECT 'unknown_column.sql', 'error', NULL"""
)
def sql_folder(t):
    t["in_history"].createOrReplaceTempView("historico")
    return folder_report(t.spark, run_sql_folder(t.spark, str(QUERY_FOLDER)))
