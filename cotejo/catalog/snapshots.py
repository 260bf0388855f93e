"""File inventory and snapshot-group queries."""

from pyspark.sql import functions as F

from cotejo.catalog.registry import register
from cotejo.operators import anchors, checks, files, groups

CATEGORIES = ("view", "click", "purchase")
EXTENSIONS = (".csv", ".xlsx", ".xls")

INVENTORY = """
    inv AS (
        SELECT *, TRY_CAST(substring(name, 1, 10) || ' ' || substring(name, 12, 2) || ':00:00' AS TIMESTAMP) AS ts FROM (
            SELECT *, regexp_extract(path, '([^/]*)$', 1) AS name, lower(regexp_extract(path, '([.][^.]*)$', 1)) AS ext
            FROM in_files)
        WHERE ext IN ('.csv', '.xlsx', '.xls') AND name NOT LIKE '~%')"""
NEXT_ANCHORS = """
    d AS (SELECT DISTINCT {keys}, ts FROM inv WHERE ts IS NOT NULL {only}),
    nxt AS (SELECT *, min(ts) OVER (PARTITION BY {keys} ORDER BY ts
                 RANGE BETWEEN INTERVAL '2 hours 1 second' FOLLOWING AND UNBOUNDED FOLLOWING) AS following FROM d),
    anchors({keys}, anchor, following) AS (
        SELECT {keys}, ts, following FROM nxt QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY ts) = 1
        UNION ALL
        SELECT n.{keys}, n.ts, n.following FROM anchors a JOIN nxt n ON n.{keys} IS NOT DISTINCT FROM a.{keys} AND n.ts = a.following),
    assigned AS (SELECT d.{keys}, d.ts, max(a.anchor) AS anchor FROM d JOIN anchors a
                 ON a.{keys} IS NOT DISTINCT FROM d.{keys} AND a.anchor <= d.ts AND d.ts <= a.anchor + INTERVAL '2 hours' GROUP BY 1, 2)"""
GROUPED = f"""
    WITH RECURSIVE {INVENTORY},
    {NEXT_ANCHORS.format(keys="office", only="AND category IN ('view', 'click', 'purchase')")},
    grp AS (
        SELECT i.office, anchor, max(i.ts) AS last_ts,
               max(CASE WHEN category = 'view' THEN strftime(i.ts, '%Y%m%d%H') || path END) AS v,
               max(CASE WHEN category = 'click' THEN strftime(i.ts, '%Y%m%d%H') || path END) AS c,
               max(CASE WHEN category = 'purchase' THEN strftime(i.ts, '%Y%m%d%H') || path END) AS p
        FROM inv i JOIN assigned a ON i.office IS NOT DISTINCT FROM a.office AND i.ts = a.ts
        WHERE category IN ('view', 'click', 'purchase') GROUP BY 1, 2),
    named AS (
        SELECT office, strftime(anchor, '%Y-%m-%d-%H') || '_' || strftime(last_ts, '%H') AS group_id, anchor AS first_ts,
               last_ts, v[11:] AS "view", c[11:] AS click, p[11:] AS purchase, v[:10] AS vh, c[:10] AS ch, p[:10] AS ph
        FROM grp)"""


def _inventory(t):
    return files.inventory(t["in_files"], EXTENSIONS)


@register(f"""WITH {INVENTORY} SELECT * FROM inv""")
def file_inventory(t):
    return _inventory(t)


@register(
    """SELECT lower(regexp_extract(path, '([.][^.]*)$', 1)) AS ext, count(*) AS files FROM in_files GROUP BY 1"""
)
def files_by_extension(t):
    return files.count_by_extension(t["in_files"])


@register(
    """SELECT * FROM in_files WHERE CAST(modified AS DATE) = DATE '2024-01-15'
       AND lower(regexp_extract(path, '([.][^.]*)$', 1)) IN ('.csv', '.xlsx', '.xls')"""
)
def files_of_day(t):
    return files.files_of_day(t["in_files"], "2024-01-15", EXTENSIONS)


@register(
    """SELECT sha256(text) AS sha256, count(*) AS files, min(doc_id) AS first_path FROM documents
       GROUP BY 1 HAVING count(*) > 1"""
)
def file_fingerprint(t):
    return files.duplicate_contents(t["documents"].select("doc_id", "text"), "doc_id", "text")


@register(
    f"""WITH RECURSIVE {INVENTORY}, {NEXT_ANCHORS.format(keys="owner", only="")}
        SELECT i.*, a.anchor FROM inv i JOIN assigned a ON i.owner IS NOT DISTINCT FROM a.owner AND i.ts = a.ts"""
)
def anchored_groups(t):
    return groups.anchored_groups(_inventory(t), ["owner"])


@register(
    f"""WITH RECURSIVE {INVENTORY.replace("SELECT *, TRY_CAST", "SELECT *, 0 AS one, TRY_CAST")},
        {NEXT_ANCHORS.format(keys="one", only="")}
        SELECT i.* EXCLUDE (one), a.anchor FROM inv i JOIN assigned a ON i.ts = a.ts"""
)
def anchored_groups_global(t):
    return groups.anchored_groups(_inventory(t))


@register(
    """WITH RECURSIVE d AS (SELECT DISTINCT event_type, ts FROM events WHERE ts IS NOT NULL),
       nxt AS (SELECT *, min(ts) OVER (PARTITION BY event_type ORDER BY ts
                    RANGE BETWEEN INTERVAL '2 hours 1 microsecond' FOLLOWING AND UNBOUNDED FOLLOWING) AS following FROM d),
       chain(event_type, anchor, following) AS (
           SELECT event_type, ts, following FROM nxt QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts) = 1
           UNION ALL
           SELECT n.event_type, n.ts, n.following FROM chain c JOIN nxt n ON n.event_type IS NOT DISTINCT FROM c.event_type AND n.ts = c.following)
       SELECT e.event_id, e.event_type, e.ts, c.anchor FROM events e ASOF JOIN chain c
       ON coalesce(e.event_type, '') = coalesce(c.event_type, '') AND e.ts >= c.anchor"""
)
def anchored_groups_exact(t):
    return anchors.exact_groups(t["events"].select("event_id", "event_type", "ts"), ["event_type"])


def _groups(t):
    return groups.snapshot_groups(_inventory(t), CATEGORIES, ["office"])


@register(
    f"""{GROUPED} SELECT office, group_id, first_ts, last_ts, "view", click, purchase FROM named
        WHERE "view" IS NOT NULL AND click IS NOT NULL AND purchase IS NOT NULL"""
)
def complete_groups(t):
    complete = groups.complete_groups(_groups(t), CATEGORIES)
    ordered = groups.newest_first(complete, "office")
    return ordered.select("office", "group_id", "first_ts", "last_ts", *CATEGORIES)


@register(
    f"""{GROUPED} SELECT office, group_id,
            coalesce(vh, ch, ph) = coalesce(ch, vh, ph) AND coalesce(ch, vh, ph) = coalesce(ph, vh, ch)
            AND coalesce(vh, ph) IS NOT DISTINCT FROM coalesce(ph, vh) AS same_hour FROM named"""
)
def group_hour_agreement(t):
    return groups.with_hour_agreement(_groups(t), CATEGORIES).select("office", "group_id", "same_hour")


@register(
    f"""{GROUPED}, flags AS (
            SELECT coalesce(vh, ch, ph) = coalesce(ch, vh, ph) AND coalesce(ch, vh, ph) = coalesce(ph, vh, ch)
                   AND coalesce(vh, ph) IS NOT DISTINCT FROM coalesce(ph, vh) AS same FROM named)
        SELECT count(*) FILTER (WHERE same) AS same_hour_groups, count(*) FILTER (WHERE NOT same) AS different_groups
        FROM flags"""
)
def group_hour_counts(t):
    return groups.hour_agreement_counts(_groups(t), CATEGORIES)


@register(
    """WITH g AS (SELECT event_id AS output_key, ts AS modified FROM events),
       ledger AS (SELECT event_id AS output_key, CASE CAST(event_id % 4 AS INT) WHEN 0 THEN ts
                  WHEN 1 THEN ts + INTERVAL '999 milliseconds' WHEN 2 THEN ts + INTERVAL '1 second' END AS modified FROM events
                  WHERE event_id % 4 < 3)
       SELECT g.* FROM g WHERE NOT EXISTS (
           SELECT 1 FROM ledger l WHERE l.output_key = g.output_key
           AND abs(epoch_us(l.modified) - epoch_us(g.modified)) < 1000000)"""
)
def pending_groups(t):
    found = t["events"].select(F.col("event_id").alias("output_key"), F.col("ts").alias("modified"))
    part = F.col("output_key") % 4
    ledger = found.filter(part < 3).withColumn(
        "modified",
        F.when(part == 0, F.col("modified"))
        .when(part == 1, F.col("modified") + F.expr("interval '0.999' second"))
        .otherwise(F.col("modified") + F.expr("interval '1' second")),
    )
    return files.pending_groups(found, ledger, "output_key")


PREFIX = "regexp_extract(name, '^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}-[0-9]{2} Notice', 0)"


@register(
    f"""WITH p AS (SELECT {PREFIX} AS prefix, count(*) FILTER (WHERE name LIKE '%.pdf') AS pdf_files,
               count(*) FILTER (WHERE name LIKE '%.xlsx') AS xlsx_files FROM in_notices GROUP BY 1)
        SELECT *, pdf_files = 0 AS pdf_missing, xlsx_files = 0 AS xlsx_missing, pdf_files > 1 AS pdf_several,
               xlsx_files > 1 AS xlsx_several FROM p WHERE prefix <> ''"""
)
def pair_completeness(t):
    return files.pair_completeness(t["in_notices"], "Notice")


@register(f"""SELECT * FROM in_notices WHERE {PREFIX} = ''""")
def unprefixed_files(t):
    return files.unprefixed_files(t["in_notices"], "Notice")


@register(
    f"""SELECT {PREFIX} AS prefix, arg_min(name, o_orderkey) AS first_file, count(*) AS files FROM in_notices
        WHERE name LIKE '%.xlsx' AND {PREFIX} <> '' GROUP BY 1"""
)
def first_per_prefix(t):
    return files.first_sheet_per_prefix(t["in_notices"], "Notice", "o_orderkey")


CALENDAR = """
    SELECT CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(day(o_orderdate) AS STRING) || '/' ||
                CAST(month(o_orderdate) AS STRING) || '/' || CAST(year(o_orderdate) AS STRING) END AS "DATE START",
           '28/' || CAST(month(o_orderdate) AS STRING) || '/' || CAST(year(o_orderdate) AS STRING) AS "DATE END",
           o_orderkey, o_custkey FROM <orders>"""
EXPECTED = f"""
    expected AS (SELECT *, '[FacturaVsCR][user][' || replace("DATE START", '/', '-') || '][' ||
                        replace("DATE END", '/', '-') || '].xls' AS expected_name
                 FROM ({CALENDAR.replace("<orders>", "orders")}) WHERE "DATE START" IS NOT NULL),
    present AS (SELECT expected_name AS name FROM expected GROUP BY 1 HAVING min(o_custkey) % 3 = 0
                UNION ALL SELECT 'stray ' || l_orderkey || '.xls' FROM lineitem GROUP BY ALL)"""


def _exports(t):
    expected = files.expected_exports(t.sql(CALENDAR), "user")
    first = expected.groupBy(F.col("expected_name").alias("name")).agg(F.min("o_custkey").alias("least"))
    found = first.filter("least % 3 = 0").select("name")
    stray = t["lineitem"].select(F.format_string("stray %d.xls", "l_orderkey").alias("name"))
    return expected, found.unionByName(stray.distinct())


@register(f"""WITH {EXPECTED} SELECT * FROM expected WHERE expected_name NOT IN (SELECT name FROM present)""")
def missing_files(t):
    return files.missing_files(*_exports(t))


@register(f"""WITH {EXPECTED} SELECT * FROM present WHERE name NOT IN (SELECT expected_name FROM expected)""")
def unexpected_files(t):
    return files.unexpected_files(*_exports(t))


@register(f"""WITH {EXPECTED} SELECT DISTINCT name FROM present WHERE name IN (SELECT expected_name FROM expected)""")
def present_files(t):
    return files.present_files(*_exports(t))


RANGES = """
    SELECT CASE WHEN o_orderkey % 11 = 0 THEN last_day(CAST(o_orderdate AS DATE))
                ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS start,
           CASE WHEN o_orderkey % 11 = 0 THEN CAST(date_trunc('month', o_orderdate) AS DATE)
                ELSE last_day(CAST(o_orderdate AS DATE)) END AS "end"
    FROM <orders>"""


@register(
    f"""SELECT r.start, r."end", count(*) AS hits FROM (SELECT DISTINCT * FROM ({RANGES.replace("<orders>", "orders")})) r
        JOIN orders o ON CAST(o.o_orderdate AS DATE) BETWEEN r.start AND r."end" GROUP BY 1, 2 HAVING count(*) > 180"""
)
def range_overflow(t):
    return checks.range_overflow(t.sql(RANGES), t["orders"], "o_orderdate", cap=180)


@register(
    f"""WITH c AS ({CALENDAR.replace("<orders>", "orders")})
        SELECT "DATE START", CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM c WHERE "DATE START" IS NOT NULL)
               THEN '1/8/2024' ELSE "DATE END" END AS "DATE END", o_orderkey, o_custkey FROM c"""
)
def extend_last_range(t):
    return checks.extend_last_range(t.sql(CALENDAR), "1/8/2024", "o_orderkey")


@register(
    """WITH prev AS (SELECT user_id AS dataset, count(*) AS pages FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1),
       cur AS (SELECT user_id AS dataset, count(*) AS pages FROM events WHERE ts >= TIMESTAMP '2024-01-16'
               AND user_id % 10 <> 0 GROUP BY 1)
       SELECT p.dataset, p.pages AS previous_pages, coalesce(c.pages, 0) AS pages,
              CASE WHEN coalesce(c.pages, 0) = 0 THEN 'no data' ELSE 'partial' END AS finding
       FROM prev p LEFT JOIN cur c USING (dataset) WHERE coalesce(c.pages, 0) < p.pages"""
)
def partial_extract_alert(t):
    return checks.partial_extract_alert(*_page_counts(t))


@register(
    """WITH prev AS (SELECT user_id AS dataset, count(*) AS pages FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1),
       cur AS (SELECT user_id AS dataset, count(*) AS pages FROM events WHERE ts >= TIMESTAMP '2024-01-16'
               AND user_id % 10 <> 0 GROUP BY 1)
       SELECT coalesce(c.dataset, p.dataset) AS dataset, coalesce(c.pages, p.pages) AS pages
       FROM prev p FULL JOIN cur c USING (dataset)"""
)
def next_page_counts(t):
    return checks.next_page_counts(*_page_counts(t))


def _page_counts(t):
    pages = t["events"].withColumnRenamed("user_id", "dataset")
    half = F.lit("2024-01-16").cast("timestamp_ntz")
    now = pages.filter((F.col("ts") >= half) & (F.col("dataset") % 10 != 0))
    return checks.page_counts(now), checks.page_counts(pages.filter(F.col("ts") < half))
