"""Row-preserving lookups: collapse the right side to one row per key, left-join it, label the misses."""

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from cotejo.functions.clean import strip, to_number
from cotejo.operators import ranges
from cotejo.operators.dedup import dedup_first, top_rows
from cotejo.operators.setops import union_by_name
from cotejo.operators.skew import join_unique, key_match
from cotejo.values import CANCELLED, MISSING_TEXT, NOT_FOUND

log = logging.getLogger(__name__)

PART_WIDTH = 1_000_000
PIECE = 100  # rows of one prefix that meet its files in a task


@dataclass(frozen=True)
class LookupSpec:
    """Which left columns match which right columns, and which right columns come back."""

    left: tuple[str, ...]
    right: tuple[str, ...]
    returns: tuple[str, ...]
    # Returned as a number, and only where exactly one right row matches.
    single_numbers: tuple[str, ...] = ()

    def __post_init__(self):
        if len(self.left) != len(self.right):
            raise ValueError("left and right keys must have the same length")

    def missing(self, left: DataFrame, right: DataFrame) -> list[str]:
        wanted_right = [*self.right, *self.returns, *self.single_numbers]
        return [c for c in self.left if c not in left.columns] + [c for c in wanted_right if c not in right.columns]


def _rows(lookups: Sequence[tuple[DataFrame, LookupSpec]], order: str, part_width: int) -> DataFrame:
    """Rows of all right tables: keys ``_key0``..., order and part, the table's number ``_of``, values ``_text0``... and ``_single0``...

    Rows with a NULL key match nothing and are left out.
    """
    frames = []
    for n, (right, spec) in enumerate(lookups):
        texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING_TEXT)) for c in spec.returns]
        frames.append(
            right.dropna(subset=list(spec.right)).select(
                *[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(spec.right)],
                F.col(order).alias("_order"),
                F.floor(F.col(order) / part_width).alias("_part"),
                F.lit(n).alias("_of"),
                *[t.alias(f"_text{i}") for i, t in enumerate(texts)],
                *[F.col(f"`{c}`").cast("string").alias(f"_single{i}") for i, c in enumerate(spec.single_numbers)],
            )
        )
    return union_by_name(frames)


def _asked_for(rows: DataFrame, keys: Sequence[str], wanted: DataFrame) -> DataFrame:
    """Rows whose key occurs in ``wanted`` (its columns in the order of the key): only those are worth joining up.

    Labels such as ``no localizado`` and ``nan`` that stand for missing keys on the right go here, while they are still rows;
    their partition can be split among tasks.
    """
    names = [f"_want{i}" for i in range(len(keys))]
    return join_unique(rows, keys, wanted.dropna().distinct().toDF(*names), names, "left_semi")


def _equals(field: str, value: Column) -> Callable[[Column], Column]:
    return lambda x: x[field] == value


def _fields(*names: str) -> Callable[[Column], Column]:
    return lambda x: F.struct(*[x[name].alias(name) for name in names])


def _parts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Comma-joined values per key, table and range of the order column, in row order.

    The values of a row are gathered together, in one list per group: lists are what such an aggregate spends its time on.
    """
    texts = [c for c in rows.columns if c.startswith("_text")]
    singles = [c for c in rows.columns if c.startswith("_single")]
    gathered = rows.groupBy(*keys, "_of", "_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.collect_list(F.struct("_order", *texts)).alias("_items"), *[F.min(c).alias(c) for c in singles]
    )

    def joined(text: str):
        own = "_items" if text == texts[0] else F.transform("_items", _fields("_order", text))
        return F.array_join(F.sort_array(own)[text], ",")

    return gathered.select(*keys, "_of", "_part", "_rows", *[joined(text).alias(text) for text in texts], *singles)


def collapse_parts(
    right: DataFrame, spec: LookupSpec, order: str = "_row_no", part_width: int = PART_WIDTH
) -> DataFrame:
    """Comma-joined right values per key and range of the order column, in row order.

    A part covers ``part_width`` row numbers, hence at most that many rows of a key. The rows of one hot key spread
    over many tasks and are joined up inside the map tasks first.
    """
    keys = [f"_key{i}" for i in range(len(spec.right))]
    parts = _parts(_rows([(right, spec)], order, part_width), keys)
    return parts.select(
        *[F.col(k).alias(name) for k, name in zip(keys, spec.right)],
        "_part",
        "_rows",
        *[F.col(f"_text{i}").alias(c) for i, c in enumerate(spec.returns)],
        *[F.col(f"_single{i}").alias(c) for i, c in enumerate(spec.single_numbers)],
    )


def collapse(
    lookups: Sequence[tuple[DataFrame, LookupSpec]],
    order: str = "_row_no",
    part_width: int = PART_WIDTH,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """One row per key with the joined values of all right tables, key columns ``_key0``, ``_key1``, ...

    The tables travel together: one shuffle meets the wanted keys, one brings together what the map tasks gathered of a key.
    ``wanted`` may hold more keys than are needed in the end; it spares their texts, it doesn't choose rows. A key's values are
    one cell here whatever ``part_width``; ``collapse_parts`` is the form that cuts them by it.
    """
    keys = [f"_key{i}" for i in range(len(lookups[0][1].right))]
    rows = _rows(lookups, order, part_width)
    rows = rows if wanted is None else _asked_for(rows, keys, wanted)
    values = [c for c in rows.columns if c.startswith(("_text", "_single"))]
    gathered = rows.groupBy(*keys).agg(F.collect_list(F.struct("_of", "_order", *values)).alias("_all"))
    number = [F.lit(n) for n in range(len(lookups))]
    own = [F.filter("_all", _equals("_of", n)) if len(lookups) > 1 else F.col("_all") for n in number]
    tables = gathered.select(*keys, *[rows_of.alias(f"_table{n}") for n, rows_of in enumerate(own)])
    found = []
    for n, (_, spec) in enumerate(lookups):
        table = F.col(f"_table{n}")
        for i, c in enumerate(spec.returns):
            ordered = F.sort_array(F.transform(table, _fields("_order", f"_text{i}")))[f"_text{i}"]
            found.append(F.when(F.size(table) > 0, F.array_join(ordered, ",")).alias(c))
        for i, c in enumerate(spec.single_numbers):
            found.append(F.when(F.size(table) == 1, to_number(F.get(table, 0)[f"_single{i}"])).alias(c))
    return tables.select(*keys, *found)


def populate_all(
    left: DataFrame,
    lookups: Sequence[tuple[DataFrame, LookupSpec]],
    order: str = "_row_no",
    part_width: int = PART_WIDTH,
    overwrite: bool = False,
    asked: DataFrame | None = None,
) -> DataFrame:
    """Several lookups on the same left key: the right tables are collapsed together, the left side is joined once.

    ``asked`` is a table that has the left key columns with all keys of the left side (and maybe more) at less cost than it.
    """
    usable = []
    for right, spec in lookups:
        missing = spec.missing(left, right)
        if missing:
            log.warning("lookup skipped, missing columns: %s", ", ".join(missing))
        else:
            usable.append((right, spec))
    if not usable:
        return left
    left_keys = usable[0][1].left
    if any(spec.left != left_keys for _, spec in usable):
        raise ValueError("lookups of one pass must share the left key")
    returned = [c for _, spec in usable for c in (*spec.returns, *spec.single_numbers)]
    clash = [c for c in returned if c in left.columns or returned.count(c) > 1]
    if clash and not overwrite:
        raise ValueError(f"returned columns already exist: {sorted(set(clash))}")
    kept = left.drop(*[c for c in clash if c not in left_keys])
    wanted = (left if asked is None else asked).select(*[F.col(f"`{k}`") for k in left_keys])
    collapsed = collapse(usable, order, part_width, wanted)
    joined = join_unique(kept, left_keys, collapsed, [f"_key{i}" for i in range(len(left_keys))])
    return joined.withColumns(
        {c: F.coalesce(F.col(f"`{c}`"), F.lit(NOT_FOUND)) for _, spec in usable for c in spec.returns}
    )


def populate(left: DataFrame, right: DataFrame, spec: LookupSpec, order="_row_no", **options) -> DataFrame:
    """Left rows with the right values of their key, ``no localizado`` where there is none."""
    return populate_all(left, [(right, spec)], order, **options)


def populate_metrics(left: DataFrame, right: DataFrame, spec: LookupSpec) -> DataFrame:
    """Row counts of a lookup: left, matched, unmatched. Both sides are reduced to keys before they meet."""
    lefts = left.groupBy(*[F.col(f"`{k}`").alias(f"_l{i}") for i, k in enumerate(spec.left)]).agg(
        F.count(F.lit(1)).alias("_n")
    )
    rights = right.select(*[F.col(f"`{k}`").alias(f"_r{i}") for i, k in enumerate(spec.right)]).distinct()
    condition = [F.col(f"_l{i}") == F.col(f"_r{i}") for i in range(len(spec.left))]
    joined = lefts.join(rights.withColumn("_hit", F.lit(1)), condition, "left")
    return joined.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum(F.when(F.col("_hit").isNotNull(), F.col("_n"))), F.lit(0)).alias("matched_rows"),
        F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("_n"))), F.lit(0)).alias("unmatched_rows"),
    )


def join_first(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, order=("_row_no",), match_nulls: bool = True
) -> DataFrame:
    """Left join with the first right row per key; by default a NULL key matches a NULL key."""
    first = dedup_first(right, [right_key], order).drop(*[c for c in order if c in left.columns])
    first = first.withColumn("_key", F.col(f"`{right_key}`"))
    return join_unique(left, [left_key], first, ["_key"], null_safe=match_nulls)


def mark_listed(left: DataFrame, key: str, listed: DataFrame, listed_key: str, column: str, value: str) -> DataFrame:
    """Set ``column`` to ``value`` where the key is listed; NULL keys are never listed."""
    flags = listed.select(F.col(f"`{listed_key}`").alias("_listed")).filter("_listed is not null").distinct()
    joined = join_unique(left, [key], flags.withColumn("_hit", F.lit(True)), ["_listed"])
    return joined.withColumn(
        column, F.when(F.col("_hit"), F.lit(value)).otherwise(F.col(f"`{column}`"))
    ).drop("_hit")


def anti_join(left: DataFrame, left_keys: Sequence[str], right: DataFrame, right_keys: Sequence[str], null_safe=False):
    """Left rows without a partner; a missing key has none unless ``null_safe``."""
    known = right.select(*[F.col(f"`{k}`") for k in right_keys]).distinct()
    return join_unique(left, left_keys, known, right_keys, "left_anti", null_safe)


def new_documents(docs: DataFrame, known: DataFrame, uuid="UUID", pair=("Folio", "Archivo")) -> DataFrame:
    """Documents whose UUID is unknown and whose (folio, file) pair is unknown; batch duplicates stay."""
    unseen = anti_join(docs, [uuid], known, [uuid])
    return anti_join(unseen, pair, known, pair, null_safe=True)


def _chains(some: DataFrame, keys: DataFrame) -> DataFrame:
    """(_prefix, _chain) of some distinct keys: all ``keys`` that are prefixes of a key, itself included."""
    lengths = keys.agg(F.collect_set(F.length("_prefix"))).scalar()
    cut = some.withColumn("_length", F.explode(lengths)).filter(F.col("_length") <= F.length("_prefix"))
    cut = cut.withColumn("_start", F.expr("substring(_prefix, 1, _length)"))
    known = keys.select(F.col("_prefix").alias("_known"))
    return cut.join(known, F.col("_start") == F.col("_known"), "left_semi").groupBy("_prefix").agg(F.collect_set("_start").alias("_chain"))


def prefix_hits(keys: DataFrame, files: DataFrame, name: str, path: str, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """(_key, path, order columns): one row for each distinct key (``_prefix``) and file whose lower-cased name starts with it.

    Names and keys are sorted together in ranges with even shares of both (see ``ranges``). All keys that a name starts with are prefixes of one another,
    and of the last key that sorts before the name or equals it, so each name looks at that key's chain only. A range
    begins with the last key of the ranges before it. A name travels once, whatever the number of keys, and a key that
    matches many names meets them in all the ranges they fill.
    """
    names = files.select(F.lower(F.col(f"`{name}`")).alias("_text"), F.col(f"`{path}`").alias("_path"), *[F.col(f"`{o}`").alias(f"_order{i}") for i, o in enumerate(order)])
    names = names.filter("_text is not null")
    texts = names.select("_text", "_path").unionByName(keys.select(F.col("_prefix").alias("_text")), allowMissingColumns=True)
    edges = ranges.bounds(texts, "_text", ["_path"], parts)
    low = ranges.below("_prefix", edges, or_equal=False)
    last = F.struct("_prefix", "_chain").alias("_last")
    chains = _chains(keys, keys).select(F.col("_prefix").alias("_text"), low.alias("_range"), last)
    tops = keys.groupBy(low.alias("_range")).agg(F.max("_prefix").alias("_prefix")).select("_prefix")
    carried = _chains(tops, keys).select(low.alias("_range"), last)
    earlier = F.element_at(ranges.before(carried, "_range", F.col("_last"), "max", len(edges)), F.col("_range") + 1)
    both = names.withColumn("_range", ranges.dealt("_text", edges, ["_text", "_path"])).unionByName(chains, allowMissingColumns=True)
    so_far = Window.partitionBy("_range").orderBy("_text", F.col("_last").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = both.withColumn("_seen", F.last("_last", ignorenulls=True).over(so_far)).filter("_last is null")
    looked = scanned.withColumn("_chain", F.coalesce(F.col("_seen"), earlier)["_chain"])
    hits = looked.withColumn("_key", F.explode(F.filter("_chain", lambda key: F.startswith("_text", key))))
    return hits.select("_key", F.col("_path").alias(path), *[F.col(f"_order{i}").alias(o) for i, o in enumerate(order)])


def _keyed(wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    keyed = wanted.withColumn("_prefix", F.lower(strip(F.col(f"`{key}`"))))
    return keyed, keyed.select("_prefix").filter("_prefix is not null").distinct()


def prefix_rows(wanted: DataFrame, key: str, files: DataFrame, name: str, path: str, parts: int | None = None) -> DataFrame:
    """``wanted`` rows, once for each file whose name starts with the key, with the file's ``path``; rows without one vanish.

    There are far more of these rows than of those that meet, so tasks are cut by them: the wanted rows of a key are dealt to
    pieces of about ``PIECE`` rows, each piece meets all files of the key, and pieces are shuffled into a fixed number of
    partitions, which adaptive execution, seeing how small they are, would otherwise merge into few.
    """
    keyed, keys = _keyed(wanted, key)
    sized = keyed.filter("_prefix is not null").groupBy("_prefix").agg((F.floor(F.count(F.lit(1)) / PIECE) + 1).alias("_pieces"))
    row = F.xxhash64(*[F.col(f"`{c}`") for c in wanted.columns])
    dealt = join_unique(keyed, ["_prefix"], sized, ["_prefix"], "inner").withColumn("_piece", F.pmod(row, F.col("_pieces"))).drop("_pieces")
    hits = join_unique(prefix_hits(keys, files, name, path, [], parts), ["_key"], sized, ["_prefix"], "inner")
    hits = hits.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pieces") - 1))).drop("_pieces")
    tasks = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = dealt.join(hits.repartition(tasks, "_key", "_at"), (F.col("_prefix") == F.col("_key")) & (F.col("_piece") == F.col("_at")))
    return met.drop("_prefix", "_key", "_piece", "_at")


def prefix_matches(
    wanted: DataFrame, key: str, files: DataFrame, name: str, path: str, order: Sequence[str], limit: int = 1, parts: int | None = None
) -> DataFrame:
    """``wanted`` rows with ``found``, how many file names start with the key, and ``matches``, the first ``limit`` paths in order.

    Both are NULL if there are none. The count is always of all; ``prefix_rows`` gives all paths, as rows.
    """
    keyed, keys = _keyed(wanted, key)
    hits = prefix_hits(keys, files.withColumnRenamed(path, "_path"), name, "_path", order, parts)
    place = F.struct(*[F.col(f"`{o}`") for o in order], F.col("_path"))
    found = F.count(F.lit(1)).alias("found")
    if limit == 1:
        counted = hits.groupBy("_key").agg(found, F.array(F.min(place)["_path"]).alias("matches"))
    else:
        short = top_rows(hits, ["_key"], [*order, "_path"], limit).groupBy("_key")
        paths = F.transform(F.array_sort(F.collect_list(place)), lambda x: x["_path"])
        counted = hits.groupBy("_key").agg(found).join(short.agg(paths.alias("matches")), "_key")
    return join_unique(keyed, ["_prefix"], counted, ["_key"]).drop("_prefix")


def fallback_lookup(
    work: DataFrame,
    work_keys: Sequence[str],
    results: DataFrame,
    result_keys: Sequence[str],
    status: str,
    payload: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Work rows with the first result that is not cancelled, trying the keys in the given order.

    Adds ``priority`` (position of the key that hit, from 0) and the payload columns, NULL where no key hits. Work rows
    with the same keys are looked up once and all kept.
    """
    alive = results.filter(~F.coalesce(F.contains(F.col(f"`{status}`"), F.lit(CANCELLED)), F.lit(False)))
    candidates = alive.select(
        F.explode(F.array(*[F.col(f"`{k}`").cast("string") for k in result_keys])).alias("_candidate"),
        *[F.col(f"`{c}`").alias(f"_pay{i}") for i, c in enumerate(payload)],
        *[F.col(f"`{c}`").alias(f"_order{i}") for i, c in enumerate(order)],
    ).filter("_candidate is not null")
    best = dedup_first(candidates, ["_candidate"], [f"_order{i}" for i in range(len(order))]).select(
        "_candidate",
        F.struct(*[F.col(f"_pay{i}").alias(c) for i, c in enumerate(payload)]).alias("_payload"),
    )
    asked = [f"_asked{i}" for i in range(len(work_keys))]
    terms = work.select(*[F.col(f"`{k}`").cast("string") for k in work_keys]).toDF(*asked).distinct()
    terms = terms.select(*asked, F.posexplode(F.array(*asked)).alias("_priority", "_term")).withColumn(
        "_term", F.when((F.lower("_term") != MISSING_TEXT) & (F.col("_term") != ""), F.col("_term"))
    )
    hits = join_unique(terms, ["_term"], best, ["_candidate"], "inner")
    first = hits.groupBy(*asked).agg(F.min(F.struct("_priority", "_payload")).alias("_hit"))
    texts = work.withColumns({f"_text{i}": F.col(f"`{k}`").cast("string") for i, k in enumerate(work_keys)})
    chosen = join_unique(texts, [f"_text{i}" for i in range(len(work_keys))], first, asked, null_safe=True)
    return chosen.select(
        *[F.col(f"`{c}`") for c in work.columns],
        F.col("_hit._priority").cast("bigint").alias("priority"),
        *[F.col(f"_hit._payload.`{c}`").alias(c) for c in payload],
    )
