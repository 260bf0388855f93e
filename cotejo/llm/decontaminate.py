"""Benchmark decontamination: which documents hold a test item, in DataFrame functions only.

Texts are lower-cased and cut into words (runs of letters, marks and digits), words into shingles of five. A document
holds an item if at least ``SHARE`` of the item's different shingles are among its own.

Search by MinHash containment, partitioned by size: items are split into classes by their number n of shingles (powers of
two). The sketch of an item is its least s shingle hashes, s = floor((1 - SHARE) * n) + 1 with n at the class's upper
bound, so of any SHARE of the item's shingles at least one is in the sketch: no holder is missed. A class has a bound, the largest
hash in its sketches; of a document only the hashes up to the bound of a class (its own MinHash sketch) are looked up, and only in
classes of items that it is large enough to hold. Candidates are then verified by their shingles' texts.

An item of fewer than five words is one shingle of all of them, looked up among document shingles of that width. Null
and empty texts have no shingles: such items are held by nothing, such documents hold nothing. Missing ids are reported as
null; rows that share an id are reported as one, with their best share, and cleaned each by its own text. Further columns
play no part.

Item sketches are joined as Spark chooses by their size; with a large benchmark that is a shuffled join of small rows,
whose hot hashes adaptive execution splits. Texts are shuffled once, to verify the candidates.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cotejo.functions.clean import once
from cotejo.llm.common import NO_ID, fresh, identified, real_id, row_keyed, stored

WIDTH, SHARE = 5, 0.8
NOT_WORD = r"[^\p{L}\p{M}\p{N}]+"


def words(text: str) -> Column:
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda x: x != "")


def shingle_texts(column: str, width: int) -> Column:
    """Different shingles of an array of words, as texts."""
    starts = F.sequence(F.lit(1), F.size(column) - width + 1)
    texts = F.transform(starts, lambda i: F.concat_ws(" ", F.slice(column, i, width)))
    return F.when(F.size(column) >= width, F.array_distinct(texts)).otherwise(F.array().cast("array<string>"))


def shingle_hashes(column: str, width: int) -> Column:
    """Hashes of the shingles of an array of words' hashes."""
    starts = F.sequence(F.lit(0), F.size(column) - width)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(F.col(column), i + k) for k in range(width)]))
    return F.when(F.size(column) >= width, hashes).otherwise(F.array().cast("array<bigint>"))


def _hashed(df: DataFrame, width: int, *keep: str) -> DataFrame:
    hashed = df.withColumn("_words", once(F.transform(words("text"), lambda x: F.xxhash64(x))))
    return hashed.select(*keep, once(shingle_hashes("_words", width)).alias("hashes"))


def _sketches(items: DataFrame, width: int, share: float) -> DataFrame:
    """(class, item, need, hash): need is the least number of shingles a holder has."""
    own = _hashed(items, width, "item").withColumn("hashes", once(F.array_sort(F.array_distinct("hashes"))))
    size = own.withColumn("n", F.size("hashes")).where("n > 0")
    classed = size.withColumn("class", F.ceil(F.log2("n")).cast("int"))
    enough = F.floor(F.lit(1 - share + 1e-9) * F.pow(F.lit(2), F.col("class"))).cast("int") + 1
    # A document is large enough with SHARE of the class's least size.
    need = F.ceil(F.lit(share - 1e-9) * (F.floor(F.pow(F.lit(2), F.col("class") - 1)) + 1)).cast("int")
    return classed.select("class", "item", need.alias("need"), F.explode(F.slice("hashes", 1, enough)).alias("hash"))


def _candidates(docs: DataFrame, items: DataFrame, width: int, share: float) -> DataFrame:
    """(doc_id, item) of documents that have some shingle of an item's sketch."""
    sketches = stored(_sketches(items, width, share))
    bounds = sketches.groupBy("class", "need").agg(F.max("hash").alias("bound")).collect()  # one row per class: at most 32
    if not bounds:
        return sketches.select(F.lit(None).cast("bigint").alias("doc_id"), "item").where("false")
    hashed = _hashed(docs, width, "doc_id")
    highest = max(row["bound"] for row in bounds)
    least = min(row["need"] for row in bounds)
    sketch = F.array_distinct(F.filter("hashes", lambda x: x <= highest))
    low = hashed.where(F.size("hashes") >= least).select("doc_id", F.size("hashes").alias("n"), F.explode(sketch).alias("_hash"))
    return low.join(sketches, (F.col("_hash") == F.col("hash")) & (F.col("n") >= F.col("need"))).select("doc_id", "item").distinct()


def holders(docs: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, item_id, n_shared, n_item and containment of every pair of a document and an item it holds."""
    docs = identified(docs)
    item_id = F.coalesce(F.col("item_id").cast("bigint"), F.lit(NO_ID))
    own = words("text")
    items = items.select(item_id.alias("item_id"), "text").where(F.size(own) > 0)
    items = stored(items.withColumns({"item": F.xxhash64("item_id", "text"), "width": F.least(F.lit(WIDTH), F.size(own))}).dropDuplicates(["item"]))
    found = []
    for row in items.select("width").distinct().collect():  # at most WIDTH rows
        width = row["width"]
        some = items.where(F.col("width") == width)
        candidates = _candidates(docs, some, width, share)
        wanted = candidates.join(some.select(F.col("item").alias("_item"), "item_id", "text"), F.col("item") == F.col("_item"))
        wanted = wanted.withColumn("_own", once(words("text"))).select(F.col("doc_id").alias("_doc"), F.struct("item_id", shingle_texts("_own", width).alias("shingles")).alias("_item"))
        per_doc = wanted.groupBy("_doc").agg(F.collect_list("_item").alias("_items"))  # bounded by the items
        both = docs.join(per_doc, F.col("doc_id") == F.col("_doc")).withColumn("_words", once(words("text")))
        checked = both.select("doc_id", "_items", once(shingle_texts("_words", width)).alias("_has"))
        counted = checked.select("doc_id", F.explode(F.transform("_items", lambda x: F.struct(x["item_id"].alias("item_id"), F.size(F.array_intersect(x["shingles"], F.col("_has"))).alias("n_shared"), F.size(x["shingles"]).alias("n_item")))).alias("x"))
        found.append(counted.select("doc_id", "x.item_id", "x.n_shared", "x.n_item").where(F.col("n_shared") >= F.lit(share - 1e-9) * F.col("n_item")))
    if not found:
        found = [items.select(F.col("item_id").alias("doc_id"), "item_id", F.lit(0).alias("n_shared"), F.lit(0).alias("n_item")).where("false")]
    best = F.max(F.struct(F.col("n_shared") / F.col("n_item"), "n_shared", "n_item"))
    pairs = reduce(DataFrame.union, found).groupBy("doc_id", "item_id").agg(best.alias("_best"))
    return pairs.select(real_id(), real_id("item_id"), F.col("_best.n_shared").cast("bigint").alias("n_shared"), F.col("_best.n_item").cast("bigint").alias("n_item"), (F.col("_best.n_shared") / F.col("_best.n_item")).alias("containment"))


def clean(docs: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    rows, key = row_keyed(docs)
    name = fresh(rows, "_held")
    held = holders(rows.select(F.col(key).alias("doc_id"), "text"), items, share).select(F.coalesce("doc_id", F.lit(NO_ID)).alias(name)).distinct()
    return rows.join(held, F.col(key) == F.col(name), "left_anti").drop(key)


SQL = r"""
WITH doc_words AS (
    SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
item_words AS (
    SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
widths AS (SELECT item_id, w, least(5, len(w)) AS width FROM item_words WHERE len(w) > 0),
item_shingles AS (
    SELECT DISTINCT item_id, width, array_to_string(w[i:i + width - 1], ' ') AS s
    FROM (SELECT *, unnest(range(1, len(w) - width + 2)) AS i FROM widths)),
doc_shingles AS (
    SELECT DISTINCT doc_id, width, array_to_string(w[i:i + width - 1], ' ') AS s
    FROM (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS i
          FROM doc_words, (SELECT DISTINCT width FROM widths) WHERE len(w) >= width)),
sizes AS (SELECT item_id, count(*) AS n_item FROM item_shingles GROUP BY item_id),
shared AS (
    SELECT doc_id, item_id, count(*) AS n_shared FROM doc_shingles JOIN item_shingles USING (width, s)
    GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM shared JOIN sizes USING (item_id) WHERE n_shared >= 0.8 * n_item"""
