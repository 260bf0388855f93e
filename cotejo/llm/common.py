"""What the operators of this package share: stable storage, null ids, gapless ranks, components."""

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Stands for a missing doc_id inside the operators, so that joins and orders treat it as one more (smallest) id.
NO_ID = -(2**63)


def stored(df: DataFrame) -> DataFrame:
    """The rows, written to the session's checkpoint folder: lineage ends there and lost executors lose nothing.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a session without any gets a folder of
    its own, as in tests on one machine.
    """
    session = df.sparkSession
    context = session.sparkContext
    if context.getCheckpointDir() is None:
        named = session.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint(eager=True)


def small_batches(session: SparkSession) -> None:
    """Bound what one Arrow batch holds, so that very long texts don't fill a worker's memory."""
    session.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def identified(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id (never null, see NO_ID) and text, with the named further columns."""
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"), "text", *more)


def real_id(column: str = "doc_id") -> Column:
    """A doc_id as the caller had it: null where it was missing."""
    return F.when(F.col(column) != F.lit(NO_ID), F.col(column)).alias(column)


def fresh(df: DataFrame, name: str) -> str:
    """The name, longer where the frame already has a column called so."""
    taken = {column.lower() for column in df.columns}
    while name in taken:
        name += "_"
    return name


def partitions(session: SparkSession) -> int:
    return int(session.conf.get("spark.sql.shuffle.partitions"))


def row_keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a bigint column that no two rows share and that orders them by doc_id, and its name.

    Where no id is shared (several missing ids are) the key is the id itself. Otherwise the rows that share one are stored
    with a number of their own, all rows are numbered in the order of (doc_id, own number), and that is stored too.
    """
    key, at, row = fresh(docs, "_key"), fresh(docs, "_at"), fresh(docs, "_row")
    rows = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)))
    shared = rows.groupBy(F.col(key).alias("_shared")).agg(F.count("*").alias("_n")).where("_n > 1").select("_shared")
    if shared.isEmpty():
        return rows, key
    shared = stored(shared)
    several = stored(rows.join(shared, F.col(key) == F.col("_shared"), "left_semi").withColumn(at, F.monotonically_increasing_id()))
    single = rows.join(shared, F.col(key) == F.col("_shared"), "left_anti").withColumn(at, F.lit(0).cast("bigint"))
    both = single.unionByName(several)
    in_order = both.select(key, at).repartitionByRange(partitions(docs.sparkSession), key, at).sortWithinPartitions(key, at)
    numbers = stored(in_order.select(F.col(key).alias("_of"), F.col(at).alias("_nth"), F.monotonically_increasing_id().alias(row)))
    numbered = both.join(numbers, (F.col(key) == F.col("_of")) & (F.col(at) == F.col("_nth")))
    return numbered.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(row).alias(key)), key


def ranked(df: DataFrame, group: list[str], order: list[Column], rows_per_cell: int = 5_000) -> DataFrame:
    """Adds ``rank``: gapless from 0 within each group, without bringing a group into one task. ``df`` should be stored.

    Rows are spread over cells by a hash of the columns in ``order``; each cell is numbered on its own and the counts of
    the cells before it are added. A group of any size is thus numbered by as many tasks as it has cells. Rows equal in
    ``order`` share a cell and are numbered among themselves in any order.
    """
    cells = max(1, df.count() // rows_per_cell)
    df = df.withColumn("_cell", F.pmod(F.xxhash64(*order), F.lit(cells)))
    keys = [*group, "_cell"]
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    numbered = df.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    joined = numbered.join(starts.withColumnsRenamed({k: f"_of_{k}" for k in keys}), [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return joined.withColumn("rank", F.col("_before") + F.col("_at")).drop("_cell", "_at", "_before", *[f"_of_{k}" for k in keys])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b): component is the smallest node reachable.

    Rounds of the alternating star method: each round hooks every node to the smallest one it sees, first among its
    larger and then among its smaller neighbours. Links never outnumber the input's; every round is stored, and the
    rounds grow with the logarithm of the longest path. Neighbours of a node are reduced by aggregation, never gathered.
    """

    def star(links: DataFrame, larger: bool) -> DataFrame:
        """Hook the larger (or else the smaller-or-equal) neighbours of each node, and itself, to the least of them."""
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.union(links.select("b", "a")) if larger else both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        spread = both.join(least, F.col("u") == F.col("n"))
        hooked = spread.where(F.col("v") > F.col("u")) if larger else spread.where(F.col("v") < F.col("u"))
        own = least.where("n <> m").select(F.col("n").alias("a"), F.col("m").alias("b"))
        out = hooked.select(F.col("v").alias("a"), F.col("m").alias("b"))
        out = out if larger else out.union(own)
        return out.where("a <> b").distinct()

    links = stored(edges.select("a", "b").where("a <> b").distinct())
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    mark = None
    while True:
        links = stored(star(star(links, True), False))
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    label = links.groupBy(F.col("a").alias("_n")).agg(F.min("b").alias("_m"))
    return nodes.join(label, F.col("node") == F.col("_n"), "left").select("node", F.coalesce("_m", "node").alias("component"))
