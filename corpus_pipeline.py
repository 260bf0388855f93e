"""From raw documents to packed training sequences: five stages, each on all that the stage before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. ``run``
applies them one after another, each stage's rows written as Parquet in the session's checkpoint folder and read again, so that no
stage repeats the work of another and a lost executor costs the tasks it ran.

Every stage takes null, empty and very long texts, rows that repeat or share an id (each is a document of its own), empty tables and
further columns of any name, which stay as they are.
"""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from cotejo.llm import decontaminate, line_dedup, packing, quality_rules, simhash


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the regression, which is fitted on the labelled ones among them."""
    return quality_rules.keep(docs, quality_rules.fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of three consecutive lines; n_chars follows the text."""
    return line_dedup.dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document by doc_id of each class of near copies: fingerprints of four-word shingles, four bits at most apart.

    A missing doc_id comes first; texts without words are one class.
    """
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, packed into sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near_copies),
    ("decontamination", decontamination),
    ("packing", packed),
]

# The regression can't be expressed in SQL: the pipeline is tested against a plain version of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="stages-")
    folder = f"{shared.rstrip('/')}/stages-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
