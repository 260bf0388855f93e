"""Incremental loads: the file source remembers which documents were read.

Known keys are dropped by the history rule against the target (``*_writer``), or by the stream's own state (``unseen_documents``).
"""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from cotejo.operators.lookup import new_documents
from cotejo.sinks.writers import append_history
from cotejo.sources import invoice_xml
from cotejo.sources.datasets import read_dataset
from cotejo.values import HISTORY_KEY


def stream_documents(spark: SparkSession, path: str, pattern: str = "*.xml", files_per_batch: int = 100_000) -> DataFrame:
    """Whole documents as they arrive: (file_name, text)."""
    files = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )
    return files.select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"))


def unseen_documents(
    documents: DataFrame, delay: str, known: DataFrame | None = None, uuid: str = "UUID", pair: Sequence[str] = ("Folio", "Archivo")
) -> DataFrame:
    """Documents of a stream whose UUID and whose (folio, file) pair haven't come before, whatever batch they came in.

    What came is kept by Spark's state store, not re-read from the target, so a batch costs what arrives in it. A key is kept for
    ``delay`` after it first came, by the clock of the batches: nothing is ever late, and a key that comes again later than that is
    new. A missing UUID is nobody's, missing parts of a pair are values. Of rows with one key in a batch any one stays; a document
    counts as come even if its other key was known. ``known`` are documents loaded before the stream began. The state of many
    documents belongs in RocksDB (``spark.sql.streaming.stateStore.providerClass``).
    """
    fresh = documents if known is None else new_documents(documents, known, uuid, pair)
    own = F.when(F.col(f"`{uuid}`").isNull(), F.struct(*[F.col(f"`{c}`") for c in pair]))
    clocked = fresh.withColumns({"_whose": own, "_arrived": F.current_timestamp()}).withWatermark("_arrived", delay)
    once_each = clocked.dropDuplicatesWithinWatermark([uuid, "_whose"]).dropDuplicatesWithinWatermark(list(pair))
    return once_each.drop("_whose", "_arrived")


def invoice_lines(documents: DataFrame, delay: str, known: DataFrame | None = None) -> DataFrame:
    """Line items of the unseen ones among a stream of whole documents (``stream_documents``)."""
    return invoice_xml.line_items(unseen_documents(invoice_xml.headers(invoice_xml.parse_documents(documents)), delay, known))


def append_once(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Add what has arrived since the last run to a Parquet folder, then stop.

    The folder's log names the files of finished batches, so a batch that is repeated after a failure adds its rows once.
    """
    return stream.writeStream.format("parquet").trigger(availableNow=True).option("checkpointLocation", checkpoint).start(path)


def run_once(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame], None]) -> StreamingQuery:
    """Process what has arrived since the last run, batch by batch, then stop."""
    return (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, _: write(batch))
        .start()
    )


def invoice_lines_writer(table_path: str) -> Callable[[DataFrame], None]:
    """Append the line items of unknown documents; a repeated batch finds its documents known and adds nothing."""

    def write(batch: DataFrame) -> None:
        spark = batch.sparkSession
        documents = invoice_xml.headers(invoice_xml.parse_documents(batch))
        schema = invoice_xml.line_items(documents).schema
        known = read_dataset(spark, table_path, schema)
        lines = invoice_xml.line_items(new_documents(documents, known))
        lines.write.mode("append").parquet(table_path)

    return write


def history_writer(table: str, key=HISTORY_KEY) -> Callable[[DataFrame], None]:
    """Append the batch rows whose key the history does not hold."""

    def write(batch: DataFrame) -> None:
        append_history(batch.sparkSession, table, batch, key)

    return write
