"""Stages that a restarted run doesn't repeat.

Beside every stored sheet of a group lies the list of the files it was made from, with their sizes and modification times,
and of the settings. A stage whose list is the same again (times less than a second apart, as for pending groups) is
read back instead of being run. Sheets of earlier stages are files too, so a stage that ran again makes all that read
it pending. The list is emptied before a sheet is replaced and written after it: a run that dies in between finds the
stage pending.

A table without files behind it can't be compared, so stages that read one always run. Of a table made from files and
other rows only the files are compared. What the caller does to its files before a stage takes them isn't seen either: say it in
the settings.
"""

import json
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cotejo.operators.files import pending_groups
from cotejo.operators.lookup import anti_join
from cotejo.sinks.writers import write_sheet

ENTRY = "output_key string, modified timestamp, schema string"


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    root: str
    group_id: str

    def stage(self, sheet: str, inputs: Sequence[DataFrame], settings: dict, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored sheet, built only where its list of files and settings has changed."""
        now = self.made_from(inputs, settings)
        known = None if now is None else self._known(sheet, now)
        if known is not None:
            return known
        self._entry(sheet, self.spark.createDataFrame([], ENTRY))
        stored = write_sheet(build(), self.root, sheet, self.group_id)
        if now is not None:
            self._entry(sheet, now.withColumn("schema", F.lit(stored.schema.json())))
        return stored

    def made_from(self, inputs: Sequence[DataFrame], settings: dict) -> DataFrame | None:
        """(output_key, modified): files by name and size, and the settings; None where an input has no files."""
        paths = [frame.inputFiles() for frame in inputs]
        if not all(paths):
            return None
        names = sorted({re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(path)) for some in paths for path in some})
        files = self.spark.read.format("binaryFile").load(names).select(F.concat_ws(" ", "path", "length").alias("output_key"), F.col("modificationTime").alias("modified"))
        said = f"settings {json.dumps(settings, sort_keys=True, default=str)}"
        return files.unionByName(self.spark.range(1).select(F.lit(said).alias("output_key"), F.timestamp_seconds(F.lit(0)).alias("modified")))

    def _known(self, sheet: str, now: DataFrame) -> DataFrame | None:
        if not self._exists(self._place(sheet)):
            return None
        entry = self.spark.read.schema(ENTRY).parquet(self._place(sheet))
        one = entry.select("schema").first()
        if one is None or not pending_groups(now, entry, "output_key").isEmpty() or not anti_join(entry, ["output_key"], now, ["output_key"]).isEmpty():
            return None
        schema = StructType.fromJson(json.loads(one["schema"]))
        return self.spark.read.schema(schema).parquet(f"{self.root}/{sheet}/group_id={self.group_id}")

    def _entry(self, sheet: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(self._place(sheet))

    def _place(self, sheet: str) -> str:
        return f"{self.root}/_ledger/{sheet}/group_id={self.group_id}"

    def _exists(self, path: str) -> bool:
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(found)
