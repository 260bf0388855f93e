"""Run every SQL file of a folder over the registered views.

The SQL texts themselves are read by the driver, from its own file system.
"""

import logging
from dataclasses import dataclass
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class SqlResult:
    file: str
    status: str
    result: DataFrame | None = None
    error: str | None = None


def run_sql_folder(spark: SparkSession, folder: str, args: dict | None = None) -> list[SqlResult]:
    """One result per file in name order: ``ok``, ``empty`` or ``error``; an error does not stop the others."""
    results = []
    for path in sorted(Path(folder).glob("*.sql")):
        query = path.read_text(encoding="utf-8").strip().rstrip(";")
        if not query:
            results.append(SqlResult(path.name, "empty"))
            continue
        try:
            results.append(SqlResult(path.name, "ok", spark.sql(query, args=args)))
        except PySparkException as error:
            log.warning("%s failed: %s", path.name, error)
            results.append(SqlResult(path.name, "error", error=str(error)))
    return results


def count_rows(result: DataFrame) -> int:
    """Rows of a result that is worked out in full: a count alone would leave out columns, and their errors."""
    seen = Observation()
    result.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    return seen.get["rows"]


def folder_report(spark: SparkSession, results: list[SqlResult]) -> DataFrame:
    """(file, status, result_rows): every result is run on its own, so that one that fails leaves the others alone."""
    rows = []
    for item in results:
        status, count = item.status, None
        if item.result is not None:
            try:
                count = count_rows(item.result)
            except PySparkException as error:
                log.warning("%s failed: %s", item.file, error)
                status = "error"
        rows.append((item.file, status, count))
    return spark.createDataFrame(rows, "file string, status string, result_rows bigint")
