"""Tax-status receipts held as text."""

from pyspark.sql import DataFrame, functions as F

from cotejo.values import ACTIVE, CANCELLED, UNKNOWN

# The id sits between these two marks, in any letter case and possibly across lines.
ID_PATTERN = "(?is)&id=(.+?)&re="


def receipt_status(receipts: DataFrame, text: str = "text", file_name: str = "filename") -> DataFrame:
    """(uuid, estado, filename); the id without blanks, NULL where there is none."""
    line = F.translate(F.col(text), "\n\r", "  ")
    found = F.nullif(F.regexp_extract(line, ID_PATTERN, 1), F.lit(""))
    status = (
        F.when(F.contains(line, F.lit(CANCELLED)), F.lit(CANCELLED))
        .when(F.contains(line, F.lit(ACTIVE)), F.lit(ACTIVE))
        .otherwise(F.lit(UNKNOWN))
    )
    return receipts.select(
        F.replace(found, F.lit(" "), F.lit("")).alias("uuid"), status.alias("estado"), F.col(file_name).alias("filename")
    )
