"""Column expressions that clean and type raw text (all built-in, code-generated functions)."""

import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from cotejo.values import MISSING_TEXT, NO_DATE, NULL_MARKERS

# Whitespace as Unicode defines it, as a pattern and as the list of characters; numbers accepted by the
# cleaning rules.
SPACE = r"(?U)[\s\x1c-\x1f]"
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"


def as_column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Trim Unicode whitespace on both ends (``trim`` alone removes blanks only)."""
    return F.trim(as_column(c), F.lit(BLANKS))


def once(c: Column) -> Column:
    """The value computed a single time per row, however often later steps use it.

    Catalyst copies an expression into every filter and column built on it; it does not do so across a generator.
    """
    return F.explode(F.array(c))


def null_markers(c, markers=NULL_MARKERS) -> Column:
    """Trimmed text, NULL where it is one of the markers in any letter case."""
    text = strip(c)
    return F.when(~F.lower(text).isin(*markers), text)


def clean_strings(df: DataFrame, markers=NULL_MARKERS) -> DataFrame:
    """``null_markers`` over every string column."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({n: null_markers(F.col(f"`{n}`"), markers) for n in names})


def to_number(c) -> Column:
    """Double, or NULL where the text is no number (also for ``nan`` and ``1d``)."""
    text = strip(as_column(c).cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def strict_number(c) -> Column:
    """Double; text that is no number fails the query, a missing value stays NULL."""
    raw = as_column(c).cast("string")
    text = strip(raw)
    return (
        F.when(text.rlike(NUMBER), text.try_cast("double"))
        .when(text.isNull() | (F.lower(text) == MISSING_TEXT), F.lit(None).cast("double"))
        .otherwise(F.raise_error(F.concat(F.lit("not a number: "), raw)).cast("double"))
    )


def to_integer(c, on_fraction: str = "error") -> Column:
    """Nullable whole number; a fraction fails the query or, with ``on_fraction="null"``, gives NULL."""
    if on_fraction not in ("error", "null"):
        raise ValueError(f"on_fraction must be 'error' or 'null', not {on_fraction!r}")
    number = to_number(c)
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    if on_fraction == "null":
        return whole
    message = F.concat(F.lit("not a whole number: "), number.cast("string"))
    return F.when(number.isNull() | (number == F.floor(number)), whole).otherwise(
        F.raise_error(message).cast("bigint")
    )


def strip_key(c) -> Column:
    """Text without any whitespace; a missing key becomes the text ``nan``."""
    return F.regexp_replace(F.coalesce(as_column(c).cast("string"), F.lit(MISSING_TEXT)), rf"{SPACE}+", "")


def parse_currency(c) -> Column:
    """``$1,234.50`` to 1234.5; any other text fails the query."""
    return strict_number(F.regexp_replace(as_column(c), "[$,]", ""))


def line_amount(price, quantity) -> Column:
    return strict_number(price) * strict_number(quantity)


def parse_date_sentinel(c) -> Column:
    """``d/M/yyyy`` to a timestamp; 1900-01-01 where the text is missing or no date."""
    parsed = F.try_to_date(as_column(c), "d/M/yyyy").cast("timestamp_ntz")
    return F.coalesce(parsed, F.lit(NO_DATE).cast("timestamp_ntz"))


def date_like(name: str) -> bool:
    return "fecha" in name or "date" in name


def fill_dates_by_name(df: DataFrame) -> DataFrame:
    """NULL in columns named like a date becomes 1900-01-01 (as text in text columns)."""
    filled = {}
    for field in df.schema.fields:
        if not date_like(field.name):
            continue
        if isinstance(field.dataType, (TimestampType, TimestampNTZType, DateType)):
            sentinel = F.lit(NO_DATE).cast("timestamp_ntz").cast(field.dataType)
        elif isinstance(field.dataType, StringType):
            sentinel = F.lit(NO_DATE)
        else:
            continue
        filled[field.name] = F.coalesce(F.col(f"`{field.name}`"), sentinel)
    return df.withColumns(filled)


def format_currency(c) -> Column:
    """``$1,234.50``, negative ``$-1,234.50``, empty text for NULL."""
    return F.coalesce(F.concat(F.lit("$"), F.format_number(as_column(c), 2)), F.lit(""))


def format_percent(c) -> Column:
    """``12.34%``, empty text for NULL; rounds like the currency format (half to even)."""
    text = F.call_function("format_number", as_column(c), F.lit("0.00"))
    return F.coalesce(F.concat(text, F.lit("%")), F.lit(""))


def dashed_date(c) -> Column:
    return F.translate(as_column(c), "/", "-")


def hour_stamp(c) -> Column:
    """Timestamp as ``yyyy-MM-dd-HH``, read off its text so that no time zone plays a part."""
    return F.translate(F.substring(as_column(c).cast("string"), 1, 13), " ", "-")


def hour_text(c) -> Column:
    return F.substring(as_column(c).cast("string"), 12, 2)


def parse_hour_stamp(c) -> Column:
    """``yyyy-MM-dd-HH`` to a timestamp, NULL where the text is none."""
    text = as_column(c)
    stamp = F.concat(F.substring(text, 1, 10), F.lit(" "), F.substring(text, 12, 2), F.lit(":00:00"))
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}-\d{2}$"), stamp.try_cast("timestamp_ntz"))


def normalize_identifier(name: str) -> str:
    """SQL-safe column name: lower case, ``[a-z0-9_]`` only, never starting with a digit."""
    tidy = re.sub("_+", "_", re.sub("[^a-z0-9_]", "_", str(name).strip().lower()))
    return f"col_{tidy}" if tidy[:1].isdigit() else tidy


def normalize_identifier_column(c) -> Column:
    """The same rule for names held in a column."""
    tidy = F.regexp_replace(F.regexp_replace(F.lower(strip(c)), "[^a-z0-9_]", "_"), "_+", "_")
    return F.regexp_replace(tidy, "^([0-9])", "col_$1")


def normalize_header(name: str) -> str:
    """Lower-cased header with runs of whitespace, no-break space included, as one blank."""
    return " ".join(str(name).split()).lower()


def normalize_header_column(c) -> Column:
    return F.lower(strip(F.regexp_replace(as_column(c), rf"{SPACE}+", " ")))


def series_folio(series, folio) -> Column:
    """``series-folio`` when both are present, else the one that is, else empty text."""
    s, f = F.nullif(as_column(series), F.lit("")), F.nullif(as_column(folio), F.lit(""))
    return F.when(s.isNotNull() & f.isNotNull(), F.concat_ws("-", s, f)).otherwise(F.coalesce(f, s, F.lit("")))
