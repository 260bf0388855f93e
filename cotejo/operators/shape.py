"""Column shaping: schema-driven projections that cost nothing at run time."""

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cotejo.functions.clean import normalize_identifier


# Fixed value: headers of columns without a name.
UNNAMED = r"^Unnamed(\s*:\s*\d+)?$"


def quoted(name: str):
    return F.col(f"`{name}`")


def with_identifiers(df: DataFrame) -> DataFrame:
    """Columns renamed to SQL-safe identifiers; names that would collide are an error."""
    names = [normalize_identifier(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns collide after normalisation: {twice}")
    return df.toDF(*names)


def clean_table(df: DataFrame) -> DataFrame:
    """Tidy headers, drop unnamed columns; rows stay as they are."""
    tidy = df.toDF(*[" ".join(c.split()) for c in df.columns])
    named = [c for c in tidy.columns if not re.match(UNNAMED, c)]
    return tidy.select(*[quoted(c) for c in named])


def drop_unnamed(df: DataFrame) -> DataFrame:
    """Looser rule at load time: any column that starts with ``unnamed`` in any letter case."""
    return df.select(*[quoted(c) for c in df.columns if not c.lower().startswith("unnamed")])


def has_values(df: DataFrame) -> bool:
    """Whether any row holds any value; stops at the first one found."""
    return bool(df.columns) and not df.dropna(how="all").isEmpty()


def project_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return df.select(*[quoted(c) for c in wanted if c in df.columns])


def prefix_columns(df: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in columns if c in df.columns})


def resolve_column(df: DataFrame, *parts: str, override: str | None = None) -> str:
    """First column whose lower-cased name contains every part."""
    if override is not None:
        return override
    for name in df.columns:
        if all(part in name.lower() for part in parts):
            return name
    raise ValueError(f"no column name contains {', '.join(parts)}")


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    return df
