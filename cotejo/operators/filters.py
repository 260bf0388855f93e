"""Row filters and splits."""

from pyspark.sql import Column, DataFrame

from cotejo.functions.clean import to_number
from cotejo.operators.shape import quoted
from cotejo.values import ACTIVE, CANCELLED


def active_only(df: DataFrame, status: str, value: str = ACTIVE) -> DataFrame:
    return df.filter(quoted(status) == value)


def not_cancelled(df: DataFrame, status: str, value: str = CANCELLED) -> DataFrame:
    """Every status but the cancelled one; a missing status stays."""
    return df.filter(~quoted(status).eqNullSafe(value))


def payment_accepted(amount: str = "importe", folio: str = "folio_fiscal") -> Column:
    return to_number(quoted(amount)).isNotNull() & quoted(folio).isNotNull()


def flag_payments(df: DataFrame, amount: str = "importe", folio: str = "folio_fiscal") -> DataFrame:
    """Adds ``accepted``; every row is either accepted or rejected."""
    return df.withColumn("accepted", payment_accepted(amount, folio))


def split_payments(df: DataFrame, amount: str = "importe", folio: str = "folio_fiscal"):
    """(accepted rows with a numeric amount, rejected rows as they came)."""
    flag = payment_accepted(amount, folio)
    accepted = df.filter(flag).withColumn(amount, to_number(quoted(amount)))
    return accepted, df.filter(~flag)
