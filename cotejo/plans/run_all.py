"""The stages one after the other: invoices, integration, history load, SQL folder.

Every stage writes its tables and the next one reads them back, so no stage recomputes an earlier one and a lost
executor costs at most the running stage. The first failure stops the run. With ``resume`` a run that is started again
reads back the stages whose inputs haven't changed (``ledger``); the history load adds nothing twice by itself.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cotejo.operators.history import prepare_history
from cotejo.plans.integrate import clean_accounts, clean_invoices, enrich_orders, with_amount
from cotejo.plans.invoices import load_invoices
from cotejo.plans.ledger import Ledger
from cotejo.plans.sql_folder import SqlResult, run_sql_folder
from cotejo.sinks.writers import append_history, write_sheet
from cotejo.values import HISTORY_KEY


@dataclass(frozen=True)
class Inputs:
    orders: DataFrame
    accounts: DataFrame
    penalties: DataFrame
    catalogs: Sequence[DataFrame]
    xml_lines: DataFrame
    tax_status: DataFrame | None = None


def stored_orders(
    spark: SparkSession, inputs: Inputs, root: str, group_id: str, file_date, resume: bool = False, settings: dict | None = None, **options
) -> DataFrame:
    """The integrated orders of a group, every stage on the way stored under ``root`` per sheet and group."""
    ledger = Ledger(spark, root, group_id)
    said = {**(settings or {}), "options": options}

    def keep(sheet: str, sources: Sequence[DataFrame], build: Callable[[], DataFrame], **more) -> DataFrame:
        return ledger.stage(sheet, sources, {**said, **more}, build) if resume else write_sheet(build(), root, sheet, group_id)

    status = [] if inputs.tax_status is None else [inputs.tax_status]
    loaded = keep("loaded", [*inputs.catalogs, inputs.xml_lines, *status], lambda: load_invoices(inputs.catalogs, inputs.xml_lines, inputs.tax_status))
    priced = with_amount(inputs.orders)
    invoices = keep("invoices", [loaded, inputs.orders], lambda: clean_invoices(loaded, priced, **options))
    accounts = keep("accounts", [inputs.accounts, invoices], lambda: clean_accounts(inputs.accounts, invoices, **options))
    sources = [inputs.orders, invoices, accounts, inputs.penalties]
    return keep("orders", sources, lambda: enrich_orders(priced, invoices, accounts, inputs.penalties, file_date, **options), file_date=str(file_date))


def run_all(
    spark: SparkSession, inputs: Inputs, root: str, group_id: str, file_date, table: str, sql_folder: str | None = None, resume: bool = False,
    settings: dict | None = None, **options
) -> list[SqlResult]:
    """Tables under ``root`` per sheet and group, history rows in ``table``; returns the SQL results.

    ``options`` go to the lookups (``order``, ``part_width``, ``overwrite``). With ``resume``, ``settings`` says what else the
    inputs depend on beside their files.
    """
    orders = stored_orders(spark, inputs, root, group_id, file_date, resume, settings, **options)
    append_history(spark, table, prepare_history([orders]), HISTORY_KEY)
    return run_sql_folder(spark, sql_folder) if sql_folder else []
