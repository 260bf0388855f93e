"""Integration of orders with invoices, portal accounts and penalties into one row per order."""

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cotejo.functions.clean import line_amount, parse_currency, strip_key
from cotejo.operators.dedup import dedup_first
from cotejo.operators.filters import active_only, not_cancelled
from cotejo.operators.lookup import LookupSpec, collapse, populate, populate_all
from cotejo.operators.skew import join_unique
from cotejo.values import NOT_FOUND

INVOICE_KEY = ("Referencia", "Factura")
INVOICE_CHECK = LookupSpec(("Referencia", "Total"), ("numero_orden_suministro", "Importe"), ("orden_remision",))
ACCOUNT_INVOICE = LookupSpec(("Folio fiscal",), ("UUID",), ("Referencia",))
ORDER_INVOICE = LookupSpec(("numero_orden_suministro",), ("Referencia",), ("UUID", "Folio"))
ORDER_ACCOUNT = LookupSpec(("numero_orden_suministro",), ("Orden de suministro",), ("Estado de la factura",))
ORDER_PENALTY = LookupSpec(
    ("numero_orden_suministro",), ("ORDEN DE SUMINISTRO",), ("OFICIO",), single_numbers=("PENA",)
)


@dataclass(frozen=True)
class Integrated:
    orders: DataFrame
    accounts: DataFrame
    invoices: DataFrame


def with_amount(orders: DataFrame) -> DataFrame:
    return orders.withColumn("Importe", line_amount("precio_unitario", "cantidad_solicitada"))


def unique_invoices(invoices: DataFrame) -> DataFrame:
    """Active invoices, one per order and invoice number after all whitespace left the keys."""
    return dedup_first(active_invoices(invoices), INVOICE_KEY)


def active_invoices(invoices: DataFrame) -> DataFrame:
    return active_only(invoices, "UUID Descripción").withColumns({k: strip_key(k) for k in INVOICE_KEY})


def clean_invoices(invoices: DataFrame, orders: DataFrame | None = None, **options) -> DataFrame:
    """Unique active invoices; with orders at hand, the delivery note of the order with the same amount."""
    single = unique_invoices(invoices)
    return single if orders is None else populate(single, orders, INVOICE_CHECK, asked=active_invoices(invoices), **options)


def backfill_orders(accounts: DataFrame, invoices: DataFrame, **options) -> DataFrame:
    """Accounts that are not cancelled, order keys filled in through their invoice.

    A folio with any row that lacks its order gets the invoice's order on all its rows, ``no localizado`` where no
    invoice has the folio. Rows without a folio stay as they are.
    """
    kept = not_cancelled(accounts, "Estado de la factura")
    open_folios = (
        kept.filter(F.col("`Orden de suministro`").isNull() & F.col("`Folio fiscal`").isNotNull())
        .select(F.col("`Folio fiscal`").alias("_folio"))
        .distinct()
    )
    found = collapse([(invoices, ACCOUNT_INVOICE)], wanted=open_folios, **options).withColumnsRenamed({"Referencia": "_order"})
    fills = open_folios.join(found, F.col("_folio") == F.col("_key0"), "left").select(
        "_folio", F.coalesce("_order", F.lit(NOT_FOUND)).alias("_order")
    )
    return (
        join_unique(kept, ["Folio fiscal"], fills, ["_folio"])
        .withColumn("Orden de suministro", F.coalesce("_order", F.col("`Orden de suministro`")))
        .drop("_order")
    )


def clean_accounts(accounts: DataFrame, invoices: DataFrame, **options) -> DataFrame:
    return backfill_orders(accounts, invoices, **options).withColumn("Total", parse_currency("`Total`"))


def enrich_orders(
    priced: DataFrame, invoices: DataFrame, accounts: DataFrame, penalties: DataFrame, file_date, **options
) -> DataFrame:
    """Orders with invoice, account status, penalty and snapshot: three lookups in one pass over the orders."""
    lookups = [(invoices, ORDER_INVOICE), (accounts, ORDER_ACCOUNT), (penalties, ORDER_PENALTY)]
    return populate_all(priced, lookups, **options).withColumn("file_date", stamp(file_date))


def integrate(
    orders: DataFrame, invoices: DataFrame, accounts: DataFrame, penalties: DataFrame, file_date, **options
) -> Integrated:
    """All three cleaned tables. The lookups read the invoices without the delivery note, which they do not need."""
    priced = with_amount(orders)
    single = unique_invoices(invoices)
    states = clean_accounts(accounts, single, **options)
    return Integrated(
        enrich_orders(priced, single, states, penalties, file_date, **options),
        states,
        populate(single, priced, INVOICE_CHECK, asked=active_invoices(invoices), **options),
    )


def stamp(file_date):
    """The snapshot: the group's date cut to the hour."""
    moment = datetime.datetime.fromisoformat(str(file_date)).replace(minute=0, second=0, microsecond=0)
    return F.lit(moment.isoformat(" ")).cast("timestamp_ntz")
