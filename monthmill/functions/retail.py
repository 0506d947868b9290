"""Expressions on retail transaction columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line revenue is kept as a decimal so that sums do not depend on the order of addition.
MONEY = "decimal(18,4)"


def is_cancelled(invoice: Column) -> Column:
    return F.coalesce(invoice.startswith("C"), F.lit(False))


def is_priced(quantity: Column, price: Column) -> Column:
    return (quantity > 0) & (price > 0)


def is_valid_sale(invoice: Column, customer: Column, quantity: Column, price: Column) -> Column:
    return ~is_cancelled(invoice) & customer.isNotNull() & is_priced(quantity, price)


def is_non_product(code: Column, codes: Iterable[str]) -> Column:
    return F.coalesce(F.upper(code).isin(*codes), F.lit(False))


def revenue(quantity: Column, price: Column) -> Column:
    return (quantity * price).cast(MONEY)


def year_month(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM")


def weekday_name(moment: Column) -> Column:
    return F.date_format(moment, "EEEE")


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole 24-hour days between two moments (not calendar boundaries)."""
    return F.timestamp_diff("DAY", start, end)


def percent(part: Column, whole: Column) -> Column:
    return part.cast("double") / whole.cast("double") * 100
