"""Exact money arithmetic and rounded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from comanda.schemas import MONEY, MONEY_SUM


def line_amount(quantity: Column, price: Column) -> Column:
    return (quantity * price).cast(MONEY)


def money_sum(amount: Column | str) -> Column:
    """Sum of decimals: exact, so the same for every partitioning."""
    return F.sum(amount).cast(MONEY_SUM)


def money_avg(amount: Column | str) -> Column:
    return F.round(F.avg(amount), 2).cast("double")


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, two decimals, rounded half up."""
    ratio = part.cast("decimal(18,0)") * 100 / whole.cast("decimal(18,0)")
    return F.round(ratio, 2).cast("double")


def growth_percent(now: Column, before: Column) -> Column:
    """Relative change in percent; NULL without a non-zero previous value."""
    ratio = (now - before).cast("decimal(20,2)") / F.nullif(before, F.lit(0)).cast("decimal(20,2)")
    return F.round(ratio * 100, 2).cast("double")
