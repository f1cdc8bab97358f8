"""Sales measures in local and base currency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sales_measures(quantity: Column, unit_price: Column, cost_price: Column, rate: Column) -> dict[str, Column]:
    """Line total, cost and margin; base-currency amounts are rounded to cents."""
    local = quantity * unit_price
    revenue = F.round(local / rate, 2)
    cost = F.round(quantity * cost_price / rate, 2)
    return {
        "LineTotalLocal": local,
        "LineTotalBaseCurrency": revenue,
        "LineCostBaseCurrency": cost,
        "GrossMarginBaseCurrency": F.round(revenue - cost, 2),
    }


def cents(amount: Column) -> Column:
    """A cent-rounded double as a whole number of cents."""
    return F.rint(amount * 100).cast("bigint")


def exact_sum(amount: Column) -> Column:
    """Sum of cent-rounded doubles that does not depend on the order of rows.

    Cents add up exactly as integers; the total is a double again at the end. A total
    beyond 9.2e16 raises an error.
    """
    return F.sum(cents(amount)) / 100
