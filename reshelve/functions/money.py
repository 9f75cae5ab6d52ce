"""Price expressions in exact decimals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from reshelve.schema import MONEY


def money(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast(MONEY)


def net_price(price="extended_price", discount="discount") -> Column:
    return money(price) * (F.lit(1) - money(discount))


def gross_price(price="extended_price", discount="discount", tax="tax") -> Column:
    return net_price(price, discount) * (F.lit(1) + money(tax))


def total(amount: Column) -> Column:
    """Sum where a null amount adds nothing and an empty sum is zero."""
    return F.coalesce(F.sum(amount), F.lit(0))


def cents(amount: Column) -> Column:
    """Round a total half up to whole cents."""
    return F.round(amount, 2)
