"""Division and rounding of rates and averages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double, 0 where the denominator is not positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator).otherwise(F.lit(0.0))


def round_binary(value: Column, digits: int) -> Column:
    """Round a non-negative double by its exact binary value, ties to even.

    ``round`` and ``bround`` go through the shortest decimal text of the double, so 0.35
    (really 0.34999...) counts as a tie there. Here the scaled value is kept as a product
    and its rounding error, which together are exact.
    """
    scale = 10 ** digits
    splitter = value * 134217729.0
    high = splitter - (splitter - value)
    low = value - high
    product = value * float(scale)
    error = (high * float(scale) - product) + low * float(scale)
    floor = F.floor(product).cast("double")
    excess = product - floor - 0.5
    up = (excess > 0) | ((excess == 0) & ((error > 0) | ((error == 0) & (floor % 2 == 1))))
    return (floor + F.when(up, 1.0).otherwise(0.0)) / float(scale)
