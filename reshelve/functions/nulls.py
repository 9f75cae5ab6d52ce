"""Null tests as plain predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def complete(df: DataFrame, columns=None) -> Column:
    """Whether every column holds a value; NaN counts as none.

    A conjunction of null tests says the same as ``dropna``, but reaches the file scan and
    lets Catalyst drop the parts of a union that are null by construction.
    """
    tests = []
    for name in columns or df.columns:
        tests.append(F.col(name).isNotNull())
        if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
            tests.append(~F.isnan(name))
    return reduce(Column.__and__, tests)
