"""Helpers on columns that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SPACE = r"[\x20\x09-\x0D]+"


def text_or_empty(column: str) -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def hex_of(fingerprint: Column) -> Column:
    """A 64-bit number as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def distance(left: Column, right: Column) -> Column:
    """Number of differing bits of two 64-bit numbers."""
    return F.bit_count(left.bitwiseXOR(right))


def signed(mask: int) -> int:
    """A 64-bit mask as the signed number Spark stores."""
    return mask - (1 << 64) if mask >= 1 << 63 else mask
