"""Narrow a large table to wanted keys before it is shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reshelve.session import stored

# Up to this many keys of one column are broadcast, some tens of megabytes.
BROADCAST_KEYS = 1_000_000


def checked_broadcast(keys: DataFrame) -> DataFrame:
    """Hint a broadcast of a key column if it is short, which is counted first.

    Size estimates know nothing of how few keys a lookup leaves, and by the time adaptive
    execution sees it the large side is already being shuffled. The keys are worked out once, in
    the shared checkpoint folder, for the count and for the join.
    """
    keys = stored(keys)
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def short(keys: DataFrame) -> DataFrame | None:
    """The keys with a hint to broadcast them, or None if they are too many for that."""
    keys = stored(keys)
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else None


def lines_of(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """The lines of some orders."""
    wanted = checked_broadcast(orders.select(F.col("o_orderkey").alias("l_orderkey")))
    return lineitem.join(wanted, "l_orderkey", "left_semi")
