"""Clean the source tables and join them into one enriched frame."""

from __future__ import annotations

from pyspark.sql import DataFrame

from reshelve.functions.nulls import complete
from reshelve.schema import LINE_FIELDS, RENAMES

CLEANED = ("customer", "orders", "lineitem")


def clean(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Drop rows holding any null from the fact tables and give columns business names.

    Every source column counts for the null check, also those dropped afterwards.
    """
    cleaned = {}
    for name, names in RENAMES.items():
        df = tables[name]
        if name in CLEANED:
            df = df.where(complete(df))
        cleaned[name] = df.withColumnsRenamed(names)
    cleaned["lineitem"] = cleaned["lineitem"].select("order_id", *LINE_FIELDS)
    return cleaned


def locate(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Add nation and region to customers, keeping customers that lack one.

    Neither side is hinted: Spark broadcasts the dimensions while their files are below its
    threshold and joins by shuffle beyond it.
    """
    return customer.join(nation, "nation_key", "left").join(region, "region_key", "left")


def enrich(tables: dict[str, DataFrame], cleaned: bool = False) -> DataFrame:
    """One row per customer, order and line; customers without orders and orders without
    lines are kept with nulls.

    The two outer joins are written as inner joins plus the rows without a partner. A skewed
    key of an outer join cannot be split on its null-padded side and all padding would share
    one null key, whereas inner joins split on either side and anti joins need only the
    distinct keys.
    """
    t = tables if cleaned else clean(tables)
    customers = locate(t["customer"], t["nation"], t["region"])
    orders, lines = t["orders"], t["lineitem"]

    placed = customers.join(orders, "customer_id")
    detail = placed.join(lines, "order_id")
    bare = placed.join(lines.select("order_id").distinct(), "order_id", "left_anti")
    idle = customers.join(orders.select("customer_id").distinct(), "customer_id", "left_anti")

    enriched = (detail
                .unionByName(bare, allowMissingColumns=True)
                .unionByName(idle, allowMissingColumns=True))
    own = [c for c in t["customer"].columns if c not in ("customer_id", "nation_key")]
    placed_columns = [c for c in orders.columns if c not in ("customer_id", "order_id")]
    named = ["region_key", "nation_key", "customer_id", *own, "order_id", *placed_columns,
             *LINE_FIELDS, "nation_name", "region_name"]
    rest = [c for c in enriched.columns if c not in named]
    return enriched.select(*named, *rest)

