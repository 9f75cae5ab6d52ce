"""The five questions on customer documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from reshelve.functions.money import cents, money, net_price, total
from reshelve.operators.document import Documents, headers, unwind_lines, unwind_orders

DETAIL_FIELDS = ("customer_id", "name", "nation", "region", "order_id", "status", "total_price",
                 "order_date", "line_number", "quantity", "extended_price", "discount",
                 "return_flag", "line_status", "ship_date")


def _pick(docs: Documents, customer_id=None, low=None, high=None) -> Documents:
    if customer_id is not None:
        docs = docs.of_customer(customer_id)
    if low is not None:
        docs = docs.where(F.col("customer_id").between(low, high))
    return docs


def d1(docs: Documents, customer_id: int | None = None) -> DataFrame:
    """Id, name, nation and region of a document; no row if there is none."""
    return headers(_pick(docs, customer_id))


def d2(docs: Documents, customer_id: int | None = None) -> DataFrame:
    """Order lines unwound, 15 fields; missing orders and lines stay as nulls."""
    return unwind_lines(_pick(docs, customer_id), keep_empty=True).select(*DETAIL_FIELDS)


def d2_count(docs: Documents, customer_id: int | None = None) -> DataFrame:
    """Number of unwound rows per customer."""
    return d2(docs, customer_id).groupBy("customer_id").agg(F.count(F.lit(1)).alias("row_count"))


def d2_sample(docs: Documents, customer_id: int | None = None, k: int = 3) -> DataFrame:
    """The first ``k`` unwound rows of each customer as JSON text."""
    by_key = Window.partitionBy("customer_id").orderBy(
        F.asc_nulls_first("order_id"), F.asc_nulls_first("line_number"),
        *[F.asc_nulls_first(f) for f in DETAIL_FIELDS[9:]])
    return (d2(docs, customer_id)
            .withColumn("position", F.row_number().over(by_key))
            .where(F.col("position") <= k)
            .select("customer_id", "position",
                    F.to_json(F.struct(*DETAIL_FIELDS)).alias("document")))


def d3(docs: Documents, customer_id: int | None = None) -> DataFrame:
    """Order count and value by status; a missing status is a group, a missing price 0."""
    return (unwind_orders(_pick(docs, customer_id))
            .groupBy("customer_id", "status")
            .agg(F.count(F.lit(1)).alias("order_count"),
                 total(money("total_price")).alias("total_value")))


def d4(docs: Documents, region: str | None = None, low: int | None = None,
       high: int | None = None) -> DataFrame:
    """Customers of a region within an inclusive id range."""
    found = headers(_pick(docs, None, low, high))
    if region is not None:
        found = found.where(F.col("region") == region)
    return found.select("customer_id", "name", "region")


def d4_count(docs: Documents, low: int | None = None, high: int | None = None) -> DataFrame:
    """Number of customers found per region."""
    return d4(docs, None, low, high).groupBy("region").agg(F.count(F.lit(1)).alias("customers"))


def customer_revenue(docs: Documents, low: int | None = None,
                     high: int | None = None) -> DataFrame:
    """Net revenue and line count per customer, unordered."""
    return (unwind_lines(_pick(docs, None, low, high))
            .groupBy("customer_id", "name")
            .agg(cents(total(net_price())).alias("total_revenue"),
                 F.count(F.lit(1)).alias("total_orders")))


def d5(docs: Documents, low: int | None = None, high: int | None = None) -> DataFrame:
    """Net revenue per customer, greatest first. ``total_orders`` counts order lines, as the
    name is used by the query this answers."""
    return customer_revenue(docs, low, high).orderBy(F.desc("total_revenue"), "customer_id")
