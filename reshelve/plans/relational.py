"""The five questions on the normalised tables.

Each function answers for all customers; a customer id, region or id range narrows it.
Catalyst pushes the narrowing to every scan that carries the customer key, and lines are
narrowed by the orders left. Keys of customer, orders, nation and region are primary keys in
the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reshelve.functions.money import cents, gross_price, money, net_price
from reshelve.operators.narrow import lines_of

Tables = dict[str, DataFrame]


def _pick(df: DataFrame, column: str, customer_id=None, low=None, high=None) -> DataFrame:
    if customer_id is not None:
        df = df.where(F.col(column) == customer_id)
    if low is not None:
        df = df.where(F.col(column).between(low, high))
    return df


def _orders_and_lines(t: Tables, customer_id=None, low=None, high=None):
    orders = _pick(t["orders"], "o_custkey", customer_id, low, high)
    if customer_id is None and low is None:
        return orders, t["lineitem"]
    return orders, lines_of(orders, t["lineitem"])


def _located(t: Tables) -> DataFrame:
    return (t["customer"]
            .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
            .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")))


def r1(t: Tables, customer_id: int | None = None) -> DataFrame:
    """Customer with nation and region; no row if there is none."""
    return _pick(_located(t), "c_custkey", customer_id).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
        F.col("n_name").alias("nation"), F.col("r_name").alias("region"))


def r2(t: Tables, customer_id: int | None = None) -> DataFrame:
    """Order lines of a customer in 16 columns."""
    orders, lines = _orders_and_lines(t, customer_id)
    return (_pick(_located(t), "c_custkey", customer_id)
            .join(orders, F.col("c_custkey") == F.col("o_custkey"))
            .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
            .select(
                F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
                F.col("n_name").alias("nation"), F.col("r_name").alias("region"),
                F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
                money("o_totalprice").alias("total_price"),
                F.col("o_orderdate").alias("order_date"),
                F.col("l_linenumber").alias("line_number"),
                money("l_quantity").alias("quantity"),
                money("l_extendedprice").alias("extended_price"),
                money("l_discount").alias("discount"), money("l_tax").alias("tax"),
                F.col("l_returnflag").alias("return_flag"),
                F.col("l_linestatus").alias("line_status"),
                F.col("l_shipdate").alias("ship_date")))


def _per_order(lines: DataFrame, amount) -> DataFrame:
    """Line count and amount per order, summed before the orders are joined."""
    return lines.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum(amount).alias("amount"))


def r2_summary(t: Tables, customer_id: int | None = None) -> DataFrame:
    """Line count and net revenue per customer that has lines."""
    orders, lines = _orders_and_lines(t, customer_id)
    per_order = _per_order(lines, F.coalesce(net_price("l_extendedprice", "l_discount"), F.lit(0)))
    sums = (orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
            .groupBy("o_custkey")
            .agg(F.sum("line_count").alias("line_count"), F.sum("amount").alias("revenue")))
    return (_pick(_located(t), "c_custkey", customer_id)
            .join(sums, F.col("c_custkey") == F.col("o_custkey"))
            .select(F.col("c_custkey").alias("customer_id"), "line_count",
                    cents(F.col("revenue")).alias("revenue")))


def r3(t: Tables, customer_id: int | None = None) -> DataFrame:
    """Order count and value by status."""
    return (_pick(t["orders"], "o_custkey", customer_id)
            .groupBy(F.col("o_custkey").alias("customer_id"),
                     F.col("o_orderstatus").alias("status"))
            .agg(F.count(F.lit(1)).alias("order_count"),
                 F.sum(money("o_totalprice")).alias("total_value")))


def r4(t: Tables, region: str | None = None, low: int | None = None,
       high: int | None = None) -> DataFrame:
    """Customers of a region within an inclusive id range."""
    found = _pick(_located(t), "c_custkey", None, low, high)
    if region is not None:
        found = found.where(F.col("r_name") == region)
    return found.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
                        F.col("r_name").alias("region"))


def r4_count(t: Tables, low: int | None = None, high: int | None = None) -> DataFrame:
    """Number of customers found per region."""
    return r4(t, None, low, high).groupBy("region").agg(F.count(F.lit(1)).alias("customers"))


def order_revenue(t: Tables, low: int | None = None, high: int | None = None) -> DataFrame:
    """Gross revenue per order, unordered."""
    orders, lines = _orders_and_lines(t, None, low, high)
    per_order = _per_order(lines, gross_price("l_extendedprice", "l_discount", "l_tax"))
    return (orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
            .join(_pick(t["customer"], "c_custkey", None, low, high),
                  F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
                    F.col("o_orderkey").alias("order_id"), F.col("amount").alias("revenue")))


def r5(t: Tables, low: int | None = None, high: int | None = None) -> DataFrame:
    """Gross revenue per order of the customers in an id range, greatest first."""
    return (order_revenue(t, low, high)
            .withColumn("revenue", cents(F.col("revenue")))
            .orderBy(F.desc("revenue"), "order_id"))


def r5_top(t: Tables, low: int | None = None, high: int | None = None,
           k: int = 5) -> DataFrame:
    """The ``k`` orders of greatest revenue."""
    return r5(t, low, high).limit(k)


def r5_total(t: Tables, low: int | None = None, high: int | None = None) -> DataFrame:
    """Number of orders and their summed revenue."""
    return order_revenue(t, low, high).agg(
        F.count(F.lit(1)).alias("orders"),
        cents(F.coalesce(F.sum("revenue"), F.lit(0))).alias("grand_total"))
