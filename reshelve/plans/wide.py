"""The five questions on the wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from reshelve.functions import text
from reshelve.functions.money import cents, gross_price, net_price, total
from reshelve.functions.nulls import complete
from reshelve.operators.wide import of_customer
from reshelve.schema import RETURN_FLAGS, WIDE_SCHEMA


def _pick(wide: DataFrame, customer_id=None) -> DataFrame:
    return wide if customer_id is None else of_customer(wide, customer_id)


def k1(wide: DataFrame, customer_id: int | None = None) -> DataFrame:
    """Id, name, nation and region from the first row of a customer in key order."""
    # The fields are constant for a customer as a rule, so the first grouping leaves a row per
    # customer before its shuffle. Order and line make one number, which sums up by hash.
    fields = ("customer_id", "name", "nation", "region")
    place = (F.col("order_id").cast("decimal(20,0)") * F.lit(2 ** 32)
             + F.col("line_number").cast("decimal(10,0)"))
    groups = _pick(wide, customer_id).groupBy(*fields).agg(F.min(place).alias("place"))
    return (groups.groupBy("customer_id")
            .agg(F.min(F.struct("place", *fields[1:])).alias("row"))
            .select("customer_id", "row.name", "row.nation", "row.region"))


def k2(wide: DataFrame, customer_id: int | None = None) -> DataFrame:
    """All columns of a customer's order lines."""
    return _pick(wide, customer_id).select(*WIDE_SCHEMA.names)


def k2_summary(wide: DataFrame, customer_id: int | None = None) -> DataFrame:
    """Line count and net revenue; a line lacking an operand counts but adds nothing."""
    return (_pick(wide, customer_id).groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("line_count"),
                 cents(total(net_price())).alias("revenue")))


def k2_sample(wide: DataFrame, customer_id: int | None = None, k: int = 3) -> DataFrame:
    """The first ``k`` order lines of each customer in key order."""
    by_key = Window.partitionBy("customer_id").orderBy("order_id", "line_number")
    return (_pick(wide, customer_id).select("customer_id", "order_id", "line_number", "status")
            .withColumn("position", F.row_number().over(by_key))
            .where(F.col("position") <= k))


def k3(wide: DataFrame, customer_id: int | None = None) -> DataFrame:
    """Distinct orders and lines. Lines are counted per order first, so the distinct count
    becomes a plain count."""
    return (_pick(wide, customer_id).groupBy("customer_id", "order_id")
            .agg(F.count(F.lit(1)).alias("lines"))
            .groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("unique_orders"), F.sum("lines").alias("total_lines")))


def k4(wide: DataFrame, customer_id: int | None = None, flags=RETURN_FLAGS) -> DataFrame:
    """Lines and quantity of each return flag asked for, 0 where a customer has none."""
    columns = []
    for flag in flags:
        hit = F.col("return_flag") == flag
        columns += [F.count_if(hit).alias(f"lines_{flag}"),
                    total(F.when(hit, F.col("quantity"))).alias(f"quantity_{flag}")]
    sums = _pick(wide, customer_id).groupBy("customer_id").agg(*columns)
    per_flag = F.array(*[
        F.struct(F.lit(flag).alias("return_flag"), F.col(f"lines_{flag}").alias("matching_lines"),
                 F.col(f"quantity_{flag}").alias("total_quantity")) for flag in flags])
    return sums.select("customer_id", F.inline(per_flag))


def order_revenue(wide: DataFrame, customer_id: int | None = None) -> DataFrame:
    """Gross revenue per order; an order whose lines all lack an operand is absent."""
    rows = _pick(wide, customer_id)
    return (rows.where(complete(rows, ("extended_price", "discount", "tax")))
            .groupBy("customer_id", "order_id")
            .agg(F.sum(gross_price()).alias("revenue")))


def k5(wide: DataFrame, customer_id: int | None = None) -> DataFrame:
    """Gross revenue per order in key order."""
    return (order_revenue(wide, customer_id)
            .withColumn("revenue", cents(F.col("revenue")))
            .orderBy("customer_id", "order_id"))


def k5_total(wide: DataFrame, customer_id: int | None = None) -> DataFrame:
    """Number of orders and their summed revenue per customer."""
    return (order_revenue(wide, customer_id).groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("orders"),
                 cents(F.sum("revenue")).alias("grand_total")))


def k5_first(wide: DataFrame, customer_id: int | None = None, k: int = 5) -> DataFrame:
    """The first ``k`` orders of each customer in key order, with their revenue."""
    by_key = Window.partitionBy("customer_id").orderBy("order_id")
    return (order_revenue(wide, customer_id)
            .withColumn("position", F.row_number().over(by_key))
            .where(F.col("position") <= k)
            .select("customer_id", "position", "order_id",
                    cents(F.col("revenue")).alias("revenue")))


def k5_text(wide: DataFrame, customer_id: int | None = None, k: int = 5) -> DataFrame:
    """The response text: the first ``k`` orders of a customer and the totals."""
    shown = (k5_first(wide, customer_id, k).groupBy("customer_id")
             .agg(F.sort_array(F.collect_list(F.struct("position", "order_id", "revenue")))
                  .alias("shown")))
    return (k5_total(wide, customer_id).join(shown, "customer_id")
            .select("customer_id", text.revenue_text(
                F.col("customer_id"), F.col("orders"), F.col("shown"), F.col("grand_total"))
                .alias("response")))
