"""Many lookups in one job.

A parameter table holds one row per lookup. Facts are first narrowed to the customers asked
for by a semi join and aggregated per customer, then matched back to the lookups, so a
customer asked for many times is aggregated once. Spark broadcasts the parameters when they
are small and shuffles them otherwise. Ranges are answered by running totals, or by bins of ids
where the rows themselves are wanted; neither depends on how wide a range is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from reshelve.functions.money import cents
from reshelve.operators.document import Documents
from reshelve.operators.narrow import checked_broadcast, lines_of, short
from reshelve.operators.ranges import covered, range_totals, rows_in_ranges
from reshelve.operators.wide import of_customers
from reshelve.plans import document, relational, wide as wide_plan
from reshelve.schema import REGIONS, RETURN_FLAGS

REGION_WIDTH = 100
REVENUE_WIDTH = 10


def _choice(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]),
                        (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def parameters(spark: SparkSession, n: int, max_id: int) -> DataFrame:
    """``n`` lookups spread evenly over the ids 1 to ``max_id``, the same on every run."""
    i = F.col("sample_id")
    spread = F.pmod(i * 2_654_435_761, F.lit(2**40))

    def upto(limit: int) -> Column:
        return F.pmod(spread, F.lit(max(limit, 1))) + 1

    return (spark.range(n).withColumnRenamed("id", "sample_id")
            .select(i, upto(max_id).alias("customer_id"),
                    _choice(REGIONS, i).alias("region"),
                    _choice(RETURN_FLAGS, i).alias("return_flag"),
                    upto(max_id - 1000).alias("region_start"),
                    upto(max_id - 50).alias("revenue_start"))
            .withColumn("region_end", F.col("region_start") + REGION_WIDTH)
            .withColumn("revenue_end", F.col("revenue_start") + REVENUE_WIDTH))


def parameters_for(customers: DataFrame, n: int | None = None) -> DataFrame:
    """``n`` lookups over the ids the customers have, one per customer if no number is given."""
    found = customers.agg(F.max("c_custkey").alias("max_id"), F.count(F.lit(1)).alias("n")).first()
    return parameters(customers.sparkSession, found.n if n is None else n, found.max_id or 0)


def keys(params: DataFrame) -> DataFrame:
    """The customers asked for, once each."""
    return params.select(F.col("customer_id").cast("bigint").alias("customer_id")).distinct()


def range_keys(params: DataFrame, ids: DataFrame, start: str, end: str) -> DataFrame:
    """Those of the given customers that are inside any of the ranges, once each."""
    found = covered(ids.select(F.col("customer_id").alias("id")), params, start, end)
    return found.withColumnRenamed("id", "customer_id")


def narrow_customers(tables: dict[str, DataFrame], wanted: DataFrame) -> dict[str, DataFrame]:
    """The customers of the wanted ids. Few ids are broadcast, so that customers are filtered
    where they are read: the small side of the left join that follows could not be."""
    few = checked_broadcast(wanted.withColumnRenamed("customer_id", "c_custkey"))
    return {**tables, "customer": tables["customer"].join(few, "c_custkey", "left_semi")}


def narrow_tables(tables: dict[str, DataFrame], wanted: DataFrame) -> dict[str, DataFrame]:
    """The customers and orders of the wanted ids, and the lines of those orders."""
    def kept(df, column):
        return df.join(wanted.withColumnRenamed("customer_id", column), column, "left_semi")

    orders = kept(tables["orders"], "o_custkey")
    return {**tables, "customer": kept(tables["customer"], "c_custkey"), "orders": orders,
            "lineitem": lines_of(orders, tables["lineitem"])}


def lookup(params: DataFrame, answers: DataFrame, fill: tuple[str, ...] = ()) -> DataFrame:
    """Match one answer row per customer to each lookup. A customer that is not there gives
    ``found`` false, and 0 in the columns to fill."""
    matched = params.join(answers.withColumn("found", F.lit(True)), "customer_id", "left")
    matched = matched.withColumn("found", F.coalesce("found", F.lit(False)))
    return matched.fillna(0, list(fill)) if fill else matched


def points(params: DataFrame, *columns: str) -> DataFrame:
    return params.select("sample_id", "customer_id", *columns)


def _range_count(params: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers found per lookup, 0 where there are none."""
    ranges = params.select("sample_id", "region", "region_start", "region_end")
    values = customers.select("region", F.col("customer_id").cast("bigint").alias("id"),
                              F.lit(1).cast("bigint").alias("customers"))
    return range_totals(ranges, values, "region_start", "region_end", ["region"])


def _range_revenue(params: DataFrame, per_customer: DataFrame) -> DataFrame:
    """Orders and revenue per lookup, from one row per customer."""
    ranges = params.select("sample_id", "revenue_start", "revenue_end")
    values = per_customer.select(F.col("customer_id").cast("bigint").alias("id"), "orders",
                                 "revenue")
    return (range_totals(ranges, values, "revenue_start", "revenue_end")
            .withColumn("grand_total", cents(F.col("revenue"))).drop("revenue"))


# Relational model

def r1(params: DataFrame, tables) -> DataFrame:
    return lookup(points(params), relational.r1(narrow_customers(tables, keys(params))))


def r2(params: DataFrame, tables) -> DataFrame:
    answers = relational.r2_summary(narrow_tables(tables, keys(params)))
    return lookup(points(params), answers, ("line_count", "revenue"))


def r3(params: DataFrame, tables) -> DataFrame:
    orders = tables["orders"].join(
        keys(params).withColumnRenamed("customer_id", "o_custkey"), "o_custkey", "left_semi")
    return points(params).join(relational.r3({"orders": orders}), "customer_id")


def r4(params: DataFrame, tables) -> DataFrame:
    return _range_count(params, relational.r4(tables))


def _order_revenue(params: DataFrame, tables) -> DataFrame:
    ids = tables["customer"].select(F.col("c_custkey").alias("customer_id"))
    wanted = range_keys(params, ids, "revenue_start", "revenue_end")
    return relational.order_revenue(narrow_tables(tables, wanted))


def r5(params: DataFrame, tables) -> DataFrame:
    per_customer = (_order_revenue(params, tables).groupBy("customer_id")
                    .agg(F.count(F.lit(1)).alias("orders"), F.sum("revenue").alias("revenue")))
    return _range_revenue(params, per_customer)


def r5_top(params: DataFrame, tables, k: int = 5) -> DataFrame:
    """The ``k`` orders of greatest revenue per lookup. Only the ``k`` greatest of each
    customer can be among them, so the others are dropped before the ranges are joined. Each
    range is answered once, however many lookups ask for it."""
    order = (F.desc("revenue"), F.asc("order_id"))
    bounds = ("revenue_start", "revenue_end")
    best = (_order_revenue(params, tables)
            .withColumn("revenue", cents(F.col("revenue")))
            .withColumn("place", F.row_number().over(
                Window.partitionBy("customer_id").orderBy(*order)))
            .where(F.col("place") <= k).drop("place"))
    # Sorts as the orders do: greatest revenue first, none last.
    listed = F.struct(F.col("revenue").isNull().alias("none"), (-F.col("revenue")).alias("less"),
                      "order_id", "customer_id", "name", "revenue")
    found = (rows_in_ranges(params.select(*bounds).distinct(), best, "customer_id", *bounds)
             .withColumn("place", F.row_number().over(Window.partitionBy(*bounds).orderBy(*order)))
             .where(F.col("place") <= k)
             .groupBy(*bounds).agg(F.sort_array(F.collect_list(listed)).alias("rows")))
    # A lookup of several rows asks for the greatest orders of all its ranges.
    asked = (params.groupBy("sample_id").agg(F.collect_list(F.struct(*bounds)).alias("ranges"))
             .select("sample_id", F.size("ranges").alias("n"), F.inline("ranges")))
    answered = asked.join(found, list(bounds)).select("sample_id", "n", "rows")
    merged = F.slice(F.sort_array(F.flatten(F.collect_list("rows"))), 1, k)
    return (answered.where("n = 1").select("sample_id", "rows")
            .unionByName(answered.where("n > 1").groupBy("sample_id").agg(merged.alias("rows")))
            .select("sample_id", F.posexplode("rows").alias("at", "row"))
            .select("sample_id", (F.col("at") + 1).alias("place"), "row.customer_id", "row.name",
                    "row.order_id", "row.revenue"))


# Document model

def narrow_documents(docs: Documents, wanted: DataFrame) -> Documents:
    """The documents of few customers, which are broadcast; all if many are asked for, as
    answers are matched to lookups anyway and whole documents would be shuffled for nothing."""
    few = short(wanted)
    return docs if few is None else docs.within(few)


def d1(params: DataFrame, docs: Documents) -> DataFrame:
    return lookup(points(params), document.d1(docs.within(keys(params))))


def d2(params: DataFrame, docs: Documents) -> DataFrame:
    answers = document.d2_count(narrow_documents(docs, keys(params)))
    return lookup(points(params), answers, ("row_count",))


def d3(params: DataFrame, docs: Documents) -> DataFrame:
    return points(params).join(document.d3(narrow_documents(docs, keys(params))), "customer_id")


def d4(params: DataFrame, docs: Documents) -> DataFrame:
    return _range_count(params, document.d4(docs))


def d5(params: DataFrame, docs: Documents) -> DataFrame:
    """Net revenue and line count per lookup and customer."""
    wanted = range_keys(params, document.d1(docs), "revenue_start", "revenue_end")
    ranges = params.select("sample_id", "revenue_start", "revenue_end")
    revenue = document.customer_revenue(narrow_documents(docs, wanted))
    return (rows_in_ranges(ranges, revenue, "customer_id", "revenue_start", "revenue_end")
            .select("sample_id", "customer_id", "name", "total_revenue", "total_orders"))


# Wide model

def _rows(params: DataFrame, wide: DataFrame) -> DataFrame:
    return of_customers(wide, keys(params))


def k1(params: DataFrame, wide: DataFrame) -> DataFrame:
    return lookup(points(params), wide_plan.k1(_rows(params, wide)))


def k2(params: DataFrame, wide: DataFrame) -> DataFrame:
    answers = wide_plan.k2_summary(_rows(params, wide))
    return lookup(points(params), answers, ("line_count", "revenue"))


def k3(params: DataFrame, wide: DataFrame) -> DataFrame:
    answers = wide_plan.k3(_rows(params, wide))
    return lookup(points(params), answers, ("unique_orders", "total_lines"))


def k4(params: DataFrame, wide: DataFrame) -> DataFrame:
    answers = wide_plan.k4(_rows(params, wide)).withColumn("found", F.lit(True))
    return (points(params, "return_flag")
            .join(answers, ["customer_id", "return_flag"], "left")
            .withColumn("found", F.coalesce("found", F.lit(False)))
            .fillna(0, ["matching_lines", "total_quantity"]))


def k5(params: DataFrame, wide: DataFrame) -> DataFrame:
    answers = wide_plan.k5_total(_rows(params, wide))
    return lookup(points(params), answers, ("orders", "grand_total"))
