"""Nest enriched rows into customer documents and unwind them again.

Every customer is nested by the same steps, in pieces of bounded size. A customer of up to
``max_rows`` rows is one piece, its document. The orders of a larger one are dealt over several
pieces by a hash of the order, and the lines of an order that is too large by itself over pieces
of their own by a hash of the line. So neither a hot customer nor a hot order ever meets in one
task, and no answer depends on where the cuts are: one piece of a customer is marked as its
first, and pieces that carry on an order are marked, so that orders are counted once.

:func:`nest_documents` nests rows that are already joined. :func:`nest_tables` starts from the
source tables and joins nested orders instead, so that lines are shuffled flat once and nested once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from reshelve.config import DOCUMENT_LIMIT_BYTES
from reshelve.operators.narrow import checked_broadcast
from reshelve.operators.prepare import clean, enrich, locate
from reshelve.operators.wide import of_customer, of_customers
from reshelve.schema import CUSTOMER_FIELDS, LINE_FIELDS, ORDER_FIELDS
from reshelve.session import stored

# No order or line takes fewer bytes as JSON; the field names alone take most of them. So a
# customer with more rows than this is above the size limit whatever the values are.
MIN_ROW_BYTES = 96

# Lines that share a count, on average, where it is only asked whether any order has very many.
LINES_PER_SLOT = 256

# Marks of a piece: it is the whole document, the first piece of its customer, it carries on
# an order of another piece.
MARKS = ("whole", "first", "carried")


def rows_within(limit_bytes: int) -> int:
    """Number of rows above which no document can be within the limit."""
    return max(1, limit_bytes // MIN_ROW_BYTES)


MAX_ROWS = rows_within(DOCUMENT_LIMIT_BYTES)


@dataclass(frozen=True)
class Documents:
    """Customer documents as pieces: their fields, orders and the marks of a piece.

    ``padded`` tells whether a missing order or line is held as an all-null struct (as the joins
    leave it) or as an empty array. Stored documents are laid out in ``buckets`` of customers.
    """

    pieces: DataFrame
    padded: bool = True
    buckets: int | None = None

    def where(self, condition) -> "Documents":
        """Keep documents by a condition on the top-level fields."""
        return replace(self, pieces=self.pieces.where(condition))

    def of_customer(self, customer_id: int) -> "Documents":
        """Keep the document of one customer."""
        return replace(self, pieces=of_customer(self.pieces, customer_id, self.buckets))

    def within(self, keys: DataFrame) -> "Documents":
        """Keep the documents of the customers listed in ``keys``."""
        return replace(self, pieces=of_customers(self.pieces, keys, self.buckets))


def flat_rows(enriched: DataFrame) -> DataFrame:
    """Enriched rows under the field names of the documents."""
    return enriched.select(
        "customer_id", "name", F.col("nation_name").alias("nation"),
        F.col("region_name").alias("region"), *ORDER_FIELDS, *LINE_FIELDS)


def _slot(hashed: Column, slots: Column) -> Column:
    """A slot by the size of a hash, so that the least hash is in the first slot in use."""
    share = hashed.cast("double") / 2.0 ** 64 + 0.5
    return F.least(F.floor(share * slots), slots - 1).cast("int")


def _line_hash() -> Column:
    return F.xxhash64(*LINE_FIELDS)


def cuts(rows: DataFrame, max_rows: int) -> tuple[DataFrame, DataFrame]:
    """The orders and the customers that have more than ``max_rows`` rows, usually none.

    Rows are counted per order before their shuffle, and customers from those counts. A hot
    order comes with its own fields, as its pieces cannot see each other's.
    """
    orders = rows.groupBy("customer_id", "order_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("status").alias("all_status"),
        F.min("total_price").alias("all_total_price"), F.min("order_date").alias("all_order_date"),
        F.min(_line_hash()).alias("least"))
    parts = F.ceil(F.col("n") / max_rows)
    hot = orders.where(F.col("n") > max_rows).select(
        "customer_id", "order_id", "all_status", "all_total_price", "all_order_date",
        parts.alias("parts"), _slot(F.col("least"), parts).alias("first_part"))
    shelves = F.ceil(F.col("n") / max_rows)
    large = (orders.groupBy("customer_id")
             .agg(F.sum("n").alias("n"), F.min(F.xxhash64("order_id")).alias("least"))
             .where(F.col("n") > max_rows)
             .select("customer_id", shelves.alias("shelves"),
                     _slot(F.col("least"), shelves).alias("first_shelf")))
    return hot, large


def nest(rows: DataFrame, drop_empty: bool = False, max_rows: int = MAX_ROWS) -> DataFrame:
    """Nest flat rows into pieces: lines per order first, then orders per customer.

    Rows are shuffled by order and the nested orders by customer; each grouping keeps to the
    partitioning of the join before it.
    """
    hot, large = cuts(rows, max_rows)
    line = F.struct(*LINE_FIELDS)
    cut = rows.join(hot, ["customer_id", "order_id"], "left")
    part = F.coalesce(_slot(_line_hash(), F.col("parts")), F.lit(0))
    cut = cut.withColumn("part", part).withColumn(
        "carried", F.col("part") != F.coalesce("first_part", F.lit(0)))
    field = {f: F.min(F.coalesce(f"all_{f}", f)).alias(f)
             for f in ("status", "total_price", "order_date")}
    by_order = cut.groupBy("customer_id", "order_id", "name", "nation", "region", "part",
                           "carried").agg(
        *field.values(), F.sort_array(F.collect_list(line)).alias("lineitems"))
    if drop_empty:
        by_order = by_order.withColumn(
            "lineitems", F.filter("lineitems", lambda item: item["line_number"].isNotNull()))
    placed = by_order.join(large, "customer_id", "left")
    shelf = F.coalesce(_slot(F.xxhash64("order_id"), F.col("shelves")), F.lit(0))
    placed = placed.withColumn("shelf", shelf)
    alone = F.when(F.col("carried"), F.struct("order_id", "part"))
    pieces = (placed.groupBy("customer_id", "shelf", "carried", alone.alias("alone"))
              .agg(F.min("name").alias("name"), F.min("nation").alias("nation"),
                   F.min("region").alias("region"),
                   F.sort_array(F.collect_list(F.struct(*ORDER_FIELDS, "lineitems")))
                   .alias("orders"),
                   F.min(F.col("shelves").isNull()).alias("whole"),
                   F.min(F.col("shelf") == F.coalesce("first_shelf", F.lit(0))).alias("first")))
    if drop_empty:
        pieces = pieces.withColumn(
            "orders", F.filter("orders", lambda item: item["order_id"].isNotNull()))
    return pieces.select("customer_id", "name", "nation", "region", "orders", "whole",
                         (F.col("first") & ~F.col("carried")).alias("first"), "carried")


def nest_documents(enriched: DataFrame, drop_empty: bool = False,
                   max_rows: int = MAX_ROWS) -> Documents:
    """Turn enriched rows into documents. They are read twice, to count and to nest, so costly
    ones should be stored before."""
    return Documents(nest(flat_rows(enriched), drop_empty, max_rows), not drop_empty)


def _most_rows(tables: dict[str, DataFrame]) -> int:
    """A number of joined rows that no customer and no order has more of: the product of the most
    rows per key of each table. Only keys are read, of rows that are cleaned away, too. Lines are
    counted by a hash that some orders share, which keeps the counts few and none too low."""
    lines = tables["lineitem"]
    slots = F.lit(lines.count() // LINES_PER_SLOT + 1)
    keys = {name: tables[name].where(F.col(key).isNotNull()).select(F.col(key).alias("key"))
            for name, key in (("orders", "o_custkey"), ("customer", "c_custkey"),
                              ("nation", "n_nationkey"), ("region", "r_regionkey"))}
    keys["lineitem"] = lines.where("l_orderkey IS NOT NULL").select(
        F.pmod(F.xxhash64("l_orderkey"), slots).alias("key"))
    most = [rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"))
            for rows in keys.values()]
    return math.prod(r.most or 1 for r in reduce(DataFrame.unionByName, most).collect())


def _too_large(t: dict[str, DataFrame], max_rows: int) -> tuple[DataFrame, DataFrame]:
    """The customers that have more than ``max_rows`` joined rows and the orders that have more
    lines, whether or not there is such an order. Only keys are counted."""
    lines = t["lineitem"].groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    sums = (t["orders"].select("customer_id", "order_id").join(lines, "order_id", "left")
            .groupBy("customer_id").agg(F.sum(F.coalesce("n", F.lit(1))).alias("rows")))
    copies = locate(t["customer"], t["nation"], t["region"]).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("copies"))
    rows = F.col("copies") * F.coalesce("rows", F.lit(1))
    large = copies.join(sums, "customer_id", "left").where(rows > max_rows)
    hot = lines.where(F.col("n") > max_rows)
    found = stored(large.select("customer_id", F.lit(None).cast("bigint").alias("order_id"))
                   .unionByName(hot.select("order_id"), allowMissingColumns=True))
    return (found.where("customer_id IS NOT NULL").select("customer_id"),
            found.where("order_id IS NOT NULL").select("order_id"))


def _nest_small(t: dict[str, DataFrame], drop_empty: bool) -> DataFrame:
    """One piece per customer, where no customer or order has more rows than a piece.

    Lines are gathered per order and meet their orders, and the nested orders go to their
    customers, whose fields are added last. Rows of customers or orders that repeat a key count as
    often as they would if joined. Rows are sorted once after each shuffle, so that they are
    gathered and joined as they come, with one group in memory at a time.
    """
    line = F.struct(*LINE_FIELDS)
    lines = (_together(t["lineitem"], "order_id").groupBy("order_id")
             .agg(F.sort_array(F.collect_list(line)).alias("lineitems")))
    orders = (_together(t["orders"], "order_id", "customer_id").groupBy("order_id", "customer_id")
              .agg(*[F.min(f).alias(f) for f in ORDER_FIELDS[1:]], F.count(F.lit(1)).alias("n")))
    kinds = {f.name: f.dataType for f in orders.schema} | {
        "lineitems": lines.schema["lineitems"].dataType}
    no_lines = F.array(F.struct(*[F.lit(None).cast(f.dataType).alias(f.name)
                                  for f in kinds["lineitems"].elementType]))
    held_lines = F.coalesce("lineitems", no_lines)
    by_order = orders.join(lines, "order_id", "left").select(
        "customer_id", *ORDER_FIELDS, F.when(F.col("n") == 1, held_lines).otherwise(
            F.sort_array(F.flatten(F.array_repeat(held_lines, F.col("n").cast("int")))))
        .alias("lineitems"))
    nested = F.struct(*ORDER_FIELDS, "lineitems")
    gathered = (_together(by_order, "customer_id").groupBy("customer_id")
                .agg(F.sort_array(F.collect_list(nested)).alias("orders")))
    own = F.struct("name", F.col("nation_name").alias("nation"), F.col("region_name").alias("region"))
    customers = (locate(t["customer"], t["nation"], t["region"]).groupBy("customer_id")
                 .agg(F.collect_list(own).alias("own")))
    empty = F.array(F.struct(*[F.lit(None).cast(kinds[f]).alias(f) for f in ORDER_FIELDS],
                             no_lines.alias("lineitems")))
    held = F.coalesce("orders", empty)
    pieces = customers.join(gathered, "customer_id", "left").select(
        "customer_id", *[F.array_min(F.transform("own", lambda c: c[f])).alias(f)
                         for f in CUSTOMER_FIELDS[1:]],
        F.when(F.size("own") == 1, held).otherwise(_repeated(held)).alias("orders"))
    if drop_empty:
        pieces = pieces.withColumn("orders", F.transform(
            F.filter("orders", lambda o: o["order_id"].isNotNull()),
            lambda o: o.withField("lineitems", F.filter(
                o["lineitems"], lambda item: item["line_number"].isNotNull()))))
    return pieces.withColumns({"whole": F.lit(True), "first": F.lit(True), "carried": F.lit(False)})


def _together(rows: DataFrame, key: str, *then: str) -> DataFrame:
    """Rows of a key in one partition and next to each other."""
    return rows.repartition(key).sortWithinPartitions(key, *then)


def _repeated(orders: Column) -> Column:
    """The orders of a customer that has several rows (``own``): each once per different row, with
    its lines as often as that row is there."""
    times = F.transform(F.array_distinct("own"), lambda c: F.size(
        F.filter("own", lambda other: other.eqNullSafe(c))))
    return F.sort_array(F.flatten(F.transform(orders, lambda o: F.transform(
        times, lambda n: o.withField("lineitems", F.sort_array(F.flatten(
            F.array_repeat(o["lineitems"], n))))))))


def nest_tables(tables: dict[str, DataFrame], drop_empty: bool = False,
                max_rows: int = MAX_ROWS) -> Documents:
    """Documents from the source tables, the same as those of the enriched rows.

    Customers with more than ``max_rows`` rows, usually none, are looked for first and are joined
    and nested in pieces by :func:`nest`, as are all orders of that size. They are not looked for
    where the most rows per key of the tables tell that there are none.
    """
    t = clean(tables)
    if _most_rows(tables) <= max_rows:
        return Documents(_nest_small(t, drop_empty), not drop_empty)
    large, hot = _too_large(t, max_rows)
    some, many = not large.isEmpty(), not hot.isEmpty()
    ids = checked_broadcast(large) if some else None
    small = dict(t)
    if some:
        for name in ("customer", "orders"):
            small[name] = t[name].join(ids, "customer_id", "left_anti")
    if many:
        small["lineitem"] = t["lineitem"].join(checked_broadcast(hot), "order_id", "left_anti")
    pieces = _nest_small(small, drop_empty)
    if some:
        kept = {name: t[name].join(ids, "customer_id", "left_semi") for name in ("customer", "orders")}
        wanted = checked_broadcast(kept["orders"].select("order_id").distinct())
        lines = t["lineitem"].join(wanted, "order_id", "left_semi")
        rows = stored(flat_rows(enrich({**t, **kept, "lineitem": lines}, cleaned=True)))
        pieces = pieces.unionByName(nest(rows, drop_empty, max_rows))
    return Documents(pieces, not drop_empty)


def unwind_orders(docs: Documents, keep_empty: bool = False) -> DataFrame:
    """One row per order, without its lines."""
    unwound = F.explode_outer("orders") if keep_empty else F.explode("orders")
    return (docs.pieces.where("NOT carried").select(*CUSTOMER_FIELDS, unwound.alias("o"))
            .select(*CUSTOMER_FIELDS, *[F.col(f"o.{f}") for f in ORDER_FIELDS]))


def unwind_lines(docs: Documents, keep_empty: bool = False) -> DataFrame:
    """One row per order line, flat."""
    unwind = F.explode_outer if keep_empty else F.explode
    return (docs.pieces.select(*CUSTOMER_FIELDS, unwind("orders").alias("o"))
            .select(*CUSTOMER_FIELDS, *[F.col(f"o.{f}") for f in ORDER_FIELDS],
                    unwind("o.lineitems").alias("l"))
            .select(*CUSTOMER_FIELDS, *ORDER_FIELDS,
                    *[F.col(f"l.{f}") for f in LINE_FIELDS]))


def headers(docs: Documents) -> DataFrame:
    """The top-level fields, one row per customer."""
    return docs.pieces.where("first").select(*CUSTOMER_FIELDS)
