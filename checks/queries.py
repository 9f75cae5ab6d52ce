"""One entry per query and operator, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from checks import adapters as a
from reshelve.config import PipelineConfig, SourceConfig
from reshelve.functions import text
from reshelve.functions.convert import convert_values
from reshelve.operators.document import MARKS, MAX_ROWS, Documents, nest_documents, unwind_lines, unwind_orders
from reshelve.operators.prepare import clean, enrich, locate
from reshelve.operators.wide import BUCKET, cluster_by, conform, to_wide
from reshelve.plans import batch, compare, document, latency, relational, wide
from reshelve.plans.latency_table import append_counts, percentiles_of, read_counts
from reshelve.plans.pipeline import STAGES, run
from reshelve.sinks.collection import load_collection, read_collection
from reshelve.sinks.documents import measured, split_by_size, write_documents
from reshelve.sinks.staged import stage, write_report
from reshelve.sinks.wide import write_wide
from reshelve.sources.stores import read_documents, read_wide
from reshelve.sources.tables import read_staged

Query = Callable[[SparkSession, str], DataFrame]

HOUR = 3_600_000
DAY = 24 * HOUR
REGION = "ASIA"
CUSTOMER = 7


def _document_shape(spark, folder, drop_empty=False, max_rows=MAX_ROWS):
    """Counts and totals taken from inside the nested value, summed over the pieces."""
    docs = a.documents(spark, folder, drop_empty, max_rows).pieces
    lines = F.flatten(F.transform("orders", lambda o: o["lineitems"]))
    own = F.filter("orders", lambda o: ~F.col("carried"))

    def total(values, field):
        return F.sum(F.aggregate(
            F.filter(F.transform(values, lambda v: v[field].cast("decimal(15,2)")),
                     lambda v: v.isNotNull()),
            F.lit(0).cast("decimal(25,2)"), lambda x, y: (x + y).cast("decimal(25,2)")))

    first = F.get("orders", F.lit(0))["order_id"]
    return docs.groupBy("customer_id", "name", "nation", "region").agg(
        F.sum(F.size(own)).cast("int").alias("order_elements"),
        F.sum(F.size(lines)).cast("int").alias("line_elements"),
        total(own, "total_price").alias("order_value"),
        total(lines, "extended_price").alias("line_value"), F.min(first).alias("first_order"))


def _document_marks(spark, folder):
    """Of customers with up to 20 rows and more: pieces, first pieces, and whether they are whole."""
    docs = a.documents(spark, folder, max_rows=20).pieces
    marks = docs.groupBy("customer_id").agg(
        F.count_if("first").alias("firsts"), F.bool_and("whole").alias("whole"),
        F.max(F.size(F.flatten(F.transform("orders", lambda o: o["lineitems"])))).alias("most"))
    return marks.select("customer_id", "firsts", "whole", (F.col("most") <= 60).alias("bounded"))


def _repeated_orders(spark, folder, max_rows):
    """Value by status where every third order id stands for two orders."""
    tables = a.source_tables(spark, folder)
    orders = tables["orders"]
    twice = orders.where("o_orderkey % 3 = 0").withColumns(
        {"o_orderstatus": F.lit("Z"), "o_totalprice": F.col("o_totalprice") + 1})
    path = a.new_folder(spark, "enriched")
    enrich({**tables, "orders": orders.unionByName(twice)}).write.parquet(path)
    docs = nest_documents(spark.read.parquet(path), max_rows=max_rows)
    return document.d3(docs)


def _document_rejects(spark, folder):
    """Documents above 16 KiB as JSON, with the reason."""
    docs = a.documents(spark, folder).pieces
    _, rejected = split_by_size(measured(convert_values(docs)), 16 * 1024)
    return rejected.select("customer_id", "document_bytes", "reason")


def _stored_wide(spark, folder):
    path = a.new_folder(spark, "wide")
    write_wide(to_wide(a.enriched(spark, folder)), path, truncate=True, buckets=8)
    return read_wide(spark, path)


def _stored_documents(spark, folder):
    path = a.new_folder(spark, "documents")
    write_documents(a.documents(spark, folder), path, "parquet", 8 * 1024, buckets=8)
    return read_documents(spark, path)


def _wide_after_nothing(spark, folder):
    """A load without rows, then one with."""
    path = a.new_folder(spark, "wide")
    rows = to_wide(a.enriched(spark, folder))
    write_wide(rows.limit(0), path, truncate=True)
    write_wide(rows, path)
    return read_wide(spark, path).drop(BUCKET)


def _load_counts(spark, folder):
    """What a load says it did, against the documents there are."""
    docs = a.documents(spark, folder)
    counts = write_documents(docs, a.new_folder(spark, "documents"), "parquet", 8 * 1024)
    return spark.createDataFrame([(counts.attempted, counts.inserted, counts.rejected)],
                                 "attempted long, inserted long, rejected long")


def _converted_dates(spark, folder):
    """Orders with a time of day, which conversion takes off; the dates as full text."""
    tables = a.source_tables(spark, folder)
    orders = tables["orders"].withColumn("o_orderdate", F.col("o_orderdate") + F.make_interval(
        hours=F.col("o_orderkey") % 24, mins=F.lit(59)))
    path = a.new_folder(spark, "enriched")
    enrich({**tables, "orders": orders}).write.parquet(path)
    docs = Documents(convert_values(nest_documents(spark.read.parquet(path)).pieces))
    return unwind_orders(docs).where("order_id IS NOT NULL").select(
        "customer_id", "order_id", F.date_format("order_date", "yyyy-MM-dd HH:mm:ss").alias(
            "order_date"))


def _in_order(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows of a sorted result of a few rows, with the place they come in."""
    listed = rows.coalesce(1).agg(F.collect_list(F.struct(*columns)).alias("rows"))
    return listed.select(F.posexplode("rows").alias("place", "row")).select("place", "row.*")


def _clustered_order(spark, folder):
    """Rows of each customer that come after a row with a greater key; there should be none."""
    rows = cluster_by(a.wide_table(spark, folder)).withColumn(
        "at", F.monotonically_increasing_id())
    key = F.struct("order_id", "line_number")
    before = F.lag(key).over(Window.partitionBy("customer_id").orderBy("at"))
    return rows.withColumn("late", before > key).groupBy("customer_id").agg(
        F.count_if("late").alias("misplaced"))


def _collection_counts(spark, folder):
    """The same load into a store that refuses large documents."""
    counts = load_collection(a.documents(spark, folder), a.new_folder(spark, "collection"),
                             8 * 1024, batch_size=100)
    return spark.createDataFrame([(counts.attempted, counts.inserted, counts.rejected)],
                                 "attempted long, inserted long, rejected long")


def _collection(spark, folder, limit):
    path = a.new_folder(spark, "collection")
    docs = a.documents(spark, folder)
    load_collection(docs, path, limit, batch_size=50)
    fields = [f for f in convert_values(docs.pieces).schema if f.name not in MARKS]
    return read_collection(spark, path, T.StructType(fields))


def _staged(spark, folder):
    path = a.new_folder(spark, "staged")
    stage(a.source_tables(spark, folder), path)
    return read_staged(spark, path)["lineitem"]


def _documents_sink(spark, folder):
    """Documents above 8 KiB are rejected but their lines kept, so all lines come back."""
    path = a.new_folder(spark, "documents")
    write_documents(a.documents(spark, folder), path, "parquet", 8 * 1024)
    return document.d2(read_documents(spark, path))


def _wide_sink(spark, folder):
    """The same load twice, the second appended to the first."""
    path = a.new_folder(spark, "wide")
    rows = to_wide(a.enriched(spark, folder))
    write_wide(rows, path, truncate=True, buckets=8)
    write_wide(rows, path)
    return read_wide(spark, path).drop(BUCKET)


def _wide_killed_load(spark, folder):
    """A load of all rows, then one whose tasks fail at some of its rows."""
    path = a.new_folder(spark, "wide")
    rows = to_wide(a.enriched(spark, folder))
    write_wide(rows, path, truncate=True, buckets=8)
    broken = rows.withColumn("status", F.when(F.col("order_id") % 50 == 0, F.raise_error(F.lit(
        "planned"))).otherwise("gone"))
    try:
        write_wide(broken, path)
    except PySparkException:
        return read_wide(spark, path).drop(BUCKET)
    raise AssertionError("the load was meant to fail")


def _wide_partial_load(spark, folder):
    """A load of all rows, then one that changes a third of the orders and adds some."""
    path = a.new_folder(spark, "wide")
    rows = to_wide(a.enriched(spark, folder))
    write_wide(rows.where("order_id % 5 != 0"), path, truncate=True, buckets=8)
    write_wide(rows.where("order_id % 5 = 0 OR order_id % 3 = 0").withColumn(
        "status", F.when(F.col("order_id") % 3 == 0, "Z").otherwise(F.col("status"))), path)
    return read_wide(spark, path).drop(BUCKET)


def _pipeline(spark, folder):
    """Staged tables to documents and wide table, then the lines of both counted."""
    path = a.new_folder(spark, "pipeline")
    staged = f"{path}/staging"
    stage(a.source_tables(spark, folder), staged)
    config = PipelineConfig(SourceConfig(parquet_path=folder), staged, f"{path}/documents",
                            f"{path}/wide", document_format="parquet", wide_buckets=8)
    run(spark, config, set(STAGES) - {"stage"})
    from_documents = document.d2_count(read_documents(spark, f"{path}/documents"))
    from_wide = wide.k2_summary(read_wide(spark, f"{path}/wide")).drop("revenue")
    return from_documents.join(from_wide, "customer_id", "left")


def _comparison(spark, folder):
    stats = latency.rollup(a.request_log(spark, folder))
    return compare.compare(stats, compare.catalogue(spark, a.CATALOGUE))


def _comparison_sink(spark, folder):
    path = a.new_folder(spark, "comparison")
    write_report(_comparison(spark, folder), path)
    return spark.read.parquet(path)


def _found_text(spark, folder):
    tables, params = a.source_tables(spark, folder), a.lookups(spark, folder)
    return batch.r1(params, tables).select(
        "sample_id", text.found_text(F.col("found"), F.col("customer_id"), F.col("name"),
                                     F.col("nation"), F.col("region")).alias("response"))


def _range_text(spark, folder):
    found = batch.r4(a.lookups(spark, folder), a.source_tables(spark, folder))
    return found.select("sample_id", text.range_text(
        F.col("region"), F.col("region_start"), F.col("region_end"),
        F.col("customers")).alias("response"))


def _rows_text(spark, folder):
    docs = a.kept_documents(spark, folder)
    sample = document.d2_sample(docs).groupBy("customer_id").agg(
        F.sort_array(F.collect_list(F.struct("position", "document"))).alias("sample"))
    return document.d2_count(docs).join(sample, "customer_id").select(
        "customer_id", text.rows_text(F.col("customer_id"), F.col("row_count"),
                                      F.col("sample.document")).alias("response"))


def _customers_text(spark, folder):
    """A line per customer of a narrow range, gathered per lookup, greatest revenue first."""
    params = a.lookups(spark, folder)
    line = F.struct((-F.col("total_revenue")).alias("order"), "customer_id", "name",
                    "total_revenue", "total_orders")
    gathered = batch.d5(params, a.kept_documents(spark, folder)).groupBy("sample_id").agg(
        F.sort_array(F.collect_list(line)).alias("customers"))
    return params.join(gathered, "sample_id").select("sample_id", text.customers_text(
        F.col("revenue_start"), F.col("revenue_end"), F.col("customers")).alias("response"))


def _orders_text(spark, folder):
    """The five greatest orders of a range and its totals; ranges without orders have none."""
    params, tables = a.lookups(spark, folder), a.source_tables(spark, folder)
    top = batch.r5_top(params, tables).groupBy("sample_id").agg(F.sort_array(F.collect_list(
        F.struct("place", "name", "order_id", "revenue"))).alias("shown"))
    return batch.r5(params, tables).join(top, "sample_id").select("sample_id", text.orders_text(
        F.col("revenue_start"), F.col("revenue_end"), F.col("shown"), F.col("orders"),
        F.col("grand_total")).alias("response"))


def _stored_counts(spark, folder):
    """The counts of the log, stored in two parts."""
    path, log = a.new_folder(spark, "counts"), a.request_log(spark, folder)
    for k in range(2):
        append_counts(log.where(F.col("start_ms") % 2 == k), path)
    return read_counts(spark, path)


def _enriched_prepared(build):
    return lambda spark, folder: build(a.enriched(spark, folder))


def _tables(build):
    return lambda spark, folder: build(a.source_tables(spark, folder))


def _docs(build):
    return lambda spark, folder: build(a.documents(spark, folder))


def _wide(build):
    return lambda spark, folder: build(a.wide_table(spark, folder))


def _log(build):
    return lambda spark, folder: build(a.request_log(spark, folder))


def _batch_tables(build):
    return lambda spark, folder: build(a.lookups(spark, folder), a.source_tables(spark, folder))


def _wide_ranges(build):
    return lambda spark, folder: build(a.wide_lookups(spark, folder),
                                       a.source_tables(spark, folder))


def _batch_docs(build):
    return lambda spark, folder: build(a.lookups(spark, folder), a.documents(spark, folder))


def _batch_wide(build):
    return lambda spark, folder: build(a.lookups(spark, folder), a.wide_table(spark, folder))


def _located(tables):
    t = clean(tables)
    return locate(t["customer"], t["nation"], t["region"]).select(
        "customer_id", "name", "nation_name", "region_name")


QUERIES: dict[str, Query] = {
    # preparation
    "clean_customer": _tables(lambda t: clean(t)["customer"]),
    "clean_orders": _tables(lambda t: clean(t)["orders"]),
    "clean_lineitem": _tables(lambda t: clean(t)["lineitem"]),
    "located_customers": _tables(_located),
    "enriched_rows": a.enriched,
    "staged_lineitem": _staged,
    # wide model
    "wide_conform": _enriched_prepared(lambda e: conform(to_wide(e))),
    "wide_upsert": a.wide_table,
    "wide_clustered": _wide(lambda w: cluster_by(w)),
    "wide_clustered_order": _clustered_order,
    "wide_sink": _wide_sink,
    "wide_after_empty_load": _wide_after_nothing,
    "wide_killed_load": _wide_killed_load,
    "wide_partial_load": _wide_partial_load,
    # document model
    "document_shape": _document_shape,
    "document_shape_without_empty": lambda s, f: _document_shape(s, f, True),
    "document_converted": _docs(
        lambda d: unwind_lines(Documents(convert_values(d.pieces)), keep_empty=True)),
    "document_converted_dates": _converted_dates,
    "document_shape_in_pieces": lambda s, f: _document_shape(s, f, max_rows=5),
    "document_marks": _document_marks,
    "document_repeated_orders": lambda s, f: _repeated_orders(s, f, MAX_ROWS),
    "document_repeated_orders_in_pieces": lambda s, f: _repeated_orders(s, f, 3),
    "document_rejects": _document_rejects,
    "document_load_counts": _load_counts,
    "collection_load_counts": _collection_counts,
    "collection_rejects": lambda s, f: _collection(s, f, 16 * 1024)[1],
    "collection_status": lambda s, f: document.d3(_collection(s, f, 2 ** 24)[0]),
    "document_sink": _documents_sink,
    "unwind_keep_empty": lambda s, f: unwind_lines(a.documents(s, f, True), keep_empty=True),
    "unwind_drop_empty": lambda s, f: unwind_lines(a.documents(s, f, True), keep_empty=False),
    "pipeline_counts": _pipeline,
    # five questions, relational
    "r1_customer": _tables(relational.r1),
    "r2_detail": _tables(relational.r2),
    "r2_summary": _tables(relational.r2_summary),
    "r3_status": _tables(relational.r3),
    "r4_region": _tables(lambda t: relational.r4(t, REGION)),
    "r4_count": _tables(relational.r4_count),
    "r5_revenue": _tables(relational.r5),
    "r5_top": _tables(relational.r5_top),
    "r5_top_order": _tables(lambda t: _in_order(
        relational.r5_top(t, k=50), "customer_id", "order_id", "revenue")),
    "r5_total": _tables(relational.r5_total),
    # five questions, documents
    "d1_customer": _docs(document.d1),
    "d2_detail": _docs(document.d2),
    "d2_count": _docs(document.d2_count),
    "d2_sample": _docs(document.d2_sample),
    "d3_status": _docs(document.d3),
    "d4_region": _docs(lambda d: document.d4(d, REGION)),
    "d4_count": _docs(document.d4_count),
    "d5_revenue": _docs(document.d5),
    "d5_first_order": _docs(lambda d: _in_order(
        document.d5(d).limit(50), "customer_id", "total_revenue", "total_orders")),
    # five questions, wide rows
    "k1_customer": _wide(wide.k1),
    "k2_detail": _wide(wide.k2),
    "k2_summary": _wide(wide.k2_summary),
    "k2_sample": _wide(wide.k2_sample),
    "k3_orders": _wide(wide.k3),
    "k4_flags": _wide(wide.k4),
    "k5_revenue": _wide(wide.k5),
    "k5_total": _wide(wide.k5_total),
    "k5_first": _wide(wide.k5_first),
    # single lookups on stored models
    "r2_lookup": _tables(lambda t: relational.r2(t, CUSTOMER)),
    "d2_lookup": lambda s, f: document.d2(_stored_documents(s, f), CUSTOMER),
    "k2_lookup": lambda s, f: wide.k2(_stored_wide(s, f), CUSTOMER),
    "stored_batch_d2": lambda s, f: batch.d2(a.lookups(s, f), _stored_documents(s, f)),
    "stored_batch_k2": lambda s, f: batch.k2(a.lookups(s, f), _stored_wide(s, f)),
    # texts
    "text_found": _found_text,
    "text_range": _range_text,
    "text_lines": _wide(lambda w: wide.k2_summary(w).select(
        text.lines_text(F.col("customer_id"), F.col("line_count"), F.col("revenue"))
        .alias("response"))),
    "text_flags": _wide(lambda w: wide.k4(w).select(
        text.flag_text(F.col("customer_id"), F.col("return_flag"), F.col("matching_lines"),
                       F.col("total_quantity")).alias("response"))),
    "text_distinct": _wide(lambda w: wide.k3(w).select(
        text.distinct_text(F.col("customer_id"), F.col("unique_orders"), F.col("total_lines"))
        .alias("response"))),
    "text_status": _tables(lambda t: relational.r3(t).select(
        "customer_id", text.status_text(F.col("status"), F.col("order_count"),
                                        F.col("total_value")).alias("response"))),
    "text_revenue": _wide(lambda w: wide.k5_text(w).select("customer_id", "response")),
    "text_rows": _rows_text,
    "text_customers": _customers_text,
    "text_orders": _orders_text,
    # batches of lookups
    "batch_r1": _batch_tables(batch.r1),
    "batch_r2": _batch_tables(batch.r2),
    "batch_r3": _batch_tables(batch.r3),
    "batch_r4": _batch_tables(batch.r4),
    "batch_r5": _batch_tables(batch.r5),
    "batch_r5_top": _batch_tables(batch.r5_top),
    "batch_r4_wide": _wide_ranges(batch.r4),
    "batch_r5_wide": _wide_ranges(batch.r5),
    "batch_parameters": _tables(lambda t: batch.parameters_for(t["customer"])),
    "batch_d1": _batch_docs(batch.d1),
    "batch_d2": _batch_docs(batch.d2),
    "batch_d3": _batch_docs(batch.d3),
    "batch_d4": _batch_docs(batch.d4),
    "batch_d4_wide": lambda s, f: batch.d4(a.wide_lookups(s, f), a.documents(s, f)),
    "batch_d5": lambda s, f: batch.d5(a.lookups(s, f), a.kept_documents(s, f)),
    "batch_k1": _batch_wide(batch.k1),
    "batch_k2": _batch_wide(batch.k2),
    "batch_k3": _batch_wide(batch.k3),
    "batch_k4": _batch_wide(batch.k4),
    "batch_k5": _batch_wide(batch.k5),
    # request log
    "log_rollup": _log(latency.rollup),
    "log_csv_rollup": lambda s, f: latency.rollup(a.stored_log(s, f)),
    "log_csv_messages": lambda s, f: a.stored_log(s, f).groupBy(
        "response_message", latency.failed().alias("failed")).agg(
            F.count(F.lit(1)).alias("samples")),
    "log_totals": _log(latency.totals),
    "log_percentiles": _log(lambda g: latency.percentiles(g, ["label"])),
    "log_statistics": _log(latency.statistics),
    "log_stored_percentiles": lambda s, f: percentiles_of(_stored_counts(s, f), ["label"]),
    "log_stored_mornings": lambda s, f: percentiles_of(
        _stored_counts(s, f).where(F.pmod("bucket_ms", F.lit(DAY)) < DAY // 2), ["failed"]),
    "log_error_types": _log(latency.error_types),
    "log_top_errors": _log(latency.top_errors),
    "log_apdex": _log(latency.apdex),
    "log_bands": _log(latency.bands),
    "log_outcome_share": _log(latency.outcome_share),
    "log_histogram": _log(latency.histogram),
    "log_percentile_curve": _log(latency.percentile_curve),
    "log_means_over_time": _log(lambda g: latency.means_over_time(g, HOUR)),
    "log_percentiles_over_time": _log(lambda g: latency.percentiles_over_time(g, DAY)),
    "log_hits_over_time": _log(lambda g: latency.hits_over_time(g, HOUR)),
    "log_codes_over_time": _log(lambda g: latency.codes_over_time(g, HOUR)),
    "log_transactions_over_time": _log(lambda g: latency.transactions_over_time(g, HOUR)),
    "log_total_over_time": _log(lambda g: latency.total_over_time(g, HOUR)),
    "log_threads_over_time": _log(lambda g: latency.threads_over_time(g, HOUR)),
    "log_elapsed_by_threads": _log(latency.elapsed_by_threads),
    "log_elapsed_by_mean_threads": _log(latency.elapsed_by_mean_threads),
    "log_bytes_over_time": _log(lambda g: latency.bytes_over_time(g, HOUR)),
    "log_median_by_load": _log(lambda g: latency.median_by_load(g, "elapsed", HOUR)),
    "log_latency_by_load": _log(lambda g: latency.median_by_load(g, "latency", HOUR)),
    "log_comparison": _comparison,
    "log_comparison_sink": _comparison_sink,
}


def registered() -> dict[str, Query]:
    """Every query, its result in types that compare across engines."""
    def wrapped(query: Query) -> Query:
        return lambda spark, folder: a.plain(query(spark, folder))

    return {name: wrapped(query) for name, query in QUERIES.items()}
