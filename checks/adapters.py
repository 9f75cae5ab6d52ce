"""Fit the test tables to the schemas the library reads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from reshelve.operators.document import MAX_ROWS, Documents, nest_tables
from reshelve.operators.prepare import enrich
from reshelve.operators.wide import to_wide, upsert
from reshelve.schema import JOINED_TABLES, LOG_COLUMNS, REGIONS, RETURN_FLAGS
from reshelve.session import configure, shared_folder
from reshelve.sources.request_log import read_log
from reshelve.sources.tables import Tables, read_parquet_tables

# Labels of the comparison; the last one has no samples.
CATALOGUE = [
    ("Q1", "clicks and views", "A", "click", False),
    ("Q1", "clicks and views", "B", "view", False),
    ("Q2", "purchases and signups", "A", "purchase", False),
    ("Q2", "purchases and signups", "B", "signup", True),
    ("Q3", "errors", "A", "error", False),
    ("Q3", "errors", "B", "missing", False),
]


def source_tables(spark: SparkSession, folder: str) -> Tables:
    """The five joined tables. Commit and receipt dates, which the test lines lack, are
    derived from ship date and line number."""
    configure(spark)
    tables = read_parquet_tables(spark, folder, JOINED_TABLES)
    ship = F.col("l_shipdate").cast("date")
    tables["lineitem"] = tables["lineitem"].withColumns({
        "l_commitdate": F.date_sub(ship, F.col("l_linenumber")),
        "l_receiptdate": F.date_add(ship, F.col("l_linenumber")),
    })
    return tables


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    return enrich(source_tables(spark, folder))


def documents(spark: SparkSession, folder: str, drop_empty: bool = False,
              max_rows: int = MAX_ROWS) -> Documents:
    return nest_tables(source_tables(spark, folder), drop_empty, max_rows)


def kept_documents(spark: SparkSession, folder: str) -> Documents:
    """Documents stored as they are, for questions that read them twice."""
    docs, path = documents(spark, folder), new_folder(spark, "pieces")
    docs.pieces.write.parquet(path)
    return Documents(spark.read.parquet(path))


def wide_table(spark: SparkSession, folder: str) -> DataFrame:
    return upsert(to_wide(enriched(spark, folder)))


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a request log: one event is one request."""
    configure(spark)
    failed = F.col("event_id") % 20 == 0
    kind = F.col("user_id") % 3
    return spark.read.parquet(f"{folder}/events.parquet").select(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("start_ms"),
        F.floor(F.col("value") * 10).cast("bigint").alias("elapsed"),
        F.col("event_type").alias("label"),
        F.when(failed & (kind == 0), "500").when(failed & (kind == 1), "502")
        .when(failed, "503").otherwise("200").alias("response_code"),
        F.when(failed & (kind == 0), "Internal Server Error")
        .when(failed & (kind == 1), "Bad Gateway")
        .when(failed, "Service Unavailable").otherwise("OK").alias("response_message"),
        F.concat(F.lit("Group "), "event_type", F.lit(" 1-"),
                 (1 + F.col("user_id") % 5).cast("string")).alias("thread_name"),
        F.when(failed & (kind == 0), "False").when(failed, "false")
        .otherwise("true").alias("success"),
        F.length("props").cast("bigint").alias("bytes"),
        F.length("event_type").cast("bigint").alias("sent_bytes"),
        (1 + F.col("user_id") % 5).cast("int").alias("group_threads"),
        (1 + F.col("user_id") % 5).cast("int").alias("all_threads"),
        F.when(F.col("event_id") % 7 != 0, F.floor(F.col("value") * 5).cast("bigint"))
        .alias("latency"),
        F.lit(0).cast("bigint").alias("idle_time"),
        F.floor(F.col("value")).cast("bigint").alias("connect"))


def stored_log(spark: SparkSession, folder: str) -> DataFrame:
    """The request log written as CSV and read back, its messages with quotes, commas and line
    breaks in them."""
    log = request_log(spark, folder).withColumn("response_message", F.concat(
        F.lit('said "'), "response_message", F.lit('",\nwent on')))
    path = new_folder(spark, "log")
    headers = [F.col(name).alias(header) for header, (name, _, _) in LOG_COLUMNS.items()]
    log.select(*headers).write.csv(path, header=True, escape='"', escapeQuotes=True)
    return read_log(spark, path)


def lookups(spark: SparkSession, folder: str) -> DataFrame:
    """The events as lookups: one event asks for one customer and two ranges of customers.
    Some of the customers asked for do not exist."""
    configure(spark)
    asked = F.col("user_id") * 10 + F.col("event_id") % 11

    def choice(values, index):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))

    return spark.read.parquet(f"{folder}/events.parquet").select(
        F.col("event_id").alias("sample_id"), asked.alias("customer_id"),
        choice(REGIONS, F.col("event_id") % 5).alias("region"),
        choice(RETURN_FLAGS, F.col("event_id") % 3).alias("return_flag"),
        (F.col("user_id") * 10).alias("region_start"),
        (F.col("user_id") * 10 + 100).alias("region_end"),
        asked.alias("revenue_start"), (asked + 10).alias("revenue_end"))


def wide_lookups(spark: SparkSession, folder: str) -> DataFrame:
    """The same lookups with ranges of one id up to a hundred million. Some end before they
    start."""
    start = F.col("customer_id") - 5
    end = (F.when(F.col("sample_id") % 50 == 0, start - 1 - F.col("sample_id") % 7)
           .otherwise(start + F.pow(F.lit(10), F.col("sample_id") % 9).cast("bigint") - 1))
    return lookups(spark, folder).withColumns({
        "region_start": start, "region_end": end, "revenue_start": start, "revenue_end": end})


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, which compare alike across engines."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("date").cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)
