"""What the physical plans must look like, and answers on badly skewed keys."""

import contextlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks import adapters
from conftest import plan
from fixtures import line, order, tables
from reshelve.operators.document import nest_documents
from reshelve.operators import narrow
from reshelve.operators.prepare import clean, enrich
from reshelve.operators.wide import to_wide, upsert
from reshelve.plans import batch, document, latency, relational, wide


@contextlib.contextmanager
def settings(spark, **values):
    names = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


NO_BROADCAST = {"autoBroadcastJoinThreshold": "-1", "adaptive__autoBroadcastJoinThreshold": "-1"}
SKEW = {**NO_BROADCAST, "adaptive__skewJoin__skewedPartitionThresholdInBytes": "20k",
        "adaptive__skewJoin__skewedPartitionFactor": "1.5",
        "adaptive__advisoryPartitionSizeInBytes": "20k"}


@pytest.fixture(scope="module")
def source(spark, folder):
    return adapters.source_tables(spark, folder)


def scans(df) -> list[str]:
    return [text for text in plan(df).split("\n") if "FileScan" in text]


def scans_of(df, table) -> list[str]:
    found = [text for text in scans(df) if f"/{table}.parquet" in text]
    assert found
    return found


def scan_of(df, table) -> str:
    [found] = scans_of(df, table)
    return found


def test_a_customer_id_reaches_every_scan(source):
    for query in (relational.r2, relational.r2_summary):
        df = query(source, 7)
        assert all("EqualTo(c_custkey,7)" in text for text in scans_of(df, "customer"))
        assert all("EqualTo(o_custkey,7)" in text for text in scans_of(df, "orders"))
    assert "EqualTo(o_custkey,7)" in scan_of(relational.r3(source, 7), "orders")


def test_an_id_range_reaches_both_scans(source):
    df = relational.r5(source, 100, 110)
    for table, key in (("customer", "c_custkey"), ("orders", "o_custkey")):
        for text in scans_of(df, table):
            assert f"GreaterThanOrEqual({key},100)" in text
            assert f"LessThanOrEqual({key},110)" in text


def test_lines_are_narrowed_before_their_shuffle(spark, source, monkeypatch):
    params = spark.createDataFrame([(0, 7, 100, 110)], "sample_id bigint, customer_id bigint, "
                                                       "revenue_start bigint, revenue_end bigint")
    queries = [lambda: relational.r2(source, 7), lambda: relational.r2_summary(source, 7),
               lambda: relational.r5(source, 100, 110), lambda: batch.r2(params, source),
               lambda: batch.r5(params, source)]
    answers = []
    with settings(spark, **NO_BROADCAST):
        for query in queries:
            text = plan(query())
            above_scan = text[:text.index("/lineitem.parquet")].split("Exchange hashpartitioning")[-1]
            assert "LeftSemi" in above_scan and "BroadcastHashJoin" in above_scan
            answers.append(sorted(map(str, query().collect())))
        monkeypatch.setattr(narrow, "BROADCAST_KEYS", 0)
        for query, answer in zip(queries, answers):
            assert "BroadcastHashJoin" not in plan(query())
            assert sorted(map(str, query().collect())) == answer


def test_only_the_needed_columns_are_read(source):
    read = scan_of(relational.r5(source), "lineitem").split("ReadSchema: ")[1]
    assert sorted(part.split(":")[0] for part in read[len("struct<"):-1].split(",")) == [
        "l_discount", "l_extendedprice", "l_orderkey", "l_tax"]


def test_null_checks_reach_the_scan(spark, source):
    with settings(spark, maxMetadataStringLength="10000"):
        assert "IsNotNull(o_orderpriority)" in scan_of(clean(source)["orders"], "orders")


def test_wide_rows_need_no_padding(source):
    assert "Union" not in plan(to_wide(enrich(source)))
    assert len(scans(to_wide(enrich(source)))) == 5


def test_dimensions_are_broadcast_only_below_the_threshold(spark, source):
    assert "BroadcastHashJoin" in plan(relational.r1(source))
    with settings(spark, **NO_BROADCAST):
        assert "Broadcast" not in plan(relational.r1(source))


def test_amounts_are_summed_before_the_joins(spark, source):
    with settings(spark, **NO_BROADCAST):
        below_join = plan(relational.r5(source)).split("SortMergeJoin")[-1]
    assert "partial_sum" in below_join


def test_first_rows_are_cut_before_the_shuffle(spark, source):
    rows = to_wide(enrich(source))
    docs = nest_documents(enrich(source))
    log = spark.createDataFrame([], "label string, success string, response_code string, "
                                    "response_message string, elapsed bigint")
    for df in (wide.k2_sample(rows), wide.k5_first(rows), document.d2_sample(docs),
               latency.top_errors(log)):
        assert "WindowGroupLimit" in plan(df)
    assert "TakeOrderedAndProject" in plan(relational.r5_top(source))


def test_samples_are_counted_before_ranking(spark):
    log = spark.range(10).selectExpr("id AS elapsed", "'x' AS label")
    text = plan(latency.percentiles(log, ["label"]))
    windows = text.split("Window ")
    assert len(windows) > 2 and "partial_count" in windows[-1]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A third of the orders belong to customer 1, a third of the lines to order 5."""
    path = str(tmp_path_factory.mktemp("skewed"))
    orders = spark.range(9000).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500).alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"), F.col("id").cast("double").alias("o_totalprice"),
        F.lit("1996-01-02").cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("c").alias("o_comment"))
    lines = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.xxhash64("id") % 4000 + 4000)
        .alias("l_orderkey"), F.col("id").cast("int").alias("l_linenumber"),
        F.lit(1.0).alias("l_quantity"), (F.col("id") % 977 + 0.25).alias("l_extendedprice"),
        F.lit(0.1).alias("l_discount"), F.lit(0.05).alias("l_tax"),
        F.lit("R").alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"), F.lit("1996-03-13").cast("date").alias("l_shipdate"),
        F.lit("1996-03-13").cast("date").alias("l_commitdate"),
        F.lit("1996-03-13").cast("date").alias("l_receiptdate"))
    small = tables(spark, [(i, f"C{i}", 1, "x") for i in range(520)], [order(1, 1)], [line(1, 1)])
    for name, df in {**small, "orders": orders, "lineitem": lines}.items():
        df.repartition(8).write.parquet(f"{path}/{name}")
    return {name: spark.read.parquet(f"{path}/{name}") for name in small}


def test_skewed_joins_are_split(spark, skewed):
    with settings(spark, **SKEW):
        for query in (relational.r2, lambda t: to_wide(enrich(t))):
            df = query(skewed)
            df.collect()
            assert "skew=true" in plan(df)


def test_skew_changes_no_answer(spark, skewed):
    t = clean(skewed)
    expected = (t["customer"]
                .join(t["orders"].join(t["lineitem"], "order_id", "left"), "customer_id", "left")
                .join(t["nation"], "nation_key", "left").join(t["region"], "region_key", "left"))
    wanted = expected.columns
    plain = Counter(map(tuple, expected.drop("o_comment", "c_comment").collect()))
    whole = document.d5(nest_documents(expected)).collect()
    with settings(spark, **SKEW):
        found = enrich(skewed).select(*wanted).drop("o_comment", "c_comment")
        assert Counter(map(tuple, found.collect())) == plain
        docs = nest_documents(enrich(skewed), max_rows=3000)
        assert docs.pieces.where("NOT whole").count() > 1
        assert document.d5(docs).collect() == whole


def test_a_repeated_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    text = plan(upsert(rows, keys=("k",)))
    assert text.index("Exchange") < text.index("partial_max")
    assert sorted(map(tuple, upsert(rows, keys=("k",)).collect())) == [(0, 999), (1, 997), (2, 998)]
