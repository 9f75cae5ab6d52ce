"""Sources, sinks and the whole run."""

from collections import Counter
from dataclasses import replace
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql.types import DoubleType
from fixtures import line, odd_tables, order, tables

from conftest import plan
from reshelve.config import PipelineConfig, SourceConfig
from reshelve.operators.document import MARKS, nest_documents
from reshelve.operators.prepare import enrich
from reshelve.operators.wide import BUCKET, bucket_of, buckets_for, to_wide
from reshelve.plans import batch, document, pipeline, wide
from reshelve.plans.pipeline import STAGES, StageError, check_stages, choose_stages
from reshelve.schema import document_schema
from reshelve.session import BYTES_PER_SHUFFLE_TASK, configure, shared_folder
from reshelve.sinks.collection import FORMAT
from reshelve.sinks.documents import LoadCounts, write_documents
from reshelve.sinks.staged import stage, write_report
from reshelve.sinks.wide import compact_wide, write_wide
from reshelve.sources.stores import read_documents, read_wide
from reshelve.sources.tables import (
    histogram_options, jdbc_options, probe_options, read_parquet_tables, read_staged, read_tables)


def rows_of(df):
    columns = sorted(set(df.columns) - {BUCKET})
    return Counter(map(str, df.select(*columns).collect()))


@pytest.fixture(scope="module")
def enriched(spark):
    return enrich(odd_tables(spark)).cache()


def test_missing_tables_are_skipped(spark, folder, caplog):
    found = read_parquet_tables(spark, folder)
    assert set(found) == {"lineitem", "orders", "customer", "part", "supplier", "nation", "region"}
    assert "partsupp" in caplog.text


def test_source_settings_come_from_the_environment(spark, folder):
    assert not SourceConfig.from_env({}).use_jdbc
    config = SourceConfig.from_env({"TPCH_USE_JDBC": "True", "TPCH_JDBC_URL": "jdbc:x"})
    assert config.use_jdbc
    with pytest.raises(ValueError, match="user"):
        read_tables(spark, config)
    with pytest.raises(ValueError, match="folder"):
        read_tables(spark, SourceConfig())
    assert "orders" in read_tables(spark, SourceConfig.from_env({"TPCH_PARQUET_PATH": folder}))


@pytest.mark.parametrize("url,expected", [
    ("jdbc:db://h/t", "jdbc:db://h/t?useCursorFetch=true"),
    ("jdbc:db://h/t?a=b", "jdbc:db://h/t?a=b&useCursorFetch=true")])
def test_jdbc_options(url, expected):
    config = SourceConfig(use_jdbc=True, jdbc_url=url, jdbc_user="u", jdbc_password="p")
    options = jdbc_options(config)
    assert (options["url"], options["fetchsize"]) == (expected, "5000")
    assert histogram_options(config, "part", 5, 50_004)["query"] == (
        "SELECT FLOOR((p_partkey - 5) / 5.0) AS bin, COUNT(*) AS n FROM part "
        "WHERE p_partkey BETWEEN 5 AND 50004 GROUP BY FLOOR((p_partkey - 5) / 5.0)")
    assert probe_options(config, "part")["query"] == (
        "SELECT MIN(p_partkey) AS low, MAX(p_partkey) AS high FROM part")


def test_staging_twice_leaves_one_copy(spark, tmp_path):
    t = odd_tables(spark)
    for _ in range(2):
        stage(t, str(tmp_path))
    assert rows_of(read_staged(spark, str(tmp_path))["orders"]) == rows_of(t["orders"])


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_documents_are_written_and_read_back(spark, enriched, tmp_path, fmt):
    docs = nest_documents(enriched)
    for _ in range(2):
        counts = write_documents(docs, str(tmp_path), fmt)
    assert counts == LoadCounts(5, 5, 0)
    schema = document_schema(DoubleType())
    written = spark.read.parquet(f"{tmp_path}/staged").drop("document_bytes", *MARKS).schema
    assert written.simpleString() == schema.simpleString()
    stored = read_documents(spark, str(tmp_path), fmt, schema)
    assert rows_of(document.d5(stored)) == rows_of(document.d5(docs))
    assert rows_of(document.d3(stored)) == rows_of(document.d3(docs))


def test_oversize_documents_are_set_aside(spark, enriched, tmp_path):
    docs = nest_documents(enriched)
    counts = write_documents(docs, str(tmp_path), "parquet", max_bytes=600)
    assert counts == LoadCounts(5, 4, 1)
    rejected = spark.read.parquet(f"{tmp_path}/rejected").first()
    assert rejected.customer_id == 1 and rejected.document_bytes > 600
    assert "size limit" in rejected.reason
    stored = read_documents(spark, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/accepted").count() == 4
    assert stored.pieces.count() == 5
    assert rows_of(document.d5(stored)) == rows_of(document.d5(docs))


def test_customers_with_too_many_rows_are_set_aside(spark, enriched, tmp_path):
    counts = write_documents(nest_documents(enriched, max_rows=2), str(tmp_path))
    assert counts == LoadCounts(5, 4, 1)
    assert "rows" in spark.read.parquet(f"{tmp_path}/rejected").first().reason
    stored = read_documents(spark, str(tmp_path))
    assert rows_of(document.d5(stored)) == rows_of(document.d5(nest_documents(enriched)))


def test_documents_go_out_in_batches(spark, enriched, tmp_path):
    write_documents(nest_documents(enriched), str(tmp_path), batch_size=1)
    accepted = spark.read.parquet(f"{tmp_path}/accepted")
    assert len(accepted.inputFiles()) == accepted.count() == 5


def test_a_connector_says_where_rows_go(spark, enriched, tmp_path):
    """Connector options are passed on; here they name a folder."""
    there = f"{tmp_path}/store"
    counts = write_documents(nest_documents(enriched), f"{tmp_path}/work", "parquet",
                             connector={"path": f"{there}/documents"})
    assert counts.inserted == spark.read.parquet(f"{there}/documents").count() == 5
    rows = to_wide(enriched)
    for _ in range(2):
        write_wide(rows, "unused", connector={"path": f"{there}/wide"})
    assert spark.read.parquet(f"{there}/wide").count() == 2 * rows.count()
    write_wide(rows, "unused", truncate=True, connector={"path": f"{there}/wide"})
    assert rows_of(spark.read.parquet(f"{there}/wide")) == rows_of(rows)


def test_an_empty_collection(spark, enriched, tmp_path):
    assert write_documents(nest_documents(enriched.limit(0)), str(tmp_path)) == LoadCounts(0, 0, 0)


def test_loads_append_and_the_last_wins(spark, enriched, tmp_path):
    path = str(tmp_path / "wide")
    rows = to_wide(enriched)
    write_wide(rows, path, buckets=4)
    write_wide(rows, path, buckets=9)
    assert rows_of(read_wide(spark, path)) == rows_of(rows)
    t = tables(spark, [(1, "Ann", 1, "x")], [order(10, 1, "A")], [line(10, 1, 1.0)])
    write_wide(to_wide(enrich(t)), path)
    found = read_wide(spark, path)
    changed = found.where("order_id = 10 AND line_number = 1").first()
    assert (changed.status, changed.extended_price) == ("A", Decimal("1.00"))
    assert found.count() == rows.count()
    compact_wide(spark, path, str(tmp_path / "compact"))
    assert rows_of(read_wide(spark, str(tmp_path / "compact"))) == rows_of(found)
    write_wide(rows, path, truncate=True, buckets=4)
    assert rows_of(read_wide(spark, path)) == rows_of(rows)
    assert "SortAggregate" not in plan(read_wide(spark, path))


def test_append_after_an_empty_load(spark, enriched, tmp_path):
    path = str(tmp_path / "wide")
    rows = to_wide(enriched)
    write_wide(rows.limit(0), path, truncate=True)
    assert read_wide(spark, path).count() == 0
    write_wide(rows, path)
    assert rows_of(read_wide(spark, path)) == rows_of(rows)
    with pytest.raises(ValueError, match="no wide table"):
        read_wide(spark, str(tmp_path / "none"))


def test_a_lookup_reads_one_bucket(spark, enriched, tmp_path):
    """Of the wide table and of the documents, also where a load was appended."""
    rows = to_wide(enriched)
    write_wide(rows, f"{tmp_path}/wide", truncate=True, buckets=4)
    docs = nest_documents(enriched)
    write_documents(docs, f"{tmp_path}/documents", max_bytes=600, buckets=4)
    stored = read_documents(spark, f"{tmp_path}/documents")
    for _ in range(2):
        table = read_wide(spark, f"{tmp_path}/wide")
        for customer in (1, 2, 4, 5, 1000):
            found = wide.k2(table, customer)
            assert rows_of(found) == rows_of(rows.where(f"customer_id = {customer}"))
            assert f"PartitionFilters: [isnotnull({BUCKET}" in plan(found)
            assert rows_of(document.d2_count(stored, customer)) == rows_of(
                document.d2_count(docs, customer))
        assert wide.k3(table, 1).first()[:] == (1, 2, 3)
        write_wide(rows, f"{tmp_path}/wide")
    assert f"PartitionFilters: [isnotnull({BUCKET}" in plan(document.d2(stored, 1))
    asked = spark.createDataFrame([(1, 1), (2, 1)], "sample_id long, customer_id long")
    for answer in (batch.k2(asked, table), batch.d2(asked, stored)):
        scan = [row for row in plan(answer).split("\n") if "PartitionFilters" in row]
        assert any(f"{BUCKET}" in row.split("PartitionFilters")[1].split("]")[0] for row in scan)


def test_buckets_agree_between_column_and_value(spark):
    from pyspark.sql import functions as F
    ids = [0, 1, 2, 999, 2 ** 31 - 1, 2 ** 31, 2 ** 40 + 17]
    df = spark.createDataFrame([(i,) for i in ids], "customer_id bigint")
    for row in df.select("customer_id", bucket_of(F.col("customer_id"), 13).alias("b")).collect():
        assert row.b == bucket_of(row.customer_id, 13)
    assert buckets_for(10) == 8 and buckets_for(750_000_000_000) == 75_000


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5)], "label string, avg_ms double")
    write_report(df, f"{tmp_path}/csv", "csv")
    assert spark.read.csv(f"{tmp_path}/csv", header=True).first()[:] == ("a", "1.5")


def test_stage_selection():
    assert choose_stages() == set(STAGES)
    assert choose_stages(["extract"], ["extract"]) == {"extract"}
    assert choose_stages(skip=["wide"]) == set(STAGES) - {"wide"}
    for refused in ({"stage"}, {"extract", "wide"}, {"extract", "documents"}, {"extract", "x"}):
        with pytest.raises(StageError):
            check_stages(refused)
    assert pipeline.main(["--stages", "transform"]) == 1
    assert pipeline.main(["--stages", "extract", "wide"]) == 1


def test_the_whole_run(spark, tmp_path):
    t = odd_tables(spark)
    for name, df in t.items():
        df.write.parquet(f"{tmp_path}/source/{name}.parquet")
    config = PipelineConfig(SourceConfig(parquet_path=f"{tmp_path}/source"), f"{tmp_path}/staging",
                            f"{tmp_path}/documents", f"{tmp_path}/wide",
                            document_format="parquet")
    assert pipeline.run(spark, config, {"extract", "stage"}) is None
    for _ in range(2):
        assert pipeline.run(spark, config, set(STAGES) - {"stage"}) == LoadCounts(5, 5, 0)
    expected = enrich(t)
    assert rows_of(read_wide(spark, config.wide_path)) == rows_of(to_wide(expected))
    assert rows_of(document.d5(read_documents(spark, config.documents_path))) == rows_of(
        document.d5(nest_documents(expected)))
    loaded = replace(config, documents_path=f"{tmp_path}/collection", document_format=FORMAT)
    assert pipeline.run(spark, loaded, set(STAGES) - {"stage", "wide"}) == LoadCounts(5, 5, 0)


def test_transform_needs_staged_tables(spark, tmp_path, folder):
    config = PipelineConfig(SourceConfig(parquet_path=folder), f"{tmp_path}/none",
                            f"{tmp_path}/d", f"{tmp_path}/w")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        pipeline.run(spark, config, {"extract", "transform"})


def test_shuffles_are_sized_from_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    configure(spark, 1000 * BYTES_PER_SHUFFLE_TASK)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "1000"
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_the_shared_folder_is_the_clusters(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_stored_documents_are_read_by_column(spark, enriched, tmp_path):
    write_documents(nest_documents(enriched), str(tmp_path))
    docs = read_documents(spark, str(tmp_path))
    scanned = plan(document.d3(docs))
    assert "lineitems" not in scanned.split("ReadSchema")[1].split("\n")[0]
    assert "quantity" not in plan(document.d5(docs)).split("ReadSchema")[1].split("\n")[0]
    assert "EqualTo(customer_id,1)" in plan(document.d2(docs, 1))


KEYS = {
    "dense": list(range(1, 5001)),
    "gap": list(range(1, 3000)) + list(range(10 ** 12, 10 ** 12 + 3000)),
    "far": list(range(2000)) + [-10 ** 15, 10 ** 15],
    "hot": [7] * 4000 + list(range(100)),
    "cluster": [10 ** 9 + i for i in range(4000)] + [0],
    "one": [3], "none": [],
}


@pytest.mark.parametrize("kind", sorted(KEYS))
def test_strides_hold_every_key_once(spark, monkeypatch, kind):
    """The conditions on keys with gaps, hot keys and rows without a key; the histogram is that
    which the database would give."""
    from reshelve.sources import tables as source
    keys = KEYS[kind]
    low, high = (min(keys), max(keys)) if keys else (None, None)
    monkeypatch.setattr(source, "key_range", lambda *_: (low, high))
    monkeypatch.setattr(source, "key_histogram", lambda s, c, t, lo, hi: Counter(
        (k - lo) // source.bin_width(lo, hi) for k in keys if lo <= k <= hi))
    config = SourceConfig(keys_per_stride=500)
    found = source.strides(spark, config, "orders")
    rows = duckdb.sql("SELECT UNNEST(?::BIGINT[]) AS o_orderkey", params=[keys + [None] * 3])
    hits = [rows.filter(condition).fetchall() for condition in found]
    assert sum(map(len, hits)) == len(keys) + 3
    distinct = [set(h) for h in hits]
    assert sum(map(len, distinct)) == len(set().union(*distinct))
    if kind in ("dense", "gap", "far", "cluster"):
        assert max(map(len, hits)) <= 2 * 500 + 3 and len(found) >= len(keys) // 500


def test_tables_are_read_by_their_strides(spark, monkeypatch):
    from reshelve.sources import tables as source
    asked = {}
    monkeypatch.setattr(source, "strides", lambda s, c, table: [f"{table} 1", f"{table} 2"])
    monkeypatch.setattr(type(spark.read), "jdbc", lambda self, url, table, **given:
                        asked.setdefault(table, (url, given["predicates"])))
    config = SourceConfig(use_jdbc=True, jdbc_url="jdbc:x", jdbc_user="u", jdbc_password="p")
    source.read_tables(spark, config)
    assert set(asked) == set(source.TABLES)
    assert asked["part"] == ("jdbc:x?useCursorFetch=true", ["part 1", "part 2"])
