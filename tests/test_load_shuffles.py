"""How often loads of the wide table shuffle whole rows."""

import pytest
from conftest import plan
from fixtures import line, odd_tables, order, tables
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from reshelve.operators.prepare import enrich
from reshelve.operators.wide import BUCKET, refuse_null_keys, to_wide, typed, upsert, with_bucket
from reshelve.sinks import wide as sink
from reshelve.sinks.wide import write_wide
from reshelve.sources.snapshots import read_snapshot
from reshelve.sources.stores import read_wide
from test_plans import NO_BROADCAST, settings


def exchanges(df) -> list[str]:
    return [row for row in plan(df).split("\n") if "Exchange hashpartitioning" in row]


def test_joined_lines_are_upserted_where_they_are(spark):
    with settings(spark, **NO_BROADCAST):
        rows = to_wide(enrich(odd_tables(spark)))
        loaded = refuse_null_keys(upsert(typed(rows)))
        assert len(exchanges(loaded)) == len(exchanges(rows))


def test_an_append_shuffles_each_row_once(spark, tmp_path):
    path = str(tmp_path)
    rows = to_wide(enrich(odd_tables(spark)))
    write_wide(rows, path, truncate=True, buckets=4)
    seen = read_snapshot(spark, path)
    with settings(spark, **NO_BROADCAST):
        new = with_bucket(read_wide(spark, path).drop(BUCKET), 4)
        merged = sink._replaced(spark, path, seen, new, {b: 5 for b in seen.loads}, set(seen.loads))
        assert len(exchanges(merged)) == 1
        assert sorted(map(str, merged.collect())) == sorted(map(str, new.collect()))


def test_pieces_of_a_bucket_change_no_row(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sink, "ROWS_PER_PIECE", 1)
    path = str(tmp_path)
    lines = [line(o, n, 10.0 * n) for o in (1, 2) for n in range(1, 6)]
    t = tables(spark, [(1, "Ann", 1, "x")], [order(1, 1), order(2, 1)], lines)
    rows = to_wide(enrich(t))
    write_wide(rows, path, truncate=True, buckets=2)
    write_wide(rows.where("line_number > 3").withColumn("status", F.lit("Z")), path)
    found = read_wide(spark, path).drop(BUCKET)
    expected = rows.withColumn("status", F.expr("if(line_number > 3, 'Z', status)"))
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_a_null_key_fails_a_load(spark, tmp_path):
    rows = to_wide(enrich(odd_tables(spark))).withColumn(
        "order_id", F.expr("if(order_id = 11, null, order_id)"))
    with pytest.raises(PySparkException, match="null in key column order_id"):
        write_wide(rows, str(tmp_path), truncate=True, buckets=4)
