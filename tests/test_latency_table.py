"""Percentiles from stored counts against those of the log."""

import random

import pytest
from pyspark.sql import functions as F

from reshelve.plans import latency
from reshelve.plans.latency_table import (
    BITS, append_counts, compact_counts, count_table, middle, percentiles_of, read_counts)

SCHEMA = "label string, success string, start_ms bigint, elapsed bigint"


@pytest.fixture(scope="module")
def log(spark):
    draw = random.Random(4)
    rows = [(draw.choice("ab"), draw.choice(["true", "false"]), draw.randrange(10 ** 7),
             int(draw.lognormvariate(draw.choice([2, 6, 11]), 1.5))) for _ in range(4000)]
    return spark.createDataFrame(rows + [(None, "true", 1, 1), ("a", None, 5, 0), ("a", "true", 5, None)],
                                 SCHEMA).cache()


def test_buckets(spark):
    values = [0, 1, 2, 255, 256, 257, 511, 512, 513, 2 ** 20, 2 ** 20 + 4095, 2 ** 40 - 1, -1, -300]
    rows = spark.createDataFrame([(v,) for v in values], "v bigint").select(
        "v", middle(F.col("v")).alias("m")).collect()
    for row in rows:
        size = abs(row.v)
        shift = max(0, size.bit_length() - BITS)
        expected = (size >> shift << shift) + ((1 << shift) - 1) // 2
        assert row.m == (-expected if row.v < 0 else expected)
        assert abs(row.m - row.v) * 2 ** BITS <= size


@pytest.mark.parametrize("by", [["label"], []])
def test_error_is_bounded(log, by):
    counts = count_table(log)
    points = {p: f"p{p}" for p in (0, 1, 100, 250, 500, 900, 990, 999, 1000)}
    near = {tuple(r[b] for b in by): r for r in percentiles_of(counts, by, points).collect()}
    known = log.where("label IS NOT NULL")
    exact = {tuple(r[b] for b in by): r for r in latency.percentiles(known, by, points).collect()}
    assert set(near) == set(exact)
    for key, row in exact.items():
        for name in points.values():
            assert abs(near[key][name] - row[name]) <= row[name] / 2 ** BITS


def test_windows_and_outcomes(log):
    counts = count_table(log)
    found = percentiles_of(counts, ["label", "failed"], None, 1_200_000, 4_800_000).collect()
    minute = F.col("start_ms") + F.col("elapsed")
    inside = log.where((minute >= 1_200_000) & (minute < 4_800_000)).withColumn(
        "failed", F.coalesce(F.lower("success") == "false", F.lit(False)))
    exact = {(r.label, r.failed): r for r in latency.percentiles(inside, ["label", "failed"]).collect()}
    assert len(found) == len(exact) == 4
    for row in found:
        for name in latency.PERCENTILES.values():
            right = exact[row.label, row.failed][name]
            assert abs(row[name] - right) <= right / 2 ** BITS


def test_parts_add_up(spark, log, tmp_path):
    path = str(tmp_path / "counts")
    for k in range(3):
        append_counts(log.where(F.pmod("start_ms", F.lit(3)) == k), path)
    stored, whole = read_counts(spark, path), count_table(log)
    for table in (stored, compact_counts(stored)):
        assert sorted(map(tuple, percentiles_of(table, ["label"]).collect())) == sorted(
            map(tuple, percentiles_of(whole, ["label"]).collect()))
    assert compact_counts(stored).count() == whole.count() <= stored.count()


def test_no_samples(log):
    assert percentiles_of(count_table(log.limit(0)), ["label"]).count() == 0
