"""Totals over ranges, ids inside ranges and rows inside ranges, against every id tried."""

import random

import pytest
from conftest import plan

from reshelve.operators import ranges
from reshelve.operators.ranges import covered, range_totals, rows_in_ranges, running_totals
from reshelve.plans import batch


def drawn(seed, far=False):
    draw = random.Random(seed)
    limit = 2 ** 40 if far else 300
    ids = [draw.randrange(-limit, limit) for _ in range(120)] + [0, -1, 65535, 65536, -65536, -65537]
    pairs = [(draw.choice(ids) + draw.randrange(-2, 3), draw.choice("ab"),
              draw.choice([0, 1, 5, 70, 10 ** 8, 2 ** 41, -4])) for _ in range(60)]
    return ids, [(i, key, low, low + width) for i, (low, key, width) in enumerate(pairs)]


def tables(spark, seed, far):
    ids, asked = drawn(seed, far)
    values = [(i, "ab"[n % 2], n, 1) for n, i in enumerate(ids)]
    return (values, asked, spark.createDataFrame(values, "id long, key string, amount long, n long"),
            spark.createDataFrame(asked, "sample long, key string, low long, high long"))


@pytest.mark.parametrize("seed, far, bits", [(1, False, 16), (2, True, 16), (3, False, 3)])
def test_against_every_pair(spark, monkeypatch, seed, far, bits):
    monkeypatch.setattr(ranges, "SPAN_BITS", bits)
    values, asked, left, right = tables(spark, seed, far)
    found = range_totals(right, left, "low", "high", ["key"])
    assert sorted(map(tuple, found.collect())) == [
        (sample, key, low, high,
         sum(a for i, k, a, _ in values if k == key and low <= i <= high),
         sum(k == key and low <= i <= high for i, k, *_ in values))
        for sample, key, low, high in asked]
    inside = sorted({i for i, *_ in values if any(low <= i <= high for *_, low, high in asked)})
    assert sorted(r.id for r in covered(left, right, "low", "high").collect()) == inside
    joined = rows_in_ranges(right.drop("key"), left, "id", "low", "high")
    assert sorted((r.sample, r.id, r.amount) for r in joined.collect()) == sorted(
        (sample, i, a) for sample, _, low, high in asked for i, _, a, _ in values
        if low <= i <= high)


def test_odd_tables(spark):
    asked = spark.createDataFrame([(1, None, 5), (2, 5, None), (3, 7, 6), (4, 1, 9)],
                                  "sample long, low long, high long")
    values = spark.createDataFrame([(3, 10), (3, 1), (9, None), (None, 4)], "id long, amount long")
    found = range_totals(asked, values, "low", "high").collect()
    assert sorted((r.sample, r.amount) for r in found) == [(3, 0), (4, 11)]
    assert range_totals(asked, values.limit(0), "low", "high").where("sample = 4").first().amount == 0
    assert range_totals(asked.limit(0), values, "low", "high").count() == 0
    assert [r.id for r in covered(values, asked, "low", "high").orderBy("id").collect()] == [3, 9]
    assert covered(values, asked.limit(0), "low", "high").count() == 0
    assert sorted(r.id for r in rows_in_ranges(asked, values, "id", "low", "high").collect()) == [
        3, 3, 9]
    assert running_totals(values, spark.createDataFrame([(2,)], "id long")).first().amount is None


def test_one_span_and_one_range_hold_most(spark):
    values = spark.range(30_000).selectExpr("id", "1 AS n")
    asked = spark.range(5000).selectExpr("id AS sample", "100L AS low", "200L AS high")
    found = range_totals(asked, values, "low", "high")
    assert found.where("n = 101").count() == 5000


def test_no_row_per_id_of_a_range(spark, folder):
    """A range over all there can be costs what a short one does: as many rows, no sequence."""
    from checks import adapters as a
    source = a.source_tables(spark, folder)
    params = spark.createDataFrame(
        [(i, "ASIA", 1, 2 ** 60, 1, 2 ** 60) for i in range(50)],
        "sample_id long, region string, region_start long, region_end long, revenue_start long, "
        "revenue_end long")
    for query in (batch.r4, batch.r5):
        found = query(params, source)
        assert "sequence(" not in plan(found) and "NestedLoopJoin" not in plan(found)
        assert found.count() == 50
    assert "sequence(" not in plan(batch.r5_top(params, source))


def test_windows_hold_a_span_at_most(spark, folder):
    values = spark.range(1000).selectExpr("id", "1 AS n")
    asked = spark.createDataFrame([(1, 5, 10)], "sample long, low long, high long")
    text = plan(range_totals(asked, values, "low", "high"))
    assert "hashpartitioning(span" in text
