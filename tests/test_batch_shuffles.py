"""What batches of lookups do with ranges and customers asked for many times."""

import pytest
from conftest import plan
from fixtures import line, odd_tables, order, tables

from reshelve.operators import narrow
from reshelve.operators.document import nest_tables
from reshelve.plans import batch
from test_plans import NO_BROADCAST, settings

ASKED = "sample_id long, customer_id long, revenue_start long, revenue_end long"


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_a_range_is_answered_once(spark, monkeypatch):
    t = odd_tables(spark)
    joined = []
    real = batch.rows_in_ranges
    monkeypatch.setattr(batch, "rows_in_ranges",
                        lambda ranges, *rest: joined.append(ranges) or real(ranges, *rest))
    asked = spark.createDataFrame([(n, 1, 1, 5) for n in range(50)] + [(99, 1, None, 5)], ASKED)
    found = batch.r5_top(asked, t)
    assert joined[0].where("revenue_start IS NOT NULL").count() == 1
    one = [tuple(r[1:]) for r in found.where("sample_id = 7").orderBy("place").collect()]
    assert [r[0] for r in one] == [1, 2, 3, 4, 5] and found.count() == 250


def test_a_lookup_of_several_rows_has_one_answer(spark):
    lines = [line(n, 1, 10.0 * n) for n in range(1, 9)] + [line(9, 1, None)]
    t = tables(spark, [(1, "Ann", 1, "x"), (2, "Ben", 1, "x")],
               [order(n, 1 + n % 2) for n in range(1, 10)], lines)
    asked = spark.createDataFrame(
        [(1, 1, 1, 2), (1, 1, 1, 2), (2, 1, 1, 1), (2, 1, 2, 2), (3, 1, 1, 2), (None, 1, 2, 2)], ASKED)
    found = {}
    for r in batch.r5_top(asked, t).orderBy("place").collect():
        found.setdefault(r.sample_id, []).append((r.place, r.order_id))
    assert found == {1: list(enumerate([8, 8, 7, 7, 6], 1)), 2: list(enumerate([8, 7, 6, 5, 4], 1)),
                     3: list(enumerate([8, 7, 6, 5, 4], 1)), None: list(enumerate([7, 5, 3, 1, 9], 1))}


@pytest.mark.parametrize("run", [batch.d2, batch.d3, batch.d5])
def test_documents_stay_where_they_are(spark, tmp_path, monkeypatch, run):
    nest_tables(odd_tables(spark)).pieces.write.parquet(str(tmp_path / "pieces"))
    docs = batch.Documents(spark.read.parquet(str(tmp_path / "pieces")))
    asked = spark.createDataFrame([(1, 1, 1, 3), (2, 9, 2, 2)], ASKED)
    with settings(spark, **NO_BROADCAST):
        few = run(asked, docs)
        monkeypatch.setattr(narrow, "BROADCAST_KEYS", 0)
        many = run(asked, docs)
        assert rows_of(few) == rows_of(many)
        for answer in (few, many):
            shuffled = [r for r in plan(answer).split("\n") if "LeftSemi" in r and "SortMerge" in r]
            assert not shuffled
