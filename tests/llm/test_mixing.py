import math

import numpy as np
from pyspark.sql import functions as F

from reshelve.llm import mixing as m
from conftest import plan


def test_steps_are_the_distribution_function():
    for rate in (0.0, 0.01, 0.7, 3.2, 40.0, 900.0):
        steps = m.poisson_steps(rate)
        assert (np.diff(steps) >= 0).all() and abs(steps[-1] - 1) < 1e-9
        if 0 < rate < 50:
            pmf = [math.exp(-rate) * rate ** k / math.factorial(k) for k in range(10)]
            assert np.allclose(steps[:10], np.cumsum(pmf))


def test_sources_meet_their_weights(spark, docs_of):
    docs = docs_of([(i, f"t{i}") for i in range(3000)], source="big").union(
        docs_of([(i, f"t{i}") for i in range(3000, 3300)], source="small"))
    mixed = m.mix(docs, {"big": 1, "small": 3, "absent": 2}, size=4000)
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(counts["big"] - 1000) < 5 * math.sqrt(1000)
    assert abs(counts["small"] - 3000) < 5 * math.sqrt(3000)
    again = m.mix(docs.repartition(7), {"big": 1, "small": 3, "absent": 2}, size=4000)
    key = ["doc_id", "copy"]
    assert again.select(*key).exceptAll(mixed.select(*key)).isEmpty()
    assert mixed.count() == again.count()
    other = m.mix(docs, {"big": 1, "small": 3}, size=4000, seed=5)
    assert not other.select(*key).exceptAll(mixed.select(*key)).isEmpty()


def test_many_sources_are_joined_by_shuffle(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    broadcast = m.mix(docs)
    monkeypatch.setattr(m, "MAX_BROADCAST_SOURCES", 1)
    shuffled = m.mix(docs)
    assert "__salt" in plan(shuffled) and "__salt" not in plan(broadcast)
    assert broadcast.exceptAll(shuffled).isEmpty() and broadcast.count() == shuffled.count()


def test_odd_rows(spark, docs_of):
    rows = docs_of([(1, "a"), (1, "a"), (2, None), (None, "b"), (3, "")], copy="x", rate=1, n=2)
    rows = rows.withColumn("source", F.when(F.col("doc_id") == 1, F.lit("s")))
    mixed = m.mix(rows, {"s": 1, None: 1}, size=50)
    assert set(mixed.columns) == set(rows.columns)
    found = mixed.collect()
    one = sorted(r.copy for r in found if r.doc_id == 1)
    assert one and one == sorted(2 * list(range(1, len(one) // 2 + 1)))
    assert {r.doc_id for r in found} == {1, 2, 3, None}
    assert m.mix(rows, {"other": 1.0}).count() == 0 and m.mix(rows, {"s": 0.0}).count() == 0
    assert m.mix(docs_of([])).count() == 0
