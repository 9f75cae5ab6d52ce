import random
import tracemalloc
import zlib

import numpy as np
import pytest

from reshelve.llm import quality as q


@pytest.fixture(scope="module")
def medium():
    return "/root/testdata/sf0.01"


def test_held_out_accuracy(spark, medium):
    rows = {r.doc_id: r for r in q.op5_quality(spark, medium).collect()}
    labels = {r.doc_id: r.quality
              for r in spark.read.parquet(f"{medium}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{medium}/documents.parquet").count()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    tested = [i for i in labels if i in rows and rows[i].held_out]
    right = [rows[i].predicted == labels[i] for i in tested]
    good = [rows[i].predicted for i in tested if labels[i] == 1]
    assert np.mean(right) >= 0.95 and np.mean(good) >= 0.98


def test_held_out_labels_change_nothing(spark, docs_of):
    pairs = [(i, "all fine words here" if i % 2 else "NO!! GOOD!! AT!! ALL!!") for i in range(40)]
    docs = docs_of(pairs, quality=5, score="x")
    label = [(i, i % 2) for i in range(40)]
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in label]
    models = [q.train(docs, spark.createDataFrame(rows + [(None, 1), (3, None), (3, 7)],
                                                  "doc_id long, quality int"))
              for rows in (label, turned)]
    assert np.array_equal(models[0].weight, models[1].weight)
    kept = q.keep(docs, models[0])
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(1, 40, 2))


def test_dual_descent_reaches_the_margin():
    """Separable texts end outside the margin, and the dual variables' sum makes the weights."""
    random = np.random.default_rng(0)
    texts = [np.unique(np.r_[random.integers(0, 50, 8), 60 + y]) for y in (0, 1) * 60]
    labels = np.array([0, 1] * 60)
    model = q.fit(texts, labels)
    margins = np.array([model.margin(t) for t in texts])
    assert (np.sign(margins) == 2 * labels - 1).all()
    assert all((model.score(t) >= 0.5) == y for t, y in zip(texts, labels))


def test_without_two_classes(spark, docs_of):
    docs = docs_of([(1, "a"), (2, None), (None, "")])
    empty = spark.createDataFrame([], "doc_id long, quality int")
    score = q.scorer(q.train(docs, empty))
    assert [r[0] for r in docs.select(score("lang")).collect()] == [0.5] * 3
    one = q.fit([np.array([1, 2])], np.array([1]))
    assert one.score(np.array([], dtype=int)) == 1 and one.score(np.array([9])) == 1
    assert q.fit([np.array([1])], np.array([0])).score(np.array([1])) < 1e-9
    assert q.keep(docs_of([]), one).count() == 0


def test_shapes_and_grams():
    assert q.shape("Hello,") == "Xx," and q.shape("A1!!!!!") == "X9!!!" and q.shape("") == ""
    grams = q.Grams()
    assert q.TWICE in grams.of("no no yes") and q.THRICE not in grams.of("no no yes")
    assert q.THRICE in grams.of("no no no")
    assert len(grams.of("")) == 0 and len(grams.of(" \n\t")) == 0
    assert set(grams.of("a b " * 100_000)) >= set(grams.of("a b a"))


def test_an_ngram_takes_few_bytes_of_the_driver(spark, docs_of):
    """The driver's Python holds numbers of n-grams as bytes, not as objects."""
    pick = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    pairs = [(i, " ".join(pick.sample(words, 500))) for i in range(1500)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in pairs], "doc_id long, quality int")
    peaks = []
    for n in (200, 1200):
        docs = docs_of(pairs[:n] + [(None, None), (-1, "")]).repartition(4).cache()
        docs.count()
        learned = sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(n))
        tracemalloc.start()
        q.train(docs, labels)
        peaks.append((learned, tracemalloc.get_traced_memory()[1]))
        tracemalloc.stop()
        docs.unpersist()
    (few, low), (many, high) = peaks
    assert (high - low) / ((many - few) * 500) < 28
