import itertools
import math
import zlib

import numpy as np
import pytest

from reshelve.llm import toxicity
from reshelve.llm.toxicity import LabelModel, Model, Scorer, features, forest, label_model, \
    logistic, scored, ties, train


@pytest.fixture(scope="module")
def larger():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def result(spark, larger):
    return {r.doc_id: r for r in toxicity.op12_toxicity(spark, larger).collect()}


def test_held_out_accuracy(spark, larger, result):
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{larger}/labels.parquet").collect()]
    held = [(i, t) for i, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(result[i].held_out for i, _ in held) and len(held) > 50
    right = sum(result[i].predicted == t for i, t in held)
    assert right / len(held) >= 0.95
    clean = [i for i, t in held if t == 0]
    assert sum(result[i].predicted for i in clean) / len(clean) <= 0.02


def test_every_document_has_a_score(spark, larger, result):
    assert spark.read.parquet(f"{larger}/documents.parquet").count() == len(result)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in result.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in result.items())


def planted(n=600):
    """Texts whose toxic ones hold some of the words xqa to xqd; a tenth of them are odd ones out."""
    draw = np.random.default_rng(5)
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    rows = []
    for i in range(n):
        toxic = int(i % 5 == 0)
        text = list(draw.choice(words, 12)) + (
            list(draw.choice(["xqaing", "xqb", "xqc", "you idiot"], 3)) if toxic else [])
        rows.append((i, " ".join(text), toxic))
    return rows


def labelled(spark, rows):
    return (spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string"),
            spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))


def test_unseen_forms_of_known_words(spark):
    docs, labels = labelled(spark, planted())
    model = train(docs, labels)
    scorer = Scorer(model)
    assert scorer.score("alpha beta xqaful xqb gamma") > 0.5 > scorer.score("alpha beta gamma")
    assert scorer.score("") < 0.5


def test_fit_is_the_same_each_time_and_on_any_partitions(spark):
    rows = planted(200)
    docs, labels = labelled(spark, rows)
    one, two = train(docs, labels), train(docs.repartition(7), labels.repartition(3))
    assert one.weight == two.weight and one.bias == two.bias


def test_labels_of_the_held_out_fold_are_not_read(spark):
    rows = planted(300)
    docs, labels = labelled(spark, rows)
    _, turned = labelled(spark, [(i, t, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y)
                                 for i, t, y in rows])
    one, two = train(docs, labels), train(docs, turned)
    assert one.weight == two.weight and one.bias == two.bias


def test_odd_labels(spark):
    docs, labels = labelled(spark, planted(100))
    none = labels.limit(0)
    assert Scorer(train(docs, none)).score("xqb") == 0.5
    clean = labels.where("toxic = 0")
    assert Scorer(train(docs, clean)).score("xqb") < 1e-9
    odd = spark.createDataFrame([(None, 1), (1, 7), (2, None)], "doc_id long, toxic int")
    one, two = train(docs, labels), train(docs, labels.unionByName(odd))
    assert one.weight == two.weight


def test_odd_texts_and_columns(spark):
    model = Model({"bad": 5.0, "ba*": 1.0, "xxxx*": 2.0}, -3.0)
    rows = [(1, None), (2, ""), (None, "bad"), (None, "bad"), (3, "Bad, BAD! bad"),
            (4, "fine " * 300_000), (5, "fine " * 300_000 + "bad"), (6, "b" * 3_000_000), (7, "b4d")]
    docs = spark.createDataFrame([(i, t, 9, 9, "x") for i, t in rows],
                                 "doc_id long, text string, score int, predicted int, votes string")
    found = scored(docs, model).collect()
    assert [r.predicted for r in found] == [0, 0, 1, 1, 1, 0, 1, 0, 1]
    assert found[0].score == found[1].score == pytest.approx(1 / (1 + math.exp(3)))
    assert scored(docs.limit(0), model).count() == 0
    assert scored(docs, model).columns == docs.columns


def test_features():
    assert features("idiot") == ["idiot", "idi*", "idio*"]
    assert features("1d10t")[:2] == ["1d10t", "idiot"] and features("ab") == ["ab"]
    assert features("2024")[:1] == ["2024"] and "2o2a" not in features("2024")


def test_probability_against_every_table_by_hand():
    draw = np.random.default_rng(2)
    votes = draw.integers(-1, 2, (40, 4)).astype(np.int8)
    model = LabelModel([-1, 0, 1, -1])
    model.learn(votes, draw.random(40))
    for row, p in zip(votes.tolist(), model.probability(votes)):
        joint = []
        for y in (0, 1):
            found = model.prior if y else 1 - model.prior
            for j, parent in enumerate(model.parent):
                before = 0 if parent < 0 else row[parent] + 1
                found *= model.tables[j][y, before, row[j] + 1]
            joint.append(found)
        assert p == pytest.approx(joint[1] / sum(joint))


def test_label_model_finds_accuracies_and_ties():
    draw = np.random.default_rng(4)
    n = 6000
    label = draw.random(n) < 0.3
    right = [0.9, 0.8, 0.7, 0.8]
    votes = np.stack([np.where(draw.random(n) < a, label, ~label) for a in right]
                     + [np.zeros(n, bool)], axis=1)
    copied = draw.random(n) < 0.9
    votes[:, 4] = np.where(copied, votes[:, 2], draw.random(n) < 0.5)
    votes = np.where(votes, 1, -1).astype(np.int8)
    annotated = np.where(np.where(draw.random(n) < 0.9, label, ~label), 0.9, 0.1)
    model, belief = label_model(votes, annotated)
    assert {j for j, p in enumerate(model.parent) if p >= 0} <= {2, 4}
    assert model.parent[4] == 2 or model.parent[2] == 4
    assert np.allclose(model.accuracy()[[0, 1, 3]], [0.9, 0.8, 0.8], atol=0.03)
    assert ((belief > 0.5) == label).mean() > 0.95


def test_forest_is_the_greatest():
    draw = np.random.default_rng(1)
    for _ in range(20):
        strength = draw.random((5, 5))
        strength = np.triu(strength, 1) + np.triu(strength, 1).T
        parent = forest(strength, 0.3)
        got = sum(strength[j, p] for j, p in enumerate(parent) if p >= 0)
        edges = [(i, j) for i in range(5) for j in range(i) if strength[i, j] >= 0.3]
        best = 0.0
        for k in range(5):
            for some in itertools.combinations(edges, k):
                top = list(range(5))
                for i, j in some:
                    a, b = top[i], top[j]
                    if a == b:
                        break
                    top = [a if t == b else t for t in top]
                else:
                    best = max(best, sum(strength[e] for e in some))
        assert got == pytest.approx(best)


def test_ties_of_copies_and_of_independent_voters():
    draw = np.random.default_rng(3)
    votes = np.where(draw.random((4000, 3)) < 0.5, 1, -1).astype(np.int8)
    votes[:, 2] = votes[:, 0]
    found = ties(votes, draw.random(4000))
    assert found[0, 2] == pytest.approx(math.log(2), abs=0.02) and found[0, 1] < 0.005


def test_logistic_reaches_the_least_loss():
    draw = np.random.default_rng(8)
    x = draw.integers(0, 3, (200, 3)).astype(float)
    target = 1 / (1 + np.exp(-(x @ [1.5, -1.0, 0.5] - 0.7)))
    row, column = np.nonzero(x)
    weight, bias = logistic(row, column, x[row, column], target, 3)
    p = 1 / (1 + np.exp(-(x @ weight + bias)))
    assert np.abs(p - target).max() < 0.05
