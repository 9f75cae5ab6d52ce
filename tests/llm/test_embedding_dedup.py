import math

import numpy as np
import pytest

from llm.brute import grouped
from reshelve.llm import embedding_dedup as ed


def clustered(seed, groups=25, size=12, dims=16, spread=0.08):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(groups, dims))
    found = np.repeat(centres, size, axis=0) + spread * random.normal(size=(groups * size, dims))
    return found.astype(np.float32)


def expected(vectors, cosine=0.95):
    x = vectors.astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= cosine
    np.fill_diagonal(near, False)
    n = range(len(x))
    return near.sum(axis=1).tolist(), grouped(n, np.argwhere(near).tolist())


@pytest.mark.parametrize("spread", [0.02, 0.08, 0.3])
def test_equals_brute_force_in_many_cells_and_blocks(spark, monkeypatch, spread):
    monkeypatch.setattr(ed, "CELL_ROWS", 20)
    monkeypatch.setattr(ed, "BLOCK_ROWS", 16)
    monkeypatch.setattr(ed, "BLOCK_COLUMNS", 32)
    vectors = clustered(int(spread * 100), spread=spread)
    vectors = np.r_[vectors, vectors[:40], vectors[:5] * 3]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)],
                                 "vec_id long, embedding array<float>")
    links, groups = expected(vectors)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in ed.groups(rows).collect()}
    assert found == {i: (links[i], groups[i], groups[i] == i) for i in groups}


def test_query_equals_brute_force(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    links, groups = expected(np.array([r.embedding for r in rows]))
    found = {r.vec_id: (r.n_links, r.component_id)
             for r in ed.op3_embedding_dedup(spark, folder).collect()}
    assert found == {rows[i].vec_id: (links[i], rows[groups[i]].vec_id) for i in groups}


def test_every_partner_is_visited():
    """The bound on cells holds for pairs right at the limit."""
    random = np.random.default_rng(7)
    centres = ed.unit(random.normal(size=(40, 8)))
    x = ed.unit(random.normal(size=(400, 8)))
    across = random.normal(size=x.shape)
    across = ed.unit(across - (across * x).sum(axis=1, keepdims=True) * x)
    angle = math.acos(0.95) * 0.999
    y = math.cos(angle) * x + math.sin(angle) * across
    import pandas as pd
    cells = ed._assign(centres, 0.95).func
    for a, b in zip(cells(pd.Series(list(x))), cells(pd.Series(list(y)))):
        later, earlier = (a, b) if a[0] >= b[0] else (b, a)
        assert earlier[0] in later


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(4, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (None, [1.0, 0.0]), (5, None),
            (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [1.0, None]), (9, [inf, 1.0]), (1, []),
            (10, [1.0, 0.0, 0.0]), (11, [0.0, -1.0]), (12, [-0.0, -1.0]), (13, [1e-30, 0.0])]
    table = spark.createDataFrame([(*r, 0, "x") for r in rows],
                                  "vec_id long, embedding array<float>, label int, node string")
    found = sorted(((r.vec_id, r.n_links, r.component_id, r.kept)
                    for r in ed.groups(table).collect()), key=str)
    assert found == sorted([
        (4, 4, 2, False), (2, 4, 2, True), (2, 4, 2, True), (None, 4, 2, False),
        (13, 4, 2, False), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True),
        (9, 0, 9, True), (1, 0, 1, True), (10, 0, 10, True), (11, 1, 11, True),
        (12, 1, 11, False)], key=str)
    assert ed.groups(table.limit(0)).count() == 0
