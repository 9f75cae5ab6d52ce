import hashlib
import random
import re

import numpy as np
import xxhash

from llm.brute import grouped
from reshelve.llm import near_dedup as nd
from reshelve.llm.forest import components, unite


def plain(text):
    """The fingerprint straight from its rule."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64)
               if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_query_equals_brute_force(spark, folder, given):
    prints = {i: plain(t) for i, t in given}
    groups = grouped(prints, [(a, b) for a in prints for b in prints if a < b
                              and (prints[a] ^ prints[b]).bit_count() <= 3])
    found = {r.doc_id: (r.fingerprint, r.component_id)
             for r in nd.op2_near_dedup(spark, folder).collect()}
    assert found == {i: (f"{p:016x}", groups[i]) for i, p in prints.items()}


def test_votes_do_not_depend_on_chunks(monkeypatch, given):
    texts = [t for _, t in given[:15]]
    whole = [nd.simhash(t) for t in texts], [nd.weighted_simhash(t).tolist() for t in texts]
    monkeypatch.setattr(nd, "CHUNK", 7)
    assert [nd.simhash(t) for t in texts] == whole[0]
    near = [nd.weighted_simhash(t).tolist() for t in texts]
    assert sum(a != b for a, b in zip(near, whole[1])) <= 1  # sums of roots may round


def test_masks_cover_every_choice_of_bits():
    pick = random.Random(3)
    for radius in (1, 3, 4):
        masks = nd.covering_masks(radius)
        assert len(masks) == (1 << radius + 1) - 1
        for _ in range(300):
            bits = sum(1 << b for b in pick.sample(range(64), radius))
            assert any(not bits & m for m in masks)


def test_hot_bucket_in_small_blocks(spark):
    """Several hundred fingerprints around one, cut into blocks of 16."""
    pick = random.Random(4)
    middle = pick.getrandbits(62)
    values = sorted({middle ^ sum(1 << b for b in pick.sample(range(60), n))
                     for n in (1, 2, 3) for _ in range(90)} | {pick.getrandbits(62)
                                                             for _ in range(50)})
    rows = spark.createDataFrame([(i, [v]) for i, v in enumerate(values)],
                                 "node long, parts array<long>")
    found = {r.node: r.component for r in components(nd.links(rows, 3, block=16)).collect()}
    n = range(len(values))
    groups = grouped(n, [(a, b) for a in n for b in n if a < b
                         and (values[a] ^ values[b]).bit_count() <= 3])
    assert {i: found.get(i, i) for i in n} == groups


def test_odd_rows(spark, docs_of):
    text = "one two three four five six seven eight"
    pairs = [(7, text), (3, text), (3, text), (None, text), (9, None), (8, ""), (5, " \n"),
             (None, "quite another text of some words"), (6, "word " * 50_000)]
    rows = docs_of(pairs, parts=1, least=2, component_id=3, node=4)
    found = sorted(((r.doc_id, r.component_id) for r in nd.groups(rows).collect()), key=str)
    assert found == sorted([(7, 3), (3, 3), (3, 3), (None, 3), (9, 5), (8, 5), (5, 5),
                            (None, None), (6, 6)], key=str)
    kept = nd.deduplicate(rows)
    assert kept.columns == rows.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "5", "6", "None"]
    assert nd.groups(docs_of([])).count() == 0 and nd.deduplicate(docs_of([])).count() == 0


def test_different_texts_of_one_id_stay(spark, docs_of):
    pick = random.Random(9)
    texts = [" ".join(str(pick.random()) for _ in range(30)) for _ in range(5)]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[0]), (None, texts[2]), (None, texts[2]),
            (None, texts[3]), (2, texts[1]), (2, texts[4]), (None, texts[4])]
    kept = sorted(((r.doc_id, r.text) for r in nd.deduplicate(docs_of(rows)).collect()), key=str)
    assert kept == sorted([(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[3]),
                           (2, texts[4])], key=str)


def test_copies_with_changed_words_are_found(spark, docs_of):
    pick = random.Random(5)

    def word():
        return "".join(pick.choice(["an", "er", "tion", "th", "ou", "st"]) for _ in range(4))

    pairs, copies = [], []
    for i in range(60):
        words = [word() for _ in range(300)]
        pairs.append((2 * i, " ".join(words)))
        for at in pick.sample(range(300), 4):  # five-word shingles in common: 0.87 and more
            words[at] = word()
        pairs.append((2 * i + 1, " ".join(words)))
        copies.append(2 * i + 1)
    kept = {r.doc_id for r in nd.deduplicate(docs_of(pairs)).collect()}
    assert kept >= {2 * i for i in range(60)}
    assert len(kept & set(copies)) <= 3


def test_trees_and_stars(spark):
    pick = random.Random(6)
    pairs = [(pick.randrange(400), pick.randrange(400)) for _ in range(330)]
    pairs += [(i, i + 1) for i in range(500, 700)] + [(800, i) for i in range(801, 900)]
    nodes = {n for p in pairs for n in p}
    expected = grouped(nodes, pairs)
    parent = np.arange(1000)
    unite(parent, np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
    assert {n: int(parent[n]) for n in nodes} == expected
    found = components(spark.createDataFrame(pairs, "a long, b long"))
    single = {a for a, b in pairs if a == b} - {n for a, b in pairs if a != b for n in (a, b)}
    assert {r.node: r.component for r in found.collect()} == {
        n: c for n, c in expected.items() if n not in single}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def similarity(a, b):
    a, b = (set(zip(*[t.lower().split()[i:] for i in range(5)])) for t in (a, b))
    return len(a & b) / len(a | b)


def test_copies_changed_in_one_piece_are_found(spark, docs_of):
    """Cut ends, added ends and a replaced middle, all of a shingle similarity of 0.8 and more."""
    pick = random.Random(7)

    def words(n):
        return ["".join(pick.choice(["an", "er", "tion", "th", "ou", "st"]) for _ in range(4))
                for _ in range(n)]

    pairs = []
    for i in range(60):
        own = words(300)
        for j, copy in enumerate((own, own[:255], own + words(50),
                                  own[:150] + words(25) + own[175:])):
            pairs.append((4 * i + j, " ".join(copy)))
    texts = dict(pairs)
    assert all(similarity(texts[i - i % 4], texts[i]) >= 0.8 for i in texts)
    kept = {r.doc_id for r in nd.deduplicate(docs_of(pairs)).collect()}
    assert kept >= set(range(0, 240, 4)) and len(kept) <= 60 + 2


def test_shingles_decide_among_texts_that_meet(spark, docs_of):
    """All texts in one bucket of small blocks: links are those of 0.8 and more."""
    pick = random.Random(8)
    base = [str(pick.random()) for _ in range(200)]
    texts = [" ".join(base[:pick.randrange(60, 200)]) for _ in range(60)]
    rows = spark.createDataFrame(
        [(i, hashlib.md5(t.encode()).hexdigest(), [7]) for i, t in enumerate(texts)],
        "node long, mark string, bands array<long>")
    edges = nd.alike(docs_of(list(enumerate(texts))), rows, block=9).collect()
    n = range(len(texts))
    right = [(a, b) for a in n for b in n if a < b and similarity(texts[a], texts[b]) >= 0.8]
    assert all((min(e), max(e)) in set(right) or texts[e.a] == texts[e.b] for e in edges)
    assert grouped(n, [tuple(e) for e in edges]) == grouped(n, right)


def test_links_of_a_large_group_are_few(spark):
    """Equal edges of a group's buckets collapse, so that a node has a few, not one per bucket."""
    pick = random.Random(8)
    middle = pick.getrandbits(62)
    values = sorted({middle ^ sum(1 << b for b in pick.sample(range(60), pick.choice((1, 2))))
                     for _ in range(900)})
    rows = spark.createDataFrame([(i, [v]) for i, v in enumerate(values)],
                                 "node long, parts array<long>")
    edges = nd.links(rows, 4).distinct()
    assert set(r.component for r in components(edges).collect()) == {0}
    assert edges.count() <= 8 * len(values)


def test_texts_are_shuffled_once(spark, docs_of):
    """Repeated rows are dropped where the join of documents and kept keys has put them."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = docs_of([(1, "a b c"), (1, "a b c"), (None, "x y z"), (None, "x y z"), (0, "x y z")])
        found = nd.deduplicate(docs)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.index("SortMergeJoin") < plan.index("Exchange")
        assert sorted((r.doc_id, r.text) for r in found.collect()) == [(0, "x y z"), (1, "a b c")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
