import sentencepiece

import corpus_pipeline as cp
from reshelve.llm import mixing, near_dedup, pieces
from llm.test_line_dedup import plain as plain_lines


def test_stages_one_after_another(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [docs]
    for i, (name, stage) in enumerate(cp.STAGES):
        stage(spark, kept[-1], folder).write.parquet(f"{tmp_path}/{i}")
        kept.append(spark.read.parquet(f"{tmp_path}/{i}"))
    tables = [k.collect() for k in kept]
    for table in kept[1:-1]:
        assert table.columns == docs.columns
    given, good, lined, single, mixed, coded = tables
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    text = {r.doc_id: r.text for r in given}
    ids = {r.doc_id for r in good}
    assert all(r.text == text[r.doc_id] for r in good) and len(ids) == len(good) < len(given)
    right = [(i in ids) == bool(q) for i, q in labels.items()]
    assert sum(right) >= 0.95 * len(right)
    assert {r.doc_id: r.text for r in lined} == plain_lines([(r.doc_id, r.text) for r in good])
    assert all(r.n_chars == len(r.text) for r in lined)
    prints = {r.doc_id: near_dedup.weighted_simhash(r.text) for r in lined}
    left = {r.doc_id for r in single}
    near = [(a, b) for a in prints for b in prints if a < b and any(
        (int(x) ^ int(y)).bit_count() <= near_dedup.NEAR_RADIUS
        for x, y in zip(prints[a], prints[b]))]
    from llm.brute import grouped
    assert left == set(grouped(prints, near).values())
    counts = {}
    for r in mixed:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert set(counts) <= left
    expected = mixing.mix(kept[3]).groupBy("doc_id").count().collect()
    assert counts == {r.doc_id: r["count"] for r in expected}
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    assert len(coded) == len(mixed)
    assert all(r.ids == library.encode(r.text) for r in coded)


def test_run_gives_the_last_stage(spark, folder):
    rows = cp.run(spark, folder).collect()
    assert rows and all(r.exact and r.n_ids == len(r.ids) for r in rows)


def test_empty_documents(spark, folder, docs_of):
    docs = docs_of([])
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0


def test_odd_documents(spark, folder, docs_of):
    docs = docs_of([(1, None), (2, ""), (None, "some text"), (3, "a b c\n" * 20_000), (3, None)])
    for _, stage in cp.STAGES[1:]:
        docs = stage(spark, docs, folder)
    assert docs.where("not exact").count() == 0
