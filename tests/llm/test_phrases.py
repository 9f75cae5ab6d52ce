import re
from collections import Counter

import pytest

from reshelve.llm import phrases

COLUMNS = ["group", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least, top):
    """Every phrase of every piece, counted one by one."""
    words, count = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            found = re.findall("[^ \t]+", piece)
            words[lang] += len(found)
            for k in range(1, 6):
                for i in range(len(found) - k + 1):
                    count[lang, tuple(found[i:i + k])] += 1
    count = {key: n for key, n in count.items() if n >= least}
    inside = {(lang, p[i:j]) for (lang, p), n in count.items() for i in range(len(p))
              for j in range(i + 2, len(p) + 1) if j - i < len(p) and n >= count[lang, p[i:j]]}
    scored = {}
    for (lang, p), a in count.items():
        if len(p) > 1 and (lang, p) not in inside:
            score, k = min((1000 * a * words[lang] // (count[lang, p[:k]] * count[lang, p[k:]]), k)
                           for k in range(1, len(p)))
            scored.setdefault(lang, []).append(
                (-score, -a, " ".join(p).encode(), count[lang, p[:k]], count[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, words[lang], -score)
                  for lang, found in scored.items()
                  for i, (score, a, p, left, right) in enumerate(sorted(found)[:top]))


def mined(spark, rows, least, top, parts=3):
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(parts)
    found = phrases.collocations(phrases.frequent_phrases(docs, least=least), top=top)
    return sorted(tuple(r) for r in found.select(COLUMNS).collect())


@pytest.mark.parametrize("small", [False, True])
def test_table_against_brute_force(spark, folder, monkeypatch, small):
    if small:  # bursting containers, spilled subtrees, forgotten words, slices of long texts
        for name, value in (("BURST", 40), ("MAX_PHRASES", 300), ("MAX_WORDS", 200),
                            ("BATCH", 2000), ("HOT_SHARE", 30), ("MAX_BITS", 1 << 12)):
            monkeypatch.setattr(phrases, name, value)
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet")
            .select("text", "lang").collect()]
    expected = brute(rows, 5, 200)
    assert len(expected) > 200
    assert mined(spark, rows, 5, 200) == expected


def test_odd_texts(spark):
    rows = [(None, "en"), ("", None), ("a b a b a b", None), ("a b", "und"), ("A\tB c, a  b\x0bc", "x"),
            ("é\x1cf é\x1cf g " * 3, "x"), ("a b c " * 50, "long"), ("a b c " * 50, "long"),
            ("q,q q;q q:q q!q q?q q\nq q\x0cq q\rq", "x")]
    for least in (1, 2, 3):
        assert mined(spark, rows, least, 1000) == brute(rows, least, 1000)


def test_ties_stand_in_byte_order(spark):
    rows = [("z y. b a. é e. b a. z y. é e", "en")]
    assert [r[2] for r in mined(spark, rows, 2, 2)] == ["b a", "z y"]


def test_one_language_and_one_pair_hold_most(spark, monkeypatch):
    monkeypatch.setattr(phrases, "HOT_SHARE", 10)
    rows = [(f"very common w{i % 7} x{i % 5}", "en") for i in range(300)] + [("very common", "de")]
    assert mined(spark, rows, 4, 1000) == brute(rows, 4, 1000)


def test_empty_table_and_clashing_names(spark):
    assert mined(spark, [], 1, 10) == []
    docs = spark.createDataFrame([("a b", "en", 1, 2, 3)],
                                 "text string, lang string, phrase int, count int, subtree int")
    found = phrases.collocations(phrases.frequent_phrases(docs, least=1)).collect()
    assert [(r.phrase, r.a, r.score) for r in found] == [("a b", 1, 2000)]


def test_sums_stay_exact():
    """Products beyond 64 bits: a thousand times 3e9 times 4e12, cut by 5e9 times 3e9."""
    import decimal
    decimal.getcontext().prec = 60
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    counts = spark.createDataFrame(
        [("g", None, None, 4 * 10**12 + 7), ("g", "a", 1, 5 * 10**9 + 3), ("g", "b", 1, 3 * 10**9 + 1),
         ("g", "a b", 2, 3 * 10**9)], "group string, phrase string, size int, count long")
    row = phrases.collocations(counts).first()
    assert row.score == 1000 * 3 * 10**9 * (4 * 10**12 + 7) // ((5 * 10**9 + 3) * (3 * 10**9 + 1))


def test_bitmap_calls_no_frequent_phrase_rare(spark):
    rows = [("g", f"w{i} v{i % 3}", 2, 9) for i in range(3000)]
    known = phrases.remember(spark.createDataFrame(
        rows, "group string, phrase string, size int, count long"), 2)
    import numpy as np

    def hashes(pairs):
        return phrases.mixed([np.array([phrases.word_hash("g", p[k].encode()) for p in pairs],
                                       np.uint64) for k in range(2)])

    assert known.has(hashes([tuple(r[1].split()) for r in rows])).all()
    assert known.has(hashes([(f"x{i}", "y") for i in range(3000)])).mean() < 0.1
