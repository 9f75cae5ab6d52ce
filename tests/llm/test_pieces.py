import random

import pytest
import sentencepiece

from reshelve.llm import pieces as p


@pytest.fixture(scope="module")
def transducer():
    return p.Transducer(p.read_vocabulary())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=p.MODEL)


def test_equals_the_library(transducer, library, given):
    for _, text in given:
        ids = transducer.encode(text).tolist()
        assert ids == library.encode(text) and transducer.decode(ids) == text


def test_odd_texts(transducer, library):
    pick = random.Random(0)
    odd = ["", " ", "    ", "a  b", "\t\r\n", "▁", "x▁ y", "\U0001F9FF漢字é́", "\x00",
           " " * 3000, "ab" * 2000, "ing" * 700 + " "]
    odd += ["".join(pick.choice("ab  \n éß漢▁the1ing\U0001F9FF") for _ in range(40))
            for _ in range(400)]
    for text in odd:
        ids = transducer.encode(text).tolist()
        assert ids == library.encode(text)
        assert transducer.decode(ids) == library.decode(ids)
        if p.MARK not in text:
            assert transducer.decode(ids) == text


def test_special_and_broken_ids(transducer, library):
    for ids in ([1, 542, 2], [0], [3 + 0xC3], [542, 3 + 0xFF, 542], [3 + 0xC3, 3 + 0xA9]):
        assert transducer.decode(ids) == library.decode(ids)


def test_unigram_takes_the_best_path():
    pieces = ["<unk>", p.MARK, "a", "b", "ab", "ba", "aba"]
    scores = [0.0, -1.0, -2.0, -2.0, -2.5, -1.0, -4.5]
    t = p.Transducer(p.Vocabulary(pieces, scores, [2, 1, 1, 1, 1, 1, 1], False, False, True, 0))
    assert [pieces[i] for i in t.encode("aba")] == ["a", "ba"]
    assert [pieces[i] for i in t.encode(" ab  ab ")] == ["ab", p.MARK, "ab"]
    assert t.encode("axb").tolist() == [2, 0, 3]


def test_bounded_memory(library, monkeypatch, given):
    monkeypatch.setattr(p, "MAX_CACHED", 50)
    t = p.Transducer(p.read_vocabulary())
    assert all(t.encode(x).tolist() == library.encode(x) for _, x in given[:5])
    assert max(map(len, (t.segments, t.pairs, t.whole))) <= 50


def test_columns(spark, docs_of):
    rows = docs_of([(1, "Hello world"), (1, "Hello world"), (2, None), (None, ""),
                    (3, "long " * 40_000)], ids="x", exact=1)
    vocabulary = p.read_vocabulary()
    coded = p.decode(p.encode(rows, vocabulary), vocabulary)
    assert set(coded.columns) == set(rows.columns) | {"n_ids", "decoded"}
    found = coded.collect()
    assert all(r.exact and r.decoded == (r.text or "") and r.n_ids == len(r.ids) for r in found)
    assert len(found) == 5 and {r.n_ids for r in found if not r.text} == {0}
    assert p.encode(docs_of([]), vocabulary).count() == 0


def test_query_covers_the_table(spark, folder, given, library):
    found = {r.doc_id: r.ids for r in p.op7_pieces(spark, folder).collect()}
    assert found == {i: library.encode(t) for i, t in given}
