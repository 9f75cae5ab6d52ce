import random

from reshelve.llm import line_dedup as ld


def plain(pairs):
    """Chunks in the order of ids; what was seen before is dropped."""
    seen, found = set(), {}
    for i, text in sorted(pairs):
        lines, parts = ld.chunks(text)
        kept = []
        for start, end in parts:
            joined = "\n".join(lines[start:end])
            if end - start > 1 and joined.strip():
                if joined in seen:
                    continue
                seen.add(joined)
            kept += lines[start:end]
        found[i] = "\n".join(kept)
    return found


def test_query_equals_brute_force(spark, folder, given):
    found = {r.doc_id: r.text for r in ld.op4_line_dedup(spark, folder).collect()}
    assert found == plain(given)
    assert any(found[i] != t for i, t in given)


def test_chunks_resist_shifts():
    pick = random.Random(1)
    shared = [f"line {pick.random()}" for _ in range(60)]
    cut = []
    for extra in (0, 1, 5):
        lines, parts = ld.chunks("\n".join([f"own {extra} {i}" for i in range(extra)] + shared))
        assert [n for part in parts for n in range(*part)] == list(range(len(lines)))
        cut.append({tuple(lines[a:b]) for a, b in parts})
    assert len(cut[0] & cut[1] & cut[2]) >= 0.7 * len(cut[0])


def test_odd_rows(spark, docs_of):
    passage = "\n".join(f"shared line number {i} of the passage" for i in range(30))
    pairs = [(2, passage), (1, "own start\n" + passage + "\nown end"), (3, None), (4, ""),
             (5, "\n\n\n\n"), (6, "\n\n\n\n"), (2, passage), (None, passage),
             (7, "single"), (8, "single")]
    rows = docs_of(pairs, n_lines="x", number=1, hash=2, key=3, mark=4)
    result = ld.remove_repeated(rows)
    assert set(result.columns) == set(rows.columns) | {"n_removed"}
    found = {}
    for r in result.collect():
        found.setdefault(r.doc_id, []).append((r.text, r.n_removed))
    known = [(i, t) for i, t in dict(pairs).items() if t is not None and i is not None]
    expected = plain(known)
    assert {i: t for i, ((t, _), *_) in found.items() if i in expected} == expected
    assert len(found[2]) == 2 and found[2][0] == found[2][1]
    assert found[3] == [(None, 0)] and found[4] == [("", 0)]
    assert found[5] == found[6] == [("\n\n\n\n", 0)]
    assert found[7] == found[8] == [("single", 0)]
    assert len(found[None][0][0]) < len(passage) / 2
    assert ld.remove_repeated(docs_of([])).count() == 0


def test_equal_hash_is_not_enough(spark, docs_of):
    """A chunk with the hash of another but another text stays."""
    pairs = [(i, "\n".join(f"{i} {j}" for j in range(6))) for i in range(5)] + [
        (9, "\n".join(f"2 {j}" for j in range(6)))]
    result = ld.remove_repeated(docs_of(pairs), hash_bits=1)
    found = {r.doc_id: r.text for r in result.collect()}
    assert found == plain(pairs) and found[9] != pairs[-1][1]


def shortened(pairs):
    """Texts without the lines of runs of two or more that stand earlier, found run by run."""
    places, found = {}, {}
    for i, text in sorted(pairs):
        lines = text.split("\n")
        gone = set()
        for at in range(len(lines)):
            for other, start in places.get(lines[at], ()):
                end = 0
                while (at + end < len(lines) and start + end < len(other)
                       and lines[at + end] == other[start + end]):
                    end += 1
                if end > 1 and "".join(lines[at:at + end]).strip():
                    gone |= set(range(at, at + end))
            places.setdefault(lines[at], []).append((lines, at))
        found[i] = "\n".join(line for n, line in enumerate(lines) if n not in gone)
    return found


def test_passages_equal_brute_force(spark, folder, given):
    found = {r.doc_id: r.text for r in ld.op4_passages(spark, folder).collect()}
    assert found == shortened(given)
    assert found != plain(given)


def test_short_passages_are_removed_whole(docs_of):
    """Passages of 2 to 6 lines in two documents each, between lines of their own."""
    pick = random.Random(2)

    def own(n):
        return [f"own line {pick.random()}" for _ in range(n)]

    pairs, expected = [], {}
    for n in (2, 3, 4, 6):
        for _ in range(15):
            passage, i = own(n), len(pairs)
            for j in (i, i + 1):
                before, after = own(pick.randrange(1, 9)), own(pick.randrange(1, 9))
                pairs.append((j, "\n".join(before + passage + after)))
                expected[j] = "\n".join(before + (passage if j == i else []) + after)
    found = ld.remove_repeated(docs_of(pairs), cut=ld.pairs).collect()
    assert {r.doc_id: r.text for r in found} == expected
    assert all(r.n_lines - r.n_removed == len(r.text.split("\n")) for r in found)


def test_pairs_of_equal_hash_and_odd_rows(docs_of):
    pairs = [(1, "a\na\na\nb"), (2, "b\nc\n\n\n"), (3, None), (4, ""), (5, "x\na\na\ny"),
             (6, "z\n\n\n"), (7, "b"), (7, "b"), (8, "q\nr"), (8, "q\nr"), (None, "q\nr")]
    found = [(r.doc_id, r.text, r.n_removed) for r in ld.remove_repeated(
        docs_of(pairs), hash_bits=1, cut=ld.pairs).collect()]
    assert sorted(found, key=str) == sorted([
        (1, "a\nb", 2), (2, "b\nc\n\n\n", 0), (3, None, 0), (4, "", 0), (5, "x\ny", 2),
        (6, "z\n\n\n", 0), (7, "b", 0), (7, "b", 0), (8, "q\nr", 0), (8, "q\nr", 0),
        (None, "", 2)], key=str)
