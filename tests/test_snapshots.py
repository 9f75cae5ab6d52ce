"""Loads of the wide table: seen whole or not at all, and only the buckets they touch."""

import os

import pytest
from conftest import plan
from fixtures import odd_tables

from reshelve.operators.prepare import enrich
from reshelve.operators.wide import BUCKET, to_wide
from reshelve.sinks import wide as sink
from reshelve.sinks.wide import write_wide
from reshelve.sources import snapshots
from reshelve.sources.snapshots import Snapshot, commit, read_snapshot, vacuum
from reshelve.sources.stores import read_wide


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.fixture(scope="module")
def rows(spark):
    return to_wide(enrich(odd_tables(spark))).cache()


def loads(path):
    return sorted(os.listdir(f"{path}/data"))


def test_a_load_that_dies_leaves_no_trace(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path)
    write_wide(rows, path, truncate=True, buckets=4)

    def die(*_):
        raise KeyboardInterrupt

    for truncate in (False, True):
        with monkeypatch.context() as patch:
            patch.setattr(sink, "commit", die)
            with pytest.raises(KeyboardInterrupt):
                write_wide(rows.where("customer_id = 1"), path, truncate=truncate, buckets=2)
        assert rows_of(read_wide(spark, path).drop(BUCKET)) == rows_of(rows)
    assert read_snapshot(spark, path).version == 0 and len(loads(path)) > 1
    assert vacuum(spark, path) == []
    left = len(loads(path)) - 1
    assert len(vacuum(spark, path, 0)) == left and len(loads(path)) == 1
    assert rows_of(read_wide(spark, path).drop(BUCKET)) == rows_of(rows)


def test_untouched_buckets_keep_their_files(spark, rows, tmp_path):
    path = str(tmp_path)
    write_wide(rows, path, truncate=True, buckets=16)
    before = read_snapshot(spark, path)
    write_wide(rows.where("customer_id = 1"), path)
    after = read_snapshot(spark, path)
    changed = {b for b in after.loads if before.loads[b] != after.loads[b]}
    assert len(changed) == 1 and after.version == 1 and set(after.loads) == set(before.loads)
    assert rows_of(read_wide(spark, path).drop(BUCKET)) == rows_of(rows)


def test_new_buckets_are_not_written_twice(spark, rows, tmp_path):
    path = str(tmp_path)
    write_wide(rows.where("customer_id = 1"), path, truncate=True, buckets=64)
    write_wide(rows.where("customer_id != 1"), path)
    assert len(loads(path)) == 2
    assert rows_of(read_wide(spark, path).drop(BUCKET)) == rows_of(rows)


def test_a_reader_keeps_its_snapshot(spark, rows, tmp_path):
    path = str(tmp_path)
    write_wide(rows, path, truncate=True, buckets=4)
    reading = read_wide(spark, path).drop(BUCKET)
    write_wide(rows.where("customer_id = 1"), path, truncate=True, buckets=2)
    assert rows_of(reading) == rows_of(rows)
    assert rows_of(read_wide(spark, path).drop(BUCKET)) == rows_of(rows.where("customer_id = 1"))


def test_reads_merge_nothing(spark, rows, tmp_path):
    path = str(tmp_path)
    for _ in range(3):
        write_wide(rows, path, buckets=4)
    text = plan(read_wide(spark, path))
    assert not any(step in text for step in ("Aggregate", "Exchange", "Sort", "Join"))


def test_a_number_is_taken_once(spark, tmp_path):
    path = str(tmp_path)
    one, two = (Snapshot(0, 4, "", {0: name}) for name in ("a", "b"))
    assert commit(spark, path, one) and not commit(spark, path, two)
    assert read_snapshot(spark, path) == one
    assert [n for n in os.listdir(f"{path}/_snapshots") if not n.endswith(".crc")] == [
        "0000000000.json"]


def test_a_load_that_comes_second_starts_over(spark, rows, tmp_path, monkeypatch):
    """Another load commits between this one's look at the table and its commit."""
    path = str(tmp_path)
    write_wide(rows.where("customer_id = 1"), path, truncate=True, buckets=4)
    real, met = sink.commit, []

    def late(spark_, path_, snapshot):
        if not met:
            met.append(1)
            with monkeypatch.context() as patch:
                patch.setattr(sink, "commit", real)
                write_wide(rows.where("customer_id IN (1, 3)"), path)
        return real(spark_, path_, snapshot)

    monkeypatch.setattr(sink, "commit", late)
    write_wide(rows.where("customer_id NOT IN (1, 3)"), path)
    assert rows_of(read_wide(spark, path).drop(BUCKET)) == rows_of(rows)
    assert read_snapshot(spark, path).version == 2


def test_a_replaced_table_refuses_loads_under_way(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path)
    write_wide(rows, path, truncate=True, buckets=4)
    old = read_snapshot(spark, path)
    write_wide(rows, path, truncate=True, buckets=2)
    found = iter([old, read_snapshot(spark, path)])
    monkeypatch.setattr(sink, "read_snapshot", lambda *_: next(found))
    with pytest.raises(RuntimeError, match="replaced"):
        write_wide(rows, path)


def test_many_versions_are_read_by_number(spark, tmp_path):
    for n in (0, 9, 10, 11):
        assert commit(spark, str(tmp_path), Snapshot(n, 4, "x", {n: "a"}))
    assert read_snapshot(spark, str(tmp_path)).version == 11
    assert read_snapshot(spark, str(tmp_path / "none")) is None
    assert vacuum(spark, str(tmp_path / "none")) == []
    assert snapshots.written_buckets(spark, str(tmp_path), BUCKET) == set()
