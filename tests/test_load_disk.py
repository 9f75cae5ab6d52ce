"""What loads of the wide table move and leave on disk."""

import time

import pytest
from fixtures import line, order, tables
from pyspark.sql import functions as F

from reshelve.operators.prepare import enrich
from reshelve.operators.wide import BUCKET, to_wide
from reshelve.session import REMOVE_SHUFFLES, shuffles_removed
from reshelve.sinks import wide as sink
from reshelve.sinks.wide import write_wide
from reshelve.sources.stores import read_wide

NUMBERS = (-65, -1, 0, 1, 63, 64, 127, 128, 200)


def joined(spark):
    """Two customers with an order each, whose lines have odd numbers."""
    lines = [line(o, n, 10.0 * o) for o in (1, 2) for n in NUMBERS]
    t = tables(spark, [(1, "Ann", 1, "x"), (2, "Bob", 1, "x")], [order(1, 1), order(2, 2)], lines)
    return to_wide(enrich(t))


@pytest.fixture(scope="module")
def rows(spark):
    return joined(spark).cache()


@pytest.fixture
def merges(monkeypatch):
    """The buckets whose rows of the table were shuffled, and how many rows they gave."""
    real, found = sink._replaced, []

    def replaced(*args, **options):
        rows = real(*args, **options)
        found.append((set(args[5]), rows.count()))
        return rows

    monkeypatch.setattr(sink, "_replaced", replaced)
    return found


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def shuffle_files(spark) -> set[str]:
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    files = manager.diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_rows_that_are_all_replaced_are_not_shuffled(spark, rows, tmp_path, merges):
    path = str(tmp_path)
    write_wide(rows, path, truncate=True, buckets=2)
    again = rows.withColumn("status", F.lit("Z"))
    write_wide(again, path)
    assert merges == []
    assert rows_of(read_wide(spark, path).drop(BUCKET)) == rows_of(again)


@pytest.mark.parametrize("loaded", [(-1,), (63, 64), NUMBERS[1:]])
def test_only_rows_that_stay_are_written_beside_a_load(spark, rows, tmp_path, merges, loaded):
    path = str(tmp_path)
    write_wide(rows, path, truncate=True, buckets=2)
    some = F.col("line_number").isin(*loaded) & (F.col("customer_id") == 1)
    write_wide(rows.where(some).withColumn("status", F.lit("Z")), path)
    [(buckets, left)] = merges
    assert len(buckets) == 1 and left == len(NUMBERS) - len(loaded)
    expected = rows.withColumn("status", F.when(some, "Z").otherwise(F.col("status")))
    assert rows_of(read_wide(spark, path).drop(BUCKET)) == rows_of(expected)


def test_rows_an_overtaken_load_left_are_looked_for_again(spark, rows, tmp_path, monkeypatch):
    path, real, met = str(tmp_path), sink.commit, []
    write_wide(rows, path, truncate=True, buckets=1)
    other, own = rows.where("line_number < 64"), rows.where("line_number >= 63")

    def late(*args):
        if not met:
            met.append(1)
            write_wide(other.withColumn("status", F.lit("Y")), path)
        return real(*args)

    monkeypatch.setattr(sink, "commit", late)
    write_wide(own.withColumn("status", F.lit("Z")), path)
    expected = rows.withColumn("status", F.expr("if(line_number >= 63, 'Z', 'Y')"))
    assert rows_of(read_wide(spark, path).drop(BUCKET)) == rows_of(expected)


def test_a_load_removes_its_shuffle_files(spark, tmp_path):
    path, rows, before = str(tmp_path), joined(spark), shuffle_files(spark)
    write_wide(rows, path, truncate=True, buckets=2)
    write_wide(rows.where("line_number > 0"), path)
    until = time.monotonic() + 20
    while (left := shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    assert left == set()


def test_shuffle_files_stay_elsewhere(spark):
    before = spark.conf.get(REMOVE_SHUFFLES)
    with pytest.raises(KeyError), shuffles_removed(spark):
        assert spark.conf.get(REMOVE_SHUFFLES) == "true"
        raise KeyError
    assert spark.conf.get(REMOVE_SHUFFLES) == before == "false"
