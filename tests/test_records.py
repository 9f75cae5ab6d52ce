"""CSV files with line breaks in values, read by many tasks, against the reader of one task."""

import csv
import random

import pytest
from conftest import plan

from reshelve.sources.records import read_csv
from reshelve.sources.request_log import convert_log, read_log

SIGNS = ["a", "b,c", '"', '""', "\n", "\n\n", ",", " ", "é", "x" * 30, "", "漢", "'"]


def values(draw, breaks):
    signs = SIGNS if breaks else [s for s in SIGNS if "\n" not in s]
    return ["".join(draw.choice(signs) for _ in range(draw.randrange(6))) or None
            for _ in range(3)]


def write(path, rows, ending="\n", header=("id", "m s", "t")):
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, lineterminator=ending)
        writer.writerow(header)
        writer.writerows(rows)


def found(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def one_task(spark, path):
    return spark.read.csv(str(path), header=True, escape='"', multiLine=True)


@pytest.fixture
def small_blocks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    opened = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "16")

    def of(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

    yield of
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.set("spark.sql.files.openCostInBytes", opened)


@pytest.mark.parametrize("size", [700, 2_000, 9_000])
@pytest.mark.parametrize("breaks", [True, False])
def test_equals_one_task(spark, tmp_path, small_blocks, size, breaks):
    small_blocks(size)
    draw = random.Random(size)
    for n in range(2):
        write(tmp_path / f"{n}.csv", [(f"r{i}", *values(draw, breaks)[:2]) for i in range(400)])
    frame = read_csv(spark, str(tmp_path))
    assert found(frame) == found(one_task(spark, tmp_path))
    assert frame.columns == ["id", "m s", "t"]


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    small_blocks(4_000)
    write(tmp_path / "a.csv", [(i, "said \"x\",\nwent on", "y" * 50) for i in range(2000)])
    lines = spark.read.text(str(tmp_path), lineSep="\n")
    assert lines.rdd.getNumPartitions() > 20
    frame = read_csv(spark, str(tmp_path))
    assert frame.count() == 2000 and found(frame) == found(one_task(spark, tmp_path))
    assert "CartesianProduct" not in plan(frame)


def test_values_longer_than_blocks(spark, tmp_path, small_blocks):
    small_blocks(500)
    rows = [(1, "x", "y"), (2, "line\n" * 400, "z"), (3, "a\n" * 700, "b\n" * 300), (4, "", None)]
    write(tmp_path / "a.csv", rows)
    assert found(read_csv(spark, str(tmp_path))) == found(one_task(spark, tmp_path))
    assert read_csv(spark, str(tmp_path)).where("id = 2").first()["m s"] == "line\n" * 400


def test_line_endings_and_blank_lines(spark, tmp_path, small_blocks):
    small_blocks(300)
    write(tmp_path / "a.csv", [(i, "one\ntwo", "é") for i in range(60)], "\r\n")
    assert found(read_csv(spark, str(tmp_path))) == found(one_task(spark, tmp_path))
    other = tmp_path / "other"
    other.mkdir()
    (other / "b.csv").write_text('id,m\n\n1,"a\n\nb"\n\n2\n3,x,more\n4,"open\nend')
    assert found(read_csv(spark, str(other))) == found(one_task(spark, other))


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert read_csv(spark, str(tmp_path)).count() == 0
    (tmp_path / "b.csv").write_text("id,m\n")
    assert read_csv(spark, str(tmp_path)).count() == 0


def test_log_of_either_reader(spark, tmp_path, small_blocks):
    small_blocks(3_000)
    write(tmp_path / "log.csv", [(f"q{i % 3}", i, "true" if i % 5 else "false", 'a "b",\nc')
                                 for i in range(500)],
          header=("label", "elapsed", "success", "responseMessage"))
    split, whole = (read_log(spark, str(tmp_path / "log.csv"), split=s) for s in (True, False))
    assert found(split) == found(whole) and split.schema == whole.schema
    stored = convert_log(spark, str(tmp_path / "log.csv"), str(tmp_path / "out"))
    assert found(stored) == found(whole)
