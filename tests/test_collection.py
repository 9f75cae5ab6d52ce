"""Loads into a store that refuses some documents."""

import json
import os

import pytest
from fixtures import odd_tables
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from reshelve.operators.document import nest_documents
from reshelve.operators.prepare import enrich
from reshelve.plans import document
from reshelve.schema import document_schema
from reshelve.sinks.collection import collection_counts, load_collection, read_collection
from reshelve.sinks.documents import LoadCounts, TOO_LARGE, TOO_MANY_ROWS


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.fixture(scope="module")
def docs(spark):
    return nest_documents(enrich({n: df.cache() for n, df in odd_tables(spark).items()}))


def read(spark, path):
    return read_collection(spark, path, document_schema(DoubleType()))


@pytest.mark.parametrize("batch_size", [1, 2, 5000])
def test_all_documents_are_taken(spark, docs, tmp_path, batch_size):
    path = str(tmp_path)
    assert load_collection(docs, path, batch_size=batch_size) == LoadCounts(5, 5, 0)
    stored, rejected = read(spark, path)
    assert rejected.count() == 0
    for query in (document.d1, document.d3, document.d5):
        assert rows_of(query(stored)) == rows_of(query(docs))


@pytest.mark.parametrize("batch_size", [1, 3, 5000])
def test_the_others_of_a_refused_batch_are_taken(spark, docs, tmp_path, batch_size):
    path = str(tmp_path)
    counts = load_collection(docs, path, limit=600, batch_size=batch_size)
    stored, rejected = read(spark, path)
    assert counts == collection_counts(path) == LoadCounts(5, 4, 1)
    assert sorted(r.customer_id for r in stored.pieces.collect()) == [2, 3, 4, 5]
    [row] = rejected.collect()
    assert (row.customer_id, row.reason) == (1, TOO_LARGE) and row.document_bytes > 600


def test_a_store_has_reasons_of_its_own(spark, docs, tmp_path):
    path = str(tmp_path)
    assert load_collection(docs, path, store="tests.picky:Picky") is None
    stored, rejected = read(spark, path)
    assert collection_counts(path) == LoadCounts(5, 4, 1)
    assert [(r.customer_id, r.reason) for r in rejected.collect()] == [(3, "not this one")]
    assert stored.pieces.count() == 4


def test_customers_with_too_many_rows_are_set_aside_once(spark, docs, tmp_path):
    pieces = nest_documents(enrich(odd_tables(spark)), max_rows=2)
    assert load_collection(pieces, str(tmp_path)) == LoadCounts(5, 4, 1)
    [row] = read(spark, str(tmp_path))[1].collect()
    assert (row.customer_id, row.document_bytes, row.reason) == (1, None, TOO_MANY_ROWS)


def test_a_load_replaces_the_one_before(spark, docs, tmp_path):
    path = str(tmp_path)
    load_collection(docs, path)
    load_collection(docs.where("customer_id = 2"), path)
    assert read(spark, path)[0].pieces.count() == 1
    assert len([n for n in os.listdir(path) if not n.startswith("_")]) == 1


def test_a_load_that_fails_changes_nothing(spark, docs, tmp_path):
    path = str(tmp_path)
    load_collection(docs, path)
    broken = docs.where(F.when(F.col("customer_id") == 5, F.raise_error(F.lit("planned"))
                               .cast("boolean")).otherwise(F.lit(True)))
    with pytest.raises(PySparkException):
        load_collection(broken, path)
    assert collection_counts(path) == LoadCounts(5, 5, 0)
    assert rows_of(document.d5(read(spark, path)[0])) == rows_of(document.d5(docs))
    assert len([n for n in os.listdir(path) if not n.startswith("_")]) == 1


def test_files_of_attempts_that_lost_are_not_read(spark, docs, tmp_path):
    path = str(tmp_path)
    load_collection(docs, path)
    with open(f"{path}/_committed.json") as file:
        load = json.load(file)["load"]
    with open(f"{path}/{load}/part-000000-999.json", "w") as file:
        file.write('{"customer_id": 77}\n')
    assert read(spark, path)[0].pieces.count() == 5


def test_an_empty_collection(spark, docs, tmp_path):
    assert load_collection(docs.where("customer_id < 0"), str(tmp_path)) == LoadCounts(0, 0, 0)
    stored, rejected = read(spark, str(tmp_path))
    assert stored.pieces.count() == rejected.count() == 0
