"""Documents nested from the source tables against those of the joined rows."""

from collections import Counter

import pytest
from conftest import plan
from fixtures import line, odd_tables, order, tables

from reshelve.operators import document
from reshelve.operators.document import nest_documents, nest_tables
from reshelve.operators.prepare import enrich
from reshelve.sinks import collection
from test_plans import NO_BROADCAST, settings


def repeated(spark):
    """Rows of customers, orders and nations that repeat a key, with other values or the same."""
    customers = [(1, "Ann", 1, "x"), (1, "Ann", 1, "x"), (1, "Abe", 1, "x"), (2, "Ben", 3, "x"),
                 (2, "Ben", 3, "x"), (3, "Cyd", 42, "x")]
    orders = [order(10, 1), order(10, 1), order(10, 1, "F", 3.0), order(10, 3), order(11, 1),
              order(99, 98), order(12, 3)]
    lines = [line(10, 1), line(10, 1), line(10, 2, 5.0), line(12, None), line(12, 4), line(7, 1),
             *[line(77, n) for n in range(30)]]
    return tables(spark, customers, orders, lines,
                  [(1, "CHINA", 7), (3, "A", 7), (3, "B", 99)])


def pieces_of(docs):
    return Counter(map(str, docs.pieces.collect()))


@pytest.mark.parametrize("drop_empty", [False, True])
@pytest.mark.parametrize("build", [odd_tables, repeated])
def test_whole_documents_equal_those_of_joined_rows(spark, build, drop_empty):
    t = build(spark)
    found, expected = nest_tables(t, drop_empty), nest_documents(enrich(t), drop_empty)
    assert found.pieces.columns == expected.pieces.columns and found.padded == expected.padded
    assert [f.dataType.simpleString() for f in found.pieces.schema] == [
        f.dataType.simpleString() for f in expected.pieces.schema]
    assert pieces_of(found) == pieces_of(expected)


@pytest.mark.parametrize("max_rows", [1, 3, 8])
@pytest.mark.parametrize("build", [odd_tables, repeated])
def test_large_customers_come_in_the_same_pieces(spark, build, max_rows):
    t = build(spark)
    found, expected = (f.pieces for f in (
        nest_tables(t, max_rows=max_rows), nest_documents(enrich(t), max_rows=max_rows)))
    assert Counter(map(str, found.collect())) == Counter(map(str, expected.collect()))


def test_no_tables_at_all(spark):
    t = {name: df.limit(0) for name, df in odd_tables(spark).items()}
    assert nest_tables(t).pieces.count() == 0


def test_lines_are_shuffled_flat_once(spark):
    with settings(spark, **NO_BROADCAST):
        text = plan(nest_tables(odd_tables(spark)).pieces)
    # Orders, lines, nested orders, customers and their two dimensions; no counts, no padding.
    assert text.count("Exchange hashpartitioning") <= 8
    assert "LeftAnti" not in text and "Union" not in text


def test_rows_are_gathered_in_one_pass(spark):
    with settings(spark, **NO_BROADCAST):
        text = plan(nest_tables(odd_tables(spark)).pieces)
    # Only the fields of customers, which come unsorted, are gathered before and after a shuffle.
    assert text.count("partial_collect_list") == 1


def test_large_customers_are_looked_for_only_where_there_may_be_some(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("counted")

    t = odd_tables(spark)
    expected = pieces_of(nest_documents(enrich(t)))
    monkeypatch.setattr(document, "_too_large", refuse)
    assert pieces_of(nest_tables(t)) == expected
    with pytest.raises(AssertionError, match="counted"):
        nest_tables(t, max_rows=2)


@pytest.mark.parametrize("slot", [1, 256])
@pytest.mark.parametrize("build", [odd_tables, repeated])
def test_no_customer_or_order_has_more_than_the_most_rows(spark, build, slot, monkeypatch):
    monkeypatch.setattr(document, "LINES_PER_SLOT", slot)
    t = build(spark)
    rows = enrich(t)
    found = document._most_rows(t)
    assert all(found >= r["count"] for r in rows.groupBy("customer_id").count().collect())
    assert all(found >= r["count"] for r in t["lineitem"].groupBy("l_orderkey").count().collect())


def test_tasks_are_handed_few_documents_at_a_time(spark, tmp_path, monkeypatch):
    name, asked = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before, real = spark.conf.get(name), collection._arrow_rows
    monkeypatch.setattr(collection, "_arrow_rows",
                        lambda s, rows: asked.append(rows) or real(s, rows))
    docs = nest_tables(odd_tables(spark))
    for batch_size in (3, 5000):
        assert collection.load_collection(docs, str(tmp_path), batch_size=batch_size).inserted == 5
    assert asked == [3, collection.ARROW_ROWS] and spark.conf.get(name) == before
    with real(spark, 7):
        assert spark.conf.get(name) == "7"
