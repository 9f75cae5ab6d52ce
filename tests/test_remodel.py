"""Cleaning, joining, nesting and conforming on hand-made rows."""

import datetime as dt
from collections import Counter
from decimal import Decimal

import pytest
from fixtures import DAY, line, odd_tables, order, tables
from pyspark.sql import functions as F

from conftest import plan
from reshelve.functions.convert import convert_values
from reshelve.operators.document import nest_documents, unwind_lines
from reshelve.operators.prepare import clean, enrich
from reshelve.operators.wide import cluster_by, conform, to_wide, upsert
from reshelve.plans import document, relational, wide
from reshelve.schema import STORE_SCHEMA, WIDE_SCHEMA


@pytest.fixture(scope="module")
def odd(spark):
    return odd_tables(spark)


@pytest.fixture(scope="module")
def enriched(odd):
    return enrich(odd).cache()


def keys(df):
    return sorted(((r.customer_id, r.order_id, r.line_number) for r in df.collect()), key=str)


def test_a_null_in_any_source_column_drops_the_row(odd):
    cleaned = clean(odd)
    assert {r.customer_id for r in cleaned["customer"].collect()} == {1, 2, 3, 4, 5}
    assert 31 not in {r.order_id for r in cleaned["orders"].collect()}
    assert cleaned["lineitem"].where("order_id = 10").count() == 2


def test_nan_counts_as_missing(spark, odd):
    nan = {**odd, "orders": odd["orders"].unionByName(
        spark.createDataFrame([order(12, 1, price=float("nan"))], odd["orders"].schema))}
    assert clean(nan)["orders"].where("order_id = 12").count() == 0


def test_enriched_equals_outer_joins(odd, enriched):
    t = clean(odd)
    expected = (t["customer"]
                .join(t["orders"].join(t["lineitem"], "order_id", "left"), "customer_id", "left")
                .join(t["nation"], "nation_key", "left").join(t["region"], "region_key", "left"))
    assert sorted(enriched.columns) == sorted(set(expected.columns))
    same = expected.columns
    assert Counter(map(tuple, enriched.select(*[c for c in same if c != "o_comment"]).collect())) \
        == Counter(map(tuple, expected.select(*[c for c in same if c != "o_comment"]).collect()))


def test_enriched_keeps_padded_rows(enriched):
    assert keys(enriched) == sorted(
        [(1, 10, 1), (1, 10, 2), (1, 11, 1), (2, None, None), (3, 30, None), (4, 40, 1),
         (5, 50, 1)], key=str)
    places = {r.customer_id: (r.nation_name, r.region_name) for r in enriched.collect()}
    assert places[1] == ("CHINA", "ASIA")
    assert places[4] == ("NOWHERE", None)
    assert places[5] == (None, None)


def test_documents_hold_null_structs_for_missing_children(enriched):
    docs = {r.customer_id: r for r in nest_documents(enriched).pieces.collect()}
    assert len(docs) == 5
    assert [o.order_id for o in docs[1].orders] == [10, 11]
    assert [i.line_number for i in docs[1].orders[0].lineitems] == [1, 2]
    assert docs[2].orders[0].order_id is None
    assert docs[2].orders[0].lineitems[0].line_number is None
    assert len(docs[3].orders[0].lineitems) == 1


def test_documents_without_padding_have_empty_arrays(enriched):
    docs = {r.customer_id: r for r in nest_documents(enriched, drop_empty=True).pieces.collect()}
    assert docs[2].orders == []
    assert docs[3].orders[0].lineitems == []


@pytest.mark.parametrize("drop_empty", [False, True])
def test_unwinding_restores_the_rows(enriched, drop_empty):
    docs = nest_documents(enriched, drop_empty)
    assert keys(unwind_lines(docs, keep_empty=True)) == keys(enriched)
    expected = [k for k in keys(enriched) if not drop_empty or None not in k]
    assert keys(unwind_lines(docs)) == expected


@pytest.mark.parametrize("max_rows", [1, 2])
@pytest.mark.parametrize("drop_empty", [False, True])
def test_pieces_change_no_answer(enriched, max_rows, drop_empty):
    whole = nest_documents(enriched, drop_empty)
    split = nest_documents(enriched, drop_empty, max_rows=max_rows)
    assert whole.pieces.where("NOT (whole AND first) OR carried").count() == 0
    marks = {(r.customer_id, r.whole) for r in split.pieces.collect()}
    assert marks == {(1, False), (2, True), (3, True), (4, True), (5, True)}
    for query in (document.d1, document.d2, document.d2_count, document.d2_sample, document.d3,
                  document.d4, document.d5):
        assert Counter(map(str, query(split).collect())) \
            == Counter(map(str, query(whole).collect())), query.__name__


def test_a_hot_order_is_cut_and_counted_once(spark):
    """One customer with an order of 500 lines, another order of the same id, and 40 small ones."""
    lines = [line(10, n, float(n)) for n in range(1, 501)]
    lines += [line(100 + n, 1, 1.0) for n in range(40)]
    orders = [order(10, 1, "P", price=2.0), order(10, 1, "A", price=3.0)]
    orders += [order(100 + n, 1) for n in range(40)]
    rows = enrich(tables(spark, [(1, "Ann", 1, "x")], orders, lines))
    whole, split = nest_documents(rows), nest_documents(rows, max_rows=50)
    sizes = [sum(len(o.lineitems) for o in r.orders) for r in split.pieces.collect()]
    assert len(sizes) > 10 and max(sizes) <= 150 and sum(sizes) == 1040
    assert split.pieces.where("first").count() == 1
    for query in (document.d1, document.d2, document.d3, document.d4, document.d5):
        assert Counter(map(str, query(split).collect())) \
            == Counter(map(str, query(whole).collect())), query.__name__


def test_nesting_shuffles_lines_once(enriched, spark):
    frame = spark.range(10).selectExpr(
        "id AS customer_id", "'n' AS name", "'a' AS nation_name", "'b' AS region_name",
        "id AS order_id", "'O' AS status", "1.0 AS total_price", "current_date() AS order_date",
        "1 AS line_number", "1.0 AS quantity", "1.0 AS extended_price", "0.0 AS discount",
        "0.0 AS tax", "'R' AS return_flag", "'O' AS line_status", "current_date() AS ship_date",
        "current_date() AS commit_date", "current_date() AS receipt_date")
    pieces = plan(nest_documents(frame).pieces)
    lines = [row for row in pieces.split("\n") if "Exchange hashpartitioning" in row]
    assert "BatchEvalPython" not in pieces and "CartesianProduct" not in pieces
    # Lines go by order and nested orders by customer; the rest are counts per order.
    assert sum("part#" not in row and "n#" not in row for row in lines) <= 4


def test_document_answers(enriched):
    docs = nest_documents(enriched)
    d3 = {(r.customer_id, r.status): (r.order_count, r.total_value)
          for r in document.d3(docs).collect()}
    assert d3[1, "O"] == (1, Decimal("200.00"))
    assert d3[2, None] == (1, Decimal("0.00"))
    d5 = [(r.customer_id, r.total_revenue, r.total_orders) for r in document.d5(docs).collect()]
    assert d5[0] == (1, Decimal("280.00"), 3)
    assert (2, Decimal("0.00"), 1) in d5
    assert document.d1(docs, 77).count() == 0
    assert [r.customer_id for r in document.d4(docs, "ASIA", 2, 3).collect()] in ([2, 3], [3, 2])
    assert {r.customer_id for r in document.d5(docs, 3, 4).collect()} == {3, 4}


def test_relational_answers(odd):
    """These run on the source tables, where the line without a number counts too."""
    assert relational.r1(odd, 1).collect()[0].region == "ASIA"
    assert relational.r1(odd, 4).count() == 0
    assert {r.customer_id for r in relational.r4(odd, "ASIA", 2, 3).collect()} == {2, 3}
    top = relational.r5_top(odd, 1, 2, k=1).collect()
    assert [(r.order_id, r.revenue) for r in top] == [(10, Decimal("378.00"))]
    total = relational.r5_total(odd, 1, 1).first()
    assert (total.orders, total.grand_total) == (2, Decimal("388.00"))
    assert relational.r5_total(odd, 500, 510).first().orders == 0
    assert relational.r2_summary(odd, 1).first().line_count == 4


def test_wide_rows_and_answers(enriched):
    rows = upsert(to_wide(enriched))
    assert rows.schema.names == WIDE_SCHEMA.names
    assert keys(rows) == sorted([(1, 10, 1), (1, 10, 2), (1, 11, 1), (4, 40, 1), (5, 50, 1)],
                                key=str)
    assert wide.k1(rows, 2).count() == 0
    assert wide.k3(rows, 1).first()[1:] == (2, 3)
    flags = {r.return_flag: (r.matching_lines, r.total_quantity)
             for r in wide.k4(rows, 1).collect()}
    assert flags == {"R": (2, Decimal("6.00")), "A": (1, Decimal("3.00")), "N": (0, Decimal(0))}
    assert [(r.order_id, r.revenue) for r in wide.k5(rows, 1).collect()] == [
        (10, Decimal("283.50")), (11, Decimal("10.00"))]
    assert wide.k5_text(rows, 1).first().response == (
        "Customer 1: 2 orders\n  Order 10: 283.50\n  Order 11: 10.00\n"
        "Grand Total Revenue: 293.50")


def test_null_operands_add_nothing(spark, enriched):
    rows = to_wide(enriched).withColumn(
        "tax", F.when(F.col("order_id") != 11, F.col("tax"))).withColumn(
        "discount", F.when(F.col("line_number") != 2, F.col("discount")))
    assert wide.k2_summary(rows, 1).first()[1:] == (3, Decimal("100.00"))
    assert [r.order_id for r in wide.k5(rows, 1).collect()] == [10]


def test_upsert_keeps_one_row_per_key(spark, enriched):
    rows = to_wide(enriched)
    doubled = rows.unionByName(rows.withColumn("status", F.lit("A"))).unionByName(rows)
    assert Counter(map(tuple, upsert(doubled).collect())) == Counter(map(tuple, rows.collect()))


def test_conform_rejects_null_keys_and_other_columns(spark, enriched):
    rows = to_wide(enriched)
    assert conform(rows).count() == rows.count()
    with pytest.raises(Exception, match="null in key column order_id"):
        conform(rows.withColumn("order_id", F.lit(None).cast("bigint"))).collect()
    with pytest.raises(Exception, match="tax"):
        conform(rows.drop("tax"))


def test_ids_beyond_32_bits(spark, odd):
    large = 2 ** 40
    t = tables(spark, [(1, "Ann", 1, "x")], [order(large, 1)], [line(large, 1)])
    rows = enrich(t)
    assert to_wide(rows).first().order_id == large
    with pytest.raises(Exception, match="OVERFLOW"):
        to_wide(rows, STORE_SCHEMA).collect()
    small = to_wide(enrich(odd))
    for narrow in (to_wide(enrich(odd), STORE_SCHEMA), conform(small, STORE_SCHEMA)):
        assert narrow.schema["order_id"].dataType.simpleString() == "int"
        assert keys(narrow) == keys(small)
    with pytest.raises(Exception, match="OVERFLOW"):
        conform(to_wide(rows), STORE_SCHEMA).collect()


def test_clustering_keeps_rows(enriched):
    rows = to_wide(enriched)
    for partitions in (None, 3):
        assert keys(cluster_by(rows, partitions=partitions)) == keys(rows)


def test_values_are_converted_at_any_depth(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2020, 1, 2, 3, 4), [(DAY, Decimal("1.50"))], None)],
        "at timestamp_ntz, items array<struct<day date, price decimal(15,2)>>, gone struct<d date>")
    row = convert_values(df).first()
    assert row["at"] == dt.datetime(2020, 1, 2)
    assert row["items"][0].day == dt.datetime(1996, 3, 13)
    assert row["items"][0].price == Decimal("1.50")
    assert row.gone is None
