"""Small hand-made tables holding the odd cases."""

from __future__ import annotations

import datetime as dt

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_comment string"
ORDERS = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
          "o_orderdate timestamp_ntz, o_comment string")
LINEITEM = ("l_orderkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
            "l_shipdate date, l_commitdate date, l_receiptdate date")
NATION = "n_nationkey int, n_name string, n_regionkey int"
REGION = "r_regionkey int, r_name string"

DAY = dt.date(1996, 3, 13)
NOON = dt.datetime(1996, 1, 2, 12, 30)


def line(order, number, price=100.0, discount=0.1, tax=0.05, flag="R", quantity=3.0):
    return (order, number, quantity, price, discount, tax, flag, "O", DAY, DAY, DAY)


def order(key, customer, status="O", price=200.0, comment="fine"):
    return (key, customer, status, price, NOON, comment)


def tables(spark, customers, orders, lines, nations=None, regions=None):
    return {
        "customer": spark.createDataFrame(customers, CUSTOMER),
        "orders": spark.createDataFrame(orders, ORDERS),
        "lineitem": spark.createDataFrame(lines, LINEITEM),
        "nation": spark.createDataFrame(nations or [(1, "CHINA", 7), (2, "NOWHERE", 99)], NATION),
        "region": spark.createDataFrame(regions or [(7, "ASIA")], REGION),
    }


def odd_tables(spark):
    """Customer 1 is complete; 2 has no orders; 3 has an order without lines; 4 lives in a
    nation without region; 5 in no known nation; 6 lacks a comment and 7 a nation key, so both
    are dropped; order 31 lacks a comment."""
    customers = [(1, "Ann", 1, "x"), (2, "Ben", 1, "x"), (3, "Cyd", 1, "x"), (4, "Dee", 2, "x"),
                 (5, "Eve", 42, "x"), (6, "Fay", 1, None), (7, "Gus", None, "x")]
    orders = [order(10, 1), order(11, 1, "F", 50.0), order(30, 3), order(31, 3, comment=None),
              order(40, 4), order(50, 5), order(60, 6), order(70, 7), order(99, 98)]
    lines = [line(10, 1), line(10, 2, 200.0, flag="A"), line(11, 1, 10.0, 0.0, 0.0),
             line(31, 1), line(40, 1), line(50, 1), line(60, 1), line(70, 1),
             line(10, None)]
    return tables(spark, customers, orders, lines)
