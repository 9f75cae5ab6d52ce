"""Texts of query results. The wording is a fixed value: clients parse it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def two_places(amount: Column) -> Column:
    return F.round(amount.cast("decimal(38,6)"), 2).cast("decimal(34,2)").cast("string")


def found_text(found: Column, customer_id: Column, name: Column, nation: Column,
               region: Column) -> Column:
    hit = F.concat(
        F.lit("Customer found: id="), customer_id.cast("string"), F.lit(", name="), name,
        F.lit(", nation="), nation, F.lit(", region="), region)
    miss = F.concat(F.lit("Customer "), customer_id.cast("string"), F.lit(" not found"))
    return F.when(found, hit).otherwise(miss)


def lines_text(customer_id: Column, lines: Column, revenue: Column) -> Column:
    return F.concat(
        F.lit("Customer "), customer_id.cast("string"), F.lit(": "), lines.cast("string"),
        F.lit(" order-lines, revenue="), two_places(revenue))


def flag_text(customer_id: Column, flag: Column, lines: Column, quantity: Column) -> Column:
    return F.concat(
        F.lit("Customer "), customer_id.cast("string"), F.lit(", return_flag="), flag,
        F.lit(": "), lines.cast("string"), F.lit(" matching lines, total_qty="),
        two_places(quantity))


def distinct_text(customer_id: Column, orders: Column, lines: Column) -> Column:
    return F.concat(
        F.lit("Customer "), customer_id.cast("string"), F.lit(": "), orders.cast("string"),
        F.lit(" unique orders, "), lines.cast("string"), F.lit(" total line items"))


def range_text(region: Column, start: Column, end: Column, customers: Column) -> Column:
    return F.concat(
        F.lit("Region="), region, F.lit(", Range=["), start.cast("string"), F.lit("-"),
        end.cast("string"), F.lit("]: Found "), customers.cast("string"), F.lit(" customers"))


def status_text(status: Column, orders: Column, value: Column) -> Column:
    return F.concat(
        F.lit("  Status: "), status, F.lit(", Count: "), orders.cast("string"),
        F.lit(", Total: "), value.cast("double").cast("string"))


def revenue_text(customer_id: Column, orders: Column, shown: Column, grand_total: Column) -> Column:
    """Totals around the lines of the few orders shown (structs of order_id, revenue)."""
    lines = F.transform(shown, lambda o: F.concat(
        F.lit("  Order "), o["order_id"].cast("string"), F.lit(": "), two_places(o["revenue"])))
    return F.concat(
        F.lit("Customer "), customer_id.cast("string"), F.lit(": "), orders.cast("string"),
        F.lit(" orders\n"), F.array_join(lines, "\n"), F.lit("\nGrand Total Revenue: "),
        two_places(grand_total))


def rows_text(customer_id: Column, rows: Column, sample: Column) -> Column:
    """The number of unwound rows before the few shown, JSON texts in an array."""
    shown = F.array_join(F.transform(sample, lambda d: F.concat(d, F.lit("\n"))), "")
    return F.concat(F.lit("Customer "), customer_id.cast("string"), F.lit(": Found "),
                    rows.cast("string"), F.lit(" order-lineitem rows.\nSample:\n"), shown)


def _range_head(start: Column, end: Column) -> Column:
    return F.concat(F.lit("Revenue for customers "), start.cast("string"), F.lit("-"),
                    end.cast("string"), F.lit(":\n"))


def customers_text(start: Column, end: Column, customers: Column) -> Column:
    """One line per customer of a range (structs of name, total_revenue, total_orders)."""
    lines = F.transform(customers, lambda c: F.concat(
        F.lit("  "), c["name"], F.lit(": revenue="), two_places(c["total_revenue"]),
        F.lit(", items="), c["total_orders"].cast("string"), F.lit("\n")))
    return F.concat(_range_head(start, end), F.array_join(lines, ""),
                    F.lit("Total customers: "), F.size(customers).cast("string"))


def orders_text(start: Column, end: Column, shown: Column, orders: Column,
                grand_total: Column) -> Column:
    """Totals of a range after the few greatest orders (structs of name, order_id, revenue)."""
    lines = F.transform(shown, lambda o: F.concat(
        F.lit("  "), o["name"], F.lit(", order "), o["order_id"].cast("string"), F.lit(": "),
        two_places(o["revenue"]), F.lit("\n")))
    return F.concat(_range_head(start, end), F.array_join(lines, ""), F.lit("Total orders: "),
                    orders.cast("string"), F.lit(", Grand Total: "), two_places(grand_total))
