"""Remodel relational order data as documents and wide rows, and analyse it with Spark."""
