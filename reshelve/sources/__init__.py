"""Readers for table sets, stored models and request logs."""
