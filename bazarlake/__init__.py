"""Batch analytics for marketplace order data on PySpark."""
