"""Warehouse loads, record linkage and period reporting as Spark DataFrame operations."""
