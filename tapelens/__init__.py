"""Audit library for order and trade event tables, written as Spark DataFrame jobs."""
