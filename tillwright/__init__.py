"""Retail sales analytics on Spark: flat files to star schema, quality gate, KPIs and alerts."""

__version__ = "0.1.0"
