"""Warehouse operators for PySpark: ingestion, reconciliation and reporting over DataFrames."""

__version__ = "0.1.0"
