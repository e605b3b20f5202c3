"""Data-quality and reconciliation engine built on PySpark DataFrames."""
