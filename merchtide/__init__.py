"""Hourly commerce decision tables, data quality and batch-risk scoring on Spark."""
