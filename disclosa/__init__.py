"""Spark-first analytics for corpora of disclosure filings."""
