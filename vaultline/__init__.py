"""Metadata-driven warehouse loading on Spark: change capture, history, data quality, data vault."""
