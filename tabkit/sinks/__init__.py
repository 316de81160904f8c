"""Sinks: delimited export, parquet, rendered-text export."""
