"""Scans: delimited/ORC/parquet files with explicit schemas, day windows,
missing-day tolerance, line and whole-file (XML message) scans."""
