"""Readers and writers.

csv        delimited files: declared schema by name, encoding/separator detection (SRC-2/3)
parquet    batch partition, per-year union, latest snapshot, missing-path guard (SRC-6..9)
warehouse  warehouse table through a connector, Parquet export fallback (SRC-1)
sinks      batch, dynamic-partition and table writes, DQ report, read-back (SNK-1..6, VAL-1)
catalog    catalog registration and SQL (CAT-1/2)
"""
