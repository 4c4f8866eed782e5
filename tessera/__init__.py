"""tessera: layered (bronze / silver / gold) indicator jobs on stock Spark.

Everything here is DataFrame / SQL / Structured Streaming code: functions take
and return DataFrames, Catalyst plans the work, no per-row Python runs on the
hot path.

Sub-packages
------------
functions   column-expression helpers (text sentinel, rounding, rates, labels)
operators   DataFrame -> DataFrame operators (cleaning, dedup, indicators, DQ)
sources     readers and writers (CSV, Parquet batches, warehouse, catalog)
plans       composite jobs (bronze, silver, gold), test-table adapter, CLI
streaming   Structured Streaming ingest, dedup and live indicator
"""

__version__ = "0.1.0"
