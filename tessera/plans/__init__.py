"""Composite jobs and the driver-facing query registry.

bronze    ingest (PIPE-1)              silver   conform/clean/dedup/audit (PIPE-2/3)
gold      three views (PIPE-4)         publish  write once -> check -> commit
jobs      CLI and multi-entity loop (PIPE-5/6)
adapters  shared test tables in student/target shape
queries   registered queries           oracle   their DuckDB SQL
"""
