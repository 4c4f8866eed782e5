"""DataFrame -> DataFrame operators.

columns     names and types: lower/upper case, rename, drop, casts (PRJ-4..11)
clean       blank/NULL text, rounding, typed projection (PRJ-12..14, SRC-4/5)
dedup       missing keys, newest row per key (FLT-3, WIN-1, SET-2/3)
indicators  rates by city/state, targets, goal comparison (AGG-1..4, FLT-1/2, JN-1, PRJ-15..20)
quality     one-pass data-quality checks, scores, gate, violations (DQ-1..10, OBS-1, AGG-6/7)
audit       audit and partition columns from one run clock (PRJ-1..3)
"""
