"""Operators for large training corpora: decontamination, near-duplicates,
license scans, line dedup, toxicity, fingerprints, packing, sharding,
personal data and token counts.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds its
queries when the folder is present.
"""
