"""Column-expression helpers (JVM-side built-ins only, no UDFs)."""

from tessera.functions.labels import goal_status, target_for_year
from tessera.functions.numeric import count_flag, deviation, flag_is_one, rate, round2
from tessera.functions.text import (blank_to_null, clean_text, fill_missing, is_missing,
                                    null_tokens_to_null)

__all__ = [
    "blank_to_null", "clean_text", "fill_missing", "is_missing", "null_tokens_to_null",
    "round2", "rate", "deviation", "flag_is_one", "count_flag",
    "target_for_year", "goal_status",
]
