"""Column expressions and small distributed building blocks."""

from tabloom.functions.columns import (
    hash_bucket32, is_numeric_type, join_small, numeric_columns, ratio_threshold,
    safe_div, split_hash, spread, valid_columns,
)
from tabloom.functions.ranking import dense_index, running_total

__all__ = [
    "dense_index", "hash_bucket32", "is_numeric_type", "join_small", "numeric_columns",
    "ratio_threshold", "running_total", "safe_div", "split_hash", "spread", "valid_columns",
]
