from claimlake.functions.codes import (
    differs_or_null,
    in_or_null,
    invalid_length,
    merge_flag,
    normalize_code,
    null_label,
    ratio_pct,
    remove_thousands,
    safe_cast,
)

__all__ = [
    "differs_or_null",
    "in_or_null",
    "invalid_length",
    "merge_flag",
    "normalize_code",
    "null_label",
    "ratio_pct",
    "remove_thousands",
    "safe_cast",
]
