from runlens.functions.columns import (
    epoch_ms,
    epoch_ntz,
    in_list,
    millis_to_ts,
    ms_of,
    ms_to_sec,
    total,
    trim_lower,
    trim_upper,
    zero_to_null,
)

__all__ = [
    "epoch_ms",
    "epoch_ntz",
    "in_list",
    "millis_to_ts",
    "ms_of",
    "ms_to_sec",
    "total",
    "trim_lower",
    "trim_upper",
    "zero_to_null",
]
