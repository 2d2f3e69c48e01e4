from shelfrank.functions.expressions import (
    flag_number,
    min_max,
    nan_to_null,
    round_half_even,
    weighted_sum,
    z_score,
)

__all__ = [
    "flag_number",
    "min_max",
    "nan_to_null",
    "round_half_even",
    "weighted_sum",
    "z_score",
]
