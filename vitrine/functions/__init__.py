"""Column expressions built only from JVM-side Spark functions."""

from vitrine.functions.exprs import (
    exact_mean,
    guarded_ratio,
    match_ci,
    plain_decimal_string,
    ratio_half_even,
    scaled_half_even,
    sum0,
    to_scaled_double,
)

__all__ = [
    "exact_mean",
    "guarded_ratio",
    "match_ci",
    "plain_decimal_string",
    "ratio_half_even",
    "scaled_half_even",
    "sum0",
    "to_scaled_double",
]
