"""Column expressions: Column in, Column out, no Python per row."""

from statera.functions.cleaning import (
    clean_text,
    code_slug,
    first_number,
    none_if_token,
    normalize_symbol,
    percent_value,
    period_bucket,
    strip_space,
    to_number,
)
from statera.functions.periods import parse_period, with_period
from statera.functions.ratios import (
    book_value_per_share,
    guarded_ratio,
    row_mean,
    round_half_even,
    sum_null_as_zero,
)
from statera.functions.scores import health_label, scale_between

__all__ = [
    "book_value_per_share",
    "clean_text",
    "code_slug",
    "first_number",
    "guarded_ratio",
    "health_label",
    "none_if_token",
    "normalize_symbol",
    "parse_period",
    "percent_value",
    "period_bucket",
    "round_half_even",
    "row_mean",
    "scale_between",
    "strip_space",
    "sum_null_as_zero",
    "to_number",
    "with_period",
]
