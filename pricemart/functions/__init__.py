"""Native Column expressions (no Python UDFs)."""

from pricemart.functions.exact import exact_mean, round_half_up, safe_div, in_bounds
from pricemart.functions.text import py_strip, normalise_label
from pricemart.functions.numbers import clean_price, parse_rate
from pricemart.functions.periods import (
    parse_period, parse_with_formats, period_to_date, slash_date_to_month, parse_rate_date,
)
from pricemart.functions.labels import map_category, standardise_label

__all__ = [
    "exact_mean", "round_half_up", "safe_div", "in_bounds",
    "py_strip", "normalise_label",
    "clean_price", "parse_rate",
    "parse_period", "parse_with_formats", "period_to_date", "slash_date_to_month", "parse_rate_date",
    "map_category", "standardise_label",
]
