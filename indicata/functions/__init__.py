"""Column expressions used by the operators and pipelines."""

from indicata.functions.dates import format_day, format_month, parse_timestamp, year_month_keys
from indicata.functions.files import file_stem, file_system, open_input
from indicata.functions.numbers import (default_zero, parse_decimal_comma, percent_change,
                                        round_half_up, scale_and_round_col,
                                        to_number, truncate_to_long)
from indicata.functions.tokens import clean_tokens, field_by_name, split_quoted

__all__ = [
    "clean_tokens", "default_zero", "field_by_name", "file_stem", "file_system", "format_day", "format_month",
    "open_input", "parse_decimal_comma", "parse_timestamp", "percent_change", "round_half_up",
    "scale_and_round_col", "split_quoted", "to_number", "truncate_to_long",
    "year_month_keys",
]
