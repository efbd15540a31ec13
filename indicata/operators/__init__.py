"""DataFrame -> DataFrame building blocks."""

from indicata.operators.aggregates import group_average, one_row_per_key, period_totals
from indicata.operators.filters import drop_all_null, keep_present, non_empty_key
from indicata.operators.joins import join_all_on_key, join_on_key, join_year_month
from indicata.operators.ordering import sort_asc, sort_desc, top_n
from indicata.operators.projection import exclude, keep, rename
from indicata.operators.windows import period_change, previous_value

__all__ = [
    "drop_all_null", "exclude", "group_average", "join_all_on_key", "join_on_key",
    "join_year_month", "keep", "keep_present", "non_empty_key", "one_row_per_key",
    "period_change", "period_totals", "previous_value", "rename", "sort_asc", "sort_desc",
    "top_n",
]
