"""Scalar helpers, distribution tails, schema checks and skew-safe building blocks."""
from .checks import MissingColumns, require_columns
from .scalars import (area_between, great_circle_m, hill_number, ln_choose_ratio,
                      night_of, safe_div, unit_vector, week_of_year)
from .scale import (cut_lineage, dense_index, exact_quantiles, exact_quantiles_many, first_per_key, join_small,
                    nearest_marked, ordered_index, permuted_index,
                    previous_row, range_buckets, value_index)
from .tails import f_tail, normal_tail, t_tail

__all__ = [
    "MissingColumns", "require_columns", "area_between", "great_circle_m", "hill_number",
    "ln_choose_ratio", "night_of", "safe_div", "unit_vector", "week_of_year", "cut_lineage",
    "dense_index", "exact_quantiles", "exact_quantiles_many", "first_per_key", "join_small", "nearest_marked", "ordered_index",
    "permuted_index", "previous_row", "range_buckets", "value_index", "f_tail", "normal_tail", "t_tail",
]
