"""Column expressions and aggregates with NA-propagating semantics."""
from geopanel.functions.aggregates import (
    numeric_columns,
    single_value,
    strict_mean,
    strict_sd,
    strict_sum,
)
from geopanel.functions.scalar import (
    alias_code,
    as_number,
    cases,
    finite_or,
    half_even,
    if_else,
    is_member,
    number_key,
    on_weekday,
    pad_key,
    ratio,
    quoted,
    remove_first,
    remove_first_text,
    slice_text,
    split_first,
    sql,
    sum_columns,
    text,
    title_case,
)

__all__ = [
    "alias_code", "as_number", "cases", "finite_or", "half_even", "if_else", "is_member",
    "number_key", "numeric_columns", "on_weekday", "pad_key", "quoted", "ratio",
    "remove_first", "remove_first_text", "single_value", "slice_text", "split_first", "sql",
    "strict_mean", "strict_sd", "strict_sum", "sum_columns", "text", "title_case",
]
