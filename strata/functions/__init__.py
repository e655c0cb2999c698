"""Column expressions shared by the operators."""

from strata.functions.dates import calendar_columns
from strata.functions.hashing import hash_expr, hash_order, hash_text, packed, unpacked
from strata.functions.measures import or_zero, with_sales_measures
from strata.functions.text import blank_to_null, split_list

__all__ = [
    "blank_to_null",
    "calendar_columns",
    "hash_expr",
    "hash_order",
    "hash_text",
    "or_zero",
    "packed",
    "split_list",
    "unpacked",
    "with_sales_measures",
]
