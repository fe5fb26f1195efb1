"""Scalar column functions (F1–F20). All are built-in Spark expressions, so they
stay inside whole-stage codegen; none is a Python UDF."""

from skuflow.functions.numeric import (
    clean_money, to_number, coerced, clip_low, round_money, truncate_long, row_sum, number_or_null,
)
from skuflow.functions.text import (
    blank_to_null, strip_trailing_s, underscore_spaces, contains_ci, equals_ci, not_equal_keep_null,
    excludes_ci, NA_TOKENS,
)
from skuflow.functions.ids import date_key, row_id, sku_channel_id
from skuflow.functions.dates import date_from_name
from skuflow.functions.json import ITEMS_SCHEMA, parse_items, json_field

__all__ = [
    "clean_money", "to_number", "coerced", "clip_low", "round_money", "truncate_long", "row_sum",
    "number_or_null", "blank_to_null", "strip_trailing_s", "underscore_spaces", "contains_ci", "equals_ci",
    "not_equal_keep_null", "excludes_ci", "NA_TOKENS", "date_key", "row_id", "sku_channel_id",
    "date_from_name", "ITEMS_SCHEMA", "parse_items", "json_field",
]
