"""Column functions: geography slices, code clean-up, names and dates."""

from tallyfold.functions.codes import (
    geo_parts, county_code, tract_code, block_group_code, county_fips, pad_code, parse_age, scope_filter,
    strip_cell, top_code, zero_fill,
)
from tallyfold.functions.names import batch_date, contains_any, remove_first, strip_prefixes

__all__ = [
    "geo_parts", "county_code", "tract_code", "block_group_code", "county_fips", "pad_code", "parse_age",
    "scope_filter", "strip_cell", "top_code", "zero_fill", "batch_date", "contains_any", "remove_first",
    "strip_prefixes",
]
