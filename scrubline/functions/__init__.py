"""Scalar column expressions (all native Spark expressions)."""

from .dates import US_DATE_FORMAT, month_text, parse_date, parse_timestamp, year_of
from .json import (decode_json, encode_json, flatten, flatten_observation, split_valid,
                   stable_uuid)
from .text import (blank_to_null, numeric_text_eq, starts_with, strip_trailing,
                   text_as_double, trim_spaces)

__all__ = [
    "US_DATE_FORMAT", "month_text", "parse_date", "parse_timestamp", "year_of",
    "decode_json", "encode_json", "flatten", "flatten_observation", "split_valid", "stable_uuid",
    "blank_to_null", "numeric_text_eq", "starts_with", "strip_trailing",
    "text_as_double", "trim_spaces",
]
