"""DataFrame -> DataFrame operators."""

from .analysis import (date_span, numeric_text_equals, running_total, top_n_per_group,
                       total_by, total_by_period)
from .cleaning import (blank_to_null, canonicalize_prefix, dedupe, delete_where, drop_all_null,
                       fill_from_peers, number_duplicates, parse_date, retype, strip_trailing,
                       trim, update_where)

__all__ = [
    "date_span", "numeric_text_equals", "running_total", "top_n_per_group", "total_by",
    "total_by_period", "blank_to_null", "canonicalize_prefix", "dedupe", "delete_where",
    "drop_all_null", "fill_from_peers", "number_duplicates", "parse_date", "retype",
    "strip_trailing", "trim", "update_where",
]
