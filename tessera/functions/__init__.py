"""Column expressions: cleaning, parsing, calendar attributes, ratios, p-values."""

from .dates import calendar_columns, decade_label, parse_date, to_day
from .numbers import count_where, duration_days, flag, pct, ratio, rescale, to_number
from .pvalues import chi2_upper_p, student_t_two_sided_p, verdict
from .text import (
    READER_NA_TOKENS, SENTINELS, clean_text_columns, format_pct, normalize_columns, normalize_name,
    null_if_sentinel, parse_pct, split_list, strip,
)

__all__ = [
    "calendar_columns", "decade_label", "parse_date", "to_day",
    "count_where", "duration_days", "flag", "pct", "ratio", "rescale", "to_number",
    "chi2_upper_p", "student_t_two_sided_p", "verdict",
    "READER_NA_TOKENS", "SENTINELS", "clean_text_columns", "format_pct", "normalize_columns",
    "normalize_name", "null_if_sentinel", "parse_pct", "split_list", "strip",
]
