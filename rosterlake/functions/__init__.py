from rosterlake.functions.numeric import clock_hours, finite_or, overlap_hours, safe_ratio, whole
from rosterlake.functions.temporal import add_hours, iso_weekday, parse_date, parse_timestamp
from rosterlake.functions.text import coerce_integer, coerce_numeric, first_integer, prefix_code, strip

__all__ = [
    "add_hours", "clock_hours", "coerce_integer", "coerce_numeric", "finite_or", "first_integer", "iso_weekday",
    "overlap_hours", "parse_date", "parse_timestamp", "prefix_code", "safe_ratio", "strip", "whole",
]
