"""Scalar functions as Column -> Column expressions (all JVM-side, no Python UDF)."""

from .codec import escapes_to_string, md5_upper, random_uuid, string_to_escapes
from .dates import date_to_millis, date_to_seconds, millis_to_date, millis_to_date_compact
from .ipaddr import ip_in_section, ip_to_long, section_bounds
from .jsonmap import json_lower_keys, json_to_map, json_to_nested_map
from .text import count_sep, is_blank, jpart, jsplit, jsplit_char, jtrim, regex_is_valid
from . import regexscan

__all__ = [
    "count_sep", "date_to_millis", "date_to_seconds", "escapes_to_string", 
    "ip_in_section", "ip_to_long", "is_blank", "json_lower_keys", "json_to_map", "json_to_nested_map", "jsplit",
    "jpart", "jsplit_char", "jtrim", "md5_upper", "millis_to_date", "millis_to_date_compact",
    "random_uuid", "regex_is_valid", "regexscan",
    "section_bounds", "string_to_escapes",
]
