"""Column expressions. Everything here stays inside the JVM: no Python UDFs."""

from .days import (
    day_spine,
    from_julian_day,
    julian_day,
    julian_number,
    parse_day,
)
from .numeric import (
    float_text,
    is_numeric,
    numeric_text,
    round_numeric,
)
from .records import display_name, hash_bytes, message, record
from .scoring import SCORE_CURVES, score, score_text

__all__ = [
    "SCORE_CURVES",
    "day_spine",
    "display_name",
    "float_text",
    "from_julian_day",
    "hash_bytes",
    "is_numeric",
    "julian_day",
    "julian_number",
    "message",
    "numeric_text",
    "parse_day",
    "record",
    "round_numeric",
    "score",
    "score_text",
]
