"""Column expressions: text, money and time."""

from .money import exact_sum
from .temporal import date_key, duration_minutes, overnight_rollover, parse_ts
from .text import hash_text, lenient_number, masked_email, masked_tail, strip, surrogate_key

__all__ = [
    "date_key",
    "duration_minutes",
    "exact_sum",
    "hash_text",
    "lenient_number",
    "masked_email",
    "masked_tail",
    "overnight_rollover",
    "parse_ts",
    "strip",
    "surrogate_key",
]
