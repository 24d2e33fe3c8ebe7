"""Column expressions shared by the operators."""

from .months import month_bits, months_from_bits, months_text
from .numeric import number_text, round_half_even, round_half_up, safe_divide
from .text import is_filled, is_missing, null_sentinel, route_label, strip, try_number

__all__ = [
    "is_filled",
    "is_missing",
    "month_bits",
    "months_from_bits",
    "months_text",
    "null_sentinel",
    "number_text",
    "round_half_even",
    "round_half_up",
    "route_label",
    "safe_divide",
    "strip",
    "try_number",
]
