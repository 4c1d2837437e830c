"""Column expressions shared by the operators."""

from wavelane.functions.columns import alert_reason, floor_to, micros, overlaps, percent_text, rate
from wavelane.functions.labels import electrode_name, suffix_repeats

__all__ = [
    "alert_reason",
    "electrode_name",
    "floor_to",
    "micros",
    "overlaps",
    "percent_text",
    "rate",
    "suffix_repeats",
]
