"""Small native expressions: labels, rates, time arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wavelane.params import SPIKE_REASON, VARIANCE_REASON, MonitorParams


def alert_reason(spikes: Column, deviation: Column, params: MonitorParams) -> Column:
    """Why a window alerts, or null. Spikes take precedence; both limits are strict."""
    return F.when(spikes > params.spike_limit, SPIKE_REASON).when(
        deviation > params.variance_limit, VARIANCE_REASON
    )


def rate(part: Column, whole: Column) -> Column:
    """Percentage as double; null when the whole is zero or a side is null."""
    return F.try_divide(part.cast("double") * 100.0, whole.cast("double"))


def percent_text(percentage: Column) -> Column:
    """``15.857`` -> ``15.86%``. The input must be double: decimals print trailing zeros."""
    return F.concat(F.round(percentage, 2).cast("string"), F.lit("%"))


def micros(moment: Column) -> Column:
    """Microseconds since the epoch of a timestamp with or without zone (session zone UTC)."""
    return F.unix_micros(moment.cast("timestamp"))


def floor_to(value: Column, width: int) -> Column:
    """Largest multiple of ``width`` not above ``value``, also for negative values."""
    return value - F.pmod(value, F.lit(width))


def overlaps(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    """Half-open intervals share time; touching ends do not count."""
    return (start_a < end_b) & (end_a > start_b)
