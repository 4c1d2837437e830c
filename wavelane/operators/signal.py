"""Signal summaries: profile, spectrum, channel names."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavelane.functions import electrode_name, micros
from wavelane.operators.series import number_within
from wavelane.params import MonitorParams


def signal_profile(
    readings: DataFrame, keys: Sequence[str] = ("patient_id", "channel")
) -> DataFrame:
    """Per patient and channel (or other ``keys``, such as the recording and channel): number of samples,
    covered time, samples per second, extremes."""
    seconds = (micros(F.col("last_time")) - micros(F.col("first_time"))) / 1e6
    grouped = readings.groupBy(*keys).agg(
        F.count("*").alias("samples"),
        F.min("event_time").alias("first_time"),
        F.max("event_time").alias("last_time"),
        F.min("voltage").alias("min_v"),
        F.max("voltage").alias("max_v"),
    )
    return grouped.withColumn("samples_per_second", F.try_divide("samples", seconds))


def band_power(readings: DataFrame, params: MonitorParams, hertz: Sequence[float]) -> DataFrame:
    """Periodogram per patient, channel and window: power at each frequency.

    Uses the true sample times, so irregular sampling is fine. Every frequency is a pair of sums in one
    aggregate: rows are not multiplied, and partial sums are all that is shuffled. A null voltage
    adds nothing.
    """
    window = F.window("event_time", params.window)
    timed = readings.select(
        "patient_id",
        "channel",
        "voltage",
        window.start.alias("window_start"),
        ((micros(F.col("event_time")) - micros(window.start)) / 1e6).alias("__t"),
    )
    sums = []
    for number, frequency in enumerate(hertz):
        angle = F.col("__t") * (2 * math.pi * frequency)
        sums.append(F.sum(F.col("voltage") * F.cos(angle)).alias(f"c{number}"))
        sums.append(F.sum(F.col("voltage") * F.sin(angle)).alias(f"s{number}"))
    grouped = timed.groupBy("patient_id", "channel", "window_start").agg(
        F.count("voltage").alias("samples"), *sums
    )
    spectrum = F.array(
        *[
            F.struct(
                F.lit(float(frequency)).alias("hertz"),
                F.try_divide(
                    F.pow(f"c{number}", 2) + F.pow(f"s{number}", 2), F.col("samples")
                ).alias("power"),
            )
            for number, frequency in enumerate(hertz)
        ]
    )
    return grouped.select("patient_id", "channel", "window_start", "samples", F.inline(spectrum))


def normalise_channels(labels: DataFrame) -> DataFrame:
    """One row per recording and electrode: the first label (by ``position``) with that electrode name.

    Expects recording, position, label. Partial aggregation keeps one candidate per task and name.
    """
    named = labels.withColumn("electrode", electrode_name(F.col("label")))
    first = F.min(F.struct("position", "label"))
    return (
        named.groupBy("recording", "electrode")
        .agg(first.alias("first"))
        .select("recording", "electrode", "first.position", "first.label")
    )


def suffix_duplicates(labels: DataFrame, block_positions: int = 65_536) -> DataFrame:
    """Give labels that recur in a recording the suffix ``-0``, ``-1``, ... in order of ``position``.

    Table form of ``suffix_repeats`` for label lists of any length.
    """
    block = F.floor(F.col("position") / block_positions)
    numbered = number_within(
        labels, ["recording", "label"], ["position"], block, "repeat", "occurrences"
    )
    suffixed = F.concat("label", F.lit("-"), F.col("repeat").cast("string"))
    unique = F.when(F.col("occurrences") > 1, suffixed).otherwise(F.col("label"))
    return numbered.select("recording", "position", "label", unique.alias("channel"))
