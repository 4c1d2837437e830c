"""Tumbling-window features and threshold alerts; the same code serves batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wavelane.functions import alert_reason
from wavelane.params import MonitorParams

FEATURE_SCHEMA = (
    StructType()
    .add("patient_id", "string")
    .add("channel", "string")
    .add("window_start", "timestamp")
    .add("window_end", "timestamp")
    .add("mean_v", "double")
    .add("stddev_v", "double")
    .add("min_v", "double")
    .add("max_v", "double")
    .add("spike_count", "long")
    .add("event_date", "date")
)


def window_features(readings: DataFrame, params: MonitorParams) -> DataFrame:
    """Per window, patient and channel: mean, deviation, extremes, number of spikes.

    One shuffle, after map-side partial aggregation: a patient that holds much of the data arrives at
    the shuffle as one row per task and window. On a stream, readings later than the watermark's
    closed windows are dropped and each window comes out once, after it closed.
    """
    if readings.isStreaming:
        readings = readings.withWatermark("event_time", params.watermark)
    spike = F.when(F.abs("voltage") > params.spike_volts, 1).otherwise(0)
    grouped = readings.groupBy(F.window("event_time", params.window), "patient_id", "channel").agg(
        F.avg("voltage").alias("mean_v"),
        F.stddev_samp("voltage").alias("stddev_v"),
        F.min("voltage").alias("min_v"),
        F.max("voltage").alias("max_v"),
        F.sum(spike).alias("spike_count"),
    )
    return grouped.select(
        "patient_id",
        "channel",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "mean_v",
        "stddev_v",
        "min_v",
        "max_v",
        "spike_count",
        F.to_date("window.start").alias("event_date"),
    )


def label_alerts(features: DataFrame, params: MonitorParams) -> DataFrame:
    """Add ``alert_reason``, null where a window is unremarkable."""
    reason = alert_reason(F.col("spike_count"), F.col("stddev_v"), params)
    return features.withColumn("alert_reason", reason)


def alerts_only(labelled: DataFrame) -> DataFrame:
    """The rows that carry a reason."""
    return labelled.where(F.col("alert_reason").isNotNull())
