"""Alerts against labelled intervals: what was detected, what was raised in vain."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavelane.functions import rate
from wavelane.operators.intervals import overlap_join
from wavelane.operators.sweep import mark_overlapping
from wavelane.params import MonitorParams

ALERT_SPAN = ("window_start", "window_end")
LABEL_SPAN = ("seizure_start_ms", "seizure_end_ms")
LABEL_COLUMNS = ("patient_id", "recording_file", *LABEL_SPAN)


def matched_pairs(alerts: DataFrame, annotations: DataFrame, params: MonitorParams) -> DataFrame:
    """Each alert with each labelled interval of the same patient it shares time with."""
    return overlap_join(alerts, annotations, ALERT_SPAN, LABEL_SPAN, params.cell_seconds)


def false_positives(alerts: DataFrame, annotations: DataFrame, params: MonitorParams) -> DataFrame:
    """Alerts that share time with no labelled interval of their patient."""
    marked = mark_overlapping(alerts, annotations, ALERT_SPAN, LABEL_SPAN, params.block_seconds, "__hit")
    return marked.where(~F.col("__hit")).drop("__hit")


def alert_spans(alerts: DataFrame, n: str | None = None) -> DataFrame:
    """Distinct alert windows per patient with their number of alerts.

    Channels that alert together share one row, so the joins below meet each window once. ``n`` names a
    column that says for how many alerts a row stands.
    """
    return alerts.groupBy("patient_id", *ALERT_SPAN).agg(F.sum(F.col(n) if n else F.lit(1)).alias("alerts"))


def _detected(spans: DataFrame, annotations: DataFrame, params: MonitorParams) -> DataFrame:
    labels = annotations.select(*LABEL_COLUMNS).distinct()
    marked = mark_overlapping(labels, spans, LABEL_SPAN, ALERT_SPAN, params.block_seconds, "__hit")
    return marked.where("__hit").drop("__hit")


def detected_seizures(alerts: DataFrame, annotations: DataFrame, params: MonitorParams) -> DataFrame:
    """Distinct labelled intervals that at least one alert shares time with."""
    return _detected(alert_spans(alerts), annotations, params)


def detection_report(alerts: DataFrame, annotations: DataFrame, params: MonitorParams) -> DataFrame:
    """One row: detected and total intervals, false positives and alerts, both rates in percent.

    Each count is a partial aggregate; a single sum brings the four of them together. A rate over nothing is
    null.
    """
    return report_on(marked_spans(alert_spans(alerts), annotations, params), annotations, params)


def marked_spans(spans: DataFrame, annotations: DataFrame, params: MonitorParams) -> DataFrame:
    """Alert spans and whether they share time with a labelled interval of their patient (``hit``)."""
    return mark_overlapping(spans, annotations, ALERT_SPAN, LABEL_SPAN, params.block_seconds, "hit")


def report_on(spans: DataFrame, annotations: DataFrame, params: MonitorParams) -> DataFrame:
    """The detection report, from marked spans."""
    total = F.coalesce(F.sum("alerts"), F.lit(0))
    vain = F.coalesce(F.sum(F.when(~F.col("hit"), F.col("alerts"))), F.lit(0))
    names = ["detected", "total_seizures", "false_positives", "total_alerts"]
    zero = F.lit(0).cast("bigint")
    rows = [
        _detected(spans, annotations, params).agg(F.count("*").alias("n")).select("n", zero, zero, zero),
        annotations.agg(F.count("*").alias("n")).select(zero, "n", zero, zero),
        spans.agg(vain.alias("vain"), total.alias("total")).select(zero, zero, "vain", "total"),
    ]
    return (
        reduce(DataFrame.union, [row.toDF(*names) for row in rows])
        .agg(*[F.sum(name).alias(name) for name in names])
        .select(
            *names,
            rate(F.col("detected"), F.col("total_seizures")).alias("detection_rate"),
            rate(F.col("false_positives"), F.col("total_alerts")).alias("false_positive_rate"),
        )
    )
