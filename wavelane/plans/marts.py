"""Summary tables for serving. Column names are upper case by contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavelane.functions import percent_text, rate
from wavelane.params import SPIKE_REASON, VARIANCE_REASON, MonitorParams
from wavelane.plans.detection import alert_spans, marked_spans


def patient_summary(features: DataFrame, alerts: DataFrame, n: str | None = None) -> DataFrame:
    """Per patient with features: windows, alerts (null without any), alert rate as text. ``n`` names a
    column of both tables that says for how many rows a row stands."""
    each = F.col(n) if n else F.lit(1)
    windows = features.groupBy("patient_id").agg(F.sum(each).alias("TOT_WINDOWS_PROCESSED"))
    told = F.sum(F.when(F.col("alert_reason").isNotNull(), each).otherwise(0))
    return summary_of(windows, alerts.groupBy("patient_id").agg(told.alias("TOT_ALERTS_FIRED")))


def summary_of(windows: DataFrame, fired: DataFrame) -> DataFrame:
    """The same mart from totals by patient."""
    share = F.coalesce(rate(F.col("TOT_ALERTS_FIRED"), F.col("TOT_WINDOWS_PROCESSED")), F.lit(0.0))
    return windows.join(fired, "patient_id", "left").select(
        F.col("patient_id").alias("PATIENT_ID"),
        "TOT_WINDOWS_PROCESSED",
        "TOT_ALERTS_FIRED",
        percent_text(share).alias("ALERT_RATE"),
    )


def alerts_daily(alerts: DataFrame, n: str | None = None) -> DataFrame:
    """Per patient, channel and date: alerts by reason. ``n`` as in ``patient_summary``."""

    def of(reason: str, name: str):
        return F.sum(F.when(F.col("alert_reason") == reason, F.col(n) if n else F.lit(1)).otherwise(0)).alias(name)

    return alerts.groupBy(
        F.col("patient_id").alias("PATIENT_ID"),
        F.col("channel").alias("CHANNEL"),
        F.col("event_date").alias("ALERT_DATE"),
    ).agg(of(SPIKE_REASON, "SPIKE_THRESHOLD_CNT"), of(VARIANCE_REASON, "HIGH_VAR_CNT"))


def seizure_detection_rate(
    alerts: DataFrame, annotations: DataFrame, params: MonitorParams
) -> DataFrame:
    """Per patient with at least one match, unnamed: patients detected (1), intervals of all patients,
    their quotient as text, false positives of this patient.

    Patients without a match have no row. ``detection_report`` counts intervals instead.
    """
    return detection_rate_of(marked_spans(alert_spans(alerts), annotations, params), annotations)


def detection_rate_of(spans: DataFrame, annotations: DataFrame) -> DataFrame:
    """The same mart from spans that are marked already."""
    total = annotations.agg(F.count_distinct("seizure_start_ms", "patient_id").alias("n")).scalar()
    hits = F.count_if("hit")
    vain = F.coalesce(F.sum(F.when(~F.col("hit"), F.col("alerts"))), F.lit(0))
    return (
        spans.groupBy("patient_id")
        .agg(hits.alias("__hits"), vain.alias("FP_COUNT"))
        .where("__hits > 0")
        .select(F.lit(1).cast("bigint").alias("DETECTED"), total.alias("TOT_SEIZURES"), "FP_COUNT")
        .select(
            "DETECTED",
            "TOT_SEIZURES",
            percent_text(rate(F.col("DETECTED"), F.col("TOT_SEIZURES"))).alias("DETECTION_RATE"),
            "FP_COUNT",
        )
    )
