"""Constraint checks on marts and alerts as rows ``(check, violations, passed)``.

The alert count of a patient without alerts is null by definition of the summary and breaks its own
not-null rule; the report shows that.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavelane.params import SPIKE_REASON, VARIANCE_REASON

# The columns that must not be null.
NOT_NULL = {
    "patient_summary": ("PATIENT_ID", "TOT_WINDOWS_PROCESSED", "TOT_ALERTS_FIRED", "ALERT_RATE"),
    "alerts_daily": ("PATIENT_ID", "CHANNEL", "ALERT_DATE"),
    "seizure_detection_rate": ("DETECTED", "TOT_SEIZURES", "DETECTION_RATE", "FP_COUNT"),
}


def not_null(table: DataFrame, name: str) -> DataFrame:
    """Null counts of the table's required columns, in one pass."""
    return _report(
        table, {f"not_null_{name}_{c.lower()}": F.col(c).isNull() for c in NOT_NULL[name]}
    )


def repeated_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return table.groupBy(*keys).agg(F.count("*").alias("cnt")).where("cnt > 1")


def unexpected_reasons(alerts: DataFrame) -> DataFrame:
    """Alerts whose reason is none of the known ones."""
    return alerts.where(_unexpected_reason())


def rates_out_of_range(marts: DataFrame) -> DataFrame:
    """Rows whose rate text is no percentage between 0 and 100; text that is no number is not judged."""
    return marts.where(_rate_out_of_range())


def _unexpected_reason() -> Column:
    return ~F.col("alert_reason").isin(SPIKE_REASON, VARIANCE_REASON)


def _rate_out_of_range() -> Column:
    value = F.replace("DETECTION_RATE", F.lit("%"), F.lit("")).try_cast("float")
    return ~value.between(0, 100)


def mart_constraints(
    alerts: DataFrame, summary: DataFrame, daily: DataFrame, detection: DataFrame
) -> DataFrame:
    """All constraint checks, one row each."""
    reports = [
        not_null(summary, "patient_summary"),
        not_null(daily, "alerts_daily"),
        not_null(detection, "seizure_detection_rate"),
        _rows_in(repeated_keys(summary.where("PATIENT_ID is not null"), ["PATIENT_ID"]), "unique_patient_id"),
        _report(alerts, {"accepted_alert_reason": _unexpected_reason()}),
        _rows_in(
            repeated_keys(daily, ["PATIENT_ID", "CHANNEL", "ALERT_DATE"]), "unique_alerts_daily"
        ),
        _report(detection, {"detection_rate_between_0_and_100": _rate_out_of_range()}),
    ]
    return reduce(DataFrame.unionByName, reports)


def _report(table: DataFrame, bad: dict[str, Column]) -> DataFrame:
    wide = table.agg(*[F.count_if(predicate).alias(name) for name, predicate in bad.items()])
    return wide.unpivot([], wide.columns, "check", "violations").withColumn(
        "passed", F.col("violations") == 0
    )


def _rows_in(offending: DataFrame, name: str) -> DataFrame:
    counted = offending.agg(F.count("*").alias("violations"))
    return counted.select(
        F.lit(name).alias("check"), "violations", (F.col("violations") == 0).alias("passed")
    )
