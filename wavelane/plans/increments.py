"""Marts kept up to date by day: what changed is counted again, the rest is merged as it is.

For every event date there are partial aggregates that merge by adding or by uniting: window and alert counts
per patient, alert counts by reason, and the set of patients as bitmaps. A load names the dates it touched; only
their partitions are read and replaced. A mart is the merge of all partials, which are as many rows as
patients and days, not windows.

Each touched date also gets a row without patient, so that a date whose rows are all gone is replaced too.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wavelane.plans.marts import alerts_daily, summary_of

TOTALS = "patient_id string, windows long, fired long, event_date date"
REASONS = "PATIENT_ID string, CHANNEL string, SPIKE_THRESHOLD_CNT long, HIGH_VAR_CNT long, ALERT_DATE date"
MEMBERS = "patient_id string, bucket long, members binary, event_date date"


@dataclass(frozen=True)
class PartialPaths:
    """Where the partial aggregates are, each partitioned by date."""

    totals: str
    reasons: str
    members: str


def refresh(
    spark: SparkSession,
    features: DataFrame,
    alerts: DataFrame,
    dates: Sequence[date],
    paths: PartialPaths,
    patient_number: Column | None = None,
    fmt: str = "parquet",
) -> None:
    """Recount the touched ``dates``. ``features`` and ``alerts`` are the stored tables, partitioned by
    event_date; other dates' partitions are not read. ``patient_number`` is a small non-negative number of a
    patient, if sets of patients are to be kept; null numbers are left out."""
    days = list(dict.fromkeys(dates))
    if not days:
        return
    touched = F.col("event_date").isin(days)
    # As many rows as dates in a load.
    marks = spark.createDataFrame([(day,) for day in days], "event_date date")
    new, raised = features.where(touched), alerts.where(touched)

    windows = new.groupBy("patient_id", "event_date").agg(F.count("*").alias("windows"), F.lit(None).cast("long").alias("fired"))
    fired = raised.groupBy("patient_id", "event_date").agg(F.lit(None).cast("long").alias("windows"), F.count("alert_reason").alias("fired"))
    _replace(windows.unionByName(fired), marks, TOTALS, "event_date", paths.totals, fmt)
    _replace(alerts_daily(raised), marks.withColumnRenamed("event_date", "ALERT_DATE"), REASONS, "ALERT_DATE", paths.reasons, fmt)
    if patient_number is not None:
        numbered = new.select("event_date", patient_number.cast("long").alias("number")).where("number is not null")
        members = numbered.groupBy("event_date", F.bitmap_bucket_number("number").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("members")
        )
        _replace(members, marks, MEMBERS, "event_date", paths.members, fmt)


def _replace(rows: DataFrame, marks: DataFrame, schema: str, day: str, path: str, fmt: str) -> None:
    names = [column.split()[0] for column in schema.split(", ")]
    whole = rows.unionByName(marks, allowMissingColumns=True)
    whole = whole.select(*[F.col(n) if n in whole.columns else F.lit(None).cast("string").alias(n) for n in names])
    whole.hint("rebalance", day).write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).save(path)


def _stored(spark: SparkSession, path: str, schema: str, fmt: str) -> DataFrame:
    return spark.read.format(fmt).schema(schema).load(path)


def patient_summary(spark: SparkSession, paths: PartialPaths, fmt: str = "parquet") -> DataFrame:
    """The mart of ``marts.patient_summary`` over all dates, from the partial counts. A null patient is one of
    the patients; only the marks of dates have no counts."""
    totals = _stored(spark, paths.totals, TOTALS, fmt).where("windows is not null or fired is not null")
    merged = totals.groupBy("patient_id").agg(F.sum("windows").alias("windows"), F.sum("fired").alias("fired"))
    windows = merged.where("windows is not null").select("patient_id", F.col("windows").alias("TOT_WINDOWS_PROCESSED"))
    return summary_of(windows, merged.where("fired is not null").select("patient_id", F.col("fired").alias("TOT_ALERTS_FIRED")))


def daily_alerts(spark: SparkSession, paths: PartialPaths, fmt: str = "parquet") -> DataFrame:
    """The mart of ``marts.alerts_daily`` over all dates: its partials are its rows."""
    return _stored(spark, paths.reasons, REASONS, fmt).where("SPIKE_THRESHOLD_CNT is not null")


def distinct_patients(spark: SparkSession, paths: PartialPaths, days: int, fmt: str = "parquet") -> DataFrame:
    """Per date with patients: how many there are on it, in the ``days`` days that end with it, and up to it.

    Sets are united, so a patient counts once. A bitmap of a bucket of 32,768 numbers has 4 KB. A bucket is
    looked at on the dates on which it has members and on those on which they leave the days looked at; how
    much its counts change then is added up along the dates, a row each.
    """
    members = _stored(spark, paths.members, MEMBERS, fmt).where("bucket is not null")
    on_dates = members.select("event_date", "bucket", "members", F.lit(True).alias("own"))
    leaving = on_dates.select(F.date_add("event_date", days).alias("event_date"), "bucket", F.lit(bytes(4096)).alias("members"), F.lit(False).alias("own"))
    events = on_dates.union(leaving).groupBy("event_date", "bucket").agg(F.bitmap_or_agg("members").alias("members"), F.bool_or("own").alias("own"))
    in_order = Window.partitionBy("bucket").orderBy(F.unix_date("event_date"))
    counted = events.select(
        "event_date",
        "bucket",
        "own",
        F.bitmap_count("members").alias("on_day"),
        F.bitmap_count(F.bitmap_or_agg("members").over(in_order.rangeBetween(1 - days, 0))).alias("lately"),
        F.bitmap_count(F.bitmap_or_agg("members").over(in_order.rangeBetween(Window.unboundedPreceding, 0))).alias("so_far"),
    )
    changes = counted.select("event_date", "own", "on_day", *[(F.col(c) - F.coalesce(F.lag(c).over(in_order), F.lit(0))).alias(c) for c in ("lately", "so_far")])
    by_date = changes.groupBy("event_date").agg(F.bool_or("own").alias("own"), *[F.sum(c).alias(c) for c in ("on_day", "lately", "so_far")])
    along = Window.orderBy("event_date").rowsBetween(Window.unboundedPreceding, 0)
    added = by_date.select("event_date", "own", "on_day", *[F.sum(c).over(along).alias(c) for c in ("lately", "so_far")])
    return added.where("own").drop("own")
