"""Quality checks of the feature table as rows ``(check, violations, passed)``.

A null predicate is no violation. All row-level checks are one aggregate over one scan.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wavelane.operators.features import FEATURE_SCHEMA
from wavelane.operators.series import find_gaps
from wavelane.params import MonitorParams

# The duration check passes on exactly one distinct value; every other check passes on none.
DURATION_CHECK = "distinct_duration_check"


def schema_mismatches(features: DataFrame) -> list[str]:
    """Missing or differently typed feature columns; extra columns and nullability do not matter."""
    found = {field.name: field.dataType.typeName() for field in features.schema}
    return [
        f"{field.name}: expected {field.dataType.typeName()}, got {found.get(field.name, 'nothing')}"
        for field in FEATURE_SCHEMA
        if found.get(field.name) != field.dataType.typeName()
    ]


def row_predicates(params: MonitorParams) -> dict[str, Column]:
    """What is wrong with a single row, by check."""
    c = F.col
    any_null = reduce(or_, [c(field.name).isNull() for field in FEATURE_SCHEMA])
    out_of_range = [F.abs(name) > params.volts_limit for name in ("min_v", "mean_v", "max_v")]
    return {
        "null_check": any_null,
        "channel_check": ~c("channel").isin(*params.channels),
        "v_range_check": out_of_range[0] | out_of_range[1] | out_of_range[2],
        "v_order_check": ~c("mean_v").between(c("min_v"), c("max_v")),
        "stddev_check": c("stddev_v") > c("max_v") - c("min_v"),
        "spike_stddev_check": F.least("spike_count", "stddev_v") < 0,
        "spike_count_check": c("spike_count") > params.sampling_rate * _seconds(),
        "window_time_check": c("window_end") <= c("window_start"),
        "event_date_check": c("event_date") != F.to_date("window_start"),
        "patient_id_format_check": ~c("patient_id").rlike(params.patient_pattern),
    }


def _seconds() -> Column:
    start, end = (F.unix_seconds(F.col(name).cast("timestamp")) for name in ("window_start", "window_end"))
    return end - start


def row_checks(features: DataFrame, params: MonitorParams) -> DataFrame:
    """Checks that look at one row at a time, and the number of distinct durations."""
    wide = features.agg(
        *[F.count_if(predicate).alias(name) for name, predicate in row_predicates(params).items()],
        F.count_distinct(_seconds()).alias(DURATION_CHECK),
    )
    return _as_report(wide)


def group_checks(features: DataFrame, params: MonitorParams) -> DataFrame:
    """Rows per window and duplicated (patient, channel, window) groups, from one keyed count.

    Only counts travel on: the window-level count adds up the keyed counts.
    """
    return _group_checks(key_counts(features), params)


def _group_checks(keyed: DataFrame, params: MonitorParams) -> DataFrame:
    windows = keyed.groupBy(*params.channel_count_keys).agg(
        F.sum("n").alias("rows"), F.count_if(F.col("n") > 1).alias("repeated")
    )
    wide = windows.agg(
        F.count_if(F.col("rows") != params.rows_per_window).alias("window_start_count"),
        F.coalesce(F.sum("repeated"), F.lit(0)).alias("duplicate_check"),
    )
    return _as_report(wide)


def gap_check(features: DataFrame, params: MonitorParams) -> DataFrame:
    """Number of windows with a gap before them."""
    wide = find_gaps(features, params.block_seconds).agg(F.count("*").alias("gap_check"))
    return _as_report(wide)


def quality_report(features: DataFrame, params: MonitorParams) -> DataFrame:
    """All checks of the feature table, one row each."""
    mismatches = len(schema_mismatches(features))
    schema = features.sparkSession.range(1).select(
        F.lit(mismatches).cast("bigint").alias("schema_check")
    )
    return (
        _as_report(schema)
        .unionByName(row_checks(features, params))
        .unionByName(group_checks(features, params))
        .unionByName(gap_check(features, params))
    )


def observed_counts(seen: Observation, names: Iterable[str]) -> dict[str, int]:
    """What was counted, once an action has read the observed table. The optimiser takes a table that it knows
    to be empty out of the plan, and what observes it; then there is nothing to read, and all counts are 0."""
    try:
        found = seen.get
    except Py4JJavaError:
        found = {}
    return {name: found.get(name) or 0 for name in names}


SPAN = ("patient_id", "channel", "window_start", "window_end")


def feature_spans(features: DataFrame, params: MonitorParams, into: Observation) -> DataFrame:
    """Distinct spans of the feature table with their number of rows ``n``. Whatever action reads them also
    counts, in the same pass over the table, its rows and the row checks' violations (``into``)."""
    counts = [F.count_if(predicate).alias(name) for name, predicate in row_predicates(params).items()]
    watched = features.observe(into, F.count(F.lit(1)).alias("rows"), *counts)
    return watched.groupBy(*SPAN).agg(F.count("*").alias("n"))


def quality_report_of(spans: DataFrame, seen: Observation, mismatches: int, params: MonitorParams) -> DataFrame:
    """The report of ``quality_report`` from stored spans and what was counted as they were made."""
    spark = spans.sparkSession
    counts = {"schema_check": mismatches} | observed_counts(seen, row_predicates(params))
    counted = spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} long" for name in counts))
    # A repeated row follows on itself, so it has a gap before it unless its window is empty.
    again = F.coalesce(F.sum(F.when(F.col("window_start") != F.col("window_end"), F.col("n") - 1)), F.lit(0))
    rows = spans.agg(F.count_distinct(_seconds()).alias(DURATION_CHECK), again.alias("again"))
    gaps = find_gaps(spans, params.block_seconds).agg(F.count("*").alias("gaps"))
    wide = gaps.join(F.broadcast(rows)).select(DURATION_CHECK, (F.col("gaps") + F.col("again")).alias("gap_check"))  # a row each
    keyed = spans.groupBy("patient_id", "channel", "window_start").agg(F.sum("n").alias("n"))
    return _as_report(counted).unionByName(_as_report(wide)).unionByName(_group_checks(keyed, params))


def key_counts(features: DataFrame) -> DataFrame:
    """Rows per (patient, channel, window start)."""
    return features.groupBy("patient_id", "channel", "window_start").agg(F.count("*").alias("n"))


def duplicate_windows(features: DataFrame) -> DataFrame:
    """(patient, channel, window start) groups with more than one row."""
    return key_counts(features).where("n > 1")


def incomplete_windows(features: DataFrame, params: MonitorParams) -> DataFrame:
    """Windows whose number of rows is not the expected one."""
    counted = features.groupBy(*params.channel_count_keys).agg(F.count("*").alias("n"))
    return counted.where(F.col("n") != params.rows_per_window)


def enforce(report: DataFrame) -> None:
    """Raise ``ValueError`` naming the failed checks. The report has a fixed handful of rows."""
    failed = [f"{r.check}: {r.violations}" for r in report.where("not passed").collect()]
    if failed:
        raise ValueError(f"validation failed with {len(failed)} error(s): " + "; ".join(failed))


def _as_report(wide: DataFrame) -> DataFrame:
    """One row of counters to one row per counter."""
    allowed = F.when(F.col("check") == DURATION_CHECK, 1).otherwise(0)
    return wide.unpivot([], wide.columns, "check", "violations").withColumn(
        "passed", F.col("violations") == allowed
    )
