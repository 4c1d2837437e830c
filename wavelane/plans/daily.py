"""The daily run: match alerts, validate features, build marts, check marts.

Features and alerts are each scanned once, into a narrow stored table of what the steps count by. How many rows
there are and how many break a row check is observed in that pass, and the size of each result as it is written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wavelane.operators.quality import enforce, feature_spans, observed_counts, quality_report_of, schema_mismatches
from wavelane.params import MonitorParams
from wavelane.plans.constraints import mart_constraints
from wavelane.plans.detection import alert_spans, marked_spans, report_on
from wavelane.plans.marts import alerts_daily, detection_rate_of, patient_summary
from wavelane.session import shared_dir
from wavelane.sinks.tables import replace_table
from wavelane.sources.tables import read_table
from wavelane.streaming.monitor import read_output


@dataclass(frozen=True)
class TablePaths:
    """Where the day's tables are, and where its results go."""

    features: str
    alerts: str
    annotations: str
    marts: str


def run_daily(
    spark: SparkSession,
    paths: TablePaths,
    annotations: DataFrame,
    params: MonitorParams,
    fmt: str = "parquet",
    strict: bool = True,
) -> dict[str, DataFrame]:
    """Run the steps in order and return the written reports and marts by name, and ``daily_run``: every
    step's figures as rows (step, metric, value).

    ``annotations`` replaces the stored annotation table. A failed feature validation raises before any
    mart is written, unless ``strict`` is off; failed mart constraints are in the returned report.
    """
    sizes: list[tuple[str, str, float]] = []
    results: dict[str, DataFrame] = {}

    def written(step: str, df: DataFrame, target: str, kind: str = fmt) -> DataFrame:
        seen = Observation()
        replace_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), target, kind)
        sizes.append((step, "rows", float(observed_counts(seen, ["rows"])["rows"])))
        return read_table(spark, target, kind)

    def result(name: str, df: DataFrame) -> DataFrame:
        results[name] = written(name, df, f"{paths.marts}/{name}")
        return results[name]

    labels = written("annotations", annotations, paths.annotations)
    features, alerts = (read_output(spark, path, fmt) for path in (paths.features, paths.alerts))
    seen = Observation()
    spans = written("feature_spans", feature_spans(features, params, seen), shared_dir(spark, "spans"), "parquet")
    keys = ["patient_id", "channel", "event_date", "window_start", "window_end", "alert_reason"]
    raised = written("alert_spans", alerts.groupBy(*keys).agg(F.count("*").alias("n")), shared_dir(spark, "spans"), "parquet")
    marked = written("marked_spans", marked_spans(alert_spans(raised, "n"), labels, params), shared_dir(spark, "spans"), "parquet")
    sizes.append(("features", "rows", float(observed_counts(seen, ["rows"])["rows"])))

    report = result("detection_report", report_on(marked, labels, params))
    quality = result("quality_report", quality_report_of(spans, seen, len(schema_mismatches(features)), params))
    if strict:
        enforce(quality)
    summary = result("patient_summary", patient_summary(spans, raised, "n"))
    daily = result("alerts_daily", alerts_daily(raised, "n"))
    rates = result("seizure_detection_rate", detection_rate_of(marked, labels))
    broken = result("mart_constraints", mart_constraints(alerts, summary, daily, rates))

    def figures(step: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(step).alias("step"), "metric", F.col("value").cast("double"))

    counts = [c for c in report.columns]
    unpivoted = report.select(*[F.col(c).cast("double") for c in counts]).unpivot([], counts, "metric", "value")
    checks = {"quality_report": quality, "mart_constraints": broken}
    rows = spark.createDataFrame(sizes, "step string, metric string, value double").union(figures("detection_report", unpivoted))
    for step, df in checks.items():
        rows = rows.union(figures(step, df.withColumnsRenamed({"check": "metric", "violations": "value"})))
    results["daily_run"] = rows
    return results
