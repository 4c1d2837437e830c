"""Feature checks and mart constraints: each trips on its own kind of bad row."""

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from wavelane import MonitorParams
from wavelane.operators.features import FEATURE_SCHEMA
from wavelane.operators.quality import enforce, feature_spans, observed_counts, quality_report, quality_report_of, schema_mismatches
from wavelane.params import EXPECTED_CHANNELS
from wavelane.plans.constraints import (
    mart_constraints,
    rates_out_of_range,
    repeated_keys,
    unexpected_reasons,
)

T0 = dt.datetime(2024, 1, 1)
PARAMS = MonitorParams(block_seconds=60)


def feature(channel, second, **changes):
    row = {
        "patient_id": "chb01",
        "channel": channel,
        "window_start": T0 + dt.timedelta(seconds=second),
        "window_end": T0 + dt.timedelta(seconds=second + 5),
        "mean_v": 0.0,
        "stddev_v": 1e-6,
        "min_v": -1e-5,
        "max_v": 1e-5,
        "spike_count": 3,
        "event_date": T0.date(),
    }
    return row | changes


GOOD = [feature(c, s) for c in EXPECTED_CHANNELS for s in range(0, 200, 5)]


def failures(spark, rows):
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], FEATURE_SCHEMA)
    report = quality_report(frame, PARAMS).collect()
    assert len(report) == 15
    # The same figures, row checks counted while the spans are made.
    seen = Observation()
    spans = feature_spans(frame, PARAMS, seen).persist()
    assert (spans.agg(F.sum("n")).first()[0] or 0) == len(rows)
    assert observed_counts(seen, ["rows"]) == {"rows": len(rows)}
    observed = quality_report_of(spans, seen, len(schema_mismatches(frame)), PARAMS).collect()
    assert sorted(observed) == sorted(report)
    spans.unpersist()
    assert all(r.passed == (r.violations == (r.check == "distinct_duration_check")) for r in report)
    return {r.check: r.violations for r in report if not r.passed}


def test_good_features_pass(spark):
    assert failures(spark, GOOD) == {}
    frame = spark.createDataFrame([tuple(r.values()) for r in GOOD], FEATURE_SCHEMA)
    enforce(quality_report(frame, PARAMS))


CASES = {
    "null_check": {"max_v": None},
    "channel_check": {"channel": "X1"},
    "v_range_check": {"max_v": 501.0},
    "v_order_check": {"mean_v": 1e-4},
    "stddev_check": {"stddev_v": 3e-5},
    "spike_stddev_check": {"spike_count": -1},
    "spike_count_check": {"spike_count": 5 * 256 + 1},
    "event_date_check": {"event_date": dt.date(2023, 1, 1)},
    "patient_id_format_check": {"patient_id": "chb001"},
}


@pytest.mark.parametrize("check", CASES)
def test_each_row_check_trips_alone(spark, check):
    found = failures(spark, [*GOOD[:-1], GOOD[-1] | CASES[check]])
    assert found[check] == 1
    unrelated = {"gap_check"} if check in ("channel_check", "patient_id_format_check") else set()
    assert set(found) - unrelated == {check}


def test_limits_themselves_pass(spark):
    edge = {"max_v": 500.0, "min_v": -500.0, "spike_count": 5 * 256}
    assert failures(spark, [*GOOD[:-1], GOOD[-1] | edge]) == {}


def test_null_predicates_are_no_violations(spark):
    found = failures(spark, [*GOOD[:-1], GOOD[-1] | {"stddev_v": None}])
    assert found == {"null_check": 1}


def test_window_checks(spark):
    reversed_window = GOOD[-1] | {"window_end": T0}
    found = failures(spark, [*GOOD[:-1], reversed_window])
    assert found["window_time_check"] == 1 and found["distinct_duration_check"] == 2
    duplicated = failures(spark, [*GOOD, GOOD[0]])
    assert duplicated["duplicate_check"] == 1 and duplicated["window_start_count"] == 1
    missing = failures(spark, [r for r in GOOD if r["window_start"] != T0 + dt.timedelta(seconds=60)])
    assert missing == {"gap_check": 23}


def test_empty_features_fail_on_durations(spark):
    assert failures(spark, []) == {"distinct_duration_check": 0}


def test_bad_row_stops_the_run(spark):
    bad = feature(
        "FP1-F7", 0, patient_id="chb1234", mean_v=999.0, min_v=999.0, max_v=999.0, stddev_v=0.0,
        spike_count=0, event_date=dt.date(2023, 1, 1),
    )
    found = failures(spark, [*GOOD, bad])
    assert {"v_range_check", "event_date_check", "patient_id_format_check"} <= set(found)
    frame = spark.createDataFrame([tuple(bad.values())], FEATURE_SCHEMA)
    with pytest.raises(ValueError, match="v_range_check: 1"):
        enforce(quality_report(frame, PARAMS))


def test_schema_check_names_columns(spark):
    frame = spark.createDataFrame([], FEATURE_SCHEMA).selectExpr("* except (mean_v)", "1 as extra")
    assert schema_mismatches(frame) == ["mean_v: expected double, got nothing"]
    cast = spark.createDataFrame([], FEATURE_SCHEMA).selectExpr("* except (mean_v)", "1 as mean_v")
    assert schema_mismatches(cast) == ["mean_v: expected double, got integer"]


def test_mart_constraints(spark):
    alerts = spark.createDataFrame([("spike_threshold",), ("other",), (None,)], "alert_reason string")
    summary = spark.createDataFrame(
        [("a", 3, 1, "33.33%"), ("a", 1, None, "0.0%")],
        "PATIENT_ID string, TOT_WINDOWS_PROCESSED bigint, TOT_ALERTS_FIRED bigint, ALERT_RATE string",
    )
    daily = spark.createDataFrame(
        [("a", "x", T0.date()), ("a", "x", T0.date()), ("a", "y", T0.date())],
        "PATIENT_ID string, CHANNEL string, ALERT_DATE date",
    )
    detection = spark.createDataFrame(
        [(1, 7, "14.29%", 3), (1, 7, "100.01%", 3), (1, 7, "-1%", None), (1, 7, "?", 0)],
        "DETECTED bigint, TOT_SEIZURES bigint, DETECTION_RATE string, FP_COUNT bigint",
    )
    report = {r.check: r.violations for r in mart_constraints(alerts, summary, daily, detection).collect()}
    assert len(report) == 15
    assert {k: v for k, v in report.items() if v} == {
        "not_null_patient_summary_tot_alerts_fired": 1,
        "not_null_seizure_detection_rate_fp_count": 1,
        "unique_patient_id": 1,
        "accepted_alert_reason": 1,
        "unique_alerts_daily": 1,
        "detection_rate_between_0_and_100": 2,
    }
    assert unexpected_reasons(alerts).count() == 1
    assert rates_out_of_range(detection).count() == 2
    assert repeated_keys(daily, ["PATIENT_ID", "CHANNEL", "ALERT_DATE"]).first().cnt == 2
