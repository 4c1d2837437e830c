"""Grid interval joins against brute force, and the reports built on them."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wavelane import MonitorParams
from wavelane.operators.intervals import broadcast_if_small, overlap_join, slice_around
from wavelane.plans.detection import detected_seizures, detection_report, false_positives
from wavelane.plans.marts import patient_summary, seizure_detection_rate

T0 = dt.datetime(2024, 1, 1)
CELL = 60


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def alerts_frame(spark, rows):
    return spark.createDataFrame(
        [(p, n, at(a), at(b)) for n, (p, a, b) in enumerate(rows)],
        "patient_id string, n int, window_start timestamp, window_end timestamp",
    )


def labels_frame(spark, rows):
    return spark.createDataFrame(
        [(p, f"f{n}", at(a), at(b)) for n, (p, a, b) in enumerate(rows)],
        "patient_id string, recording_file string, seizure_start_ms timestamp, "
        "seizure_end_ms timestamp",
    )


def join(left, right, how="inner", **options):
    spans = ("window_start", "window_end"), ("seizure_start_ms", "seizure_end_ms")
    return overlap_join(left, right, *spans, cell_seconds=CELL, how=how, **options)


def check_against_brute_force(spark, alerts, labels):
    pairs = sorted(
        (n, f"f{m}")
        for n, (p, a, b) in enumerate(alerts)
        for m, (q, c, d) in enumerate(labels)
        if p == q and a < d and b > c
    )
    left, right = alerts_frame(spark, alerts), labels_frame(spark, labels)
    got = sorted((r.n, r.recording_file) for r in join(left, right).collect())
    assert got == pairs
    hit = {n for n, _ in pairs}
    assert sorted(r.n for r in join(left, right, "left_semi").collect()) == sorted(hit)
    missed = sorted(set(range(len(alerts))) - hit)
    assert sorted(r.n for r in join(left, right, "left_anti").collect()) == missed


def random_spans(seed, count, patients=("a", "b")):
    """Spans of very different lengths, most of them with patient a, some inverted or empty."""
    rng = random.Random(seed)
    spans = []
    for _ in range(count):
        start = rng.randrange(-100_000, 20_000_000)
        length = rng.choice([0, 1, 5, 59, 60, 61, 3_000, 5_000, 300_000, 18_000_000, -30])
        spans.append((rng.choice((*patients, "a")), start, start + length))
    return spans


@pytest.mark.parametrize("seed", range(3))
def test_join_equals_brute_force(spark, seed):
    check_against_brute_force(spark, random_spans(seed, 120), random_spans(seed + 100, 60))


span = st.tuples(
    st.sampled_from("ab"), st.integers(-300, 300), st.sampled_from([0, 1, 5, 59, 60, 61, 4000])
).map(lambda s: (s[0], s[1], s[1] + s[2]))


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(alerts=st.lists(span, min_size=1, max_size=12), labels=st.lists(span, min_size=1, max_size=12))
def test_join_equals_brute_force_near_cell_borders(spark, alerts, labels):
    check_against_brute_force(spark, alerts, labels)


def test_a_side_is_broadcast_only_when_measured_small(spark):
    left = alerts_frame(spark, [("a", 0, 5)])
    right = labels_frame(spark, random_spans(1, 30))

    def plan(size):
        joined = join(left, right, broadcast_bytes=size)
        return joined._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan(1 << 30)
    assert "BroadcastHashJoin" not in plan(1000)
    assert "SortMergeJoin" in plan(1000)
    assert join(left, right, broadcast_bytes=1000).count() == join(left, right).count()


def test_touching_intervals_do_not_overlap(spark):
    check_against_brute_force(spark, [("a", 0, 5), ("a", 5, 10)], [("a", 5, 7), ("b", 0, 5)])


def test_null_bounds_match_nothing_and_stay_unmatched(spark):
    left = spark.createDataFrame(
        [("a", 0, None, at(5)), (None, 1, at(0), at(5)), ("a", 2, at(0), None)],
        "patient_id string, n int, window_start timestamp, window_end timestamp",
    )
    right = labels_frame(spark, [("a", 0, 100)])
    assert join(left, right).count() == 0
    assert join(left, right, "left_anti").count() == 3


def test_slice_keeps_thirty_seconds_around_an_interval(spark):
    times = [69.999, 70, 100, 150, 169.999, 170]
    readings = spark.createDataFrame(
        [("a", at(t), float(t)) for t in times], "patient_id string, event_time timestamp, t double"
    )
    labels = labels_frame(spark, [("a", 100, 140), ("b", 0, 1000)])
    for size in (None, 100_000):
        got = slice_around(
            readings, labels, ("seizure_start_ms", "seizure_end_ms"), 30, CELL, broadcast_bytes=size
        )
        assert sorted(r.t for r in got.collect()) == [70, 100, 150, 169.999]
        assert got.columns == [
            "patient_id",
            "event_time",
            "t",
            "recording_file",
            "seizure_start_ms",
            "seizure_end_ms",
        ]


PARAMS = MonitorParams(cell_seconds=CELL)


def test_detection_report_counts_intervals(spark):
    alerts = alerts_frame(spark, [("a", 0, 5), ("a", 5, 10), ("a", 500, 505), ("b", 0, 5)])
    labels = labels_frame(spark, [("a", 3, 8), ("a", 4, 6), ("a", 900, 950), ("c", 0, 10)])
    report = detection_report(alerts, labels, PARAMS).first().asDict()
    assert report == {
        "detected": 2,
        "total_seizures": 4,
        "false_positives": 2,
        "total_alerts": 4,
        "detection_rate": 50.0,
        "false_positive_rate": 50.0,
    }
    assert detected_seizures(alerts, labels, PARAMS).count() == 2
    assert {r.n for r in false_positives(alerts, labels, PARAMS).collect()} == {2, 3}


def test_detection_report_of_nothing_has_null_rates(spark):
    report = detection_report(
        alerts_frame(spark, []), labels_frame(spark, []), PARAMS
    ).first()
    assert (report.detected, report.total_alerts) == (0, 0)
    assert report.detection_rate is None and report.false_positive_rate is None


def test_detection_mart_has_a_row_per_patient_with_a_hit(spark):
    alerts = alerts_frame(spark, [("a", 0, 5), ("a", 500, 505), ("a", 600, 605), ("b", 0, 5), ("d", 0, 5)])
    labels = labels_frame(spark, [("a", 3, 8), ("a", 4, 6), ("b", 900, 950), ("d", 1, 2)])
    rows = sorted(map(tuple, seizure_detection_rate(alerts, labels, PARAMS).collect()))
    assert rows == [(1, 4, "25.0%", 0), (1, 4, "25.0%", 2)]


def test_patient_without_alerts_is_in_the_summary(spark):
    features = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "patient_id string")
    alerts = spark.createDataFrame([("a", "high_variance")], "patient_id string, alert_reason string")
    rows = sorted(map(tuple, patient_summary(features, alerts).collect()))
    assert rows == [("a", 3, 1, "33.33%"), ("b", 1, None, "0.0%")]


def test_endless_labels_and_rows_of_years_meet(spark):
    at = dt.datetime
    left = spark.createDataFrame(
        [("a", 1, at(2024, 1, 1), at(2024, 1, 1, 0, 0, 5)), ("a", 2, at(2001, 1, 1), at(2023, 1, 1)), ("a", 3, None, at(2024, 1, 1)), ("a", 4, at(1999, 1, 1), at(1999, 1, 2))],
        "patient_id string, n int, start timestamp, end timestamp",
    )
    right = spark.createDataFrame([("a", 7, at(2000, 1, 1), at(9999, 1, 1)), ("a", 8, None, None)], "patient_id string, m int, from timestamp, to timestamp")
    joined = overlap_join(left, right, ("start", "end"), ("from", "to"), 300)
    assert sorted((r.n, r.m) for r in joined.collect()) == [(1, 7), (2, 7)]
    missed = overlap_join(left, right, ("start", "end"), ("from", "to"), 300, "left_anti")
    assert sorted(r.n for r in missed.collect()) == [3, 4]


def test_arrays_count_in_the_measured_size(spark):
    wide = spark.range(4).selectExpr("id", "transform(sequence(1, 10000), x -> cast(x as double)) as many")
    assert "broadcast" not in broadcast_if_small(wide, 100_000)._jdf.queryExecution().toString()
