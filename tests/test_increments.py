"""Partial aggregates by day: loads in any order and number equal a build over everything."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wavelane.plans import increments, marts

ROW = "patient_id string, channel string, alert_reason string, event_date date"
FIRST = dt.date(2024, 1, 1)


def day(n):
    return FIRST + dt.timedelta(days=n)


@pytest.fixture
def paths(tmp_path):
    return increments.PartialPaths(*(f"{tmp_path}/{name}" for name in ("totals", "reasons", "members")))


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


def table(spark, rows):
    return spark.createDataFrame(rows, ROW)


def number():
    return F.substring("patient_id", 2, 20).try_cast("long")


def test_loads_equal_a_whole_build_and_removed_days_go(spark, paths):
    rng = random.Random(5)
    rows = [(f"p{rng.choice([1, 2, 3, 40_000, 70_000])}", rng.choice("AB"), rng.choice([None, "spike_threshold", "high_variance"]), day(rng.randrange(12))) for _ in range(400)]
    rows += [(None, "A", "high_variance", day(3)), ("p9", "A", None, day(4)), ("x", "A", None, day(4))]
    stored = []
    for load in (rows[:100], rows[100:250], rows[250:]):
        stored += load
        now = table(spark, stored)
        increments.refresh(spark, now, now.where("alert_reason is not null"), [r[3] for r in load], paths, number())
    # A day's rows are all deleted, on another day a patient's alerts.
    left = [r for r in stored if r[3] != day(7) and not (r[3] == day(2) and r[0] == "p1")]
    now = table(spark, left)
    increments.refresh(spark, now, now.where("alert_reason is not null"), [day(7), day(2)], paths, number())
    alerts = now.where("alert_reason is not null")
    assert rows_of(increments.patient_summary(spark, paths)) == rows_of(marts.patient_summary(now, alerts))
    daily = marts.alerts_daily(alerts)
    assert rows_of(increments.daily_alerts(spark, paths).select(*daily.columns)) == rows_of(daily)
    for days in (1, 3, 30):
        found = {r.event_date: (r.on_day, r.lately, r.so_far) for r in increments.distinct_patients(spark, paths, days).collect()}
        known = [(r[0], r[3]) for r in left if r[0] and r[0] != "x"]
        for d in {d for _, d in known}:
            want = (
                len({p for p, e in known if e == d}),
                len({p for p, e in known if d - dt.timedelta(days=days) < e <= d}),
                len({p for p, e in known if e <= d}),
            )
            assert found.pop(d) == want
        assert not found


def test_other_days_are_not_touched(spark, paths, tmp_path):
    now = table(spark, [("p1", "A", None, day(0)), ("p2", "A", None, day(1))])
    increments.refresh(spark, now, now.limit(0), [day(0), day(1)], paths)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "totals" / "event_date=2024-01-01").iterdir()}
    increments.refresh(spark, now, now.limit(0), [day(1)], paths)
    assert before == {f: f.stat().st_mtime_ns for f in (tmp_path / "totals" / "event_date=2024-01-01").iterdir()}
    increments.refresh(spark, now, now, [], paths)
    assert increments.daily_alerts(spark, paths).count() == 0
    assert rows_of(increments.patient_summary(spark, paths)) == rows_of(marts.patient_summary(now, now.limit(0)))
