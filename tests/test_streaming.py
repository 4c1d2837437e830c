"""The live monitor: equality with batch, late rows, replay, restart, and the daily run behind it."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from wavelane import MonitorParams
from wavelane.plans.daily import TablePaths, run_daily
from wavelane.session import ROCKSDB_PROVIDER
from wavelane.sources.messages import file_messages
from wavelane.streaming.monitor import (
    FanOut,
    late_rows_dropped,
    live_features,
    read_output,
    start_monitor,
)

T0 = 1_704_067_200_000
PARAMS = MonitorParams(channels=("A", "B"), rows_per_window=2, cell_seconds=60)


class Feed:
    """A folder that message files land in, and a monitor on it."""

    def __init__(self, spark, folder, **options):
        self.spark, self.folder, self.options = spark, folder, options
        self.features, self.alerts = f"{folder}/features", f"{folder}/alerts"
        self.files = 0

    def land(self, *messages):
        """messages: (seconds, voltage of A, voltage of B)."""
        lines = [
            json.dumps(
                {
                    "patient_id": "chb01",
                    "timestamp_ms": T0 + int(1000 * second),
                    "sample_index": n,
                    "channels": {"A": a, "B": b},
                }
            )
            for n, (second, a, b) in enumerate(messages)
        ]
        inbox = self.folder / "in"
        inbox.mkdir(exist_ok=True)
        file = inbox / f"{self.files:03}.txt"
        file.write_text("\n".join(lines))
        os.utime(file, (1_700_000_000 + self.files,) * 2)  # files are taken in order of time
        self.files += 1

    def run(self):
        stream = file_messages(
            self.spark, f"{self.folder}/in", "text", "value string", maxFilesPerTrigger="1"
        )
        query = start_monitor(
            stream,
            self.features,
            self.alerts,
            f"{self.folder}/state",
            PARAMS,
            state_partitions=2,
            drain=True,
            **self.options,
        )
        query.awaitTermination()
        return query

    def batch(self):
        stored = self.spark.read.text(f"{self.folder}/in")
        return live_features(stored, PARAMS)

    def rows(self, path):
        names = [c for c in self.batch().columns if c != "alert_reason" or path == self.alerts]
        table = read_output(self.spark, path, columns=names)
        return sorted(map(tuple, table.collect()), key=str)


QUIET, LOUD = 1e-6, 1e-3


def seconds(*span):
    return [(s / 4, QUIET * (-1) ** s, LOUD * (-1) ** s) for s in range(*[4 * x for x in span])]


@pytest.mark.parametrize("provider", [None, ROCKSDB_PROVIDER])
def test_stream_equals_batch_on_closed_windows(spark, tmp_path, provider):
    feed = Feed(spark, tmp_path, provider=provider)
    feed.land(*seconds(0, 7))
    feed.land(*seconds(7, 14))
    feed.land(*seconds(14, 24))
    feed.run()
    last = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=23.75 - 3)
    closed = feed.batch().where(F.col("window_end") <= F.lit(last))
    assert closed.count() == 8
    want = sorted(map(tuple, closed.drop("alert_reason").collect()), key=str)
    assert feed.rows(feed.features) == want
    alerts = sorted(map(tuple, closed.where("alert_reason is not null").collect()), key=str)
    assert feed.rows(feed.alerts) == alerts and len(alerts) == 4


def test_late_rows_count_until_their_window_closes(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.land((1, 1.0, 1.0), (7, 1.0, 1.0))
    feed.land((2, 1.0, 1.0), (20, 1.0, 1.0))  # watermark 4 s: window 0-5 is still open
    feed.land((3, 1.0, 1.0), (30, 1.0, 1.0))  # watermark 17 s: window 0-5 closes with this batch
    feed.land((4, 1.0, 1.0), (40, 1.0, 1.0))  # window 0-5 has closed
    query = feed.run()
    assert late_rows_dropped(query) == 2  # one message, two channels
    counts = {
        (r.window_start.second, r.channel): r.spike_count
        for r in read_output(spark, feed.features).collect()
    }
    assert counts[0, "A"] == counts[0, "B"] == 3


def test_restart_goes_on_without_duplicates(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.land(*seconds(0, 12))
    feed.run()
    before = feed.rows(feed.features)
    feed.land(*seconds(12, 30))
    feed.run()
    after = feed.rows(feed.features)
    assert set(before) < set(after)
    keys = [(r[1], r[2]) for r in after]
    assert len(keys) == len(set(keys)) == 10
    feed.run()
    assert feed.rows(feed.features) == after


def test_replayed_batch_replaces_its_own_rows(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.land(*seconds(0, 10))
    write = FanOut(feed.features, feed.alerts, feed="test")
    write(feed.batch(), 7)
    once = feed.rows(feed.features), feed.rows(feed.alerts)
    write(feed.batch(), 7)
    assert (feed.rows(feed.features), feed.rows(feed.alerts)) == once
    write(feed.batch(), 8)
    assert len(feed.rows(feed.features)) == 2 * len(once[0])


def annotations(spark):
    start = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [("chb01", "r", start, start + dt.timedelta(seconds=5)), ("chb02", "q", start, start)],
        "patient_id string, recording_file string, seizure_start_ms timestamp, seizure_end_ms timestamp",
    )


def test_daily_run(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.land(*seconds(0, 30))
    feed.run()
    paths = TablePaths(feed.features, feed.alerts, f"{tmp_path}/labels", f"{tmp_path}/marts")
    results = run_daily(spark, paths, annotations(spark), PARAMS)
    report = results["detection_report"].first()
    assert (report.detected, report.total_seizures, report.total_alerts) == (1, 2, 5)
    assert report.false_positives == 4 and report.detection_rate == 50.0
    assert results["quality_report"].where("not passed").count() == 0
    assert tuple(results["patient_summary"].first()) == ("chb01", 10, 5, "50.0%")
    assert tuple(results["seizure_detection_rate"].first()) == (1, 2, "50.0%", 4)
    assert results["alerts_daily"].first().SPIKE_THRESHOLD_CNT == 5
    assert results["mart_constraints"].where("not passed").count() == 0


def test_daily_run_stops_before_the_marts_on_bad_features(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.land(*seconds(0, 10), *seconds(15, 30))
    feed.run()
    paths = TablePaths(feed.features, feed.alerts, f"{tmp_path}/labels", f"{tmp_path}/marts")
    with pytest.raises(ValueError, match="gap_check: 2"):
        run_daily(spark, paths, annotations(spark), PARAMS)
    assert not (tmp_path / "marts" / "patient_summary").exists()


def test_daily_run_without_labels_and_its_figures(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.land(*seconds(0, 30))
    feed.run()
    paths = TablePaths(feed.features, feed.alerts, f"{tmp_path}/labels", f"{tmp_path}/marts")
    results = run_daily(spark, paths, annotations(spark).limit(0), PARAMS)
    figures = {(r.step, r.metric): r.value for r in results["daily_run"].collect()}
    assert figures["annotations", "rows"] == figures["detection_report", "total_seizures"] == 0
    assert figures["features", "rows"] == 10 and figures["detection_report", "total_alerts"] == 5
    assert figures["detection_report", "detection_rate"] is None and figures["detection_report", "false_positive_rate"] == 100.0
    assert figures["seizure_detection_rate", "rows"] == 0 and figures["patient_summary", "rows"] == 1
    assert figures["quality_report", "distinct_duration_check"] == 1
