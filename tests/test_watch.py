"""The watch stream: what is on time and what is late is everything, windows, gaps and silence."""

import json
import os
import random
import statistics

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wavelane import MonitorParams
from wavelane.operators.features import window_features
from wavelane.operators.readings import parse_messages
from wavelane.operators.series import find_gaps
from wavelane.sources.messages import file_messages
from wavelane.streaming import watch
from wavelane.streaming.monitor import read_output
from wavelane.streaming.watch import WatchPaths, WindowWatch, read_gaps, read_late_rows, start_watch

T0 = 1_704_067_200_000
PARAMS = MonitorParams(spike_volts=5.0, spike_limit=1, variance_limit=100.0)


class Feed:
    def __init__(self, spark, folder, silence=0):
        self.spark, self.folder, self.silence, self.files = spark, folder, silence, 0
        self.paths = WatchPaths(*(f"{folder}/{name}" for name in ("features", "alerts", "late", "gaps")))
        (folder / "in").mkdir()

    def land(self, *messages):
        """messages: (patient, seconds, {channel: voltage})."""
        file = self.folder / "in" / f"{self.files:03}.txt"
        rows = [{"patient_id": p, "timestamp_ms": T0 + int(1000 * s), "sample_index": n, "channels": c} for n, (p, s, c) in enumerate(messages)]
        file.write_text("\n".join(map(json.dumps, rows)))
        os.utime(file, (1_700_000_000 + self.files,) * 2)  # files are taken in order of time
        self.files += 1

    def run(self):
        stream = file_messages(self.spark, f"{self.folder}/in", "text", "value string", maxFilesPerTrigger="1")
        query = start_watch(stream, self.paths, f"{self.folder}/state", PARAMS, self.silence, state_partitions=2, drain=True)
        query.awaitTermination()
        return self

    def table(self, name):
        readers = {"late": read_late_rows, "gaps": read_gaps}
        return readers[name](self.spark, self.paths) if name in readers else read_output(self.spark, getattr(self.paths, name))

    def readings(self):
        return parse_messages(self.spark.read.text(f"{self.folder}/in"))


@pytest.fixture(scope="module")
def fed(spark, tmp_path_factory):
    """Three files and a restart; the second and the third hold rows of windows closed by then."""
    feed = Feed(spark, tmp_path_factory.mktemp("watch"), silence=20)
    feed.land(*[("p1", s / 4, {"A": s % 7 - 3.0, "B": None if s % 9 == 0 else 6.0}) for s in range(60)])
    feed.land(("p1", 1.0, {"A": 100.0}), ("p1", 14.9, {"A": 2.0}), ("p2", 30.0, {"A": 1.0, "B": None}), ("p2", 3.0, {"A": 9.0}))
    feed.run()
    feed.land(("p1", 14.0, {"A": 7.0}), ("p1", 52.0, {"A": 1.5}), ("p1", 51.0, {"A": 2.5}), ("p1", 50.5, {"A": 8.0}))
    return feed.run()


def late_places(feed):
    return sorted((r.patient_id, r.channel, (r.timestamp_ms - T0) / 1000) for r in feed.table("late").collect())


def test_late_rows_are_kept_and_nothing_is_lost(fed):
    # After the first file the watermark is 14.75 - 3, after the second 30 - 3.
    assert late_places(fed) == [("p1", "A", 1.0), ("p1", "A", 14.0), ("p2", "A", 3.0)]
    late = fed.table("late").select("patient_id", "channel", "timestamp_ms", "sample_index", "voltage")
    on_time = fed.readings().select(*late.columns).exceptAll(late)
    windows = window_features(on_time.withColumn("event_time", F.timestamp_millis("timestamp_ms")), PARAMS)
    closed = windows.where(F.unix_millis("window_end") <= T0 + 49_000)
    names = closed.columns

    def rows(df):
        rounded = df.withColumns({n: F.round(n, 9) for n in ("mean_v", "stddev_v", "min_v", "max_v")})
        return sorted(map(str, map(tuple, rounded.select(*names).collect())))

    assert rows(fed.table("features")) == rows(closed)
    assert closed.count() == 8


def test_alerts_follow_the_windows(fed):
    got = {(r.patient_id, r.channel, r.spike_count, r.alert_reason) for r in fed.table("alerts").collect()}
    assert {c for _, c, _, _ in got} == {"B"} and {r for *_, r in got} == {"spike_threshold"}


def test_gaps_and_silence(fed):
    found = fed.table("gaps")
    gaps = sorted(map(tuple, found.where("kind = 'gap'").select("patient_id", "channel", "window_start", "prev_end").collect()))
    assert gaps == sorted(map(tuple, find_gaps(fed.table("features"), 3600).collect()))
    silent = {(r.patient_id, r.channel, int(r.prev_end.timestamp() * 1000 - T0) // 1000) for r in found.where("kind = 'silent'").collect()}
    # The first file ends with windows to 15, so p1's silence would be raised at 35, p2's at 55.
    assert silent == {("p1", "B", 15)}


def test_a_run_without_late_rows_writes_the_other_tables(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.land(("p1", 0.0, {"A": 1.0}), ("p1", 20.0, {"A": 1.0}))
    feed.land(("p1", 21.0, {"A": 1.0}))
    feed.run()
    assert [r.window_start is not None for r in feed.table("features").collect()] == [True]
    assert feed.table("late").count() == 0 and feed.table("gaps").count() == 0


def test_figures_merge():
    import pandas as pd

    watch = WindowWatch(5.0, 0)
    volts = [1.0, None, -6.5, 7.0, 2.25, None, 5.0, -5.0, 1e6]
    held = None
    for cut in ((0, 2), (2, 3), (3, 6), (5, 6), (6, 9)):
        held = watch._merged(held, pd.DataFrame({"voltage": volts[slice(*cut)], "start_ms": 7}).astype({"voltage": float}))
    known = [v for v in volts if v is not None]
    start, n, mean, m2, low, high, spikes = held
    assert (start, n, low, high, spikes) == (7, 7, -6.5, 1e6, 3)
    assert abs(mean - statistics.mean(known)) < 1e-6 and abs((m2 / (n - 1)) ** 0.5 - statistics.stdev(known)) < 1e-4


class Page:
    """State and timers of one page, as Spark would keep them, and a count of the calls."""

    def __init__(self, silence=0):
        self.watch, self.held, self.timers, self.calls, self.watermark = WindowWatch(50.0, silence), None, set(), 0, 0
        self.watch.init(self)

    def getValueState(self, *_):
        return self

    def get(self):
        self.calls += 1
        return self.held

    def update(self, value):
        self.calls += 1
        self.held = value

    def registerTimer(self, time):
        self.calls += 1
        self.timers.add(time)

    def deleteTimer(self, time):
        self.calls += 1
        self.timers.remove(time)

    def getCurrentWatermarkInMs(self):
        return self.watermark

    def batch(self, rows, watermark, cut=7):
        """rows: (patient, channel, end_ms, voltage) of windows of 10 ms; they come ``cut`` at a time."""
        self.watermark, frames = watermark, []
        columns = ["patient_id", "channel", "end_ms", "voltage", "start_ms", "event_us", "timestamp_ms", "sample_index"]
        given = [(*row, row[2] - 10, 1000 * row[2] - 1, row[2] - 1, n) for n, row in enumerate(rows)]
        parts = [pd.DataFrame(given[n : n + cut], columns=columns).astype({"voltage": float}) for n in range(0, len(given), cut)]
        if rows:
            frames += self.watch.handleInputRows((0,), iter(parts), self)
        for time in sorted(t for t in self.timers if t <= watermark):
            frames += self.watch.handleExpiredTimer((0,), self, None)
            self.timers.remove(time)
        return [row for frame in frames for row in frame.astype(object).where(frame.notna(), None).to_dict("records")]


def test_a_page_is_read_and_written_once_a_batch_however_many_windows_it_has():
    page = Page(silence=1000)
    rows = [(f"p{p}", "A", 10 + 10 * w, float(w)) for p in range(300) for w in range(6)]
    assert page.batch(rows, 0, cut=500) == []
    assert page.calls <= 4 and page.timers == {10}
    assert len(page.batch([], 40)) == 300 * 4
    assert page.calls <= 8 and page.timers == {50}


def test_late_rows_of_a_page_need_no_state():
    page = Page()
    rows = [(f"p{p}", None if p % 5 == 0 else "A", 10 * end, None if end == 3 else float(p)) for p in range(200) for end in range(1, 6)]
    late = page.batch(rows, 50, cut=500)
    assert page.calls == 0 and not page.timers
    assert [(r["kind"], r["patient_id"], r["channel"], r["end_ms"], r["voltage"]) for r in late] == [("late", *row) for row in rows]


def test_a_page_gives_what_each_series_alone_gives():
    """Rows of several series in random batches, against a list for each series."""
    rng = random.Random(5)
    names, silence = [("p1", "A"), ("p1", "B"), ("p2", "A"), (None, "A"), ("p1", None)], 70
    page, watermark, got, want = Page(silence), 0, [], []
    windows, closed, newest, told = {}, {}, {}, set()
    for batch in range(120):
        places = [(rng.choice(names), 10 * rng.randint(max(1, batch - 4), batch + 4)) for _ in range(rng.randint(0, 12)) if not 40 < batch < 60]
        rows = [(*series, end, rng.choice([None, 60.0, -70.5, rng.uniform(-40, 40)])) for series, end in places]
        got += page.batch(rows, watermark)
        for *series, end, volts in rows:
            series = tuple(series)
            if end <= watermark:
                want.append(("late", *series, end - 10, end, volts))
                continue
            windows.setdefault((end, *map(str, series)), (series, []))[1].append(volts)
            if end > newest.get(series, 0):
                newest[series] = end
                told.discard(series)
        for key in sorted(k for k in windows if k[0] <= watermark):
            series, volts = windows.pop(key)
            volts, start = [v for v in volts if v is not None], key[0] - 10
            mean, spread = (statistics.mean(volts) if volts else None), (statistics.stdev(volts) if len(volts) > 1 else None)
            spikes = sum(abs(v) > 50 for v in volts)
            want.append(("feature", *series, start, key[0], mean, spread, min(volts, default=None), max(volts, default=None), spikes))
            if closed.get(series, start) != start:
                want.append(("gap", *series, start, closed[series]))
            closed[series] = key[0]
        for series in newest:
            if newest[series] + silence <= watermark and series not in told:
                want.append(("silent", *series, newest[series]))
                told.add(series)
        watermark = max([watermark, *(end - 15 for _, end in places)]) + (10 if 40 < batch < 60 else 0)
        assert page.timers == ({min([k[0] for k in windows] + [newest[s] + silence for s in newest if s not in told])} if len(told) < len(newest) or windows else set())
    shown = {
        "late": ("start_ms", "end_ms", "voltage"),
        "feature": ("start_ms", "end_ms", "mean_v", "stddev_v", "min_v", "max_v", "spike_count"),
        "gap": ("start_ms", "prev_end_ms"),
        "silent": ("prev_end_ms",),
    }
    got = [(r["kind"], r["patient_id"], r["channel"], *(r[c] for c in shown[r["kind"]])) for r in got]

    def lines(rows):
        return sorted(str(tuple(round(v, 6) if isinstance(v, float) else v for v in row)) for row in rows)

    assert lines(got) == lines(want)
    assert {row[0] for row in want} == set(shown)


def test_series_may_share_a_page(spark, tmp_path, monkeypatch):
    """All series in one page: readings, windows, gaps and silences are those of many pages."""
    found = []
    for pages in (1, watch.PAGES):
        monkeypatch.setattr(watch, "PAGES", pages)
        folder = tmp_path / str(pages)
        folder.mkdir()
        feed = Feed(spark, folder, silence=15)
        feed.land(*[(p, s + n, {"A": s - 6.0, "B": None if s % 3 else 7.0}) for n, p in enumerate(("p1", "p2", "p3", None)) for s in range(0, 16, 2)])
        feed.land(("p1", 33.0, {"A": 1.0, "B": 2.0}), (None, 31.0, {"A": 3.0}), ("p2", 3.0, {"B": 9.0}))
        feed.run()
        feed.land(("p2", 4.0, {"A": 9.0}), ("p1", 60.0, {"A": 1.0}))
        feed.run()
        found.append({name: sorted(str(r.asDict()) for r in feed.table(name).drop("batch_id").collect()) for name in ("features", "alerts", "late", "gaps")})
        assert len(found[-1]["late"]) == 2
    assert found[0] == found[1]
    assert all(found[0].values())


def test_many_windows_take_few_timers_and_state_rows(spark, tmp_path):
    """40 series with 25 windows each: Spark counts a timer and a value for a page, not for a window."""
    feed = Feed(spark, tmp_path, silence=20)
    feed.land(*[(f"p{p}", 5.0 * w + 1, {"A": float(w)}) for p in range(40) for w in range(25)])
    stream = file_messages(spark, f"{tmp_path}/in", "text", "value string")
    query = start_watch(stream, feed.paths, f"{tmp_path}/state", PARAMS, 20, state_partitions=2, drain=True)
    query.awaitTermination()
    (first, *_) = [p["stateOperators"][0] for p in query.recentProgress if p["numInputRows"]]
    assert 0 < first["customMetrics"]["numRegisteredTimers"] <= 40
    assert 0 < first["numRowsUpdated"] <= 4 * 40
    assert feed.table("features").count() == 40 * 23
