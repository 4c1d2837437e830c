"""The live monitor that loses nothing: late rows are kept, gaps and silent series are reported.

``streaming.monitor`` lets Spark aggregate and drop what comes too late. Here a stateful operator of our own
holds the open windows of each series (patient and channel), closes them by event-time timers, and sends rows
whose window has closed to a table of their own: what is on time and what is late is all there is. It also
sees, as windows close in order, where one does not begin at the end of the one before, and which series have
had no rows for a given time.

A call from Python to the state takes some tenths of a millisecond, and a frame longer, so series are dealt by
hash to pages: a batch reads and writes the state of a page once, however many windows and series it has.

Spark filters late rows by the watermark column before a stateful operator gets them, so that column is null on
every reading. A second row for each reading carries the time past the watermark operator and goes no further;
it is neither shuffled nor seen by Python.
"""

from __future__ import annotations

import math
import pickle
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from wavelane.functions import micros
from wavelane.operators.features import alerts_only, label_alerts
from wavelane.operators.readings import parse_messages
from wavelane.params import MonitorParams
from wavelane.session import ROCKSDB_PROVIDER
from wavelane.sinks.tables import PARTITION_COLUMNS
from wavelane.streaming.monitor import FanOut, start_with

OUTPUT = (
    "kind string, patient_id string, channel string, start_ms long, end_ms long, mean_v double, stddev_v double, "
    "min_v double, max_v double, spike_count long, event_us long, timestamp_ms long, sample_index int, voltage double, "
    "prev_end_ms long"
)
NAMES = [column.split()[0] for column in OUTPUT.split(", ")]
INTEGERS = {column.split()[0] for column in OUTPUT.split(", ") if column.split()[1] in ("long", "int")}

# How many pages series are dealt to. Checkpoints hold pages, so it must not change between starts.
PAGES = 1024


class WindowWatch(StatefulProcessor):
    """The series of one page, by patient and channel. Each has the end of the last window that closed, the end of
    the latest with rows, whether its silence since then is told, and its open windows by their end: (start,
    non-null voltages, mean, squared deviations, extremes, spikes). ``silence_ms`` 0 raises no silence.

    A page is one value of plain types, pickled, and has one timer: for what is due first."""

    def __init__(self, spike_volts: float, silence_ms: int) -> None:
        self.spike_volts, self.silence_ms = spike_volts, silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.page = handle.getValueState("page", "series binary, due_ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        page, due = {}, None
        read = False
        for frame in rows:
            late = frame["end_ms"] <= watermark
            if late.any():
                yield self._frame(frame[late].assign(kind="late"))
            if late.all():
                continue
            if not read:
                page, due = self._read()
                read = True
            for series, end, start, figures in self._windows(frame[~late]):
                closed, newest, told, windows = page.get(series) or (None, end, False, {})
                windows[end] = self._joined(windows.get(end), start, figures)
                page[series] = (closed, max(newest, end), told and newest >= end, windows)
        if read:
            self._store(page, due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        page, _ = self._read()
        rows = []
        for series, (closed, newest, told, windows) in page.items():
            for end in sorted(end for end in windows if end <= watermark):
                start, n, mean, m2, low, high, spikes = windows.pop(end)
                spread = math.sqrt(m2 / (n - 1)) if n > 1 else None
                known = (mean, spread, low, high) if n else (None,) * 4
                rows.append(("feature", *series, start, end, *known, spikes, None))
                if closed is not None and closed != start:
                    rows.append(("gap", *series, start, *(None,) * 6, closed))
                closed = end
            if self.silence_ms and not told and newest + self.silence_ms <= watermark:
                rows.append(("silent", *series, *(None,) * 7, newest))
                told = True
            page[series] = (closed, newest, told, windows)
        self._store(page, None)  # Spark removes the timer that has expired
        if rows:
            yield self._frame(pd.DataFrame(rows, columns=[*NAMES[:10], NAMES[-1]]))

    def close(self) -> None: ...

    def _read(self) -> tuple[dict, int | None]:
        """The page's series and the time of its timer."""
        held = self.page.get()
        return (pickle.loads(held[0]), held[1]) if held else ({}, None)

    def _store(self, page: dict, due: int | None) -> None:
        """Keep the page, and move its timer from ``due`` to what is due first now."""
        ends = (end for _, _, _, windows in page.values() for end in windows)
        silences = (newest + self.silence_ms for _, newest, told, _ in page.values() if self.silence_ms and not told)
        first = min(chain(ends, silences), default=None)
        if first != due:
            if due is not None:
                self.handle.deleteTimer(due)
            if first is not None:
                self.handle.registerTimer(first)
        self.page.update((pickle.dumps(page), first))

    def _windows(self, rows: pd.DataFrame) -> Iterator[tuple]:
        """Series, end, start and figures of each window that has rows."""
        place = rows.groupby(["patient_id", "channel", "end_ms"], dropna=False, sort=False).ngroup().to_numpy()
        order = np.argsort(place, kind="stable")
        rows, firsts = rows.iloc[order], np.flatnonzero(np.diff(place[order], prepend=-1))
        heads = rows.iloc[firsts]
        series = zip(*([name if isinstance(name, str) else None for name in heads[c]] for c in ("patient_id", "channel")))
        times = (heads[c].astype("int64").tolist() for c in ("end_ms", "start_ms"))
        return zip(series, *times, self._figures(rows["voltage"], firsts))

    def _figures(self, voltage: pd.Series, firsts: np.ndarray) -> Iterator[tuple]:
        """Number, mean, squared deviations, extremes and spikes of each stretch of rows that begins at one of
        ``firsts``; a null voltage adds nothing."""
        volts = voltage.to_numpy("float64")
        known = ~np.isnan(volts)
        n = np.add.reduceat(known.astype("int64"), firsts)
        with np.errstate(invalid="ignore"):  # an infinite voltage has no deviation
            mean = np.add.reduceat(np.where(known, volts, 0), firsts) / np.maximum(n, 1)
            apart = np.where(known, volts - np.repeat(mean, np.diff(firsts, append=len(volts))), 0)
        m2 = np.add.reduceat(apart * apart, firsts)
        low = np.minimum.reduceat(np.where(known, volts, math.inf), firsts)
        high = np.maximum.reduceat(np.where(known, volts, -math.inf), firsts)
        spikes = np.add.reduceat((np.abs(volts) > self.spike_volts).astype("int64"), firsts)
        return zip(*(figure.tolist() for figure in (n, mean, m2, low, high, spikes)))

    def _joined(self, held: tuple | None, start: int, figures: tuple) -> tuple:
        """A window's figures with those of more rows."""
        more, its_mean, its_m2, its_low, its_high, its_spikes = figures
        if held is None:
            return start, *figures
        start, n, mean, m2, low, high, spikes = held
        if more:
            total, apart = n + more, its_mean - mean
            m2 += its_m2 + apart * apart * n * more / total
            mean += apart * more / total
            n, low, high = total, min(its_low, low), max(its_high, high)
        return start, n, mean, m2, low, high, spikes + its_spikes

    def _merged(self, held: tuple | None, part: pd.DataFrame) -> tuple:
        """A window's figures with more rows of it."""
        (figures,) = self._figures(part["voltage"], np.array([0]))
        return self._joined(held, int(part["start_ms"].iloc[0]), figures)

    def _frame(self, rows: pd.DataFrame) -> pd.DataFrame:
        return rows.reindex(columns=NAMES).astype({c: "Int64" if c in INTEGERS else "float64" for c in NAMES[3:]})


def watched(messages: DataFrame, params: MonitorParams, silence_seconds: int = 0) -> DataFrame:
    """Closed windows (kind ``feature``), late rows (``late``), windows that don't begin where the one before
    ended (``gap``) and series without rows for ``silence_seconds`` (``silent``) of a message stream."""
    window = F.window("event_time", params.window)
    readings = parse_messages(messages).select(
        F.pmod(F.xxhash64("patient_id", "channel"), F.lit(PAGES)).cast("int").alias("page"),
        "patient_id",
        "channel",
        "timestamp_ms",
        "sample_index",
        "voltage",
        "event_time",
        micros(F.col("event_time")).alias("event_us"),
        (micros(window.start) / 1000).cast("long").alias("start_ms"),
        (micros(window.end) / 1000).cast("long").alias("end_ms"),
        F.explode(F.array(F.lit(True), F.lit(False))).alias("is_clock"),
    )
    clocked = readings.withColumn("clock", F.when(F.col("is_clock"), F.col("event_time"))).drop("event_time", "is_clock")
    # The filter is on the watermark's column, so it stays behind the watermark.
    told = clocked.withWatermark("clock", params.watermark).where(F.col("clock").isNull())
    watch = WindowWatch(params.spike_volts, silence_seconds * 1000)
    return told.groupBy("page").transformWithStateInPandas(watch, OUTPUT, "append", "EventTime")


@dataclass(frozen=True)
class WatchPaths:
    """Where the tables of a watch are."""

    features: str
    alerts: str
    late: str
    gaps: str


SERIES = "patient_id string, channel string"
LATE = f"{SERIES}, timestamp_ms long, sample_index int, voltage double, event_time timestamp, window_start timestamp, window_end timestamp, event_date date"
GAPS = f"{SERIES}, kind string, window_start timestamp, prev_end timestamp, event_date date"


def read_late_rows(spark: SparkSession, paths: WatchPaths, fmt: str = "parquet") -> DataFrame:
    """Readings that came after their window had closed; none, if none has been late so far."""
    return spark.read.format(fmt).schema(LATE).load(paths.late)


def read_gaps(spark: SparkSession, paths: WatchPaths, fmt: str = "parquet") -> DataFrame:
    """Gaps (``window_start`` does not follow on ``prev_end``) and silences (from ``prev_end`` on)."""
    return spark.read.format(fmt).schema(GAPS).load(paths.gaps)


class WatchFanOut(FanOut):
    """Writes each micro-batch to the four tables; safe to replay, as ``FanOut`` is."""

    def __init__(self, paths: WatchPaths, checkpoint: str, params: MonitorParams, fmt: str, partition_by: Sequence[str]) -> None:
        super().__init__(paths.features, paths.alerts, fmt, checkpoint, partition_by=partition_by)
        self.paths, self.params = paths, params

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        feed = self._feed(batch.sparkSession)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        series = ["patient_id", "channel"]
        start, end, previous = (F.timestamp_millis(c).alias(n) for c, n in (("start_ms", "window_start"), ("end_ms", "window_end"), ("prev_end_ms", "prev_end")))
        try:
            windows = batch.where("kind = 'feature'").select(*series, start, end, "mean_v", "stddev_v", "min_v", "max_v", "spike_count")
            labelled = label_alerts(windows.withColumn("event_date", F.to_date("window_start")), self.params)
            moment = F.timestamp_micros("event_us").alias("event_time")
            late = batch.where("kind = 'late'").select(*series, "timestamp_ms", "sample_index", "voltage", moment, start, end)
            gaps = batch.where("kind in ('gap', 'silent')").select(*series, "kind", start, previous)
            self._write(labelled.drop("alert_reason"), self.paths.features, feed, batch_id)
            self._write(alerts_only(labelled), self.paths.alerts, feed, batch_id)
            self._write(late.withColumn("event_date", F.to_date("window_start")), self.paths.late, feed, batch_id)
            self._write(gaps.withColumn("event_date", F.to_date("prev_end")), self.paths.gaps, feed, batch_id)
        finally:
            batch.unpersist()


def start_watch(
    messages: DataFrame,
    paths: WatchPaths,
    checkpoint: str,
    params: MonitorParams,
    silence_seconds: int = 0,
    fmt: str = "parquet",
    state_partitions: int | None = None,
    drain: bool = False,
    partition_by: Sequence[str] = PARTITION_COLUMNS,
) -> StreamingQuery:
    """Start (or resume from ``checkpoint``) the watch; see ``start_monitor`` for the options. State is in
    RocksDB, which the operator needs, so it may exceed executor memory."""
    writer = (
        watched(messages, params, silence_seconds)
        .writeStream.foreachBatch(WatchFanOut(paths, checkpoint, params, fmt, partition_by))
        .option("checkpointLocation", checkpoint)
    )
    return start_with(writer, messages.sparkSession, drain, state_partitions, ROCKSDB_PROVIDER)


# Workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
