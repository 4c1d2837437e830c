"""Recordings as a data source of their own: headers without bodies, bodies by byte range.

``spark.read.format("recording")`` splits recordings of any size into byte ranges, and packs small ones
together, as Spark does with splittable files. A range reads the few kilobytes of the header and then the data
records that begin in it, so a long recording is read by many tasks and a record by just one. With option
``rows`` set to ``headers`` nothing but headers is read.

Paths must be of a file system that Arrow opens (local, hdfs, s3, gcs). The listing of names and sizes is all
that planning does; the driver opens no file.
"""

from __future__ import annotations

import datetime as dt
import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from wavelane.sources import recordings as edf
from wavelane.sources.annotations import PATIENT_IN_FILE_NAME

SAMPLES = (
    "patient_id string, recording_file string, timestamp_ms long, sample_index int, channel string, "
    "voltage double, event_time timestamp"
)
SIGNAL = "label: string, samples: int, offset: int, gain: double, bias: double, channel: string"
HEADERS = (
    "folder string, recording_file string, patient_id string, started_at timestamp, header_bytes int, records long, "
    f"record_seconds double, sampling_rate double, signals array<struct<{SIGNAL}>>, record_bytes int, size long, "
    "problem string"
)
FILES_PER_PARTITION = 1000
CHUNK_BYTES = 1 << 20
# The fixed values of the format, taken along as the source goes to workers by value.
FIELDS = {name: getattr(edf, name) for name in dir(edf) if name.isupper()}


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path.removeprefix("file:")


def _whole(text: str) -> int | None:
    return int(text) if re.fullmatch(r"[+-]?[0-9]+", text) else None


def _real(text: str) -> float | None:
    try:
        return float(text)
    except ValueError:
        return None


def _moment(day: str, clock: str) -> dt.datetime | None:
    found = re.fullmatch(r"(\d\d)\.(\d\d)\.(\d\d)(\d\d)\.(\d\d)\.(\d\d)", (day + clock).replace(" ", "0"))
    if not found:
        return None
    d, month, year, hour, minute, second = map(int, found.groups())
    try:
        return dt.datetime(year + (2000 if year < FIELDS["PIVOT_YEAR"] else 1900), month, d, hour, minute, second, tzinfo=dt.timezone.utc)
    except ValueError:
        return None


@dataclass
class Header:
    """A recording's layout. ``records`` is how many there are to read, cut ones included."""

    name: str
    patient_id: str
    started_at: dt.datetime | None
    header_bytes: int | None
    records: int | None
    record_seconds: float | None
    signals: list[tuple]
    record_bytes: int
    problem: str | None

    @property
    def readable(self) -> bool:
        return bool(self.problem != "header")


def read_header(file: pa.NativeFile, name: str, size: int) -> Header:
    """The header of an open recording; reads no further."""
    main = file.read(FIELDS["MAIN_HEADER"])

    def text(at: int, width: int, source: bytes = main) -> str:
        return source[at : at + width].decode("utf-8", "replace").strip(" ")

    count = _whole(text(*FIELDS["SIGNAL_COUNT"])) or 0
    head = file.read(FIELDS["SIGNAL_HEADER"] * count) if count > 0 else b""

    def each(field: str) -> list[str]:
        offset, width = FIELDS[field]
        return [text(offset * count + k * width, width, head) for k in range(count)]

    samples = [_whole(x) or 0 for x in each("SAMPLES_PER_RECORD")]
    limits = zip(*([_real(x) for x in each(f)] for f in ("PHYSICAL_MIN", "PHYSICAL_MAX", "DIGITAL_MIN", "DIGITAL_MAX")))
    signals = []
    for k, (label, unit, (low, high, first, last)) in enumerate(zip(each("LABEL"), each("UNIT"), limits)):
        gain = bias = None
        if None not in (low, high, first, last) and last != first:
            in_volts = FIELDS["UNITS"].get(unit.lower(), 1.0)
            gain = (high - low) / (last - first)
            gain, bias = gain * in_volts, (low - first * gain) * in_volts
        if label != FIELDS["TEXT_SIGNAL"]:
            signals.append((label, samples[k], sum(samples[:k]), gain, bias))
    times, seen = Counter(s[0] for s in signals), Counter()
    named = []
    for s in signals:
        named.append((*s, f"{s[0]}-{seen[s[0]]}" if times[s[0]] > 1 else s[0]))
        seen[s[0]] += 1
    header_bytes, stated = _whole(text(*FIELDS["HEADER_BYTES"])), _whole(text(*FIELDS["RECORD_COUNT"]))
    seconds, record_bytes = _real(text(*FIELDS["RECORD_SECONDS"])), 2 * sum(samples)
    started_at = _moment(text(*FIELDS["START_DATE"]), text(*FIELDS["START_TIME"]))
    usable = count > 0 and (header_bytes or 0) > 0 and record_bytes > 0 and (seconds or 0) > 0 and stated is not None and started_at
    records, problem = stated, None
    if not usable:
        problem = "header"
    else:
        body = size - header_bytes
        if stated < 0:
            records = max(body // record_bytes, 0)
        if any(s[3] is None for s in signals):
            problem = "scale"
        elif stated < 0:
            problem = "open"
        elif body < stated * record_bytes:
            problem = "cut"
    patient = re.match(FIELDS["PATIENT_IN_FILE_NAME"], name)
    return Header(name, patient[1] if patient else "", started_at, header_bytes, records, seconds, named, record_bytes, problem)


def _samples(header: Header, first: int, data: bytes) -> Iterator[pa.RecordBatch]:
    """Readings of consecutive records from number ``first`` on; the last one may be cut."""
    values = np.frombuffer(data, "<i2", count=len(data) // 2)
    width = header.record_bytes // 2
    whole = len(values) // width
    grid, rest = values[: whole * width].reshape(whole, width), values[whole * width :]
    started_ms = int(header.started_at.timestamp()) * 1000
    for _, samples, offset, gain, bias, channel in header.signals:
        digital = np.concatenate([grid[:, offset : offset + samples].ravel(), rest[offset : offset + samples]])
        n = len(digital)
        index = first * samples + np.arange(n, dtype=np.int64)
        if not n:
            continue
        at = started_ms + np.floor(index * 1000 * header.record_seconds / samples).astype(np.int64)
        volts = pa.nulls(n, pa.float64()) if gain is None else pa.array(digital * gain + bias)
        columns = {
            "patient_id": pa.repeat(header.patient_id, n),
            "recording_file": pa.repeat(header.name, n),
            "timestamp_ms": pa.array(at),
            "sample_index": pa.array(index.astype(np.int32)),
            "channel": pa.repeat(channel, n),
            "voltage": volts,
            "event_time": pa.array(at * 1000).cast(pa.timestamp("us", "UTC")),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


@dataclass
class Ranges(InputPartition):
    """Byte ranges of files: (path, size, begin, end)."""

    pieces: list[tuple[str, int, int, int]]


class RecordingReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.glob = options.get("glob", "*.edf")
        self.headers_only = options.get("rows", "samples") == "headers"
        self.partition_bytes = int(options.get("partitionBytes", 64 << 20))

    def partitions(self) -> list[Ranges]:
        """Files one after the other, cut wherever a partition is full."""
        files, root = file_system(self.path)
        info = files.get_file_info(root)
        listed = [info] if info.is_file else files.get_file_info(pafs.FileSelector(root, recursive=True))
        found = sorted((f.path, f.size) for f in listed if f.is_file and fnmatch(f.base_name, self.glob))
        parts: list[list[tuple[str, int, int, int]]] = [[]]
        room = self.partition_bytes
        for path, size in found:
            begin = 0
            while begin < size or size == 0:
                if room <= 0 or len(parts[-1]) >= FILES_PER_PARTITION:
                    parts.append([])
                    room = self.partition_bytes
                end = size if self.headers_only else min(size, begin + room)
                parts[-1].append((path, size, begin, end))
                room -= 0 if self.headers_only else end - begin
                begin = end
                if size == 0:
                    break
        return [Ranges(p) for p in parts if p] or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator:
        files, _ = file_system(self.path)
        for path, size, begin, end in partition.pieces:
            with files.open_input_file(path) as file:
                name = path.rsplit("/", 1)[-1]
                header = read_header(file, name, size)
                if self.headers_only:
                    yield self._described(path, size, header)
                elif header.readable:
                    yield from self._range(file, header, begin, end)

    def _range(self, file: pa.NativeFile, header: Header, begin: int, end: int) -> Iterator[pa.RecordBatch]:
        """The records that begin between two bytes of the file."""
        at = [max(0, -(-(edge - header.header_bytes) // header.record_bytes)) for edge in (begin, end)]
        first, stop = at[0] if begin else 0, min(at[1], header.records)
        step = max(1, CHUNK_BYTES // header.record_bytes)
        for record in range(first, stop, step):
            file.seek(header.header_bytes + record * header.record_bytes)
            yield from _samples(header, record, file.read(min(step, stop - record) * header.record_bytes))

    def _described(self, path: str, size: int, header: Header) -> tuple:
        rate = header.signals[0][1] / header.record_seconds if header.signals and header.record_seconds else None
        return (
            path.rsplit("/", 1)[0], header.name, header.patient_id, header.started_at, header.header_bytes, header.records,
            header.record_seconds, rate, header.signals, header.record_bytes, size, header.problem,
        )


class RecordingSource(DataSource):
    """Options: ``path``, ``glob``, ``rows`` (samples or headers), ``partitionBytes``."""

    @classmethod
    def name(cls) -> str:
        return "recording"

    def schema(self) -> str:
        return HEADERS if self.options.get("rows") == "headers" else SAMPLES

    def reader(self, schema) -> RecordingReader:
        return RecordingReader(self.options)


def scan_headers(spark: SparkSession, path: str, glob: str = "*.edf") -> DataFrame:
    """One row per recording below ``path``, unreadable ones included: layout, signals, and what is wrong with
    it, if anything (as in ``recording_problems``). Bodies are not read."""
    spark.dataSource.register(RecordingSource)
    return spark.read.format("recording").options(rows="headers", glob=glob).load(path)


def scan_samples(spark: SparkSession, path: str, glob: str = "*.edf", partition_bytes: int = 64 << 20) -> DataFrame:
    """All samples of the recordings below ``path`` as readings in volts, about ``partition_bytes`` of them a
    task. The same rows as ``recording_samples`` of the files' whole contents."""
    spark.dataSource.register(RecordingSource)
    return spark.read.format("recording").options(glob=glob, partitionBytes=partition_bytes).load(path)


FIELDS["PATIENT_IN_FILE_NAME"] = PATIENT_IN_FILE_NAME
# Workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
