"""Recordings read by byte range: the same rows as from whole contents, however files are cut."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_sources_sinks import LABELS, edf

from wavelane.sinks.files import write_files
from wavelane.sources import recording_source
from wavelane.sources.recording_source import RecordingReader, scan_headers, scan_samples
from wavelane.sources.recordings import read_recordings, recording_headers, recording_problems, recording_samples


@pytest.fixture
def folder(tmp_path):
    rng = np.random.default_rng(4)
    made = {
        "chb01_01.edf": edf(LABELS, rng.integers(-2000, 2000, (4, 400))),
        "sub/chb02_01.edf": edf(["A"], rng.integers(-2000, 2000, (1, 4 * 37)), "01.02.9501.02.03", "mV"),
        "sub/x_01.edf": edf(["A", "A", "B"], rng.integers(-2000, 2000, (3, 12)), unit="?"),
    }
    whole = made["chb01_01.edf"]
    made["chb03_cut.edf"] = whole[: len(whole) - 45]  # within a sample of a record
    made["chb04_open.edf"] = whole[:236] + b"-1      " + whole[244:-7]
    made["chb05_few.edf"] = edf(["A"], rng.integers(-9, 9, (1, 8))) + b"more than stated"
    made["chb06_scale.edf"] = edf(["A"], [[1, 2, 3, 4]], digital=(5, 5))
    made["chb07_text.edf"] = b"no header at all"
    made["chb08_date.edf"] = edf(["A"], [[1, 2, 3, 4]], "31.02.9901.02.03")
    made["chb09_empty.edf"] = b""
    made["notes.txt"] = b"other"
    for name, data in made.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    return tmp_path


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.mark.parametrize("partition_bytes", [100, 333, 1 << 20])
def test_samples_equal_those_of_whole_contents(spark, folder, partition_bytes):
    whole = rows_of(recording_samples(read_recordings(spark, str(folder))))
    ranged = scan_samples(spark, str(folder), partition_bytes=partition_bytes)
    assert rows_of(ranged) == whole
    assert len(whole) > 1500
    if partition_bytes == 100:
        per_file = ranged.where("recording_file = 'chb01_01.edf'").select(F.spark_partition_id().alias("task")).distinct()
        assert per_file.count() > 20  # one file, many tasks


def test_random_cuts_lose_and_double_nothing(folder):
    rng = random.Random(9)
    for _ in range(30):
        reader = RecordingReader({"path": str(folder), "partitionBytes": rng.randrange(1, 900)})
        parts = reader.partitions()
        pieces = sorted(p for part in parts for p in part.pieces)
        for path in {p[0] for p in pieces}:
            own = [p for p in pieces if p[0] == path]
            assert own[0][2] == 0 and own[-1][3] == own[0][1]
            assert all(a[3] == b[2] for a, b in zip(own, own[1:]))
    seen = [(b.column("channel")[0].as_py(), i) for part in parts for b in reader.read(part) if b.column("recording_file")[0].as_py() == "chb01_01.edf" for i in b.column("sample_index").to_pylist()]
    assert len(seen) == len(set(seen)) == 1200


def test_headers_equal_those_of_whole_contents(spark, folder):
    names = ["recording_file", "patient_id", "started_at", "header_bytes", "records", "record_seconds", "sampling_rate", "signals", "record_bytes"]
    files = read_recordings(spark, str(folder))
    scanned = scan_headers(spark, str(folder))
    assert rows_of(scanned.where("problem is null or problem <> 'header'").select(*names)) == rows_of(
        recording_headers(files).where("started_at is not null").select(*names)
    )
    problems = scanned.where("problem is not null").select("recording_file", "problem")
    # Spark's file sources pass over files without bytes.
    assert rows_of(problems.where("recording_file <> 'chb09_empty.edf'")) == rows_of(recording_problems(files))
    assert problems.where("recording_file = 'chb09_empty.edf' and problem = 'header'").count() == 1
    assert scanned.count() == 10


def test_a_header_scan_reads_no_bodies(folder, monkeypatch):
    class Watched:
        read_bytes = 0

        def __init__(self, file):
            self.file = file

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.file.close()

        def read(self, n):
            Watched.read_bytes += n
            return self.file.read(n)

    system = recording_source.pafs.LocalFileSystem()

    class Files:
        get_file_info = system.get_file_info

        def open_input_file(self, path):
            return Watched(system.open_input_file(path))

    monkeypatch.setattr(recording_source, "file_system", lambda path: (Files(), path))
    (folder / "chb10_long.edf").write_bytes(edf(["A"], np.zeros((1, 400_000))))
    reader = RecordingReader({"path": str(folder), "rows": "headers"})
    described = [row for part in reader.partitions() for row in reader.read(part)]
    assert len(described) == 11
    assert Watched.read_bytes <= 11 * 256 * 5


def test_no_files_and_a_single_file(spark, folder, tmp_path):
    (tmp_path / "none").mkdir()
    assert scan_samples(spark, str(tmp_path / "none")).count() == 0
    assert scan_headers(spark, str(tmp_path / "none")).count() == 0
    assert scan_samples(spark, f"file://{folder}/sub/chb02_01.edf").count() == 4 * 37


def test_written_files_are_whole(spark, tmp_path):
    rows = [(f"f{k % 3}", k, bytes([k]) * k) for k in range(60)] + [("f3", 0, None), ("f4", 0, b"")]
    listed = write_files(spark.createDataFrame(rows, "name string, position long, data binary").repartition(4), f"file://{tmp_path}/out")
    assert sorted(map(tuple, listed.collect())) == [(f"f{j}", sum(range(j, 60, 3))) for j in range(3)] + [("f3", 0), ("f4", 0)]
    assert (tmp_path / "out" / "f1").read_bytes() == b"".join(bytes([k]) * k for k in range(1, 60, 3))
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["f0", "f1", "f2", "f3", "f4"]
