"""Text, binary and table sources; appending, replacing and deleting."""

import datetime as dt
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavelane.sinks.tables import append_table, delete_where, replace_table, save_mart
from wavelane.sources.annotations import annotations_from, parse_summaries, read_summaries
from wavelane.sources.recordings import read_recordings, recording_headers, recording_samples
from wavelane.sources.tables import read_partition, read_table, stage


def edf(labels, data, started="06.11.7613.43.04", unit="uV", per_record=4, digital=(-2048, 2047)):
    """Bytes of a small recording; ``data`` is signals x samples of integers, physical range +-800."""

    def field(value, width):
        return str(value).ljust(width).encode()

    data = np.asarray(data, dtype="<i2")
    signals, records = len(labels), data.shape[1] // per_record
    head = [field("0", 8), field("X", 80), field("X", 80), started.encode()]
    head += [field(256 + 256 * signals, 8), field("", 44), field(records, 8), field(1, 8), field(signals, 4)]
    columns = [(labels, 16), ([""] * signals, 80), ([unit] * signals, 8), ([-800] * signals, 8)]
    columns += [([800] * signals, 8), ([digital[0]] * signals, 8), ([digital[1]] * signals, 8)]
    columns += [([""] * signals, 80), ([per_record] * signals, 8), ([""] * signals, 32)]
    head += [field(value, width) for values, width in columns for value in values]
    blocks = data.reshape(signals, records, per_record).transpose(1, 0, 2)
    return b"".join(head) + blocks.tobytes()


LABELS = ["FP1-F7", "T8-P8", "T8-P8", "EDF Annotations"]


@pytest.fixture
def recording_folder(tmp_path):
    data = np.arange(4 * 12).reshape(4, 12) * 40 - 900
    (tmp_path / "chb01_03.edf").write_bytes(edf(LABELS, data))
    (tmp_path / "chb02_01.edf").write_bytes(edf(["A"], [[-2048, 0, 1, 2047]], "01.02.9501.02.03", "mV"))
    return tmp_path, data


def test_headers(spark, recording_folder):
    folder, _ = recording_folder
    first, second = (
        recording_headers(read_recordings(spark, str(folder))).drop("content").orderBy("recording_file").collect()
    )
    assert (first.recording_file, first.patient_id) == ("chb01_03.edf", "chb01")
    assert first.started_at == dt.datetime(2076, 11, 6, 13, 43, 4)
    assert second.started_at == dt.datetime(1995, 2, 1, 1, 2, 3)
    assert (first.sampling_rate, first.records) == (4.0, 3)
    assert [s.channel for s in first.signals] == ["FP1-F7", "T8-P8-0", "T8-P8-1"]


def test_samples_in_volts(spark, recording_folder):
    folder, data = recording_folder
    rows = recording_samples(read_recordings(spark, str(folder))).collect()
    assert len(rows) == 3 * 12 + 4
    by_place = {(r.recording_file, r.channel, r.sample_index): r for r in rows}
    gain = 1600 / 4095
    for signal, channel in enumerate(["FP1-F7", "T8-P8-0", "T8-P8-1"]):
        for index in range(12):
            row = by_place["chb01_03.edf", channel, index]
            microvolts = (data[signal, index] + 2048) * gain - 800
            assert abs(row.voltage - microvolts * 1e-6) < 1e-12
            start = dt.datetime(2076, 11, 6, 13, 43, 4)
            assert row.event_time == start + dt.timedelta(milliseconds=250 * index)
    assert abs(by_place["chb02_01.edf", "A", 3].voltage - 0.8) < 1e-12


def block(name, count, *seconds):
    lines = [f"File Name: {name}", "File Start Time: 13:43:04", "File End Time: 14:43:04"]
    lines.append(f"Number of Seizures in File: {count}")
    for n, second in enumerate(seconds):
        lines.append(f"Seizure {n // 2 + 1} {'Start' if n % 2 == 0 else 'End'} Time: {second} seconds")
    return "\n".join(lines) + "\n\n"


def test_summary_texts(spark, tmp_path):
    text = "Data Sampling Rate: 256 Hz\nChannel 1: FP1-F7\n\n" + block("chb01_01.edf", 0)
    text += block("chb01_03.edf", 1, 2996, 3036) + block("chb01_04.edf", 2, 10, 20, 30, 45)
    text += "Channels changed:\nChannel 1: 7\nChannel 2: 8\n" + block("chb17a_03.edf", 1, 5, 6)
    (tmp_path / "chb01-summary.txt").write_text(text)
    (tmp_path / "chb02-summary.txt").write_text("")
    (tmp_path / "chb03-summary.txt").write_text(block("chb03_01.edf", 1, 1, 2).replace("\n", "\r\n"))
    parsed = parse_summaries(read_summaries(spark, str(tmp_path / "*.txt")))
    got = sorted(
        (r.patient_id, r.recording_file, r.start_second, r.end_second) for r in parsed.collect()
    )
    assert got == [
        ("chb01", "chb01_03.edf", 2996, 3036),
        ("chb01", "chb01_04.edf", 10, 20),
        ("chb01", "chb01_04.edf", 30, 45),
        ("chb03", "chb03_01.edf", 1, 2),
        ("chb17", "chb17a_03.edf", 5, 6),
    ]


def test_annotations_need_a_recording(spark, recording_folder):
    folder, _ = recording_folder
    (folder / "s.txt").write_text(block("chb01_03.edf", 1, 2996, 3036) + block("chb09_01.edf", 1, 1, 2))
    headers = recording_headers(read_recordings(spark, str(folder)))
    parsed = parse_summaries(read_summaries(spark, str(folder / "s.txt")))
    (row,) = annotations_from(parsed, headers).collect()
    start = dt.datetime(2076, 11, 6, 13, 43, 4)
    assert tuple(row) == (
        "chb01",
        "chb01_03.edf",
        start + dt.timedelta(seconds=2996),
        start + dt.timedelta(seconds=3036),
    )


ROWS = [("a", 1, 1.0), ("a", 1, 999.0), ("a", 2, 999.0), ("b", 1, 2.0), ("b", 2, None), (None, 1, 3.0)]


def stored(spark, path):
    days = [(p, dt.date(2024, 1, d), v) for p, d, v in ROWS]
    frame = spark.createDataFrame(days, "patient_id string, event_date date, mean_v double")
    append_table(frame, path)
    return frame


def contents(frame):
    return sorted(
        ((r.patient_id, r.event_date.day, r.mean_v) for r in frame.collect()), key=str
    )


def test_append_and_single_partition_read(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = stored(spark, path)
    append_table(frame, path)
    assert contents(read_table(spark, path)) == sorted(ROWS * 2, key=str)
    day = read_partition(spark, path, "a", "2024-01-01")
    assert contents(day) == sorted([ROWS[0], ROWS[1]] * 2, key=str)
    plan = day._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "patient_id" in pruned and "event_date" in pruned
    opened = day.select("_metadata.file_path").distinct().collect()
    assert opened and all("patient_id=a/event_date=2024-01-01" in f.file_path for f in opened)


def test_delete_where_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    stored(spark, path)
    untouched = {str(f) for f in Path(path).glob("patient_id=b/**/*.parquet")}
    delete_where(spark, path, F.col("mean_v") == 999.0)
    assert contents(read_table(spark, path)) == sorted((r for r in ROWS if r[2] != 999.0), key=str)
    assert {str(f) for f in Path(path).glob("patient_id=b/**/*.parquet")} == untouched
    assert not Path(path, "patient_id=a/event_date=2024-01-02").exists()
    delete_where(spark, path, F.col("mean_v") == 999.0)
    assert read_table(spark, path).count() == 4


def test_delete_can_empty_a_null_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    stored(spark, path)
    delete_where(spark, path, F.col("mean_v") == 3.0)
    assert contents(read_table(spark, path)) == sorted((r for r in ROWS if r[2] != 3.0), key=str)


ODD = [("a b/c%", 1, 1.0), ("a b/c%", 2, 2.0), ("\u00e9", 1, 1.0), (None, 1, 1.0), ("z", 1, 5.0)]


def test_delete_removes_files_of_odd_names(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [(p, dt.date(2024, 1, d), v) for p, d, v in ODD]
    append_table(spark.createDataFrame(days, "patient_id string, event_date date, mean_v double"), path)
    delete_where(spark, path, F.col("mean_v") == 1.0)
    assert contents(read_table(spark, path)) == sorted([ODD[1], ODD[4]], key=str)
    assert len(list(Path(path).glob("**/*.parquet"))) == 2
    delete_where(spark, path, F.lit(True))
    assert not list(Path(path).glob("**/*.parquet"))


@pytest.mark.parametrize("stop", ["_remove_files", "_remove"])
def test_a_stopped_delete_is_finished(spark, tmp_path, monkeypatch, stop):
    """Stopped between rewriting and removing, or before the marker goes."""
    from wavelane.sinks import tables

    path = str(tmp_path / "t")
    stored(spark, path)

    def stopped(*_):
        raise InterruptedError

    with monkeypatch.context() as patch:
        patch.setattr(tables, stop, stopped)
        with pytest.raises(InterruptedError):
            delete_where(spark, path, F.col("mean_v") == 999.0)
    expected = sorted((r for r in ROWS if r[2] != 999.0), key=str)
    found = contents(read_table(spark, path))  # the marker is no part of the table
    assert set(expected) <= set(found) <= set(ROWS)
    assert tables.finish_delete(spark, path) and not tables.finish_delete(spark, path)
    assert contents(read_table(spark, path)) == expected
    assert not Path(path, tables.MARKER).exists()


def test_bucketed_tables_need_no_shuffle(spark, tmp_path):
    from wavelane.plans.marts import patient_summary
    from wavelane.sinks.tables import save_bucketed
    from wavelane.sources.tables import of_patient_day

    rows = [(f"p{k % 40}", dt.date(2024, 1, 1 + k % 3), "spike_threshold" if k % 5 == 0 else None) for k in range(400)]
    frame = spark.createDataFrame(rows, "patient_id string, event_date date, alert_reason string")
    save_bucketed(frame, "bucketed_features", 4, partition_by=["event_date"])
    save_bucketed(frame.where("alert_reason is not null"), "bucketed_alerts", 4)
    features, alerts = spark.table("bucketed_features"), spark.table("bucketed_alerts")
    summary = patient_summary(features, alerts)
    got = sorted(map(tuple, summary.collect()), key=str)
    assert got == sorted(map(tuple, patient_summary(frame, frame.where("alert_reason is not null")).collect()), key=str)
    assert "Exchange" not in summary._jdf.queryExecution().executedPlan().toString()
    day = of_patient_day(features, "p7", "2024-01-02")
    assert day.count() == sum(r[:2] == ("p7", dt.date(2024, 1, 2)) for r in rows) > 0
    # A scan alone opens the same files, but its plan says so only if it is kept in buckets.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    plan = day.select("*")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 4" in plan
    assert len(features.inputFiles()) == 12 and len(day.inputFiles()) == 4  # one file per date and bucket
    spark.sql("drop table bucketed_features")
    spark.sql("drop table bucketed_alerts")


def test_replace_stage_and_mart(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(5), path)
    replace_table(spark.range(3), path)
    stage(spark, {"stg_numbers": path})
    assert spark.sql("select count(*) from stg_numbers").first()[0] == 3
    save_mart(spark.table("stg_numbers"), "mart_numbers")
    save_mart(spark.table("stg_numbers").where("id > 0"), "mart_numbers")
    assert spark.table("mart_numbers").count() == 2
    spark.sql("drop table mart_numbers")
