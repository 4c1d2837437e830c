"""Cases in which stored rows, samples or intervals were once lost or wrong."""

from pyspark.sql import functions as F

from wavelane.operators.readings import pack_messages, parse_messages
from wavelane.operators.series import number_within
from wavelane.operators.signal import signal_profile
from wavelane.sources.annotations import parse_summaries, summary_problems
from wavelane.sources.recordings import recording_headers, recording_problems, recording_samples
from wavelane.streaming.monitor import FanOut


def edf(records="2", samples=(100, 200, 300, 400), limit="1000"):
    """A recording with one signal of two samples a record, in microvolts."""
    signal = [("EEG A", 16), ("", 80), ("uV", 8), ("-1000", 8), (limit, 8), ("-1000", 8), ("1000", 8), ("", 80), ("2", 8), ("", 32)]
    main = [("0", 8), ("", 80), ("", 80), ("01.01.24", 8), ("00.00.00", 8), ("512", 8), ("", 44), (records, 8), ("1", 8), ("1", 4)]
    head = "".join(text.ljust(width) for text, width in main + signal)
    return head.encode() + b"".join(x.to_bytes(2, "little", signed=True) for x in samples)


def files(spark, **named):
    rows = [("f", f"{name}.edf", bytearray(content)) for name, content in named.items()]
    return spark.createDataFrame(rows, "folder string, recording_file string, content binary").coalesce(1)


def microvolts(spark, **named):
    rows = recording_samples(files(spark, **named)).collect()
    return {n: [round(r.voltage * 1e6) for r in sorted(rows, key=lambda r: r.sample_index) if r.recording_file == f"{n}.edf"] for n in named}


def test_a_cut_recording_harms_no_other(spark):
    found = microvolts(spark, chb01=edf()[:-1], chb02=edf())
    assert found == {"chb01": [100, 200, 300], "chb02": [100, 200, 300, 400]}


def test_recordings_without_a_number_of_records_are_read(spark):
    assert microvolts(spark, chb01=edf("-1")) == {"chb01": [100, 200, 300, 400]}
    assert recording_headers(files(spark, chb01=edf("-1"))).first()["records"] == 2


def test_bad_recordings_are_reported(spark):
    bad = files(spark, a=edf("xx"), b=b"short", c=edf(limit="oops"), d=edf("-1"), e=edf()[:-1], f=edf())
    problems = {r.recording_file[0]: r.problem for r in recording_problems(bad).collect()}
    assert problems == {"a": "header", "b": "header", "c": "scale", "d": "open", "e": "cut"}
    assert recording_samples(bad).where("recording_file = 'f.edf'").count() == 4


def test_an_unreadable_line_spoils_only_its_interval(spark):
    lines = ["File Name: chb01_1.edf", "x", "x", "Number of Seizures in File: 2", "Start: 130", "End: unknown", "", "Start: 200", "End: 260"]
    texts = spark.createDataFrame([("\n".join(lines),)], "value string")
    assert [(r.start_second, r.end_second) for r in parse_summaries(texts).collect()] == [(200, 260)]
    assert [(r.interval, r.start_second, r.end_second) for r in summary_problems(texts).collect()] == [(1, 130, None)]


def test_repeated_readings_are_packed_once(spark):
    rows = [("p", 1, 0, "a", 1.0), ("p", 1, 0, "a", 1.0), ("p", 1, 0, "a", 2.0), ("p", 1, 0, "b", None)]
    readings = spark.createDataFrame(rows, "patient_id string, timestamp_ms long, sample_index int, channel string, voltage double")
    back = parse_messages(pack_messages(readings)).collect()
    assert sorted((r.channel, r.voltage) for r in back) == [("a", 2.0), ("b", None)]


def test_profile_keeps_patients_apart(spark):
    rows = spark.range(20).selectExpr("concat('p', id % 2) as patient_id", "'a' as channel", "timestamp_seconds(id div 2 + 100 * (id % 2)) as event_time", "1.0 as voltage")
    assert {(r.patient_id, r.samples) for r in signal_profile(rows).collect()} == {("p0", 10), ("p1", 10)}


def test_numbering_moves_the_rows_once(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = number_within(rows, ["k"], ["id"], F.floor(F.col("id") / 10), "n")._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Window [sum") if "Window [sum" in plan else len(plan)]
    assert above.count("Exchange hashpartitioning") <= 2


def test_two_feeds_keep_their_rows(spark, tmp_path):
    rows = spark.createDataFrame([("p", "a", "2024-01-01", "spike_threshold")], "patient_id string, channel string, event_date string, alert_reason string")
    paths = str(tmp_path / "features"), str(tmp_path / "alerts")
    for feed in ("one", "two", "two"):  # the last is a replay
        FanOut(*paths, feed=feed, partition_by=("event_date",))(rows, 0)
    assert spark.read.parquet(paths[0]).count() == 2
    assert spark.read.parquet(paths[1]).count() == 2
