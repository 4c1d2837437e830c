"""Wire parsing, window features and alert labels on literal edge cases."""

import datetime as dt


from wavelane import MonitorParams
from wavelane.operators.features import alerts_only, label_alerts, window_features
from wavelane.operators.readings import pack_messages, parse_messages

T0 = dt.datetime(2024, 1, 1)


def readings(spark, rows):
    """rows: (patient, second, channel, voltage)."""
    return spark.createDataFrame(
        [(p, T0 + dt.timedelta(seconds=s), c, v) for p, s, c, v in rows],
        "patient_id string, event_time timestamp, channel string, voltage double",
    )


def labelled(spark, rows, **params):
    settings = MonitorParams(**params)
    return label_alerts(window_features(readings(spark, rows), settings), settings)


def test_only_messages_with_channels_give_rows(spark):
    payloads = [
        "garbage",
        '{"patient_id": "x"}',
        '{"patient_id": "x", "channels": {}}',
        '{"patient_id": "chb01", "timestamp_ms": 1500, "sample_index": 3, "channels": {"A": 1.5, "B": null}}',
    ]
    frame = spark.createDataFrame([(p.encode(),) for p in payloads], "value binary")
    rows = sorted(parse_messages(frame).collect(), key=lambda r: r.channel)
    assert [(r.patient_id, r.timestamp_ms, r.sample_index, r.channel, r.voltage) for r in rows] == [
        ("chb01", 1500, 3, "A", 1.5),
        ("chb01", 1500, 3, "B", None),
    ]
    assert rows[0].event_time == dt.datetime(1970, 1, 1, 0, 0, 1, 500000)


def test_pack_and_parse_return_the_readings(spark, tmp_path):
    rows = [("chb01", 1000 + i // 3, i // 3, f"C{i % 3}", i * 1.1e-5) for i in range(30)]
    rows.append(("chb02", 1000, 0, "C0", None))
    columns = "patient_id string, timestamp_ms bigint, sample_index int, channel string, voltage double"
    packed = pack_messages(spark.createDataFrame(rows, columns))
    packed.write.parquet(str(tmp_path / "messages"))
    stored = spark.read.parquet(str(tmp_path / "messages"))
    assert stored.count() == 11
    back = parse_messages(stored).drop("event_time").collect()
    assert sorted(map(str, map(tuple, back))) == sorted(map(str, rows))


def test_window_features_values(spark):
    got = labelled(spark, [("p", 0, "A", 1e-5), ("p", 4, "A", -3e-5), ("p", 5, "A", 2e-5)])
    first, second = got.orderBy("window_start").collect()
    assert (first.window_start, first.window_end) == (T0, T0 + dt.timedelta(seconds=5))
    assert (first.min_v, first.max_v) == (-3e-5, 1e-5)
    assert abs(first.mean_v + 1e-5) < 1e-12 and abs(first.stddev_v - 2.8284271e-5) < 1e-10
    assert first.event_date == T0.date()
    assert second.stddev_v is None and second.alert_reason is None


def test_limits_are_strict(spark):
    at_spike_voltage = [("p", i * 0.1, "A", 5e-5) for i in range(20)]
    assert labelled(spark, at_spike_voltage).first().spike_count == 0
    ten_spikes = [("p", i * 0.1, "A", 6e-5) for i in range(10)]
    row = labelled(spark, ten_spikes).first()
    assert row.spike_count == 10 and row.alert_reason is None
    row = labelled(spark, [*ten_spikes, ("p", 2, "A", -6e-5)]).first()
    assert row.spike_count == 11 and row.alert_reason == "spike_threshold"


def test_spikes_take_precedence_over_variance(spark):
    both = [("p", i * 0.1, "A", 1e-3 * (-1) ** i) for i in range(12)]
    few = both[:4]
    assert labelled(spark, both).first().alert_reason == "spike_threshold"
    assert labelled(spark, few).first().alert_reason == "high_variance"
    assert alerts_only(labelled(spark, both[:1])).count() == 0


def test_null_voltage_counts_no_spike(spark):
    row = labelled(spark, [("p", 0, "A", None), ("p", 1, "A", 1.0)]).first()
    assert (row.spike_count, row.mean_v) == (1, 1.0)


def test_features_shuffle_once_after_partial_aggregation(spark):
    frame = window_features(readings(spark, [("p", 0, "A", 1.0)]), MonitorParams())
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_avg" in plan
