"""Block-wise order operators against plain window functions, and the signal summaries."""

import cmath
import datetime as dt
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wavelane import MonitorParams
from wavelane.functions import suffix_repeats
from wavelane.operators.series import find_gaps, number_within
from wavelane.operators.signal import (
    band_power,
    normalise_channels,
    signal_profile,
    suffix_duplicates,
)

T0 = dt.datetime(2024, 1, 1)


def windows(spark, rows):
    return spark.createDataFrame(
        [
            (p, c, T0 + dt.timedelta(seconds=a), None if b is None else T0 + dt.timedelta(seconds=b))
            for p, c, a, b in rows
        ],
        "patient_id string, channel string, window_start timestamp, window_end timestamp",
    )


def gaps_by_plain_lag(features):
    order = Window.partitionBy("patient_id", "channel").orderBy("window_start", "window_end")
    lagged = features.withColumn("prev_end", F.lag("window_end").over(order))
    return lagged.where("prev_end is not null and window_start <> prev_end").select(
        "patient_id", "channel", "window_start", "prev_end"
    )


@pytest.mark.parametrize("seed", range(3))
def test_gaps_equal_plain_lag_for_any_block(spark, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice("aab"), rng.choice("xy"), start, start + rng.choice([5, 5, 5, 7]))
        for start in (5 * rng.randrange(60) for _ in range(150))
    ]
    features = windows(spark, rows)
    want = sorted(map(tuple, gaps_by_plain_lag(features).collect()))
    for seconds in (5, 30, 10_000):
        assert sorted(map(tuple, find_gaps(features, seconds).collect())) == want


def test_gap_edges(spark):
    rows = [("a", "x", 0, 5), ("a", "x", 5, 10), ("a", "x", 15, 20), ("a", "x", 100, 105), ("a", "y", 50, 55)]
    got = find_gaps(windows(spark, rows), 50).orderBy("window_start").collect()
    assert [(r.window_start - T0).seconds for r in got] == [15, 100]
    assert [(r.prev_end - T0).seconds for r in got] == [10, 20]
    assert find_gaps(windows(spark, [("a", "x", 0, None), ("a", "x", 9, 14)]), 50).count() == 0


def test_numbering_equals_row_number(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "a", "a", "b", None]), n, rng.randrange(50)) for n in range(300)]
    frame = spark.createDataFrame(rows, "k string, n int, v int")
    key = Window.partitionBy("k")
    plain = frame.select(
        "*", (F.row_number().over(key.orderBy("v", "n")) - 1).alias("i"), F.count("*").over(key)
    )
    want = sorted(map(tuple, plain.collect()), key=str)
    for width in (1, 7, 100):
        block = F.floor(F.col("v") / width)
        got = number_within(frame, ["k"], ["v", "n"], block, "i", "of")
        assert sorted(map(tuple, got.collect()), key=str) == want


def labels(spark, rows):
    return spark.createDataFrame(rows, "recording string, position bigint, label string")


def test_first_label_per_electrode_is_kept(spark):
    rows = [("r", 0, "FP1-F7"), ("r", 1, "F7-T7"), ("r", 2, "FP1-F3"), ("r", 3, "--0 CZ"), ("s", 0, "FP1-F3")]
    got = sorted(map(tuple, normalise_channels(labels(spark, rows)).collect()))
    assert got == [
        ("r", "0", 3, "--0 CZ"),
        ("r", "F7", 1, "F7-T7"),
        ("r", "Fp1", 0, "FP1-F7"),
        ("s", "Fp1", 0, "FP1-F3"),
    ]


def test_repeated_labels_get_suffixes(spark):
    names = ["T8-P8", "A", "T8-P8", "B", "T8-P8"]
    rows = [("r", n, name) for n, name in enumerate(names)] + [("s", 0, "T8-P8")]
    want = ["T8-P8-0", "A", "T8-P8-1", "B", "T8-P8-2"]
    for block in (1, 2, 100):
        got = suffix_duplicates(labels(spark, rows), block).orderBy("recording", "position").collect()
        assert [r.channel for r in got] == [*want, "T8-P8"]
    inline = spark.createDataFrame([(names,)], "names array<string>").select(suffix_repeats(F.col("names")))
    assert inline.first()[0] == want


def samples(spark, hertz, seconds, frequency):
    rows = [
        ("p", "A", T0 + dt.timedelta(seconds=i / hertz), math.sin(2 * math.pi * frequency * i / hertz))
        for i in range(hertz * seconds)
    ]
    return spark.createDataFrame(
        rows, "patient_id string, channel string, event_time timestamp, voltage double"
    )


def test_spectrum_peaks_at_the_tone(spark):
    tone = samples(spark, 64, 5, 8)
    powers = band_power(tone, MonitorParams(), range(1, 17))
    by_hertz = {r.hertz: r.power for r in powers.collect()}
    assert max(by_hertz, key=by_hertz.get) == 8
    spectrum = [
        abs(sum(math.sin(2 * math.pi * 8 * i / 64) * cmath.exp(-2j * math.pi * f * i / 64) for i in range(320))) ** 2
        / 320
        for f in range(1, 17)
    ]
    for frequency, power in zip(range(1, 17), spectrum):
        assert abs(by_hertz[frequency] - power) < 1e-3
    plan = powers._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_profile(spark):
    row = signal_profile(samples(spark, 64, 5, 8)).first()
    assert row.samples == 320 and abs(row.samples_per_second - 64 * 320 / 319) < 0.01
    assert row.first_time == T0
