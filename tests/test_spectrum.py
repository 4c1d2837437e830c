"""Power density against direct sums, and on incomplete series."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavelane.operators.spectrum import power_density

ROW = "patient_id string, channel string, sample_index long, voltage double, segment string"


def frame(spark, signals):
    rows = [(p, c, k, v if v is None else float(v), "x") for (p, c), values in signals.items() for k, v in values]
    return spark.createDataFrame(rows, ROW).repartition(3)


def direct(values, rate, length, step):
    """Averaged density by the definition, term by term."""
    taper = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(length) / length)
    out = []
    for begin in range(0, len(values) - length + 1, step):
        x = np.array(values[begin : begin + length])
        x = (x - x.mean()) * taper
        row = []
        for k in range(length // 2 + 1):
            angle = 2 * np.pi * k * np.arange(length) / length
            one_sided = 1 if k == 0 or 2 * k == length else 2
            row.append(one_sided * ((x * np.cos(angle)).sum() ** 2 + (x * np.sin(angle)).sum() ** 2) / (rate * (taper**2).sum()))
        out.append(row)
    return len(out), np.mean(out, axis=0)


@pytest.mark.parametrize("length,step", [(16, None), (15, 4), (16, 16), (8, 3)])
def test_equals_direct_sums(spark, length, step):
    rng = np.random.default_rng(length)
    signals = {("p1", "A"): rng.normal(size=101), ("p1", "B"): rng.normal(size=length), (None, "A"): rng.normal(size=40) + 50, ("p2", "A"): rng.normal(size=length - 1)}
    found = power_density(frame(spark, {k: list(enumerate(v)) for k, v in signals.items()}), 256.0, length, step).collect()
    for key, values in signals.items():
        rows = sorted((r.hertz, r.segments, r.density) for r in found if (r.patient_id, r.channel) == key)
        if len(values) < length:
            assert rows == []
            continue
        count, want = direct(values, 256.0, length, step or length // 2)
        assert [r[1] for r in rows] == [count] * (length // 2 + 1)
        assert np.allclose([r[0] for r in rows], np.arange(length // 2 + 1) * 256.0 / length)
        assert np.allclose([r[2] for r in rows], want, rtol=1e-9, atol=1e-12)


def test_a_tone_stands_out_and_its_power_is_kept(spark):
    n, rate = 2048, 128.0
    tone = [(k, 3 * np.sin(2 * np.pi * 16 * k / rate)) for k in range(n)]
    found = {r.hertz: r.density for r in power_density(frame(spark, {("p", "A"): tone}), rate, 256).collect()}
    assert max(found, key=found.get) == 16.0
    assert abs(sum(found.values()) * rate / 256 - 4.5) < 1e-9  # the tone's variance


def test_segments_with_missing_repeated_or_null_samples_are_left_out(spark):
    values = [(k, k % 5) for k in range(40)]
    gaps = [(k, v) for k, v in values if k != 9]
    nulls = [(k, None if k == 9 else v) for k, v in values]
    twice = values + [(9, 4.0)]
    nans = [(k, float("nan") if k == 9 else v) for k, v in values]
    signals = {("p", "whole"): values, ("p", "gaps"): gaps, ("p", "nulls"): nulls, ("p", "twice"): twice, ("p", "nans"): nans, ("p", "early"): [(k - 8, v) for k, v in values]}
    found = power_density(frame(spark, signals), 1.0, 8).groupBy("channel").agg(F.max("segments").alias("n")).collect()
    assert {r.channel: r.n for r in found} == {"whole": 9, "gaps": 7, "nulls": 7, "twice": 7, "nans": 7, "early": 7}
    assert power_density(frame(spark, signals).limit(0), 1.0, 8).count() == 0
    with pytest.raises(ValueError):
        power_density(frame(spark, signals), 1.0, 1)
