"""Overlap without pairs against brute force, and without growth where intervals crowd."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wavelane.operators.intervals import overlap_join
from wavelane.operators.sweep import mark_overlapping

ROW = "n int, patient_id string, a timestamp, b timestamp, overlaps string"
OTHER = "patient_id string, c timestamp, d timestamp, extra int"


def moment(second):
    return None if second is None else dt.datetime(1970, 1, 1) + dt.timedelta(seconds=second)


def drawn(rng, n, longest):
    spans = []
    for _ in range(n):
        begin = rng.randrange(-400, 400)
        spans.append((rng.choice(["p", "p", "q", None]), begin, begin + rng.choice([0, 1, rng.randrange(longest), -3])))
    return [*spans, ("p", None, 3), ("p", 3, None), spans[0], spans[0]]


@pytest.mark.parametrize("block", [1, 60, 10_000])
def test_equals_brute_force(spark, block):
    rng = random.Random(block)
    rows, others = drawn(rng, 200, 90), drawn(rng, 60, 300)
    left = spark.createDataFrame([(k, p, moment(a), moment(b), "kept") for k, (p, a, b) in enumerate(rows)], ROW)
    right = spark.createDataFrame([(p, moment(c), moment(d), 1) for p, c, d in others], OTHER)
    found = mark_overlapping(left, right, ("a", "b"), ("c", "d"), block, "hit")
    assert found.columns == [*left.columns, "hit"]
    got = sorted((r.n, r.hit, r.overlaps) for r in found.collect())
    want = []
    for k, (p, a, b) in enumerate(rows):
        hit = any(p and p == q and None not in (a, b, c, d) and a < d and c < b for q, c, d in others)
        want.append((k, hit, "kept"))
    assert got == want
    anti = sorted(r.n for r in overlap_join(left, right, ("a", "b"), ("c", "d"), block if block > 1 else 5, "left_anti").collect())
    assert anti == [k for k, hit, _ in want if not hit]


def test_nothing_on_either_side(spark):
    none = spark.createDataFrame([], OTHER)
    one = spark.createDataFrame([(1, "p", moment(1), moment(2), "x")], ROW)
    assert [r.hit for r in mark_overlapping(one, none, ("a", "b"), ("c", "d"), 60, "hit").collect()] == [False]
    assert mark_overlapping(one.limit(0), none, ("a", "b"), ("c", "d"), 60, "hit").count() == 0


def test_crowded_intervals_make_no_pairs(spark):
    """Three thousand rows that all overlap three thousand intervals: nine million pairs by a join."""
    left = spark.range(3000).select(F.col("id").cast("int").alias("n"), F.lit("p").alias("patient_id"), F.timestamp_seconds("id").alias("a"), F.timestamp_seconds(F.col("id") + 5000).alias("b"))
    right = spark.range(3000).select(F.lit("p").alias("patient_id"), F.timestamp_seconds(F.col("id") + 1000).alias("c"), F.timestamp_seconds(F.col("id") + 9000).alias("d"))
    found = mark_overlapping(left, right, ("a", "b"), ("c", "d"), 600, "hit")
    assert found.where("hit").count() == 3000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
