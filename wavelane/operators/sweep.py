"""Whether intervals overlap any other, without pairing them.

A row overlaps some other interval if, of those that start before the row ends, the latest end lies after the
row's start. So one ordered pass with a running maximum answers it for all rows, however many intervals each
one overlaps. The pass is cut into time blocks: inside a block the maximum runs over its own rows, and of earlier
blocks a single maximum per block is carried on. A key with much of the data is spread over its time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavelane.functions import floor_to, micros

Span = tuple[str, str]


def mark_overlapping(
    rows: DataFrame,
    others: DataFrame,
    span: Span,
    others_span: Span,
    block_seconds: int,
    into: str = "overlaps",
    key: str = "patient_id",
) -> DataFrame:
    """``rows`` with a column that says whether a row's half-open span shares time with one of ``others`` of
    the same ``key``. Null keys, starts and ends overlap nothing; every row stays, repeated ones too."""
    start, end = (micros(F.col(name)) for name in span)
    first, last = (micros(F.col(name)) for name in others_span)
    asked = rows.select(
        F.col(key).alias("__key"), F.struct(*rows.columns).alias("__row"), end.alias("__at"), start.alias("__start"), F.lit(0).alias("__kind")
    )
    given = others.where(F.col(key).isNotNull() & first.isNotNull() & last.isNotNull()).select(
        F.col(key).alias("__key"), first.alias("__at"), last.alias("__until"), F.lit(1).alias("__kind")
    )
    # Of equal moments a row's end comes first: an interval that starts there does not overlap it.
    block = floor_to(F.col("__at"), block_seconds * 1_000_000)
    events = asked.unionByName(given, allowMissingColumns=True).withColumn("__block", block)
    order = Window.partitionBy("__key", "__block").orderBy("__at", "__kind")
    running = events.withColumn("__reach", F.max("__until").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    along = Window.partitionBy("__key").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = events.where("__key is not null").groupBy("__key", "__block").agg(F.max("__until").alias("__until"))
    before = blocks.select("__key", "__block", F.max("__until").over(along).alias("__before"))
    reach = F.greatest("__reach", "__before")  # of the one that is known
    found = F.coalesce(F.col("__key").isNotNull() & (reach > F.col("__start")), F.lit(False))
    placed = running.where("__kind = 0").join(before, ["__key", "__block"], "left")
    return placed.select("__row.*", found.alias(into))
