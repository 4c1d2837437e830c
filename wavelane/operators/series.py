"""Order-dependent operators that never sort a whole series in one task.

A long series (one patient and channel may hold much of the data) is cut into blocks. Work inside a
block runs as an ordinary window function on (series, block); only per-block edges or counts, a few
rows per block, are then ordered along the whole series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavelane.functions import floor_to, micros


def time_block(moment: str, seconds: int) -> Column:
    """Block number source: the moment cut to a multiple of ``seconds``."""
    return floor_to(micros(F.col(moment)), seconds * 1_000_000)


def find_gaps(
    features: DataFrame, block_seconds: int, keys: Sequence[str] = ("patient_id", "channel")
) -> DataFrame:
    """Windows that do not start where the previous window of their series ended.

    Returns keys, ``window_start`` and ``prev_end``. A null previous end is no gap. Windows are ordered
    by start, equal starts by end.
    """
    keys = list(keys)
    order = ["window_start", "window_end"]
    within = Window.partitionBy(*keys, "__block").orderBy(*order)
    along = Window.partitionBy(*keys).orderBy(*order, F.desc("__first"))

    blocked = features.select(
        *keys, *order, time_block("window_start", block_seconds).alias("__block")
    )
    placed = blocked.select(
        *keys,
        *order,
        F.lag("window_end").over(within).alias("prev_end"),
        F.lag(F.lit(1)).over(within).isNull().alias("__first"),
        F.lead(F.lit(1)).over(within).isNull().alias("__last"),
    )
    inside = placed.where(~F.col("__first"))
    edges = placed.where(F.col("__first") | F.col("__last"))
    between = edges.withColumn("prev_end", F.lag("window_end").over(along)).where("__first")
    return (
        inside.unionByName(between)
        .where(F.col("prev_end").isNotNull() & (F.col("window_start") != F.col("prev_end")))
        .select(*keys, "window_start", "prev_end")
    )


def number_within(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    block: Column,
    into: str,
    total: str | None = None,
) -> DataFrame:
    """Number the rows of each key from 0 in ``order``, like ``row_number`` but block by block.

    ``block`` must not be null nor decrease along ``order``. Null keys form a group of their own. ``total`` names a
    column for the number of rows of the key.
    """
    # As text, null is a key like others: the join is on plain equality and needs the partitioning that the
    # window has made, so the rows move once.
    texts = {
        f"__key_{number}": F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("null"))
        for number, name in enumerate(keys)
    }
    keys = list(texts)
    grouping = [*keys, "__block"]
    blocked = rows.withColumns({**texts, "__block": block})
    numbered = blocked.withColumn(
        "__place", F.row_number().over(Window.partitionBy(*grouping).orderBy(*order)) - 1
    )
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocked.groupBy(*grouping).agg(F.count("*").alias("__size"))
    offsets = sizes.select(
        *grouping,
        F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__offset"),
        F.sum("__size").over(whole).alias("__total"),
    )
    placed = numbered.join(offsets, grouping)
    counted = {into: F.col("__offset") + F.col("__place")}
    if total:
        counted[total] = F.col("__total")
    return placed.select(*rows.columns, *[value.alias(name) for name, value in counted.items()])
