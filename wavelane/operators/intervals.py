"""Interval joins on a time grid.

Joining intervals on the patient alone compares every pair of a patient's rows, and puts a busy
patient into one task. Here both sides also carry a grid cell, so that the equi key is
(patient, level, cell) and a busy patient spreads over its recorded time:

* a left row sits in exactly one cell, that of its start, at the first grid level whose cells are at
  least as long as the row;
* a right row is listed in every cell, at each level, where an overlapping left row could start.

So each overlapping pair meets in exactly one cell: no pair is found twice, none is lost, and
anti and semi joins work on the same key. Only the right side is multiplied: about three rows per
level plus its length in base cells, so the usual choice is the label table. If it holds a row of over
``LEVEL_STEP`` cells (a label that was never ended), it is listed only where left rows of a level are:
one aggregate finds their first and last moment per level. Rows without a start or end overlap nothing
and are not placed. Both sides go through a shuffle unless AQE measures one small enough to broadcast;
AQE also splits hot cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavelane.functions import overlaps

LEVEL_STEP = 64
MICROS = 1_000_000
# No two moments that a timestamp can hold are farther apart, in microseconds.
WIDEST = 10_000 * 366 * 86_400 * MICROS

Span = tuple[str, str]


def _grid(cell_seconds: int, longest: int | None) -> tuple[list[int], list[int]]:
    """Cell width and longest left row per level, in microseconds."""
    if longest is not None:
        return [cell_seconds * MICROS], [longest]
    widths = [cell_seconds * MICROS]
    while widths[-1] < WIDEST:
        widths.append(min(widths[-1] * LEVEL_STEP, WIDEST))
    return widths, widths


def _micros(name: str) -> str:
    return f"unix_micros(cast(`{name}` as timestamp))"


def _cell(moment: str, width: int) -> str:
    return f"({moment} - pmod({moment}, {width}L))"


def _with_own_cell(left: DataFrame, span: Span, widths: list[int], bounded: bool) -> DataFrame:
    start, end = map(_micros, span)
    if bounded:
        return left.withColumns({"__level": F.lit(0), "__cell": F.expr(_cell(start, widths[0]))})
    fits = [f"when {end} - {start} <= {width}L then" for width in widths]
    levels = " ".join(f"{fit} {number}" for number, fit in enumerate(fits))
    cells = " ".join(f"{fit} {_cell(start, width)}" for fit, width in zip(fits, widths))
    return left.withColumns(
        {
            "__level": F.expr(f"case {levels} end"),
            "__cell": F.expr(f"case {cells} end"),
        }
    )


def _with_reachable_cells(
    right: DataFrame, span: Span, widths: list[int], reach: list[int], used: dict | None
) -> DataFrame:
    """``used``: first start and last end of the left rows per level, if the listing is to be cut to them."""
    start, end = map(_micros, span)
    listed = ["cast(array() as array<struct<__level:int,__cell:bigint>>)"]
    for number, (width, longest) in enumerate(zip(widths, reach)):
        begin, stop = f"({start} - {longest}L)", end
        if used is not None:
            if number not in used:
                continue
            low, high = used[number]
            begin, stop = f"greatest({begin}, {low}L)", f"least({stop}, {high}L)"
        first, last = _cell(begin, width), _cell(stop, width)
        cells = f"if({begin} <= {stop}, sequence({first}, {last}, {width}L), cast(array() as array<bigint>))"
        listed.append(f"transform({cells}, c -> struct({number} as __level, c as __cell))")
    placed = right.where(F.col(span[0]).isNotNull() & F.col(span[1]).isNotNull())
    return placed.select("*", F.expr(f"inline(concat({', '.join(listed)}))"))


def _levels_in_use(placed: DataFrame, span: Span, right: DataFrame, right_span: Span, widths: list[int]) -> dict | None:
    """Where left rows are, per level; None if no right row is long enough to need it."""
    start, end = map(_micros, right_span)
    longest = right.agg(F.max(F.expr(f"{end} - {start}")).alias("longest")).first()["longest"]
    if longest is None or longest <= LEVEL_STEP * widths[0]:
        return None
    start, end = map(_micros, span)
    rows = placed.where("__level is not null").groupBy("__level").agg(F.min(F.expr(start)).alias("low"), F.max(F.expr(end)).alias("high"))
    return {row["__level"]: (row["low"], row["high"]) for row in rows.collect()}


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_span: Span,
    right_span: Span,
    cell_seconds: int,
    how: str = "inner",
    key: str = "patient_id",
    longest_micros: int | None = None,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Rows of equal ``key`` whose half-open spans share time; ``how`` is inner, left_semi or left_anti.

    Inner results carry the left columns and the right ones except ``key``; other names must differ.
    Any duration is handled on both sides. ``longest_micros`` may state that left rows are never
    longer (samples, for instance); then one grid level is enough. ``broadcast_bytes`` asks for a
    broadcast of the listed right side if it measures at most that, else shuffles.
    """
    bounded = longest_micros is not None
    widths, reach = _grid(cell_seconds, longest_micros)
    placed = _with_own_cell(left, left_span, widths, bounded)
    used = _levels_in_use(placed, left_span, right, right_span, widths)
    listed = _with_reachable_cells(right, right_span, widths, reach, used)
    if how != "inner":
        listed = listed.select(key, *right_span, "__level", "__cell")
    listed = listed.withColumnsRenamed(
        {name: f"__right_{name}" for name in (key, "__level", "__cell")}
    )
    # The table itself first: one that is too large need not be listed to know.
    if broadcast_bytes is not None and measured_bytes(right) <= broadcast_bytes:
        listed = broadcast_if_small(listed, broadcast_bytes)
    matching = (
        (F.col(key) == F.col(f"__right_{key}"))
        & (F.col("__level") == F.col("__right___level"))
        & (F.col("__cell") == F.col("__right___cell"))
        & overlaps(*map(F.col, (*left_span, *right_span)))
    )
    joined = placed.join(listed, matching, how)
    return joined.drop("__level", "__cell", "__right___level", "__right___cell", f"__right_{key}")


def broadcast_if_small(side: DataFrame, max_bytes: int) -> DataFrame:
    """Hint a broadcast only if the side's values measure at most ``max_bytes``; else it joins by shuffle."""
    return F.broadcast(side) if measured_bytes(side) <= max_bytes else side


def measured_bytes(side: DataFrame) -> int:
    """Eight bytes per value plus the rows as text, so that strings, arrays, maps and structs count with what
    they hold: one aggregate with partial sums in every task."""
    text = F.to_json(F.struct(*[F.col(f"`{name}`") for name in side.columns]))
    row = F.octet_length(text) + F.lit(8 * len(side.columns))
    return side.agg(F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).first()["bytes"]


def slice_around(
    readings: DataFrame,
    labelled: DataFrame,
    labelled_span: Span,
    pad_seconds: int,
    cell_seconds: int,
    broadcast_bytes: int | None = 64 * 1024**2,
) -> DataFrame:
    """Readings from ``pad_seconds`` before a labelled interval to as long after its end.

    A reading within reach of two intervals comes out once for each. Readings never move if the
    padded labels are few; otherwise both sides meet on (patient, cell).
    """
    start, end = labelled_span
    pad = F.make_dt_interval(secs=F.lit(pad_seconds))
    padded = labelled.withColumns({"__from": F.col(start) - pad, "__to": F.col(end) + pad})
    instants = readings.withColumn(
        "__until", F.col("event_time") + F.make_dt_interval(secs=F.lit(0.000001))
    )
    joined = overlap_join(
        instants,
        padded,
        ("event_time", "__until"),
        ("__from", "__to"),
        cell_seconds,
        longest_micros=1,
        broadcast_bytes=broadcast_bytes,
    )
    return joined.drop("__until", "__from", "__to")
