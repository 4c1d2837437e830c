"""Power spectral density of evenly sampled signals, by Welch's method.

A series is cut into overlapping segments of equal length; each is freed of its mean, tapered, transformed, and
the squared magnitudes are averaged. Segments are dealt over the cluster, so a long series is spread along its
time; they are transformed many at once by a fast Fourier transform on Arrow batches, and what moves on is one
partial sum per batch and series. The cost of a sample does not depend on the number of frequencies.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def segments_of(samples: DataFrame, keys: Sequence[str], length: int, step: int, index: str = "sample_index", value: str = "voltage") -> DataFrame:
    """keys, segment, values: the stretches of ``length`` samples that begin at each multiple of ``step``.

    A segment is left out unless each of its samples is there once and has a value. Samples are listed with
    each segment that holds them (``length / step`` of them), and a segment is as long as ``length``.
    """
    at = F.col(index)
    newest = F.floor(at / step)
    oldest = F.greatest(F.lit(0), F.floor((at - length) / step) + 1)
    listed = samples.where(at >= 0).select(
        *keys, at.alias("__at"), F.col(value).alias("__value"), F.explode(F.sequence(oldest, newest)).alias("segment")
    )
    place = (F.col("__at") - F.col("segment") * step).cast("int")
    parts = listed.withColumn("__sample", F.struct(place.alias("place"), F.col("__value").alias("value")))
    collected = parts.groupBy(*keys, "segment").agg(F.array_sort(F.collect_list("__sample")).alias("samples"))
    whole = (F.size("samples") == length) & (F.size(F.array_distinct("samples.place")) == length) & ~F.exists("samples.value", lambda v: v.isNull() | F.isnan(v))
    return collected.where(whole).select(*keys, "segment", F.col("samples.value").alias("values"))


def power_density(
    samples: DataFrame,
    rate: float,
    length: int = 1024,
    step: int | None = None,
    keys: Sequence[str] = ("patient_id", "channel"),
    index: str = "sample_index",
    value: str = "voltage",
) -> DataFrame:
    """keys, hertz, segments, density: the mean one-sided density in squared units per hertz, of a periodic Hann
    taper. ``rate`` is in samples a second; segments overlap by half unless ``step`` says otherwise. A series
    without a whole segment has no rows."""
    if length < 2:
        raise ValueError("a segment has two samples at least")
    step = step or max(1, length // 2)
    keys = list(keys)
    taper = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(length) / length)
    scale = np.full(length // 2 + 1, 2.0)
    scale[0] = 1.0
    if length % 2 == 0:
        scale[-1] = 1.0
    scale /= rate * float((taper**2).sum())

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, max(1, (1 << 22) // length)):
                part = batch.slice(begin, max(1, (1 << 22) // length))
                values = part.column("values").flatten().to_numpy().reshape(part.num_rows, length)
                parts = np.fft.rfft((values - values.mean(axis=1, keepdims=True)) * taper, axis=1)
                power = (parts.real**2 + parts.imag**2) * scale
                # The segments of a series that came in this batch are added up here.
                series = pa.Table.from_batches([part.select(keys)]).append_column("__row", pa.array(np.arange(part.num_rows)))
                rows = series.group_by(keys).aggregate([("__row", "list")])
                groups = [np.array(g) for g in rows.column("__row_list").to_pylist()]
                sums = [power[g].sum(axis=0) for g in groups]
                columns = [rows.column(k).combine_chunks() for k in keys]
                counts = pa.array([len(g) for g in groups], pa.int64())
                yield pa.RecordBatch.from_arrays([*columns, counts, pa.array([s.tolist() for s in sums], pa.list_(pa.float64()))], names=[*keys, "n", "sums"])

    cut = segments_of(samples, keys, length, step, index, value).select(*keys, "values")
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in cut.dtypes[:-1])
    partial = cut.mapInArrow(transform, f"{kinds}, n long, sums array<double>")
    by_frequency = partial.select(*keys, "n", F.posexplode("sums").alias("__bin", "__sum"))
    summed = by_frequency.groupBy(*keys, "__bin").agg(F.sum("n").alias("segments"), F.sum("__sum").alias("__total"))
    return summed.select(*keys, (F.col("__bin") * rate / length).alias("hertz"), "segments", (F.col("__total") / F.col("segments")).alias("density"))
