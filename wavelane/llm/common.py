"""What the corpus operators share: word splitting, written intermediates, bounded samples."""

from __future__ import annotations

from collections.abc import Iterator
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelane.session import shared_dir

# The white space that ends a word: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\f\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words(text: Column) -> Column:
    """Words between white space; none for a null or blank text."""
    trimmed = F.btrim(text, F.lit(WHITE))
    nothing = F.array().cast("array<string>")
    return F.when(F.length(trimmed) > 0, F.split(trimmed, WHITE_RUN)).otherwise(nothing)


_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the folder all executors share and read it again: the lineage ends there, so a lost
    executor costs no more than the tasks it ran."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[stored] = path
    return stored


def discard(*tables: DataFrame) -> None:
    """Remove what ``store`` wrote for these tables; others are left alone. For tables of which all that is
    still to be read has itself been stored."""
    for table in tables:
        folder = _FOLDERS.pop(table, None)
        if folder:
            spark = table.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def hashed_sample(df: DataFrame, key: str, rows: int, seed: int = 0) -> DataFrame:
    """About ``rows`` rows at most, chosen by a hash of ``key`` alone: every run takes the same ones.
    Nothing is ordered or collected for it."""
    total = df.count()
    if total <= rows:
        return df
    grain = 1 << 40
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(grain)) < int(grain * rows / total))


def small(table: DataFrame, rows: int = 10_000) -> DataFrame:
    """A stored table of short rows, hinted for broadcast if it was counted to have at most ``rows`` rows;
    beyond that it is joined as any other."""
    return F.broadcast(table) if table.count() <= rows else table


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """One table for each run of rows with equal (integer) ``keys``, whatever batches they came in."""
    held: list[pa.RecordBatch] = []
    last: tuple[int, ...] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy() for k in keys])
        edges = [0, *(np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for begin, stop in zip(edges, edges[1:]):
            key = tuple(values[:, begin].tolist())
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, stop - begin))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def byte_steps(batch: pa.RecordBatch, column: str, size: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of a column, one row at least, so that what a task holds does
    not depend on how many rows a batch has."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    step = np.cumsum(lengths) // size
    edges = [0, *(np.flatnonzero(step[1:] != step[:-1]) + 1).tolist(), batch.num_rows]
    for begin, stop in zip(edges, edges[1:]):
        yield batch.slice(begin, stop - begin)
