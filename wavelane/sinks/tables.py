"""Writing tables: append, replace, conditional delete."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_
from string import printable
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wavelane.session import shared_dir

# A folder per patient and day suits few patients with much data each; with very many patients, pass
# just the date as ``partition_by``, or store the table by ``save_bucketed``.
PARTITION_COLUMNS = ("patient_id", "event_date")


def append_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = PARTITION_COLUMNS,
) -> None:
    """Append by partition folder. AQE sizes the write tasks: a patient with much data is split over
    several tasks, small ones share a task, and a folder gets few files."""
    _write(df, path, fmt, partition_by, "append")


def replace_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Replace a table's whole content. ``df`` must not read from ``path``."""
    _write(df, path, fmt, partition_by, "overwrite")


def save_mart(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Materialise a mart as a catalog table."""
    df.write.format(fmt).mode("overwrite").saveAsTable(name)


def _write(df: DataFrame, path: str, fmt: str, partition_by: Sequence[str], mode: str) -> None:
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.format(fmt).mode(mode).partitionBy(*partition_by).save(path)


def save_bucketed(
    df: DataFrame,
    name: str,
    buckets: int,
    keys: Sequence[str] = ("patient_id",),
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    fmt: str = "parquet",
    mode: str = "overwrite",
) -> None:
    """Store a catalog table whose rows lie in ``buckets`` files by a hash of ``keys``, however many keys there are.

    A scan for one key opens one bucket, and tables with as many buckets of the same keys are joined and grouped
    by them without a shuffle. Rows are dealt the way they are stored, so each task writes one file per
    partition. Choose ``buckets`` for the table's size: a bucket is read by one task.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.format(fmt).mode(mode).partitionBy(*partition_by).bucketBy(buckets, *keys).sortBy(*(sort_by or keys)).saveAsTable(name)


MARKER = "_deleting"


def delete_where(
    spark: SparkSession,
    path: str,
    condition: Column,
    fmt: str = "parquet",
    partition_by: Sequence[str] = PARTITION_COLUMNS,
) -> None:
    """Delete the rows on which ``condition`` is true; rows on which it is null stay.

    Delta does it itself. A file table gets only the touched partitions rewritten: their kept rows and the
    list of files of partitions without kept rows are written aside to the shared folder; a marker in the
    table's folder says where; then the kept rows are put in place of the old partitions, the listed files are
    removed by tasks, and the marker goes last. Every kept row exists in full at any time. A run that stops
    after the marker is there is finished by ``finish_delete``, which the next call does first. Not for tables
    under concurrent writes.
    """
    if fmt == "delta":
        from delta.tables import DeltaTable

        DeltaTable.forPath(spark, path).delete(condition)
        return
    finish_delete(spark, path, fmt, partition_by)
    table = spark.read.format(fmt).load(path)
    hit = F.coalesce(condition, F.lit(False))
    touched = table.where(hit).select(*[F.col(c).alias(f"__{c}") for c in partition_by]).distinct()
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in partition_by])
    aside, emptied = shared_dir(spark, "kept"), shared_dir(spark, "emptied")
    table.join(touched, same, "left_semi").where(~hit).write.format(fmt).partitionBy(
        *partition_by
    ).save(aside)
    kept = spark.read.format(fmt).schema(table.schema).load(aside)
    _files_without_kept_rows(table, hit, kept, partition_by).write.parquet(emptied)
    marker = spark.createDataFrame([(aside, emptied, table.schema.json())], "aside string, emptied string, columns string")
    marker.write.json(f"{path}/{MARKER}")
    finish_delete(spark, path, fmt, partition_by)


def finish_delete(spark: SparkSession, path: str, fmt: str = "parquet", partition_by: Sequence[str] = PARTITION_COLUMNS) -> bool:
    """Do what is left of a delete that was stopped; says whether there was one. May be stopped and called
    again itself: each step gives the same when it is repeated."""
    if not _exists(spark, f"{path}/{MARKER}/_SUCCESS"):
        return False
    pending = spark.read.schema("aside string, emptied string, columns string").json(f"{path}/{MARKER}").first()
    kept = spark.read.format(fmt).schema(StructType.fromJson(json.loads(pending["columns"]))).load(pending["aside"])
    kept.hint("rebalance", *partition_by).write.format(fmt).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*partition_by).save(path)
    _remove_files(spark.read.schema("file string").parquet(pending["emptied"]))
    _remove(spark, f"{path}/{MARKER}")
    return True


def _files_without_kept_rows(
    table: DataFrame, hit: Column, kept: DataFrame, partition_by: Sequence[str]
) -> DataFrame:
    """Files of partitions in which every row is deleted."""
    located = table.where(hit).select(*partition_by, F.col("_metadata.file_path").alias("file")).distinct()
    remaining = kept.select(*[F.col(c).alias(f"__{c}") for c in partition_by]).distinct()
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in partition_by])
    return located.join(remaining, same, "left_anti").select("file")


def _remove_files(listed: DataFrame) -> None:
    """Remove files, and the folders that have none left. A folder's files are removed by one task."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs

        removed = 0
        for batch in batches:
            for uri in batch.column("file").to_pylist():
                uri = uri if "://" in uri else uri.replace("file:", "file://", 1)
                files, place = pafs.FileSystem.from_uri(quote(uri, safe=printable))  # other letters stand as they are
                folder, _, name = place.rpartition("/")
                # Local file systems keep a checksum beside each file.
                for one in (place, f"{folder}/.{name}.crc"):
                    if files.get_file_info(one).is_file:
                        files.delete_file(one)
                        removed += 1
                if files.get_file_info(folder).type == pafs.FileType.Directory and not files.get_file_info(pafs.FileSelector(folder)):
                    files.delete_dir(folder)
        yield pa.RecordBatch.from_arrays([pa.array([removed], pa.int64())], names=["removed"])

    folder = F.regexp_replace("file", r"/[^/]*$", "")
    dealt = listed.withColumn("folder", folder).repartition("folder").sortWithinPartitions("folder")
    dealt.select("file").mapInArrow(remove, "removed long").write.format("noop").mode("overwrite").save()


def _hadoop_path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, name: str) -> bool:
    path, files = _hadoop_path(spark, name)
    return files.exists(path)


def _remove(spark: SparkSession, folder: str) -> None:
    path, files = _hadoop_path(spark, folder)
    files.delete(path, True)
