"""Stored tables: whole scans, staging views, single-partition scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored table. ``fmt`` may be any format on the classpath, such as ``delta``."""
    return spark.read.format(fmt).load(path)


def stage(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> None:
    """Register stored tables as temp views, so that SQL reads them by name."""
    for name, path in paths.items():
        read_table(spark, path, fmt).createOrReplaceTempView(name)


def read_partition(
    spark: SparkSession, path: str, patient_id: str, event_date: str, fmt: str = "parquet"
) -> DataFrame:
    """One patient's day. Both filters are on partition columns, so other folders are not opened."""
    return of_patient_day(read_table(spark, path, fmt), patient_id, event_date)


def of_patient_day(table: DataFrame, patient_id: str, event_date: str) -> DataFrame:
    """One patient's day of a table. Of one that is partitioned by date and bucketed by patient
    (``save_bucketed``) this opens one file: the date's of the patient's bucket."""
    return table.where(
        (F.col("patient_id") == patient_id) & (F.col("event_date") == F.lit(event_date).cast("date"))
    )
