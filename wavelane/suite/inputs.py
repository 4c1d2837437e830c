"""The domain tables as seen through the given star-schema tables.

One patient per user, one channel per event type, so that everything grows with ``events``. Events are
sparse, so windows are a week and the limits are scaled to the values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelane.operators.features import alerts_only, label_alerts, window_features
from wavelane.operators.series import number_within, time_block
from wavelane.params import MonitorParams
from wavelane.session import configure

DAY = 24 * 3600

WATCH = MonitorParams(
    window="7 days",
    spike_volts=100,
    spike_limit=1,
    variance_limit=100,
    sampling_rate=2.0**-18,
    volts_limit=300,
    channels=("click", "purchase", "signup", "view"),
    rows_per_window=5,
    channel_count_keys=("patient_id", "window_start"),
    pad_seconds=1800,
    cell_seconds=7 * DAY,
    block_seconds=14 * DAY,
)


# Declared, so that planning opens no file.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, patient_id, channel, event_time, voltage: one row per event."""
    user, value = F.col("user_id"), F.col("value")
    zero = F.when(user < 10, "0").otherwise("")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("chb"), zero, user.cast("string")).alias("patient_id"),
        F.col("event_type").alias("channel"),
        F.col("ts").alias("event_time"),
        F.when(F.col("event_id") % 2 == 0, value).otherwise(-value).alias("voltage"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_features(readings(spark, sf_dir), WATCH)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_alerts(features(spark, sf_dir), WATCH)


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts_only(labelled(spark, sf_dir))


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled interval starts at each large error event and lasts its value in minutes."""
    minutes = F.make_dt_interval(mins=F.abs("voltage").cast("int"))
    return (
        readings(spark, sf_dir)
        .where((F.col("channel") == "error") & (F.abs("voltage") > 150))
        .select(
            "patient_id",
            F.concat(F.lit("chb_rec_"), F.col("event_id").cast("string")).alias("recording_file"),
            F.col("event_time").alias("seizure_start_ms"),
            (F.col("event_time") + minutes).alias("seizure_end_ms"),
        )
    )


def indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of a day and channel numbered in time order; the day is the message time."""
    day = F.date_trunc("day", F.col("event_time").cast("timestamp"))
    dated = readings(spark, sf_dir).withColumn("timestamp_ms", F.unix_millis(day))
    numbered = number_within(
        dated,
        ["patient_id", "timestamp_ms", "channel"],
        ["event_time", "event_id"],
        time_block("event_time", 3600),
        "sample_index",
    )
    return numbered.withColumn("sample_index", F.col("sample_index").cast("int"))


def part_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as channel labels: the brand is the recording, the part key the position."""
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("recording"),
        F.col("p_partkey").alias("position"),
        F.col("p_name").alias("label"),
    )
