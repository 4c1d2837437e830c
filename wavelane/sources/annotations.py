"""Labelled intervals from summary texts.

A text has one block per recording, beginning with a ``File Name`` line. By position, the first line
names the recording, the fourth gives the number of intervals, and the lines after it (blank ones aside)
give start and end in seconds from the start of the recording, two lines an interval. Values follow the
first colon of a line. A line that is no number spoils its own interval only, and is reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# How blocks begin, and on which line (from 1) their parts stand.
BLOCK_START = r"(?m)^(?=File Name)"
NAME_LINE, COUNT_LINE, FIRST_TIME_LINE = 1, 4, 5
PATIENT_IN_FILE_NAME = r"^(chb\d+)"


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """Summary texts, one row per file: folder, value."""
    texts = spark.read.text(path, wholetext=True)
    return texts.select(folder_of(F.col("_metadata.file_path")).alias("folder"), "value")


def folder_of(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


def parse_summaries(
    summaries: DataFrame, patient_pattern: str = PATIENT_IN_FILE_NAME, text: str = "value"
) -> DataFrame:
    """Every labelled interval of every block; other columns of the input are kept.

    Adds patient_id, recording_file, start_second, end_second. Blocks that state 0 intervals, and texts
    without blocks, give no row; intervals that can't be read are in ``summary_problems``.
    """
    return _stated_intervals(summaries, patient_pattern, text).where(
        "start_second is not null and end_second is not null"
    ).drop("interval")


def summary_problems(
    summaries: DataFrame, patient_pattern: str = PATIENT_IN_FILE_NAME, text: str = "value"
) -> DataFrame:
    """Stated intervals whose start or end is missing or no number: patient_id, recording_file, interval
    (from 1), and what could be read of them; other columns of the input are kept."""
    return _stated_intervals(summaries, patient_pattern, text).where(
        "start_second is null or end_second is null"
    )


def _stated_intervals(summaries: DataFrame, patient_pattern: str, text: str) -> DataFrame:
    kept = [name for name in summaries.columns if name != text]
    blocks = summaries.select(*kept, F.explode(F.split(text, BLOCK_START)).alias("block"))
    lines = blocks.where(F.col("block").startswith("File Name")).select(
        *kept, F.split("block", r"\R").alias("lines")
    )
    value = F.regexp_extract(F.get("lines", F.lit(NAME_LINE - 1)), r":(.*)", 1)
    stated = F.regexp_extract(F.get("lines", F.lit(COUNT_LINE - 1)), r":\s*(\d+)", 1)
    rest = F.slice("lines", FIRST_TIME_LINE, F.greatest(F.size("lines"), F.lit(1)))
    seconds = F.transform(
        F.filter(rest, lambda line: F.trim(line) != ""),
        lambda line: F.regexp_extract(line, r":\s*(\d+)", 1).try_cast("bigint"),
    )
    numbered = lines.select(
        *kept,
        F.trim(value).alias("recording_file"),
        F.coalesce(stated.try_cast("int"), F.lit(0)).alias("__stated"),
        seconds.alias("__seconds"),
    ).where("__stated > 0")
    # A number of intervals beyond the lines there are is one unreadable interval, not a row for each.
    listed = F.ceil(F.size("__seconds") / 2).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(1), F.least("__stated", listed + 1)),
        lambda n: F.struct(
            n.alias("interval"),
            F.get("__seconds", n * 2 - 2).alias("start_second"),
            F.get("__seconds", n * 2 - 1).alias("end_second"),
        ),
    )
    return numbered.select(
        *kept,
        F.regexp_extract("recording_file", patient_pattern, 1).alias("patient_id"),
        "recording_file",
        F.inline(pairs),
    )


def annotations_from(
    intervals: DataFrame, headers: DataFrame, on: tuple[str, ...] = ("folder", "recording_file")
) -> DataFrame:
    """Intervals in seconds to intervals in time. Recordings without a header are left out.

    ``headers`` has the ``on`` columns and ``started_at``, one row per recording.
    """
    joined = intervals.join(headers.select(*on, "started_at"), list(on))

    def moment(second: str) -> Column:
        return F.col("started_at") + F.make_dt_interval(secs=F.col(second))

    return joined.select(
        "patient_id",
        "recording_file",
        moment("start_second").alias("seizure_start_ms"),
        moment("end_second").alias("seizure_end_ms"),
    )
