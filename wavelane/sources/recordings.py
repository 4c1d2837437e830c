"""Binary multi-channel recordings in the European Data Format (public specification).

A file is a text header, one fixed-width header per signal, then data records; a record holds a run of
16-bit little-endian samples of each signal in turn. Headers, record cutting and scaling are native
expressions; only the bytes-to-integers step runs in Python, on Arrow batches.

Files are the unit of the scan; after it the data travels as one row per record and signal. Files must
fit the 2 GiB limit of a binary column.
"""


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ShortType

from wavelane.functions import suffix_repeats
from wavelane.sources.annotations import PATIENT_IN_FILE_NAME, folder_of

# Fixed values of the format: byte offsets and widths of the main header fields ...
START_DATE, START_TIME, HEADER_BYTES = (168, 8), (176, 8), (184, 8)
RECORD_COUNT, RECORD_SECONDS, SIGNAL_COUNT = (236, 8), (244, 8), (252, 4)
MAIN_HEADER = SIGNAL_HEADER = 256
# ... offsets and widths inside the signal headers, to be multiplied by the number of signals ...
LABEL, UNIT = (0, 16), (96, 8)
PHYSICAL_MIN, PHYSICAL_MAX, DIGITAL_MIN, DIGITAL_MAX = (104, 8), (112, 8), (120, 8), (128, 8)
SAMPLES_PER_RECORD = (216, 8)
# ... the label of a signal that holds text instead of samples, and units in volts.
TEXT_SIGNAL = "EDF Annotations"
UNITS = {"uv": 1e-6, "µv": 1e-6, "mv": 1e-3, "v": 1.0}
# Two-digit years below this one are in the 2000s, others in the 1900s.
PIVOT_YEAR = 85


def read_recordings(spark: SparkSession, path: str, glob: str = "*.edf") -> DataFrame:
    """Recording files: folder, recording_file, content."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return files.select(
        folder_of(F.col("path")).alias("folder"),
        F.regexp_extract("path", r"([^/]*)$", 1).alias("recording_file"),
        "content",
    )


def _text(offset: Column | int, width: int, source: str = "content") -> Column:
    start = offset + 1 if isinstance(offset, int) else offset + F.lit(1)
    return F.trim(F.substring(source, start, width).cast("string"))


def _number(field: tuple[int, int], kind: str) -> Column:
    return _text(*field).try_cast(kind)


def _start_time() -> Column:
    day = F.regexp_replace(_text(*START_DATE), " ", "0")
    clock = F.regexp_replace(_text(*START_TIME), " ", "0")
    parsed = F.try_to_timestamp(F.concat(day, clock), F.lit("dd.MM.yyHH.mm.ss"))
    century = F.when(F.year(parsed) >= 2000 + PIVOT_YEAR, 100).otherwise(0)
    return parsed - F.make_ym_interval(century)


def recording_headers(files: DataFrame) -> DataFrame:
    """One row per recording: when it started, how it is laid out. Other columns are kept.

    Signals are ``signals``, an array of structs in file order, without text signals; sampling_rate is
    that of the first. Only the head of the content is looked at, as a column of its own: array
    functions take a copy of the binary they read at each use.
    """
    kept = files.columns
    signal_count = _number(SIGNAL_COUNT, "int")
    main = files.where(signal_count > 0).select(
        *kept,
        _start_time().alias("started_at"),
        _number(HEADER_BYTES, "int").alias("header_bytes"),
        _number(RECORD_COUNT, "bigint").alias("records"),
        _number(RECORD_SECONDS, "double").alias("record_seconds"),
        signal_count.alias("__count"),
        F.substring("content", F.lit(1), MAIN_HEADER + SIGNAL_HEADER * signal_count).alias("__head"),
    )
    indexes = F.sequence(F.lit(0), F.col("__count") - 1)

    def of_signal(field: tuple[int, int], index: Column) -> Column:
        offset, width = field
        return _text(F.lit(MAIN_HEADER) + F.col("__count") * offset + index * width, width, "__head")

    listed = main.withColumns(
        {
            "__labels": F.transform(indexes, lambda i: of_signal(LABEL, i)),
            "__samples": F.transform(
                indexes,
                lambda i: F.coalesce(of_signal(SAMPLES_PER_RECORD, i).try_cast("int"), F.lit(0)),
            ),
        }
    )
    units = F.create_map(*[F.lit(x) for pair in UNITS.items() for x in pair])

    def signal(index: Column) -> Column:
        def number(field: tuple[int, int]) -> Column:
            return of_signal(field, index).try_cast("double")

        in_volts = F.coalesce(F.element_at(units, F.lower(of_signal(UNIT, index))), F.lit(1.0))
        gain = F.try_divide(
            number(PHYSICAL_MAX) - number(PHYSICAL_MIN), number(DIGITAL_MAX) - number(DIGITAL_MIN)
        )
        bias = number(PHYSICAL_MIN) - number(DIGITAL_MIN) * gain
        return F.struct(
            F.element_at("__labels", index + 1).alias("label"),
            F.element_at("__samples", index + 1).alias("samples"),
            _total(F.slice("__samples", 1, index)).alias("offset"),
            (gain * in_volts).alias("gain"),
            (bias * in_volts).alias("bias"),
        )

    described = listed.withColumns(
        {
            "__signals": F.filter(
                F.transform(indexes, signal), lambda one: one["label"] != TEXT_SIGNAL
            ),
            "record_bytes": _total(F.col("__samples")) * 2,
        }
    ).withColumn("__channels", F.col("__signals.label"))
    # A negative number of records means that it was never written: as many as the bytes make.
    there = F.try_divide(F.length("content") - F.col("header_bytes"), F.col("record_bytes"))
    described = described.withColumn(
        "records",
        F.when(F.col("records") < 0, F.greatest(F.floor(there), F.lit(0))).otherwise(F.col("records")),
    )
    named = F.zip_with(
        "__signals",
        suffix_repeats(F.col("__channels")),
        lambda one, channel: one.withField("channel", channel),
    )
    return described.select(
        *[name for name in kept if name != "content"],
        F.regexp_extract("recording_file", PATIENT_IN_FILE_NAME, 1).alias("patient_id"),
        "started_at",
        "header_bytes",
        "records",
        "record_seconds",
        F.try_divide(F.get("__signals", F.lit(0))["samples"], F.col("record_seconds")).alias(
            "sampling_rate"
        ),
        named.alias("signals"),
        "record_bytes",
        "content",
    )


def recording_problems(files: DataFrame) -> DataFrame:
    """recording_file and what is wrong with it, for files that can't be read or not to their end.

    ``header``: no usable header, so the file gives no samples. ``scale``: a signal without usable limits,
    its voltages are null. ``open``: the header states no number of records (as in a file that was not
    closed), all that are there are read. ``cut``: fewer bytes than stated, those that are there are read.
    """
    headers = recording_headers(files)
    stated = headers.join(
        files.select("recording_file", _number(RECORD_COUNT, "bigint").alias("stated")), "recording_file"
    )
    body = F.length("content") - F.col("header_bytes")
    problem = (
        F.when(~_readable(), "header")
        .when(F.exists("signals", lambda one: one["gain"].isNull()), "scale")
        .when(F.col("stated") < 0, "open")
        .when(body < F.col("records") * F.col("record_bytes"), "cut")
    )
    found = stated.select("recording_file", problem.alias("problem")).where("problem is not null")
    headless = files.where(~F.coalesce(_number(SIGNAL_COUNT, "int") > 0, F.lit(False)))
    return found.union(headless.select("recording_file", F.lit("header").alias("problem")))


def _readable() -> Column:
    return F.coalesce(
        (F.col("header_bytes") > 0)
        & (F.col("record_bytes") > 0)
        & (F.col("record_seconds") > 0)
        & F.col("records").isNotNull()
        & F.col("started_at").isNotNull(),
        F.lit(False),
    )


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda total, number: total + number)


def _with_shorts(records: DataFrame, binary: str) -> DataFrame:
    """Replace a binary column, put last, by its little-endian 16-bit integers.

    Every binary must have an even length: the bytes of a batch lie in one buffer, and one odd length would
    shift all that follow. Works on whole Arrow batches without copying or looping.
    The function is nested, so that it is sent to workers by value and they need not have this package.
    """
    schema = records.drop(binary).schema.add(binary, ArrayType(ShortType()))

    def decode(batches):
        for batch in batches:
            raw = batch.column(batch.num_columns - 1).cast(pa.large_binary())
            _, places, data = raw.buffers()
            offsets = np.frombuffer(places, "<i8")[raw.offset : raw.offset + len(raw) + 1] // 2
            values = np.frombuffer(data, "<i2", count=offsets[-1]) if data else np.empty(0, "<i2")
            lists = pa.LargeListArray.from_arrays(offsets, values).cast(pa.list_(pa.int16()))
            columns = [*batch.columns[:-1], lists]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return records.select(*schema.names).mapInArrow(decode, schema)


def recording_samples(files: DataFrame) -> DataFrame:
    """All samples as readings in volts: one row per recording, channel and sample.

    A file is cut into its records right after the scan, so what moves on is a record (a few kilobytes),
    never a file. The outer generators keep Spark from inferring filters that would parse the headers a
    second time. Of a record that is cut, the whole samples that are there are read.
    """
    headers = recording_headers(files).where(_readable() & (F.col("records") > 0))
    described = ["patient_id", "recording_file", "started_at", "record_seconds"]
    numbered = headers.select(
        *described,
        "signals",
        "content",
        "header_bytes",
        "record_bytes",
        F.explode_outer(F.sequence(F.lit(0).cast("bigint"), F.col("records") - 1)).alias("record"),
    )
    begin = F.col("header_bytes") + F.col("record") * F.col("record_bytes") + 1
    # Only the last bytes of a cut file can be odd in number.
    odd = F.greatest(F.least(F.length("content") - begin + 1, F.col("record_bytes")), F.lit(0)) % 2
    odd = F.when(odd == 1, F.col("record_bytes") - (F.length("content") - begin)).otherwise(0).cast("int")
    bodies = numbered.select(
        *described,
        "signals",
        "record",
        F.substring("content", begin.cast("int"), F.col("record_bytes") - odd).alias("body"),
    )
    decoded = _with_shorts(bodies, "body")
    chunks = decoded.select(*described, "record", "body", F.inline_outer("signals")).select(
        *described,
        "record",
        "channel",
        "samples",
        "gain",
        "bias",
        F.slice("body", F.col("offset") + 1, F.col("samples")).alias("digital"),
    )
    values = chunks.select(
        *described, "record", "channel", "samples", "gain", "bias", F.posexplode_outer("digital")
    ).where("pos is not null")
    index = F.col("record") * F.col("samples") + F.col("pos")
    offset_ms = F.floor(index * 1000 * F.col("record_seconds") / F.col("samples"))
    stamped = values.select(
        "patient_id",
        "recording_file",
        (F.unix_millis("started_at") + offset_ms).alias("timestamp_ms"),
        index.cast("int").alias("sample_index"),
        "channel",
        (F.col("col") * F.col("gain") + F.col("bias")).alias("voltage"),
    )
    return stamped.withColumn("event_time", F.timestamp_millis("timestamp_ms"))
