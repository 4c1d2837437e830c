"""The live monitor: messages in, features and alerts out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from wavelane.operators.features import alerts_only, label_alerts, window_features
from wavelane.operators.readings import parse_messages
from wavelane.params import MonitorParams
from wavelane.sinks.tables import PARTITION_COLUMNS
from wavelane.sources.tables import read_table

BATCH_COLUMN = "batch_id"


def live_features(messages: DataFrame, params: MonitorParams) -> DataFrame:
    """Labelled window features of a message stream (or of a stored set of messages)."""
    return label_alerts(window_features(parse_messages(messages), params), params)


class FanOut:
    """Writes each micro-batch twice: all windows to features, alerting ones to alerts.

    Safe to replay. A file table keeps feed and batch number as its last partition level, and a batch
    replaces just its own folders; Delta skips a batch of the feed it has seen. The state that produced a
    batch is versioned, so a replay has the same rows. ``feed`` names the query: by default its id, which
    ``checkpoint`` holds, so that neither a second query nor a new checkpoint on the same tables, whose
    batches are numbered from 0 again, touches what is stored. Adaptive execution sizes the write tasks: a
    busy folder is split over many, small ones share one.
    """

    def __init__(
        self,
        features_path: str,
        alerts_path: str,
        fmt: str = "parquet",
        checkpoint: str | None = None,
        feed: str | None = None,
        partition_by: Sequence[str] = PARTITION_COLUMNS,
    ) -> None:
        self.features_path = features_path
        self.alerts_path = alerts_path
        self.fmt = fmt
        self.checkpoint = checkpoint
        self.feed = feed
        self.partition_by = tuple(partition_by)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        feed = self._feed(batch.sparkSession)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._write(batch.drop("alert_reason"), self.features_path, feed, batch_id)
            self._write(alerts_only(batch), self.alerts_path, feed, batch_id)
        finally:
            batch.unpersist()

    def _feed(self, session: SparkSession) -> str:
        """The query's name: given, or the id Spark keeps in the checkpoint from the first start on."""
        if self.feed is None:
            if self.checkpoint is None:
                raise ValueError("name the feed, or give the checkpoint that holds the query's id")
            self.feed = session.read.schema("id string").json(f"{self.checkpoint}/metadata").first()["id"]
        return self.feed

    def _write(self, rows: DataFrame, path: str, feed: str, batch_id: int) -> None:
        rows = rows.hint("rebalance", *self.partition_by)
        if self.fmt == "delta":
            writer = rows.write.format("delta").mode("append").partitionBy(*self.partition_by)
            writer.option("txnAppId", f"wavelane-{feed}").option("txnVersion", batch_id).save(path)
            return
        numbered = rows.withColumn(BATCH_COLUMN, F.lit(f"{feed}-{batch_id}"))
        numbered.write.format(self.fmt).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*self.partition_by, BATCH_COLUMN).save(path)


def start_monitor(
    messages: DataFrame,
    features_path: str,
    alerts_path: str,
    checkpoint: str,
    params: MonitorParams,
    fmt: str = "parquet",
    state_partitions: int | None = None,
    drain: bool = False,
    provider: str | None = None,
    partition_by: Sequence[str] = PARTITION_COLUMNS,
) -> StreamingQuery:
    """Start (or resume from ``checkpoint``) the monitor; ``drain`` stops it when the input is used up.

    ``state_partitions`` is fixed when the checkpoint is made: choose it for the number of open
    (window, patient, channel) groups. ``provider`` may name a state store, such as the RocksDB one
    for state beyond executor memory. Both are set on the session while the query starts, which copies
    them, and then put back: don't start monitors with different settings from several threads at once.
    """
    writer = (
        live_features(messages, params)
        .writeStream.foreachBatch(FanOut(features_path, alerts_path, fmt, checkpoint, partition_by=partition_by))
        .option("checkpointLocation", checkpoint)
    )
    return start_with(writer, messages.sparkSession, drain, state_partitions, provider)


def start_with(
    writer: DataStreamWriter, session: SparkSession, drain: bool, state_partitions: int | None, provider: str | None
) -> StreamingQuery:
    """Start a query with settings that hold for it alone."""
    settings = {
        "spark.sql.shuffle.partitions": state_partitions and str(state_partitions),
        "spark.sql.streaming.stateStore.providerClass": provider,
    }
    settings = {key: value for key, value in settings.items() if value}
    previous = {key: session.conf.get(key, None) for key in settings}
    if drain:
        writer = writer.trigger(availableNow=True)
    for key, value in settings.items():
        session.conf.set(key, value)
    try:
        return writer.start()
    finally:
        for key, value in previous.items():
            session.conf.unset(key) if value is None else session.conf.set(key, value)


def read_output(session, path: str, fmt: str = "parquet", columns: Sequence[str] = ()) -> DataFrame:
    """A monitor's output table without the batch level."""
    table = read_table(session, path, fmt).drop(BATCH_COLUMN)
    return table.select(*columns) if columns else table


def late_rows_dropped(query: StreamingQuery) -> int:
    """Rows dropped because their window had closed, by the triggers Spark still remembers (100 unless
    spark.sql.streaming.numRecentProgressUpdates says otherwise). For all triggers, listen: ``LateRows``."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


class LateRows(StreamingQueryListener):
    """Counts late rows of every trigger, by query id: ``spark.streams.addListener(LateRows())`` before the
    start. A count outlives restarts of the query as long as the listener does."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        late = sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)
        name = str(event.progress.id)
        self.dropped[name] = self.dropped.get(name, 0) + late

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...
