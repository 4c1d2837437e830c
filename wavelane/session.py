"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Joins broadcast a side only on the size AQE measured at a shuffle, never on a planning estimate:
# interval joins explode their label side, which the estimate does not see.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16MB",
}

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators count on to an existing session."""
    for key, value in SESSION_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "wavelane", master: str | None = None, **conf: str) -> SparkSession:
    """Create a configured session; extra ``conf`` entries use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


@cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="wavelane-")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    A machine-local folder is made only in local mode, where the one machine is the cluster.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/wavelane/{purpose}-{uuid.uuid4().hex}"
