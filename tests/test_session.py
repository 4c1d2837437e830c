"""Session settings, shared folders, and the options of the topic source."""

from unittest.mock import MagicMock

import pytest

from wavelane.session import SESSION_CONF, configure, shared_dir
from wavelane.sources.messages import kafka_messages


def test_configure_sets_every_setting(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    configure(spark)
    assert {key: spark.conf.get(key) for key in SESSION_CONF} == SESSION_CONF


def test_written_intermediates_go_to_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(base) and first != second


def cluster(setting):
    session = MagicMock()
    session.conf.get.return_value = setting
    session.sparkContext.master = "yarn"
    return session


def test_a_cluster_without_a_shared_folder_is_refused():
    assert shared_dir(cluster("hdfs:///shared/"), "x").startswith("hdfs:///shared/wavelane/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(cluster(None), "x")


def test_topic_source_options():
    session = MagicMock()
    kafka_messages(session, "broker:9092", "readings", maxOffsetsPerTrigger="1000")
    session.readStream.format.assert_called_once_with("kafka")
    options = session.readStream.format.return_value.options.call_args.kwargs
    assert options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "readings",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "1000",
    }
