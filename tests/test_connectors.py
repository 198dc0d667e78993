"""Connectors that need a server: what is asked of Spark, without one."""

import pytest

from riverglass.session import shared_dir, work_dir
from riverglass.sinks import connector, jdbc, kafka_writer
from riverglass.sources import jdbc_by_predicates, jdbc_by_range, kafka_stream


class Recorder:
    """Notes each call and returns itself."""

    def __init__(self):
        self.seen = {}

    def __getattr__(self, name):
        if name in ("read", "readStream", "write", "writeStream"):
            return self

        def call(*args, **kwargs):
            if name == "option":
                self.seen[args[0]] = args[1]
            elif kwargs:
                self.seen.update(kwargs)
            else:
                self.seen[name] = args[0] if args else True
            return self
        return call

    def withColumn(self, name, value):
        self.seen["column"] = name
        return self


def test_jdbc_sink_appends_with_the_batch_id(spark):
    batch = Recorder()
    jdbc("jdbc:mysql://db/x", "top3", connections=4, user="u")(batch, 7)
    assert batch.seen["column"] == "batch_id"
    assert (batch.seen["format"], batch.seen["mode"]) == ("jdbc", "append")
    assert (batch.seen["url"], batch.seen["dbtable"], batch.seen["numPartitions"]) == ("jdbc:mysql://db/x", "top3", 4)
    assert batch.seen["user"] == "u" and batch.seen["save"]


def test_jdbc_reads_are_partitioned():
    spark = Recorder()
    jdbc_by_range(spark, "jdbc:mysql://db/x", "top3", "id", "0", "1000", 50)
    assert (spark.seen["partitionColumn"], spark.seen["lowerBound"], spark.seen["upperBound"],
            spark.seen["numPartitions"]) == ("id", "0", "1000", 50)
    spark = Recorder()
    jdbc_by_predicates(spark, "jdbc:mysql://db/x", "top3", ["k < 'm'", "k >= 'm'"])
    assert spark.seen["predicates"] == ["k < 'm'", "k >= 'm'"]


def test_connector_sink(spark):
    batch = Recorder()
    connector("some.keyvalue.store", table="recs", key__column="student_id")(batch, 1)
    assert batch.seen["format"] == "some.keyvalue.store"
    assert (batch.seen["table"], batch.seen["key.column"]) == ("recs", "student_id")


def test_kafka_options():
    spark = Recorder()
    kafka_stream(spark, "broker:9092", "stationTopic", per_batch=1000, min_partitions=64,
                 kafka__group__id="g")
    assert spark.seen["format"] == "kafka"
    assert (spark.seen["subscribe"], spark.seen["maxOffsetsPerTrigger"],
            spark.seen["minPartitions"], spark.seen["kafka.group.id"]) == ("stationTopic", 1000, 64, "g")
    df = Recorder()
    kafka_writer(df, "broker:9092", "etlTopic")
    assert (df.seen["topic"], df.seen["kafka.bootstrap.servers"], df.seen["outputMode"]) == (
        "etlTopic", "broker:9092", "append")


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    assert work_dir(spark, "a").startswith(shared_dir(spark))
    assert work_dir(spark, "a") != work_dir(spark, "a")


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Cluster:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "yarn"})()

    with pytest.raises(ValueError):
        shared_dir(Cluster())
