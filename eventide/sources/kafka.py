"""Kafka source and sink.

No Kafka connector is on this image's classpath, so these build the reader
and writer through Spark's own ``kafka`` format and are only unit-tested on
their option maps.  The reference's one-machine file replay (one line every
10 ms through a producer) becomes a distributed batch write of a text
DataFrame to a topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_source_options(topic: str, servers: str, group_id: str | None = None,
                         starting_offsets: str = "latest") -> dict[str, str]:
    """Options for ``readStream.format('kafka')``; the reference starts at
    the latest offset and names a consumer group."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": starting_offsets}
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


def read_kafka_lines(spark: SparkSession, topic: str, servers: str,
                     group_id: str | None = None, stream: bool = True) -> DataFrame:
    """One string ``value`` per record (the reference's SimpleStringSchema)."""
    opts = kafka_source_options(topic, servers, group_id,
                                "latest" if stream else "earliest")
    r = spark.readStream if stream else spark.read
    return r.format("kafka").options(**opts).load().select(
        F.col("value").cast("string").alias("value"))


def kafka_sink_options(topic: str, servers: str, acks: str = "1") -> dict[str, str]:
    """Producer options; the reference writes with ``acks=1``."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": acks}


def write_lines_to_kafka(lines: DataFrame, topic: str, servers: str,
                         col: str = "value", acks: str = "1") -> None:
    """Write every line of ``lines`` as one record to ``topic``."""
    (lines.select(F.col(col).cast("string").alias("value"))
     .write.format("kafka").options(**kafka_sink_options(topic, servers, acks)).save())
