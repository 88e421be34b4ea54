"""Topics: message streams in Kafka, or in a folder of text files when there is no broker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLDER_SCHEMA = T.StructType([T.StructField("value", T.StringType()),
                              T.StructField("topic", T.StringType())])


def kafka_source_options(servers: str, topic: str, start: str = "latest",
                         max_offsets: int | None = None) -> dict[str, str]:
    """Reader options. Offsets live in the query's checkpoint, none are committed on the side."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_kafka(spark: SparkSession, servers: str, topic: str, **kw) -> DataFrame:
    """A topic as a stream of string keys and values with their place; needs the Kafka connector package."""
    stream = spark.readStream.format("kafka").options(**kafka_source_options(servers, topic, **kw)).load()
    return stream.select(F.col("key").cast("string"), F.col("value").cast("string"), "topic",
                         "partition", "offset", "timestamp")


def read_folder(spark: SparkSession, path: str, topic: str | None = None,
                files_per_trigger: int | None = None) -> DataFrame:
    """The same messages from a topic folder (`topic=<name>` inside `path`), as a stream.

    The filter on the topic is a partition filter: other topics' files are skipped.
    """
    reader = spark.readStream.format("text").schema(FOLDER_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    stream = reader.load(path)
    return stream.filter(F.col("topic") == topic) if topic else stream


def read_folder_once(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    rows = spark.read.format("text").schema(FOLDER_SCHEMA).load(path)
    return rows.filter(F.col("topic") == topic) if topic else rows
