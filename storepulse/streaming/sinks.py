"""Sinks for micro-batches. Each write is keyed by the batch, so a repeated batch replaces itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

BatchSink = Callable[[DataFrame, int], None]


def write_batch(rows: DataFrame, batch_id: int, path: str, partition: str,
                kind: str = "parquet") -> None:
    """Write rows under `<partition>=.../batch_id=.../`, replacing what this batch wrote before.

    The rebalance step sizes the files and splits a partition that holds most of the rows.
    """
    (rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
     .hint("rebalance", partition)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition, "batch_id").format(kind).save(path))


def table(path: str, partition: str) -> BatchSink:
    return lambda rows, batch_id: write_batch(rows, batch_id, path, partition)


def topic_folder(path: str) -> BatchSink:
    """Messages (`topic`, `value`) as text files. A batch repeated after a crash is delivered again."""
    return lambda rows, batch_id: write_batch(rows.select("topic", "value"), batch_id, path,
                                              "topic", "text")


def kafka_sink_options(servers: str, **extra: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, **extra}


def kafka_topics(servers: str, **extra: str) -> BatchSink:
    """Messages to the topic each row names; needs the Kafka connector package."""
    options = kafka_sink_options(servers, **extra)
    return lambda rows, batch_id: (
        rows.select("topic", "value").write.format("kafka").options(**options).save())


def jdbc_table(url: str, name: str, **options: str) -> BatchSink:
    """Append to a table of a SQL store; its key decides what a repeated row does."""
    return lambda rows, batch_id: (
        rows.write.mode("append").format("jdbc").options(url=url, dbtable=name, **options).save())


def text_log(path: str) -> BatchSink:
    """Raw lines by day, as a log file that rolls daily."""
    return lambda rows, batch_id: write_batch(rows.select("log_date", "value"), batch_id, path,
                                              "log_date", "text")


def write_quarantine(decoded: DataFrame, batch_id: int, path: str) -> None:
    """Rejected payloads by reason; nothing is written while there are none."""
    rejected = decoded.filter(F.col("_error").isNotNull()).select("_raw", "_error")
    if not rejected.isEmpty():
        write_batch(rejected, batch_id, path, "_error")


def start(stream: DataFrame, handle: BatchSink, checkpoint: str, every: str = "5 seconds",
          once: bool = False, name: str | None = None) -> StreamingQuery:
    """Run `handle` on every micro-batch; `once` takes what is there and ends."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    return _run(writer, every, once, name)


def print_rows(stream: DataFrame, checkpoint: str, rows: int = 10, every: str = "5 seconds",
               once: bool = False) -> StreamingQuery:
    """Print the first rows of every batch."""
    writer = (stream.writeStream.format("console").option("numRows", rows)
              .option("checkpointLocation", checkpoint))
    return _run(writer, every, once, None)


def _run(writer: DataStreamWriter, every: str, once: bool, name: str | None) -> StreamingQuery:
    if name:
        writer = writer.queryName(name)
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return writer.trigger(**trigger).start()
