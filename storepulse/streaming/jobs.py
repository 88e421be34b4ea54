"""The streams: log routing, change feed, orders, and first launches.

Every job keeps its checkpoint inside the folder it writes, unless told
otherwise: offsets and results then cannot drift apart.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from storepulse import schemas
from storepulse.operators import changefeed, decode, first_launch, routing
from storepulse.session import setting
from storepulse.sources import files, tables
from storepulse.sources.keyed import KeyedTable
from storepulse.streaming import sinks, upkeep
from storepulse.streaming.counters import Counters
from storepulse.streaming.sinks import BatchSink


#: Packing the columns of a batch takes longer than decoding it.
_COMPRESSED = "spark.sql.inMemoryColumnarStorage.compressed"


def _counted(decoded: DataFrame, name: str) -> DataFrame:
    """Row counts for the query's progress reports."""
    return decoded.observe(name, F.count("*").alias("rows"),
                           F.count_if(F.col("_error").isNotNull()).alias("rejected"))


def _checkpoint(path: str, given: str | None) -> str:
    return given or f"{path}/_checkpoint"


def route_logs(lines: DataFrame, topics: BatchSink, archive: str, now: Column | None = None,
               checkpoint: str | None = None, **run) -> StreamingQuery:
    """Stamp client lines, archive them by day, and send each to its topic.

    The stamp is fixed per batch before the outputs part, so archive and topics
    agree, also when a batch is repeated.
    """
    stamped = _counted(routing.stamp_and_route(lines, now=now), "logs")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good = decode.accepted(batch)
            sinks.text_log(archive)(good, batch_id)
            sinks.write_quarantine(batch, batch_id, f"{archive}/_quarantine")
            topics(good, batch_id)
        finally:
            batch.unpersist()

    return sinks.start(stamped, handle, _checkpoint(archive, checkpoint), **run)


def forward_changes(entries: DataFrame, topics: BatchSink, checkpoint: str,
                    quarantine: str | None = None, **run) -> StreamingQuery:
    """Send inserted rows of the routed tables to their topics.

    Entries that cannot be read go to `quarantine`, by default a folder beside the checkpoint.
    """
    rejected = quarantine or f"{checkpoint.rstrip('/')}_quarantine"

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            sinks.write_quarantine(batch, batch_id, rejected)
            topics(changefeed.flatten_changes(decode.accepted(batch)), batch_id)
        finally:
            batch.unpersist()

    return sinks.start(_counted(entries, "changes"), handle, checkpoint, **run)


def _with_file(messages: DataFrame) -> DataFrame:
    """`_file`: age and path of the file that a message comes from, null if from none."""
    try:
        return messages.withColumn("_file", F.struct("_metadata.file_modification_time", "_metadata.file_path"))
    except AnalysisException:
        return messages.withColumn("_file", F.lit(None).cast("string"))


def ingest_orders(messages: DataFrame, path: str, checkpoint: str | None = None,
                  partition: str = "create_date", **run) -> StreamingQuery:
    """Masked orders by creation date; unreadable messages go to `_quarantine`.

    Of several messages on one order in a batch the newest is written: that with the
    highest offset if the messages carry one (all messages of a key share a partition),
    else with the latest `operate_time`, and of equal ones that in the
    newest file (by age, then path) and latest in it. `tables.read_orders` then takes the newest of all
    batches, so the table reads as a keyed store would.

    For a backfill of years, `partition="create_month"` makes fewer folders;
    filters on the date then skip by the statistics inside the files.
    """
    def write(newest: DataFrame, batch_id: int) -> None:
        if partition == "create_month":
            newest = newest.withColumn(partition, F.substring("create_date", 1, 7))
        sinks.write_batch(newest, batch_id, path, partition)

    return _take_orders(messages, write, path, checkpoint, **run)


def upsert_orders(messages: DataFrame, path: str, checkpoint: str | None = None, **run) -> StreamingQuery:
    """Masked orders in a keyed table, with their number and amount per hour (`upkeep.Orders`).

    Within a batch the newest message on an order is taken as in `ingest_orders`; across
    batches the last to arrive replaces the one before, as in a keyed store. The table is
    kept small by merges, and nothing needs to be combined when it is read.
    """
    def write(newest: DataFrame, batch_id: int) -> None:
        upkeep.Orders(path).apply(newest, batch_id, grouped=True)

    return _take_orders(messages, write, path, checkpoint, **run)


def _take_orders(messages: DataFrame, write: BatchSink, path: str, checkpoint: str | None, **run) -> StreamingQuery:
    """Decode orders, set aside unreadable ones, and hand the newest of each id to `write`."""
    place = ["offset"] if "offset" in messages.columns else []
    version = F.lpad(F.col("offset").cast("string"), 20, "0") if place else F.coalesce("operate_time", F.lit(""))
    decoded = _counted(decode.decode_order(_with_file(messages), keep=[*place, "_file"]), "orders")

    def handle(batch: DataFrame, batch_id: int) -> None:
        # The payload of an order that is accepted is of no more use, and most of a row.
        batch = batch.withColumns({"_place": F.monotonically_increasing_id(),
                                   "_raw": F.when(F.col("_error").isNotNull(), F.col("_raw"))})
        with setting(batch.sparkSession, _COMPRESSED, "false"):
            take(batch.persist(), batch_id)

    def take(batch: DataFrame, batch_id: int) -> None:
        try:
            orders = decode.accepted(batch).withColumn("version", version)
            newest = tables.latest_per_key(orders, "id", ("version", "_file", "_place"),
                                           [*schemas.ORDER_COLUMNS, "version"])
            write(newest, batch_id)
            sinks.write_quarantine(batch, batch_id, f"{path}/_quarantine")
        finally:
            batch.unpersist()

    return sinks.start(decoded, handle, _checkpoint(path, checkpoint), **run)


def first_launches(messages: DataFrame, path: str, checkpoint: str | None = None,
                   delay: str = "1 day", salts: int = 1, state_partitions: int | None = None,
                   **run) -> StreamingQuery:
    """One launch per device and day, whichever arrives first, by streaming state.

    Launches later than `delay` behind the newest are dropped by the watermark and counted in
    the progress report. A query of its own, which also sets unreadable lines aside, keeps
    all launches that the watermark may drop in `_late` (`upkeep.LateLaunches`);
    `upkeep.launches` reads the table with them.
    `state_partitions` fixes the number of state stores at the first start of the stream.
    """
    spark = messages.sparkSession
    where = _checkpoint(path, checkpoint)
    decoded = decode.decode_startup(messages)
    late = upkeep.LateLaunches(f"{path}/_late", delay)

    def set_aside(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            sinks.write_quarantine(rows, batch_id, f"{path}/_quarantine")
            late.apply(decode.accepted(rows), batch_id)
        finally:
            rows.unpersist()

    aside = sinks.start(decoded, set_aside, f"{where}_quarantine", once=run.get("once", False))
    if run.get("once"):
        aside.awaitTermination()
    first = first_launch.dedup_stream(decode.accepted(_counted(decoded, "startups")), delay, salts)
    kept = first.observe("first_launches", F.count("*").alias("rows"))
    with _shuffle_partitions(spark, state_partitions):
        return sinks.start(kept.select(*schemas.FIRST_LAUNCH_COLUMNS), sinks.table(path, "log_date"),
                           where, **run)


def _shuffle_partitions(spark: SparkSession, number: int | None):
    """A query takes its settings when it starts; the session's stay as they were."""
    return setting(spark, "spark.sql.shuffle.partitions", str(number) if number else None)


def first_launches_exact(messages: DataFrame, path: str, checkpoint: str | None = None,
                         order: tuple[str, ...] = ("ts",), extra: tuple[str, ...] = (),
                         first_days: bool = False, counters: Counters | None = None,
                         **run) -> StreamingQuery:
    """The earliest launch of the first batch that holds a device on a day.

    A batch is first reduced to one row per device and day and then compared with the devices
    seen before, a keyed table in `_seen`: Bloom filters tell which of its rows may be
    there, and only their buckets are opened. What a batch reads does not grow with the
    number of batches before it. With `first_days` the job also keeps every device's first
    day, in `_first_days` (`upkeep.FirstDays`), and `counters` are told the rows kept of each
    batch. `extra` names payload fields to keep as text, for `order`.
    """
    decoded = _counted(decode.decode_startup(messages, extra=extra), "startups")
    columns = [*schemas.FIRST_LAUNCH_COLUMNS, *extra]
    seen = upkeep.seen_launches(f"{path}/_seen")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        first = first_launch.first_per_key(decode.accepted(batch).select(*columns), order=order)
        first = first.persist()
        try:
            sinks.write_quarantine(batch, batch_id, f"{path}/_quarantine")
            _seed(batch.sparkSession, seen, path, batch_id)
            known = seen.lookup(first.select(*seen.key), batch_id)
            new = first_launch.unseen(first, known).persist()
            sinks.write_batch(new, batch_id, path, "log_date")
            if first_days:
                upkeep.FirstDays(f"{path}/_first_days").apply(new, batch_id)
            kept = seen.apply(new, batch_id)
            new.unpersist()
            if counters:
                counters.note(batch_id, kept=kept)
        finally:
            first.unpersist()
            batch.unpersist()

    listener = counters.listen(messages.sparkSession) if counters else None
    query = sinks.start(decoded, handle, _checkpoint(path, checkpoint), **run)
    if listener:
        listener.bind(query)
    return query


def _seed(spark: SparkSession, seen: KeyedTable, path: str, batch_id: int) -> None:
    """Fill the table of seen devices, once, from launches written before the job kept one."""
    if batch_id and seen.live_runs(spark, before=batch_id) is None and any(
            name.startswith("log_date=") for name in files.names(spark, path)):
        before = tables.read_table(spark, path, schemas.FIRST_LAUNCH_TABLE)
        seen.apply(before.filter(F.col("batch_id") < batch_id).select(*seen.key).distinct(), batch_id - 1)
