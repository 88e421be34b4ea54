"""First launch of each device per day: within a set of rows, and against rows seen before."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storepulse.functions import times

KEYS = ("mid", "log_date")


def earliest_per_key(rows: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts",
                     tie: str = "event_id") -> DataFrame:
    """`keys`, `ts`, `tie` of the earliest row of every key, ties to the smallest `tie`.

    Both numbers are packed in one decimal, so the aggregate stays in the hash map:
    no sort before or after the shuffle, and no other column is carried along.
    """
    shift, half = F.lit(Decimal(1 << 64)), F.lit(Decimal(1 << 63))
    unsigned = F.col(tie).cast("decimal(20,0)") + half
    packed = (F.col(ts).cast("decimal(17,0)") * shift + unsigned).cast("decimal(38,0)")
    first = rows.groupBy(*keys).agg(F.min(packed).alias("_first"))
    at = F.call_function("div", F.col("_first"), shift)
    rest = F.col("_first") - at.cast("decimal(17,0)") * shift - half
    return first.select(*keys, at.cast("long").alias(ts), rest.cast("long").alias(tie))


def first_per_key(rows: DataFrame, keys: Sequence[str] = KEYS,
                  order: Sequence[str] = ("ts",)) -> DataFrame:
    """The row with the smallest `order` of every key.

    `min_by` combines on the map side, so a key with very many rows sends one
    row per task over the network. End `order` in a unique column where equal
    times are possible; otherwise any of the equal rows may be kept.
    """
    rest = [c for c in rows.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return rows.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*rows.columns)


def unseen(rows: DataFrame, seen: DataFrame, keys: Sequence[str] = KEYS,
           salts: int = 1) -> DataFrame:
    """Rows whose key is not in `seen`.

    No side is forced to be broadcast: Catalyst and AQE broadcast `seen` while
    its measured size is below `spark.sql.autoBroadcastJoinThreshold` and shuffle
    it otherwise. When single keys hold much of `rows`, `salts` > 1 spreads
    each key over that many tasks and copies the (distinct) seen keys as often.
    """
    taken = seen.select(*keys).distinct()
    if salts <= 1:
        return rows.join(taken, list(keys), "left_anti")
    others = [c for c in rows.columns if c not in keys]
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*(others or keys)), F.lit(salts)).cast("int"))
    copies = taken.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*keys, "_salt"], "left_anti").select(*rows.columns)


def dedup_stream(logs: DataFrame, delay: str = "1 day", salts: int = 1) -> DataFrame:
    """One row per device and day of a stream, the first to arrive.

    A device's state is one row, kept until the watermark is `delay` past its launch, so
    a delay of a day or more covers every later launch of the same day; a shorter one
    would let repeats through. Launches older than the watermark are dropped, so this is
    an approximation for late data. `salts` > 1 adds a pass that keeps one row per device,
    day and salt: where a device sends a large share of all rows, it is spread over so
    many tasks before its key meets in one place, at the cost of as many state rows.
    """
    timed = logs.withColumn("_at", times.instant(F.col("ts"))).withWatermark("_at", delay)
    if salts > 1:
        spread = [c for c in logs.columns if c not in KEYS]
        timed = (timed
                 .withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
                 .dropDuplicatesWithinWatermark([*KEYS, "_salt"]).drop("_salt"))
    return timed.dropDuplicatesWithinWatermark([*KEYS]).drop("_at")
