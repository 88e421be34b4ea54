"""Tables that a job keeps beside what it writes, each updated once per batch.

All are keyed tables: what a batch reads of them depends on its rows and on the size of the
table, not on the number of batches before. An update reads the state before its batch, so a
repeated batch gives the same state.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storepulse import schemas
from storepulse.operators import first_launch
from storepulse.sources import files, tables
from storepulse.sources.keyed import KeyedTable

_CENTS = T.DecimalType(38, 2)


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def seen_launches(path: str, **sizes: int) -> KeyedTable:
    """Devices seen on each day, with a Bloom filter per run."""
    return KeyedTable(path, _text("mid", "log_date"), ("mid", "log_date"), ranged="log_date",
                      disjoint=True, filtered=True, **sizes)


@dataclass(frozen=True)
class FirstDays:
    """The first day of every device, kept as launches arrive.

    A launch of an earlier day that arrives late moves its device's first day back."""

    path: str

    @property
    def table(self) -> KeyedTable:
        return KeyedTable(self.path, _text("mid", "first_day"), ("mid",), ranged="first_day", filtered=True)

    def apply(self, launches: DataFrame, batch_id: int) -> None:
        """Take in launches (`mid`, `log_date`) of one batch."""
        days = launches.groupBy("mid").agg(F.min("log_date").alias("first_day")).persist()
        try:
            known = self.table.lookup(days.select("mid"), batch_id).withColumnRenamed("first_day", "known")
            earlier = days.join(known, "mid", "left").filter("known IS NULL OR first_day < known").persist()
            self.table.apply(earlier, batch_id)
            earlier.unpersist()
        finally:
            days.unpersist()

    def of_day(self, spark: SparkSession, day: str) -> DataFrame:
        """Devices whose first day is `day`; only row groups with that day are read."""
        return self.table.read(spark, low=day, high=day)


@dataclass(frozen=True)
class LateLaunches:
    """The first launch of every device and day among those that come late.

    A launch is late if it lies more than `delay` behind the newest of its own or an earlier
    batch. A watermark of that delay over the same source drops none but these, wherever its
    batches are cut: what it has seen before a row comes before the row here too."""

    path: str
    delay: str

    @property
    def table(self) -> KeyedTable:
        return KeyedTable(f"{self.path}/launches", schemas.FIRST_LAUNCH_TABLE, ("mid", "log_date"),
                          ranged="log_date", disjoint=True, filtered=True)

    def apply(self, launches: DataFrame, batch_id: int) -> None:
        spark = launches.sparkSession
        newest = launches.agg(F.max("ts")).first()[0]
        before = self._newest(spark, batch_id)
        newest = before if newest is None else newest if before is None else max(newest, before)
        if newest is not None:
            limit = spark.sql(f"SELECT unix_millis(timestamp_millis({newest}) - INTERVAL '{self.delay}')").first()[0]
            late = first_launch.first_per_key(
                launches.filter(F.col("ts") <= limit).select(*schemas.FIRST_LAUNCH_COLUMNS)).persist()
            known = self.table.lookup(late.select(*self.table.key), batch_id)
            new = first_launch.unseen(late, known).persist()
            self.table.apply(new, batch_id)
            new.unpersist()
            late.unpersist()
        files.write_text(spark, f"{self.path}/newest/{batch_id:012d}", json.dumps(newest))
        for name in files.names(spark, f"{self.path}/newest")[:-self.table.keep]:
            files.delete(spark, f"{self.path}/newest/{name}")

    def _newest(self, spark: SparkSession, batch_id: int) -> int | None:
        """The newest time as of the batch before, None before the first."""
        names = [n for n in files.names(spark, f"{self.path}/newest") if n.isdigit() and int(n) < batch_id]
        return json.loads(files.read_text(spark, f"{self.path}/newest/{names[-1]}")) if names else None


def launches(spark: SparkSession, path: str, low: str | None = None, high: str | None = None) -> DataFrame:
    """What `jobs.first_launches` wrote, with the late launches whose device and day the
    watermark let through no other; of the days `low` to `high` if given."""
    kept = tables.read_table(spark, path, schemas.FIRST_LAUNCH_TABLE).drop("batch_id")
    if low is not None:
        kept = kept.filter(F.col("log_date").between(low, high))
    late = LateLaunches(f"{path}/_late", "").table.read(spark, low=low, high=high)
    return kept.unionByName(first_launch.unseen(late, kept))


@dataclass(frozen=True)
class Orders:
    """The newest row of every order, and the number and amount of orders per hour.

    An order that comes again takes its old row's share back from the hour it was counted
    in, so the hours always equal a recount of the newest rows."""

    path: str

    @property
    def table(self) -> KeyedTable:
        return KeyedTable(f"{self.path}/orders", schemas.ORDER_TABLE, ("id",), filtered=True)

    @property
    def hours(self) -> KeyedTable:
        hour = _text("create_date", "create_hour")
        return KeyedTable(f"{self.path}/hours", T.StructType([
            *hour.fields, T.StructField("amount", _CENTS), T.StructField("orders", T.LongType())]),
            ("create_date", "create_hour"), ranged="create_date", buckets=4)

    def apply(self, orders: DataFrame, batch_id: int, grouped: bool = False) -> None:
        """Take in the orders of one batch, one row per id.

        They are written as a run first, so what follows reads of them the columns it needs.
        `grouped`: they come straight from a grouping by id (`KeyedTable.stage`)."""
        spark = orders.sparkSession
        run = self.table.stage(orders.select(*schemas.ORDER_COLUMNS), batch_id, grouped)
        rows = self.table.staged(spark, run)
        before = self.table.lookup(rows.select("id"), batch_id, n=run.rows)
        change = (_counted(rows, 1).unionByName(_counted(before, -1)).groupBy("create_date", "create_hour")
                  .agg(F.sum("amount").cast(_CENTS).alias("d_amount"), F.sum("n").alias("d_orders"))
                  .filter("d_amount <> 0 OR d_orders <> 0").persist())
        try:
            known = self.hours.lookup(change.select("create_date", "create_hour"), batch_id)
            total = lambda c: F.coalesce(F.col(c), F.lit(0)) + F.col(f"d_{c}")
            moved = change.join(known, ["create_date", "create_hour"], "left").select(
                "create_date", "create_hour", total("amount").cast(_CENTS).alias("amount"),
                total("orders").alias("orders"))
            moved = moved.persist()
            self.hours.apply(moved, batch_id)
            moved.unpersist()
        finally:
            change.unpersist()
        self.table.settle(spark, run, batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.table.read(spark)

    def per_hour(self, spark: SparkSession, low: str | None = None, high: str | None = None) -> DataFrame:
        """`create_date`, `create_hour`, `amount` (decimal), `orders`; hours without orders are left out."""
        return self.hours.read(spark, low=low, high=high).filter("orders <> 0")


def _counted(rows: DataFrame, sign: int) -> DataFrame:
    """Amounts are added in cents, so that taking one back is exact."""
    return rows.select("create_date", "create_hour", F.lit(sign).cast("long").alias("n"),
                       (F.coalesce(F.col("total_amount"), F.lit(0.0)).cast("decimal(20,2)") * F.lit(sign)).alias("amount"))
