"""Keyed tables on files: the newest row of every key, kept by merges.

A batch is written as a run: rows hashed by key into buckets, each bucket sorted. A run that
is not much larger than what came after it is merged with it, so runs grow geometrically: a
table has some log(rows) runs however many batches wrote it. A manifest per batch names the
live runs. It is written last, so a crash before it leaves the table as it was.

Runs are Spark bucketed tables with a folder of their own, declared anew by each session that
reads them. As all are bucketed alike, runs are read together without a shuffle.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storepulse.session import setting
from storepulse.sources import files

#: Bits of one page of a run's key filter, and places that a key has in it.
_PAGE_BITS, _PLACES, _BITS_PER_KEY = 32_768, 2, 16
#: Filters are asked only for keys that are fewer than the rows stored by this factor.
_FEW = 32


@dataclass(frozen=True)
class Run:
    """`low` and `high`: smallest and largest value of the table's `ranged` column."""

    run: str
    rows: int
    low: str | int | None
    high: str | int | None


@dataclass(frozen=True)
class KeyedTable:
    """`schema`: the columns stored. `key`: what identifies a row, never null; its first
    column chooses the bucket. `ranged`: a column of texts or whole numbers by which
    buckets are sorted first and runs are skipped, such as a day.

    `apply` writes one row per key and batch; a later batch replaces it. With `disjoint`,
    batches never repeat a key, so nothing is replaced and reading compares nothing.

    Runs together smaller than `small_rows` are always merged; beyond that a run is merged
    once those after it hold more than 1 / `ratio` of its rows. `keep` manifests and their
    runs stay for readers that started earlier; older ones are deleted.
    """

    path: str
    schema: T.StructType
    key: tuple[str, ...]
    ranged: str | None = None
    disjoint: bool = False
    filtered: bool = False
    buckets: int = 16
    small_rows: int = 1_000_000
    ratio: int = 2
    keep: int = 3

    # -- manifests ---------------------------------------------------------

    def _manifest(self, batch: int) -> str:
        return f"{self.path}/manifest/{batch:012d}.json"

    def _manifests(self, spark: SparkSession) -> list[int]:
        found = [n.removesuffix(".json") for n in files.names(spark, f"{self.path}/manifest") if n.endswith(".json")]
        return [int(n) for n in found]

    def _runs_of(self, spark: SparkSession, batch: int) -> list[Run]:
        return [Run(**r) for r in json.loads(files.read_text(spark, self._manifest(batch)))]

    def live_runs(self, spark: SparkSession, before: int | None = None) -> list[Run] | None:
        """Live runs, oldest first, as of the last batch (smaller than `before`); None if
        there is no such batch."""
        batches = [b for b in self._manifests(spark) if before is None or b < before]
        return self._runs_of(spark, max(batches)) if batches else None

    def _forget(self, spark: SparkSession, batch_id: int) -> None:
        """Delete manifests older than the last `keep`, and runs that none of the others names."""
        manifests = self._manifests(spark)
        old = sorted(b for b in manifests if b <= batch_id)[:-self.keep]
        for batch in old:
            files.delete(spark, self._manifest(batch))
        wanted = {r.run for b in manifests if b not in old for r in self._runs_of(spark, b)}
        for name in files.names(spark, f"{self.path}/runs"):
            if name not in wanted:
                spark.sql(f"DROP TABLE IF EXISTS {self._table(name)}")
                files.delete(spark, f"{self.path}/runs/{name}")
                files.delete(spark, f"{self.path}/filters/{name}")

    # -- runs --------------------------------------------------------------

    def _table(self, run: str) -> str:
        return "run_" + hashlib.sha256(f"{self.path}/{run}".encode()).hexdigest()[:24]

    @property
    def _sorted_by(self) -> list[str]:
        return list(dict.fromkeys([*([self.ranged] if self.ranged else []), *self.key]))

    def _open(self, spark: SparkSession, run: Run) -> DataFrame:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        order = ", ".join(f"`{c}`" for c in self._sorted_by)
        spark.sql(f"""CREATE TABLE IF NOT EXISTS {self._table(run.run)} ({columns}) USING parquet
                      CLUSTERED BY (`{self.key[0]}`) SORTED BY ({order}) INTO {self.buckets} BUCKETS
                      LOCATION '{self.path}/runs/{run.run}'""")
        return spark.table(self._table(run.run))

    def _write(self, rows: DataFrame, batch_id: int, live: bool = True, grouped: bool = False) -> Run:
        spark, name = rows.sparkSession, f"{batch_id:012d}-{uuid.uuid4().hex[:8]}"
        rows = rows.select(*self.schema.names)
        if not grouped:
            rows = rows.repartition(self.buckets, self.key[0])
        seen = Observation()
        span = F.col(self.ranged) if self.ranged else F.lit(None).cast("string")
        (rows.observe(seen, F.count("*").alias("rows"), F.min(span).alias("low"), F.max(span).alias("high"))
         .write.bucketBy(self.buckets, self.key[0]).sortBy(*self._sorted_by)
         .option("path", f"{self.path}/runs/{name}").format("parquet").saveAsTable(self._table(name)))
        run = Run(name, seen.get["rows"], seen.get["low"], seen.get["high"])
        if live and self.filtered:
            self._write_filter(spark, run)
        return run

    # -- writing -----------------------------------------------------------

    def apply(self, rows: DataFrame, batch_id: int, since: str | int | None = None) -> int:
        """Insert `rows`, one per key, and replace rows of the same keys; returns their number.
        They are read up to three times: persist them if they are dear.

        Rows whose `ranged` column is below `since` are of no more use: runs of such rows
        only are let go, and merges leave them out. A batch that is repeated starts from the
        state before it, so it replaces itself."""
        spark = rows.sparkSession
        runs = self.live_runs(spark, before=batch_id) or []
        if since is not None:
            rows = rows.filter(F.col(self.ranged) >= since)
            runs = [r for r in runs if r.high >= since]
        inserted = rows.count()
        if inserted:
            runs = self._merged(spark, runs, rows, inserted, batch_id, since)
        files.write_text(spark, self._manifest(batch_id), json.dumps([asdict(r) for r in runs]))
        self._forget(spark, batch_id)
        return inserted

    def stage(self, rows: DataFrame, batch_id: int, grouped: bool = False) -> Run:
        """Write `rows`, one per key, as a run that is no part of the table until `settle`.

        They are evaluated once. Read back with `staged` they lie in the table's buckets, so
        joining them with its rows shuffles nothing.

        `grouped`: the rows come straight from a grouping by the key. Its shuffle deals them to the
        buckets then, and they are not shuffled a second time."""
        if not grouped:
            return self._write(rows, batch_id, live=False)
        spark = rows.sparkSession
        with setting(spark, "spark.sql.shuffle.partitions", str(self.buckets)), \
                setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
            return self._write(rows, batch_id, live=False, grouped=True)

    def staged(self, spark: SparkSession, run: Run) -> DataFrame:
        return self._open(spark, run)

    def settle(self, spark: SparkSession, run: Run, batch_id: int) -> None:
        """Insert a staged run and replace rows of the same keys, as `apply` does with rows."""
        runs = self.live_runs(spark, before=batch_id) or []
        if run.rows:
            if self._stay(runs, run.rows) < len(runs):
                runs = self._merged(spark, runs, self._open(spark, run), run.rows, batch_id)
            else:
                if self.filtered:
                    self._write_filter(spark, run)
                runs = [*runs, run]
        files.write_text(spark, self._manifest(batch_id), json.dumps([asdict(r) for r in runs]))
        self._forget(spark, batch_id)

    def _stay(self, runs: list[Run], n: int) -> int:
        """How many of the runs stay as they are when `n` rows come after them."""
        stay = len(runs)
        while stay and (runs[stay - 1].rows + n <= self.small_rows or runs[stay - 1].rows < self.ratio * n):
            stay -= 1
            n += runs[stay].rows
        return stay

    def _merged(self, spark: SparkSession, runs: list[Run], rows: DataFrame, n: int, batch_id: int,
                since: str | int | None = None) -> list[Run]:
        stay = self._stay(runs, n)
        merged = self._newest([*(self._open(spark, r) for r in runs[stay:]), rows])
        if since is not None:
            merged = merged.filter(F.col(self.ranged) >= since)
        return [*runs[:stay], self._write(merged, batch_id)]

    # -- reading -----------------------------------------------------------

    def _within(self, runs: list[Run], low: str | int | None, high: str | int | None) -> list[Run]:
        """Runs that may hold rows between `low` and `high`. Only where the ranged column is
        part of the key: else a run outside may hold the row that replaces one inside."""
        if low is None or self.ranged not in self.key:
            return runs
        return [r for r in runs if r.low is not None and r.low <= high and low <= r.high]

    def _newest(self, frames: Sequence[DataFrame]) -> DataFrame:
        """Rows of frames, oldest first, whose key occurs in no later one."""
        *older, found = [f.select(*self.schema.names) for f in frames]
        if self.disjoint:
            return reduce(DataFrame.unionByName, older, found)
        later = found.select(*self.key)
        for frame in reversed(older):
            # The later runs are the smaller ones: they are hashed, the older one is streamed.
            found = found.unionByName(frame.join(later.hint("shuffle_hash"), list(self.key), "left_anti")
                                      .select(*self.schema.names))
            later = later.unionByName(frame.select(*self.key))
        return found

    def read(self, spark: SparkSession, before: int | None = None, low: str | int | None = None,
             high: str | int | None = None, keys: Sequence[str] | None = None) -> DataFrame:
        """The table, as of the last batch smaller than `before`.

        `low` and `high` bound the `ranged` column: row groups that lie outside are skipped, and
        whole runs too if the column is part of the key. `keys` are values of the first key column: buckets
        without them are not opened."""
        runs = self._within(self.live_runs(spark, before) or [], low, high)
        if not runs:
            return spark.createDataFrame([], self.schema)
        frames = [self._open(spark, r) for r in runs]
        if keys is not None:
            frames = [f.filter(F.col(self.key[0]).isin(list(keys))) for f in frames]
        found = self._newest(frames)
        return found.filter(F.col(self.ranged).between(low, high)) if self.ranged and low is not None else found

    # -- lookups -----------------------------------------------------------

    def _places(self, pages: DataFrame | int) -> list:
        return [F.pmod(F.xxhash64(F.lit(i), *self.key), F.lit(pages * _PAGE_BITS)) for i in range(_PLACES)]

    @staticmethod
    def _pages(rows: int) -> int:
        """Pages of a filter of `rows` keys: in proportion, so strangers pass as rarely at any size."""
        return max(1, -(-rows * _BITS_PER_KEY // _PAGE_BITS))

    def _write_filter(self, spark: SparkSession, run: Run) -> None:
        """A Bloom filter of a run's keys, as pages of 4 KB."""
        place = F.explode(F.array(*self._places(self._pages(run.rows)))).alias("p")
        (self._open(spark, run).select(place)
         .groupBy(F.call_function("div", F.col("p"), F.lit(_PAGE_BITS)).alias("page"))
         .agg(F.bitmap_construct_agg(F.col("p") % _PAGE_BITS).alias("bits"))
         .write.mode("overwrite").parquet(f"{self.path}/filters/{run.run}"))

    def _may_hold(self, spark: SparkSession, run: Run, keys: DataFrame) -> DataFrame:
        """The `keys` that the run's filter does not rule out."""
        bits = spark.read.schema("page long, bits binary").parquet(f"{self.path}/filters/{run.run}")
        for i, place in enumerate(self._places(self._pages(run.rows))):
            offset = F.col("_p") % _PAGE_BITS
            byte = F.conv(F.hex(F.substring("bits", (offset / 8).cast("int") + 1, 1)), 16, 10).cast("int")
            held = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (offset % 8).cast("int"))) != 0
            keys = (keys.withColumn("_p", place).withColumn("page", F.call_function("div", F.col("_p"), F.lit(_PAGE_BITS)))
                    .join(bits, "page").filter(held).select(*self.key))
        return keys

    def lookup(self, keys: DataFrame, before: int | None = None, literals: int = 1000,
               n: int | None = None) -> DataFrame:
        """The stored rows of `keys` (a row per key), as of the last batch smaller than `before`.

        With `filtered`, each run's Bloom filter is asked first: if none may hold a key, nothing
        is opened. If `literals` keys or fewer may be there, they are
        given to the scan, which opens their buckets only; more are joined.

        `n`: number of keys, if known. Keys that are not few beside the rows stored are joined
        at once, as asking the filters would shuffle them more often than the join does."""
        spark, key = keys.sparkSession, list(self.key)
        low = high = None
        if self.ranged in self.key:
            low, high = keys.agg(F.min(self.ranged), F.max(self.ranged)).first()
        runs = self._within(self.live_runs(spark, before) or [], low, high)
        wanted = keys.select(*key)
        if n is not None and n > literals and n * _FEW >= sum(r.rows for r in runs) > 0:
            return self.read(spark, before, low, high).join(wanted.hint("shuffle_hash"), key, "left_semi").select(
                *self.schema.names)
        if self.filtered and runs:
            wanted = reduce(DataFrame.unionByName, [self._may_hold(spark, r, wanted) for r in runs])
        first = wanted.select(key[0]).distinct().limit(literals + 1).collect() if runs else []
        if not first:
            return spark.createDataFrame([], self.schema)
        few = sorted(r[0] for r in first) if len(first) <= literals else None
        stored = self.read(spark, before, low, high, few)
        return stored.join(keys.select(*key), key, "left_semi").select(*self.schema.names)
