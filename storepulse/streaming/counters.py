"""Counts of every batch of a stream, kept as a table.

Streams observe what they read (rows, rejected); jobs note what they wrote. A listener puts
both together when the batch is reported, one row per batch and counter. A batch that is
repeated replaces its rows.
"""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from storepulse.sources.keyed import KeyedTable

COUNTERS = T.StructType([T.StructField("counter", T.StringType()), T.StructField("batch", T.LongType()),
                         T.StructField("n", T.LongType())])


class Counters:
    """Counters of one stream, in a keyed table at `path`."""

    def __init__(self, path: str):
        self.table = KeyedTable(path, COUNTERS, ("counter", "batch"), ranged="batch", buckets=1)
        self._noted: dict[int, dict[str, int]] = defaultdict(dict)
        self._listeners: dict[str, _Listener] = {}

    def note(self, batch_id: int, **counts: int) -> None:
        """Counts of what a batch wrote; kept until its progress is reported."""
        self._noted[batch_id].update(counts)

    def listen(self, spark: SparkSession) -> _Listener:
        """A listener for the stream that is about to start; tell it which with `bind`."""
        listener = _Listener(self, spark)
        spark.streams.addListener(listener)
        return listener

    def wait(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Wait until the counts of an ended query are stored."""
        return self._listeners[str(query.id)].ended.wait(seconds)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.table.read(spark)

    def store(self, spark: SparkSession, batch_id: int, observed: dict[str, int]) -> None:
        counts = {**observed, **self._noted.pop(batch_id, {})}
        if counts:
            rows = F.array(*[F.struct(F.lit(c).alias("counter"), F.lit(batch_id).cast("long").alias("batch"),
                                      F.lit(n).cast("long").alias("n")) for c, n in sorted(counts.items())])
            self.table.apply(spark.range(1).select(F.inline(rows)), batch_id)


class _Listener(StreamingQueryListener):
    def __init__(self, counters: Counters, spark: SparkSession):
        self.counters, self.spark, self.query_id = counters, spark, None
        self.ended, self._early, self._lock = threading.Event(), [], threading.Lock()

    def bind(self, query: StreamingQuery) -> None:
        with self._lock:
            self.query_id = str(query.id)
            self.counters._listeners[self.query_id] = self
            early, self._early = self._early, []
            for handle, event in early:  # reported before the id was known
                handle(event)

    def _handle(self, handle, event) -> None:
        with self._lock:
            if self.query_id is None:
                self._early.append((handle, event))
            else:
                handle(event)

    def _progress(self, event) -> None:
        if str(event.progress.id) == self.query_id:
            observed = {k: v for row in event.progress.observedMetrics.values() for k, v in row.asDict().items()}
            self.counters.store(self.spark, event.progress.batchId, observed)

    def _end(self, event) -> None:
        if str(event.id) == self.query_id:
            self.spark.streams.removeListener(self)
            self.ended.set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._handle(self._progress, event)

    def onQueryTerminated(self, event) -> None:
        self._handle(self._end, event)
