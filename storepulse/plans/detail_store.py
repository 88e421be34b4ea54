"""Sale details stored for search: files in key order with their counts, and an index of item names.

A load writes a version. Its rows are range-partitioned by day and key, so that a page is a
stretch of one or two files; `parts` says how many rows of a day each file holds, and `names`
how many of each item name. `grams` lists, for every run of one, two or three characters,
the item names that contain it. A keyword is answered from `grams` and `names`; details are
read only for rows to show, and only from files with hits.

The days of a load are named in one small file, written last: a crash before leaves the days
as they were, and a day loaded again replaces what it held.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storepulse.functions.text import has_keyword
from storepulse.sources import files

GRAM = 3
_MONTH = T.StructField("month", T.StringType())
_PARTS = T.StructType([T.StructField("dt", T.StringType()), T.StructField("part", T.IntegerType()),
                       T.StructField("n", T.LongType()), _MONTH])
_NAMES = T.StructType([T.StructField("dt", T.StringType()), T.StructField("name", T.StringType()),
                       T.StructField("part", T.IntegerType()), T.StructField("n", T.LongType()), _MONTH])
_GRAMS = T.StructType([T.StructField("gram", T.StringType()), T.StructField("name", T.StringType())])


def grams_of(name: Column) -> Column:
    """The distinct runs of one to `GRAM` characters of a text."""
    size = F.length(name)

    def runs(k: int) -> Column:
        cut = F.transform(F.sequence(F.lit(1), size - (k - 1)), lambda i: F.substr(name, i, F.lit(k)))
        return F.when(size >= k, cut).when(size.isNotNull(), F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*(runs(k) for k in range(1, GRAM + 1))))


@dataclass(frozen=True)
class DetailStore:
    """`schema`: the columns stored, among them `dt` (the day, as yyyy-mm-dd text), `sku_name`
    and `key`, which names a row of a day. One writer at a time."""

    path: str
    schema: T.StructType
    key: str = "order_detail_id"
    rows_per_file: int = 250_000

    # -- writing -----------------------------------------------------------

    def load(self, details: DataFrame) -> list[str]:
        """Store the details of whole days, in place of what was stored for these days.

        `details` is read twice: to count, and to write. Rows without a day belong to no
        answer and are not stored. Returns the days, sorted."""
        spark, version = details.sparkSession, uuid.uuid4().hex
        home = f"{self.path}/versions/{version}"
        dated = details.filter(F.col("dt").isNotNull()).select(*self.schema.names)
        parts = max(1, -(-dated.count() // self.rows_per_file))
        month = F.substring("dt", 1, 7)
        (dated.repartitionByRange(parts, "dt", self.key)
         .withColumn("month", month).withColumn("part", F.spark_partition_id())
         .sortWithinPartitions("month", "part", "dt", self.key)
         .write.partitionBy("month", "part").parquet(f"{home}/rows"))
        stored = self._rows(spark, version)
        # Several days may share a file and a day may span many; both are told by the counts.
        (stored.groupBy("month", "dt", "part", F.lower("sku_name").alias("name")).agg(F.count("*").alias("n"))
         .repartitionByRange("month", "dt", "name").sortWithinPartitions("month", "dt", "name")
         .select(*_NAMES.names).write.partitionBy("month").parquet(f"{home}/names"))
        names = spark.read.schema(_NAMES).parquet(f"{home}/names")
        (names.groupBy("dt", "part", "month").agg(F.sum("n").alias("n")).select(*_PARTS.names)
         .repartition("month").write.partitionBy("month").parquet(f"{home}/parts"))
        (names.filter(F.length("name") > 0).select("name").distinct()
         .select(F.explode(grams_of(F.col("name"))).alias("gram"), "name")
         .repartitionByRange("gram", "name").sortWithinPartitions("gram", "name").write.parquet(f"{home}/grams"))
        days = sorted(r["dt"] for r in spark.read.schema(_PARTS).parquet(f"{home}/parts").select("dt").distinct().collect())
        files.write_text(spark, f"{self.path}/days.json", json.dumps(self.days(spark) | dict.fromkeys(days, version)))
        return days

    def forget(self, spark: SparkSession) -> None:
        """Delete versions that no day names any more, also those of loads that failed."""
        wanted = set(self.days(spark).values())
        for name in files.names(spark, f"{self.path}/versions"):
            if name not in wanted:
                files.delete(spark, f"{self.path}/versions/{name}")

    # -- reading -----------------------------------------------------------

    def days(self, spark: SparkSession) -> dict[str, str]:
        """The stored days and the version of each."""
        where = f"{self.path}/days.json"
        return json.loads(files.read_text(spark, where)) if files.exists(spark, where) else {}

    def _rows(self, spark: SparkSession, version: str) -> DataFrame:
        full = T.StructType([*self.schema.fields, _MONTH, T.StructField("part", T.IntegerType())])
        return spark.read.schema(full).parquet(f"{self.path}/versions/{version}/rows")

    def _of_day(self, spark: SparkSession, table: str, schema: T.StructType, day: str) -> DataFrame:
        version = self.days(spark).get(day)
        if version is None:
            return spark.createDataFrame([], schema)
        rows = spark.read.schema(schema).parquet(f"{self.path}/versions/{version}/{table}")
        return rows.filter((F.col("month") == day[:7]) & (F.col("dt") == day))

    def names_with(self, spark: SparkSession, day: str, keyword: str) -> DataFrame:
        """`name`: the item names, in lower case, of the day's version that contain the keyword.

        The lists of its runs are intersected; what is left is verified."""
        version, word = self.days(spark).get(day), keyword.lower()
        if version is None:
            return spark.createDataFrame([], "name string")
        size = min(GRAM, len(word))
        wanted = sorted({word[i:i + size] for i in range(len(word) - size + 1)})
        lists = spark.read.schema(_GRAMS).parquet(f"{self.path}/versions/{version}/grams")
        return (lists.filter(F.col("gram").isin(wanted)).groupBy("name").agg(F.count("*").alias("held"))
                .filter((F.col("held") == len(wanted)) & F.contains("name", F.lit(word))).select("name"))

    def hits(self, spark: SparkSession, day: str, keyword: str | None = None, literals: int = 1000) -> DataFrame:
        """`part`, `n`: the files with hits and their number, at most one row per file of the day.

        Up to `literals` names are given to the scan, which skips other row groups; more are joined."""
        if not keyword:
            return self._of_day(spark, "parts", _PARTS, day).select("part", "n")
        names, found = self._of_day(spark, "names", _NAMES, day), self.names_with(spark, day, keyword)
        few = [r["name"] for r in found.limit(literals + 1).collect()]
        held = names.filter(F.col("name").isin(few)) if len(few) <= literals else names.join(found, "name", "left_semi")
        return held.groupBy("part").agg(F.sum("n").alias("n"))

    def total(self, spark: SparkSession, day: str, keyword: str | None = None) -> DataFrame:
        """`total`, from counts alone."""
        return self.hits(spark, day, keyword).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))

    def _in_parts(self, spark: SparkSession, day: str, keyword: str | None, parts: list[int]) -> DataFrame:
        version = self.days(spark).get(day)
        if version is None or not parts:
            return spark.createDataFrame([], self.schema)
        rows = self._rows(spark, version).filter(
            (F.col("month") == day[:7]) & F.col("part").isin(parts) & (F.col("dt") == day))
        return rows.filter(has_keyword(F.col("sku_name"), keyword)).select(*self.schema.names)

    def search(self, spark: SparkSession, day: str, keyword: str | None = None) -> DataFrame:
        """All hits of a day. Only the numbers of files with hits pass the driver."""
        parts = [r["part"] for r in self.hits(spark, day, keyword).select("part").collect()]
        return self._in_parts(spark, day, keyword, parts)

    def page(self, spark: SparkSession, day: str, offset: int, size: int, keyword: str | None = None) -> DataFrame:
        """Hits offset .. offset + size of the day in key order, however deep the offset.

        The counts tell the files it falls in: at most `size` of them, one or two without a
        keyword. The running count is over files, not over rows."""
        before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
        files_of_page = (self.hits(spark, day, keyword).withColumn("before", before)
                         .filter((F.col("before") < offset + size) & (F.col("before") + F.col("n") > offset))
                         .select("part", "before").collect())
        skipped = min((r["before"] for r in files_of_page), default=0)
        rows = self._in_parts(spark, day, keyword, [r["part"] for r in files_of_page])
        return rows.orderBy(self.key).offset(max(0, offset - skipped)).limit(size)
