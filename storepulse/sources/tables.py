"""Serving tables: Parquet folders partitioned by day and by the batch that wrote them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storepulse import schemas


def read_table(spark: SparkSession, path: str, schema: T.StructType,
               partitions: Sequence[str] = ()) -> DataFrame:
    """All batches of a table. Filters on the partition columns skip whole folders.

    The schema is given, so day partitions stay text and no file is opened to infer it.
    """
    names = {f.name for f in schema.fields}
    extra = [T.StructField(p, T.StringType()) for p in partitions if p not in names]
    full = T.StructType([*schema.fields, *extra, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(full).parquet(path)


def write_daily(rows: DataFrame, path: str, partition: str) -> None:
    """A whole table in one folder per day; the rebalance step sizes the files and splits a
    day that holds most of the rows."""
    (rows.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition).parquet(path))


def read_daily(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of `write_daily`; a filter on its partition column reads those folders only."""
    return spark.read.schema(schema).parquet(path)


def read_partitions(spark: SparkSession, path: str, schema: T.StructType, column: str,
                    values: Sequence[str | int]) -> DataFrame:
    """The given partitions only, found by name, so files of the others are not even listed.

    Partitions that do not exist are left out.
    """
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    if column not in schema.names:
        full.add(column, T.LongType() if values and isinstance(values[0], int) else T.StringType())
    folders = ",".join(f"{column}={v}" for v in values)
    try:
        return spark.read.schema(full).option("basePath", path).parquet(f"{path}/{{{folders}}}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def latest_per_key(rows: DataFrame, key: str, version: Sequence[str] = ("batch_id",),
                   columns: Sequence[str] | None = None) -> DataFrame:
    """The newest row of every key: what a keyed store would hold after all writes.

    `columns`: those to return, all by default; of others only the version is shuffled."""
    columns = list(columns or rows.columns)
    newest = F.max_by(F.struct(*[c for c in columns if c != key]), F.struct(*version))
    return rows.groupBy(key).agg(newest.alias("_row")).select(key, "_row.*").select(*columns)


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """The order table as a keyed store would hold it: the newest version of every id.

    A version sent again in a later batch replaces the earlier copy."""
    stored = read_table(spark, path, schemas.ORDER_TABLE, ["version"])
    return latest_per_key(stored, "id", ("version", "batch_id")).select(*schemas.ORDER_COLUMNS)


def live_alerts(alerts: DataFrame) -> DataFrame:
    """The rows of the last batch that wrote each alert, without withdrawn ones.

    An alert's id fixes its minute and so its date: the date is part of the key, and a
    filter on it reaches the scan on both sides.
    """
    key = ["alert_date", "alert_id"]
    last = alerts.groupBy(*key).agg(F.max("batch_id").alias("batch_id"))
    return (alerts.join(last, [*key, "batch_id"], "left_semi")
            .filter(~F.col("withdrawn")).drop("withdrawn"))


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower: str | None = None, upper: str | None = None, partitions: int | None = None,
              **options: str) -> DataFrame:
    """A serving table in a SQL store; filters and columns are pushed to it.

    Give a partition column with bounds to read it in parallel.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column:
        reader = reader.options(partitionColumn=partition_column, lowerBound=lower,
                                upperBound=upper, numPartitions=str(partitions))
    return reader.load()
