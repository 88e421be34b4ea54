"""Change-feed entries, read as JSON lines of the entry schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storepulse import schemas


_CORRUPT = "_corrupt"


def parse_entries(messages: DataFrame, value: str = "value") -> DataFrame:
    """Entries from JSON messages, with the payload as `_raw` and a reason as `_error`."""
    schema = T.StructType([*schemas.CHANGE.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value), schema, {"columnNameOfCorruptRecord": _CORRUPT})
    entries = messages.select(F.col(value).alias("_raw"), F.inline(F.array(parsed)))
    error = (F.when(F.coalesce(F.trim("_raw"), F.lit("")) == "", "empty")
             .when(F.col(_CORRUPT).isNotNull(), "bad_json")
             .when(F.col("table").isNull(), "missing_table"))
    return entries.withColumn("_error", error).drop(_CORRUPT)


def stream_entries(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Entries from a growing folder of JSON-line files."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return parse_entries(reader.text(path))


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    return parse_entries(spark.read.text(path))
