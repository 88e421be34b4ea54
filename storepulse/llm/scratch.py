"""Intermediate tables in the shared work folder, and fixed-size membership filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storepulse.session import work_folder

#: Bits of one row of `bitmap_construct_agg`.
_ROW_BITS = 32768


def stage(frame: DataFrame, name: str) -> DataFrame:
    """Write `frame` once under the shared folder and read it back: cuts the lineage,
    and every later reader sees the same rows even if an executor is lost."""
    path = work_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def bit_filter(keys: DataFrame, key: str, rows: int = 1024) -> DataFrame:
    """A bitmap of hashed `key` values: at most `rows` rows of 4 KB, however many keys.

    The size is a parameter, not a function of the data, so it can be broadcast. A
    fuller bitmap lets more strangers pass; it never loses a member.
    """
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(rows * _ROW_BITS))
    return (keys.select(place.alias("p")).groupBy(F.floor(F.col("p") / _ROW_BITS).alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.col("p") % _ROW_BITS).alias("_bits")))


def might_be_in(frame: DataFrame, key: str, bits: DataFrame, rows: int = 1024) -> DataFrame:
    """`frame` with a boolean column `_maybe`: false means that `key` is surely no member."""
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(rows * _ROW_BITS))
    probed = (frame.withColumn("_place", place)
              .withColumn("_bucket", F.floor(F.col("_place") / _ROW_BITS))
              .join(F.broadcast(bits), "_bucket", "left"))
    offset = (F.col("_place") % _ROW_BITS).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(offset / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.pow(F.lit(2), offset % 8).cast("int"))
    return (probed.withColumn("_maybe", F.coalesce(hit != 0, F.lit(False)))
            .drop("_place", "_bucket", "_bits"))
