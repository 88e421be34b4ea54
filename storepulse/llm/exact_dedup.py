"""Exact duplicates by progressive refinement: length and prefix first, full hash for survivors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storepulse.llm.scratch import bit_filter, might_be_in, stage

#: Characters that do not count when texts are compared.
WHITE = " \t\n\x0b\x0c\r"


def squeezed(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return reduce(lambda c, w: F.replace(c, F.lit(w), F.lit("")), WHITE, F.coalesce(text, F.lit("")))


def _coarse(docs: DataFrame, id_col: str, text_col: str, prefix: int, *more: Column) -> DataFrame:
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), *more,
        F.length(F.coalesce(text, F.lit(""))).cast("long").alias("n_points"),
        squeezed(text).alias("_norm"),
    ).withColumn("n_bytes", F.octet_length("_norm").cast("long")).withColumn(
        "_coarse", F.xxhash64("n_bytes", F.substring("_norm", 1, prefix)))


def refine(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 64,
           digest_all: bool = False, carry: list[str] | None = None) -> DataFrame:
    """One row per input row: `doc_id`, `n_points`, `_coarse`, `_full` (and `carry`).

    First pass: rows are counted by length of the squeezed text and hash of its first
    `prefix` characters. Only rows whose pair occurs twice or more get the full hash
    (`_full`, SHA-256) in the second pass; a row alone in its pair is no copy of any
    other. Which pairs recur is told by a bitmap of fixed size, so no text is shuffled;
    a stranger that it lets pass is merely hashed too. `digest_all` hashes every row.
    """
    pairs = _coarse(docs, id_col, text_col, prefix).groupBy("_coarse").count().filter("count > 1")
    bits = stage(bit_filter(pairs, "_coarse"), "dedup-bits")
    again = might_be_in(_coarse(docs, id_col, text_col, prefix, *(F.col(c) for c in carry or ())),
                        "_coarse", bits)
    full = F.when(F.col("_maybe") | F.lit(digest_all), F.sha2(F.col("_norm").cast("binary"), 256))
    return again.withColumn("_full", full).drop("_norm", "_maybe", "n_bytes")


def groups(rows: DataFrame) -> DataFrame:
    """Groups of equal texts: `_coarse`, `_full`, `keep_id`, `keep_points`, `keep_times`
    (rows that share id and length with the one to keep) and `group_size`.

    Rows are combined before each shuffle, so a group of any size is a few rows.
    """
    counted = rows.groupBy("_coarse", "_full", "doc_id", "n_points").agg(F.count("*").alias("n"))
    best = F.max(F.struct("n_points", F.col("doc_id").isNotNull().alias("named"),
                          F.bitwise_not("doc_id").alias("back"), "n"))
    return (counted.groupBy("_coarse", "_full").agg(best.alias("b"), F.sum("n").alias("group_size"))
            .select("_coarse", "_full", F.col("b.n_points").alias("keep_points"),
                    F.bitwise_not("b.back").alias("keep_id"), F.col("b.n").alias("keep_times"),
                    "group_size"))


def _join_groups(rows: DataFrame, found: DataFrame) -> DataFrame:
    """`rows` with the columns of their group; a group's key may hold a null hash."""
    found = found.select(F.col("_coarse").alias("_c"), F.col("_full").alias("_f"),
                         "keep_points", "keep_id", "keep_times", "group_size")
    same = (rows["_coarse"] == found["_c"]) & rows["_full"].eqNullSafe(found["_f"])
    return rows.join(found, same).drop("_c", "_f")


def _is_first():
    return F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_points"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     digest_all: bool = False) -> DataFrame:
    """Every row of `docs` with its group: `doc_id`, `keep_id`, `group_size`, `kept`, `text_sha256`.

    Texts are equal when they are identical without white space; null counts as empty,
    so null, empty and blank texts form one group. The row with the most code points in
    the original text, then the smallest id, stays (a null id comes last). Rows that
    repeat both id and length within a group are interchangeable: exactly one is marked
    kept. `text_sha256` is null for rows that were never hashed, unless `digest_all`.
    An empty table gives an empty result; other columns of `docs` are not touched.
    """
    rows = stage(refine(docs, id_col, text_col, digest_all=digest_all), "dedup-rows")
    counted = rows.groupBy("_coarse", "_full", "doc_id", "n_points").agg(F.count("*").alias("n"))
    return _join_groups(counted, groups(rows)).select(
        "doc_id", "keep_id", "group_size", _is_first().alias("_first"),
        F.col("_full").alias("text_sha256"), F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("_i"),
    ).select("doc_id", "keep_id", "group_size", (F.col("_first") & (F.col("_i") == 1)).alias("kept"),
             "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with their columns as they were; rules as above.

    Texts travel only where a group has several rows: the rest passes by the bitmap.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    packed = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), whole)
    rows = stage(refine(packed, "_id", "_text"), "dedup-rows")
    several = stage(groups(rows).filter("group_size > 1"), "dedup-groups")
    bits = stage(bit_filter(several, "_coarse"), "dedup-bits")
    told = might_be_in(_coarse(packed, "_id", "_text", 64, F.col("_row")), "_coarse", bits)
    alone = told.filter(~F.col("_maybe")).select("_row")
    hashed = told.filter("_maybe").withColumn("_full", F.sha2(F.col("_norm").cast("binary"), 256)) \
        .select("_row", "doc_id", "n_points", "_coarse", "_full")
    found = several.select("_coarse", "_full", "keep_id", "keep_points", "keep_times")
    met = hashed.join(found, ["_coarse", "_full"], "left")
    first = met.filter(F.col("keep_points").isNull() | _is_first())
    once = first.filter(F.coalesce("keep_times", F.lit(1)) == 1).select("_row")
    repeats = first.filter("keep_times > 1").dropDuplicates(["_coarse", "_full"]).select("_row")
    return alone.unionByName(once).unionByName(repeats).select("_row.*")
