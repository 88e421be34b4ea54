"""Search in sale details: a page of rows, their number, and who the buyers are."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storepulse.functions.text import has_keyword

# Age groups of the facet, each with its upper end (exclusive).
AGE_GROUPS = [(20, "<20"), (31, "20-30")]
OLDEST_GROUP = ">30"


def search(details: DataFrame, day: str, keyword: str | None = None) -> DataFrame:
    """Rows of a day whose item name contains the keyword, in any case."""
    return details.filter((F.col("dt") == day) & has_keyword(F.col("sku_name"), keyword))


def page(found: DataFrame, offset: int, size: int, key: str = "order_detail_id") -> DataFrame:
    """Rows offset .. offset + size of the result in key order.

    Spark keeps the first offset + size rows of every task, so a deep offset
    costs that much per task; step through a long result with `page_after`.
    """
    return found.orderBy(key).offset(offset).limit(size)


def page_after(found: DataFrame, after: str | None, size: int,
               key: str = "order_detail_id") -> DataFrame:
    """The next `size` rows behind the last key of the page before; the key must be unique."""
    rest = found if after is None else found.filter(F.col(key) > after)
    return rest.orderBy(key).limit(size)


def total(found: DataFrame) -> DataFrame:
    return found.agg(F.count("*").alias("total"))


def facets(found: DataFrame) -> DataFrame:
    """`facet`, `value`, `n`, `share` for age groups and genders, from one pass over the rows."""
    age = F.coalesce(*[F.when(F.col("user_age") < end, F.lit(name)) for end, name in AGE_GROUPS],
                     F.lit(OLDEST_GROUP))
    counts = (found
              .select(F.inline(F.array(
                  F.struct(F.lit("age").alias("facet"), age.alias("value")),
                  F.struct(F.lit("gender").alias("facet"), F.col("user_gender").alias("value")))))
              .groupBy("facet", "value").agg(F.count("*").alias("n")))
    # A facet has as few rows as it has values, so this window is small.
    share = F.col("n") / F.sum("n").over(Window.partitionBy("facet"))
    return counts.withColumn("share", share)


def result_json(found: DataFrame, offset: int, size: int, rows: DataFrame | None = None) -> DataFrame:
    """The page with its total and both facets as one JSON object; the page bounds its length.
    `rows`: the page, if a store has found it already.

    One pass over the rows counts every (age group, gender); total and facets are added up
    from those few counts. A second pass takes the page. A facet without rows has no options.
    """
    age = F.coalesce(*[F.when(F.col("user_age") < end, F.lit(name)) for end, name in AGE_GROUPS],
                     F.lit(OLDEST_GROUP))
    counts = found.groupBy(age.alias("age"), F.col("user_gender").alias("gender")).agg(F.count("*").alias("n"))
    listed = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
                        F.collect_list(F.struct("age", "gender", "n")).alias("c"))

    def options(by: str):
        names = F.array_sort(F.array_distinct(F.transform("c", lambda e: e[by])))
        return F.transform(names, lambda name: F.struct(name.alias("name"), F.aggregate(
            F.filter("c", lambda e: e[by].eqNullSafe(name)), F.lit(0).cast("long"),
            lambda total, e: total + e["n"]).alias("value")))

    stat = F.array(*[F.struct(F.lit(by).alias("facet"), options(by).alias("options")) for by in ("age", "gender")])
    head = listed.select("total", stat.alias("stat"), F.lit(None).cast("string").alias("_row"))
    row = F.struct("order_detail_id", *[c for c in found.columns if c != "order_detail_id"])
    rows = (page(found, offset, size) if rows is None else rows).select(row.alias("_row"))
    detail = rows.agg(F.sort_array(F.collect_list("_row")).alias("detail"))
    one = head.drop("_row").unionByName(detail, allowMissingColumns=True)
    merged = one.agg(F.first("total", True).alias("total"), F.first("stat", True).alias("stat"),
                     F.first("detail", True).alias("detail"))
    return merged.select(F.to_json(F.struct("total", "stat", "detail")).alias("json"))
