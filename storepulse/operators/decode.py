"""JSON payloads to typed rows, with unreadable rows set aside instead of failing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storepulse import schemas
from storepulse.functions import text, times

_CORRUPT = "_corrupt"
#: Amounts from here on do not fit the two-digit decimals that totals are summed in.
MOST_AMOUNT = 1e16


def _first_error(checks: list[tuple[Column, str]]) -> Column:
    """The name of the first check that holds, null if none does."""
    return F.coalesce(*[F.when(bad, F.lit(name)) for bad, name in checks])


def _is_blank(column: Column) -> Column:
    return column.isNull() | (column == "")


def decode_json(rows: DataFrame, schema: T.StructType, value: str = "value",
                keep: Sequence[str] = ()) -> DataFrame:
    """Fields of `schema`, the raw payload as `_raw` and a reason as `_error`; columns `keep` beside them.

    Unknown keys are ignored and missing keys are null. Every field is read as
    text first and cast afterwards, because producers quote their numbers.

    The payload is parsed inside a generator, so that later filters on its
    fields cannot be pushed below the parse, where they would repeat it.
    """
    as_text = T.StructType(
        [T.StructField(f.name, T.StringType()) for f in schema.fields]
        + [T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value), as_text, {"columnNameOfCorruptRecord": _CORRUPT})
    read = rows.select(*keep, F.col(value).alias("_raw"), F.inline(F.array(parsed)))

    columns, checks = [], [
        (F.coalesce(F.trim("_raw"), F.lit("")) == "", "empty"),
        (F.col(_CORRUPT).isNotNull(), "bad_json"),
    ]
    for field in schema.fields:
        raw = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            columns.append(raw.alias(field.name))
        else:
            typed = raw.try_cast(field.dataType)
            columns.append(typed.alias(field.name))
            checks.append((~_is_blank(raw) & typed.isNull(), f"bad_{field.name}"))
    return read.select(*keep, *columns, "_raw", _first_error(checks).alias("_error"))


def _also_reject(rows: DataFrame, checks: list[tuple[Column, str]]) -> DataFrame:
    return rows.withColumn("_error", F.coalesce("_error", _first_error(checks)))


def _with_text(schema: T.StructType, extra: Sequence[str]) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(c, T.StringType()) for c in extra])


def _decode_log(rows: DataFrame, schema: T.StructType, value: str,
                extra: Sequence[str]) -> DataFrame:
    logs = _also_reject(decode_json(rows, _with_text(schema, extra), value), [
        (F.col("mid").isNull(), "missing_mid"),
        (F.col("ts").isNull(), "missing_ts"),
        (~times.usable_ms(F.col("ts")), "bad_ts"),
    ])
    return logs.withColumns({"log_date": times.log_date(F.col("ts")),
                             "log_hour": times.log_hour(F.col("ts"))})


def decode_startup(rows: DataFrame, value: str = "value", extra: Sequence[str] = ()) -> DataFrame:
    """App starts with their day and hour; `extra` names further fields to keep as text."""
    return _decode_log(rows, schemas.STARTUP, value, extra)


def decode_event(rows: DataFrame, value: str = "value", extra: Sequence[str] = ()) -> DataFrame:
    """User actions with their day and hour."""
    return _decode_log(rows, schemas.EVENT, value, extra)


def decode_order(rows: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Order messages with masked phones and the date and hour of their creation."""
    orders = decode_json(rows, schemas.ORDER, value, keep).withColumns({
        "create_date": times.create_date(F.col("create_time")),
        "create_hour": times.create_hour(F.col("create_time")),
        "consignee_tel": text.mask_phone(F.col("consignee_tel")),
    })
    amount = F.col("total_amount")
    return _also_reject(orders, [
        (F.isnan(amount) | (F.abs(amount) >= MOST_AMOUNT), "bad_total_amount"),
        (F.col("consignee_tel").isNull(), "missing_consignee_tel"),
        (_is_blank(F.col("create_date")) | F.col("create_hour").isNull(), "bad_create_time"),
        (_is_blank(F.col("id")), "missing_id"),
    ])


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("_error").isNull()).drop("_raw", "_error")


def quarantined(decoded: DataFrame) -> DataFrame:
    """The payloads that could not be used, each with its reason."""
    return decoded.filter(F.col("_error").isNotNull()).select("_raw", "_error")
