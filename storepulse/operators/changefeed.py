"""Database change entries to order messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storepulse import schemas
from storepulse.functions import text

# Which inserted rows go to which topic.
DEFAULT_ROUTES = {"order_info": schemas.TOPIC_ORDER}


def row_json(after: Column) -> Column:
    """One JSON object of an after-image: text values, the last of equal names wins."""
    cells = text.last_entry_wins(after, "name")
    return F.to_json(F.map_from_entries(F.filter(cells, lambda c: c["value"].isNotNull())))


def flatten_changes(entries: DataFrame, routes: dict[str, str] | None = None,
                    types: tuple[str, ...] = ("INSERT",)) -> DataFrame:
    """`topic` and JSON `value` of every row of the wanted entries.

    Keeps row data only, of the routed tables and the given statement types. A
    statement that touched many rows gives as many messages.
    """
    routes = DEFAULT_ROUTES if routes is None else routes
    topic = F.coalesce(*[F.when(F.col("table") == table, F.lit(name))
                         for table, name in routes.items()])
    wanted = entries.filter(
        (F.col("entry_type") == "ROWDATA")
        & F.col("table").isin(*routes)
        & F.col("type").isin(*types)
        & (F.size("rows") > 0))
    return (wanted.select(topic.alias("topic"), F.explode("rows").alias("_row"))
            .select("topic", row_json(F.col("_row.after")).alias("value")))
