"""String functions on payload fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what replaces everything after the first three characters.
PHONE_MASK = "********"


def mask_phone(phone: Column, keep: int = 3) -> Column:
    return F.concat(F.substring(phone, 1, keep), F.lit(PHONE_MASK))


def has_keyword(text: Column, keyword: str | None) -> Column:
    """Case-insensitive containment; an empty keyword accepts every row."""
    if not keyword:
        return F.lit(True)
    return F.contains(F.lower(text), F.lit(keyword.lower()))


def last_entry_wins(entries: Column, key: str) -> Column:
    """Keep, of array entries with the same key, only the last one."""
    names = entries[key]
    size = F.size(entries)
    thinned = F.filter(
        entries, lambda e, i: F.array_position(F.reverse(names), e[key]) == size - i)
    # Equal keys are rare: most arrays pass after one look at their names.
    return F.when(F.size(F.array_distinct(names)) == size, entries).otherwise(thinned)
