"""Joins that don't send a common key's rows to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is common if it has over this share of all rows, and this many rows at least: fewer
#: than 1 / SHARE keys are, whatever the size of the tables.
SHARE, LEAST_ROWS = 0.001, 1000


def unique_join(rows: DataFrame, unique: DataFrame, key: str, uses: str) -> DataFrame:
    """Inner join of ``rows`` with ``unique``, which has one row a key and in ``uses`` the number
    of the key's rows in ``rows`` (the column doesn't come out). Keys are not null.

    The rows of common keys meet a broadcast of those keys (fewer than a thousand) where they
    are; only the others are shuffled. ``unique`` is read three times, so it should be a
    written table or a checkpoint."""
    total = unique.agg(F.sum(uses)).first()[0] or 0
    bound = max(LEAST_ROWS, int(total * SHARE))
    columns = [c for c in unique.columns if c != uses]
    common, others = unique.where(F.col(uses) > bound).select(columns), unique.where(F.col(uses) <= bound).select(columns)
    if total <= LEAST_ROWS or common.isEmpty():
        return rows.join(unique.select(columns), key)
    few = F.broadcast(common)
    return rows.join(few, key).unionByName(rows.join(few.select(key), key, "left_anti").join(others, key))


def counted_left_join(rows: DataFrame, unique: DataFrame, key: str) -> DataFrame:
    """The left join of ``rows`` with ``unique``, which has one row a key, where nobody has counted the
    keys yet: that is one more aggregation of the keys. Fewer than a thousand common keys reach
    the driver; their rows meet a broadcast, the others are shuffled."""
    total = rows.count()
    bound = max(LEAST_ROWS, int(total * SHARE))
    found = rows.groupBy(key).count().where(F.col("count") > bound).select(key).collect() if total > LEAST_ROWS else []
    if not found:
        return rows.join(unique, key, "left")
    common = F.col(key).isin([bytes(r[0]) if isinstance(r[0], bytearray) else r[0] for r in found])
    return rows.where(common).join(F.broadcast(unique.where(common)), key, "left").unionByName(rows.where(~common).join(unique, key, "left"))
