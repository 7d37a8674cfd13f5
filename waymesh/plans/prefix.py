"""Running totals over a table in a given order, without putting it in one partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymesh.plans.durable import checkpointed


def running_totals(df: DataFrame, order: list[str], values: list[str], shard: str = "shard") -> DataFrame:
    """``df`` with, for each of ``values``, ``<value>_before``: its sum over all rows that come
    earlier in ``order`` (a total order), and ``shard``, the number of the row's range.

    Rows are dealt by ranges of ``order``; a range's own running sum is added to the total
    of the ranges before it. Only one row per range meets in one task."""
    dealt = checkpointed(df.repartitionByRange(*order).withColumn(shard, F.spark_partition_id()))
    ahead = Window.orderBy(shard).rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(shard).agg(*[F.sum(v).alias(f"_{v}") for v in values])
    ranges = sums.select(shard, *[F.coalesce(F.sum(f"_{v}").over(ahead), F.lit(0)).alias(f"_{v}_base") for v in values])
    inside = Window.partitionBy(shard).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    made = dealt.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_{v}_in") for v in values])
    made = made.join(ranges, shard)
    return made.select(*df.columns, shard, *[(F.col(f"_{v}_base") + F.col(f"_{v}_in")).cast("long").alias(f"{v}_before") for v in values])
