"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string")) % folds


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once, and only where it is needed."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sums_before(sizes: Column, block: int = 256) -> Column:
    """For an array of numbers the array of the sums of all that come before each, as longs.

    A block of sums is built at a time and the blocks' own sums likewise, so that no
    append copies a long array."""
    sums = "struct<at:bigint,got:array<bigint>>"

    def step(a: Column, size: Column) -> Column:
        return F.struct((a["at"] + size).alias("at"), F.array_append(a["got"], a["at"]).alias("got")).cast(sums)

    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("got")).cast(sums)
    blocks = F.filter(F.sequence(F.lit(0), F.floor(F.size(sizes) / block).cast("int")), lambda b: b * block < F.size(sizes))
    inner = F.transform(blocks, lambda b: F.aggregate(F.slice(sizes, b * block + 1, block), none, step))

    def placed(found: Column) -> Column:
        bases = F.aggregate(found, none, lambda a, x: step(a, x["at"]), lambda a: a["got"])
        return F.flatten(F.zip_with(found, bases, lambda x, base: F.transform(x["got"], lambda v: v + base)))

    return let(inner, placed)
