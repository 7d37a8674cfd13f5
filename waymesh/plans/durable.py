"""Intermediate results that outlive the executors that made them.

Everything goes to the folder the cluster names in ``spark.checkpoint.dir``. Only on a local
master without that setting (tests, a laptop) a folder of our own is used; a cluster without it
is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The shared folder; sets the checkpoint folder of the context where there is none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not named and not re.match(r"local(\[|$)", context.master):  # not local-cluster
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="waymesh-"))
    return named or context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage once and cut its lineage there."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def table_path(spark: SparkSession, name: str) -> str:
    """A new folder for a table, below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/waymesh-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it again."""
    path = table_path(df.sparkSession, name)
    df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage through Hadoop's file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Latest:
    """A table of an iteration: each version is written like ``written``, and then the one before it
    is deleted, so that two versions at most are on disk. Nothing else may still read the older."""

    def __init__(self, name: str) -> None:
        self.name, self.path = name, ""

    def put(self, df: DataFrame) -> DataFrame:
        spark, old = df.sparkSession, self.path
        self.path = table_path(spark, self.name)
        df.write.options(compression="zstd").parquet(self.path)
        if old:
            remove(spark, old)
        return spark.read.schema(df.schema).parquet(self.path)


def tables_of_runs(spark: SparkSession) -> list[tuple[str, int]]:
    """(path, time of change in milliseconds) of the tables that runs have left in the shared folder."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_root(spark))
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.listStatus(root) if files.exists(root) else []
    return [(x.getPath().toString(), x.getModificationTime()) for x in found if x.getPath().getName().startswith("waymesh-")]


def prune(spark: SparkSession, before_ms: int) -> int:
    """Delete the tables that were last changed before a time; their number. Results that still
    read from them can't be computed again."""
    old = [path for path, changed in tables_of_runs(spark) if changed < before_ms]
    for path in old:
        remove(spark, path)
    return len(old)
