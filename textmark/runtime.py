"""Session-level helpers: where to put shared files, how to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may go without the setting: it gets a temporary folder,
    which on a cluster would be invisible to the other machines.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    # One JVM only: the executors of local-cluster[...] are processes of their own.
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="textmark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/textmark/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and continue from there.

    Afterwards the rows keep their partitions and their order, however often
    they are read and whichever executors are lost.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back, whatever its partitions."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores when the scan has fewer partitions than cores.

    Large inputs already have more splits than cores and come back unchanged,
    without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def compact(df: DataFrame, rows: int, per_core: int = 2, per_partition: int = 2000, least: int = 1) -> DataFrame:
    """At most a few partitions per core, fewer for few rows, without a shuffle.

    Learners return one dense, vocabulary-wide buffer per partition and label, in
    every iteration; this bounds their number by the cluster, not by the data.
    Use it on persisted rows, which keep their own small partitions below.  ``least`` are
    left if there are so many: learners that keep rows dense bound them by bytes.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    most = max(1, least, min(per_core * cores, -(-rows // per_partition)))
    return df.coalesce(most) if df.rdd.getNumPartitions() > most else df
