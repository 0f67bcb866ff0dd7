"""Scratch space that every executor can reach.

Intermediate tables that must outlive an executor are written below the folder the
session names in ``spark.checkpoint.dir``.  Only a local session without that setting
falls back to a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="stockyard-")
    return _local_roots[app]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet (not created)."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:16]}"


def spread(df: DataFrame) -> DataFrame:
    """Give a file scan at least one partition per core.

    For work that is heavy per row (training, Python tasks).  Large inputs already have more
    partitions than cores and stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def materialize(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage and survives executor loss."""
    path = fresh_dir(df.sparkSession, label)
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
