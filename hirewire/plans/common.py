"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WRITTEN: dict = {}


def written_table(spark: SparkSession, name: str, sf_dir: str, build, partition_by=None) -> DataFrame:
    """Build a derived table once per session, write it under the shared ``spark.checkpoint.dir``
    (lineage cut, re-readable by any executor), and read it back."""
    import hashlib

    from hirewire.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark)
    key = (spark.sparkContext.applicationId, name, sf_dir)
    if key not in _WRITTEN:
        tag = hashlib.sha1(f"{key}".encode()).hexdigest()[:12]
        path = f"{base.rstrip('/')}/tables/{name}-{tag}"
        w = build(spark, sf_dir).write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        _WRITTEN[key] = path
    return spark.read.parquet(_WRITTEN[key])
