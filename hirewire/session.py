"""SparkSession construction shared by the CLI, tests, bench and the driver entry."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "hirewire", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf.setdefault("spark.driver.memory", "8g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Settings every job relies on, applied to an existing session too (the driver's)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    if is_local(spark):
        # Python workers on this machine find the package where the driver found it; clusters install or ship it
        env = spark.sparkContext.environment
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        if root not in env.get("PYTHONPATH", "").split(os.pathsep):
            env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.split("[")[0] == "local"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared ``spark.checkpoint.dir``. Only a local session that has none gets a folder of its own;
    on a cluster, where executors don't see each other's disks, a missing setting is an error."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="hirewire-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def write_counted(spark: SparkSession, df: DataFrame, name: str, counters: dict[str, Column]) -> tuple[DataFrame, dict[str, int]]:
    """``write_shared``, and aggregates of the rows taken on their way into the files, instead of by a pass over them."""
    counted, seen = observed(df, name, counters)
    return write_shared(spark, counted, name), seen()


def observed(df: DataFrame, name: str, counters: dict[str, Column]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df`` with aggregates taken while an action runs over it, and what gives them afterwards."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(k) for k, c in counters.items()]), lambda: {k: v or 0 for k, v in seen.get.items()}


def write_shared(spark: SparkSession, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write a derived table below the shared checkpoint folder and read it back: its lineage ends there
    and the planner knows its size."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
