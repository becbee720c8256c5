"""Sink (K4-K6, I4): enrich new rows, write them idempotently, read the stored URLs.

The target is a parquet table partitioned by ``batch_id``. Appending a batch is a
dynamic-partition overwrite of its own partition, so replaying a batch rewrites the
same rows instead of adding more; the new-only anti-join excludes the current batch.
Old batches, an hour's few rows each, are merged into few files by ``compact``.
"""

from __future__ import annotations

import uuid
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewire.functions import dims
from hirewire.functions.domains import with_resolved_logo
from hirewire.operators.versions import VersionLog

STORED_COLS = ["platform", "title", "company", "location", "url", "description", "posted_date", "salary_range",
               "company_logo", "company_domain", "company_url", "ats_type", "source_platform", "work_type",
               "role_category", "country", "experience_level"]
EVOLVED_COLS = {"company_domain": "", "company_url": ""}
_TYPES = {"posted_date": "timestamp_ntz"}
_DEFAULT_TYPES = {k: "timestamp_ntz" if k == "last_viewed_at" else "int" if v is None or isinstance(v, int) else "string"
                  for k, v in dims.SINK_DEFAULTS.items()}
STORED_SCHEMA = ", ".join([f"{c} {_TYPES.get(c, 'string')}" for c in STORED_COLS] + [f"{c} {t}" for c, t in _DEFAULT_TYPES.items()]
                          + ["scraped_at timestamp_ntz", "batch_id string"])


def unstorable(cols) -> Column:
    """A row the database rejects: a text with a NUL character."""
    return F.coalesce(reduce(lambda a, b: a | b, [F.col(c).contains("\x00") for c in cols]), F.lit(False))


def enrich(new_rows: DataFrame) -> DataFrame:
    """K4: resolve logo and registrable domain only for rows that will be stored."""
    return with_resolved_logo(new_rows, "company", "company_url", "company_logo", "company_logo", "company_domain")


def to_stored(df: DataFrame, run_ts, batch_id: str | Column) -> DataFrame:
    """K5 shape: the 17 written columns, the owner-side defaults, ``scraped_at`` and ``batch_id`` (a value or a column)."""
    ts = F.lit(run_ts).cast("timestamp_ntz") if isinstance(run_ts, str) else run_ts
    if "ats_type" not in df.columns:
        df = df.withColumn("ats_type", F.col("platform"))
    for c in ("description", "salary_range", "company_logo", "company_url", "company_domain"):
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit("")))
    cols = [F.col(c) for c in STORED_COLS if c != "source_platform"] + [F.lit("ats").alias("source_platform")]
    defaults = []
    for k, v in dims.SINK_DEFAULTS.items():
        defaults.append(F.lit(v).cast(_DEFAULT_TYPES[k]).alias(k))
    return df.select(*cols, *defaults, ts.alias("scraped_at"), F.lit(batch_id).alias("batch_id"))


def append(df: DataFrame, path: str) -> None:
    """K5/I4: write the batch's partition; a replay of the same batch overwrites only it. If the batch was merged with
    others meanwhile, its merged rows stop counting when the new ones are there."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("batch_id").parquet(path))
    log = merged_log(df.sparkSession, path)
    number, merged = log.newest({})
    if merged:
        again = {r[0] for r in df.select("batch_id").distinct().collect()}
        if any(again & set(batches) for batches in merged.values()):
            log.commit(number, {name: [b for b in batches if b not in again] for name, batches in merged.items()})


def merged_log(spark: SparkSession, path: str) -> VersionLog:
    """Which folders of merged batches count, and for which batches: {folder: [batch_id]}."""
    return VersionLog(spark, f"{path.rstrip('/')}/_merged/versions")


def compact(spark: SparkSession, path: str, keep_last: int = 24, rows_per_file: int = 1_000_000, schema: str | None = None,
            most_folders: int = 16) -> int:
    """I4: rewrite the batches that have partitions of their own, but for the newest ``keep_last`` (by id), into few files
    of a folder below ``_merged``; returns how many. With ``most_folders`` folders they become one. Rows keep their ``batch_id``, so a batch can still be replayed. The change is one new
    version: readers see the batches in the one place or the other. The old partitions stay for readers that have
    planned already, until ``remove_merged`` is called."""
    log = merged_log(spark, path)
    number, merged = log.newest({})
    done = {b for batches in merged.values() for b in batches}
    own = sorted(unquote(n.split("=", 1)[1]) for n in log.names(path) if n.startswith("batch_id="))
    old = [b for b in own[:len(own) - keep_last] if b not in done]
    if len(old) < 2:
        return 0
    rows = spark.read.schema(schema or STORED_SCHEMA).parquet(path).where(F.col("batch_id").isin(*old))
    again = merged if len(merged) >= most_folders and done else {}
    if again:
        rows = rows.unionByName(_merged_rows(spark, path, again, schema or STORED_SCHEMA))
    name = f"m-{uuid.uuid4().hex[:12]}"
    rows.repartition(max(1, -(-rows.count() // rows_per_file))).write.parquet(f"{path.rstrip('/')}/_merged/{name}")
    log.commit(number, {**({} if again else merged), name: old + (sorted(done) if again else [])})
    return len(old)


def remove_merged(spark: SparkSession, path: str) -> list[str]:
    """Delete the own partitions of merged batches and merged folders without a batch; to be called when no reader that planned
    before the last ``compact`` is at work. Returns the batches."""
    log = merged_log(spark, path)
    merged = log.newest({})[1]
    there = {unquote(n.split("=", 1)[1]): n for n in log.names(path) if n.startswith("batch_id=")}
    gone = [b for batches in merged.values() for b in batches if b in there]
    for b in gone:
        log.delete(f"{path.rstrip('/')}/{there[b]}")
    for name in log.names(f"{path.rstrip('/')}/_merged"):
        if name.startswith("m-") and not merged.get(name):  # replayed since, or merged into another folder
            log.delete(f"{path.rstrip('/')}/_merged/{name}")
    return gone


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the table's folder is there, asked of its own file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_target(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """K6 on read: None for a table that isn't there yet; any other failure is raised, as taking it for an empty
    table would store every URL again. The schema is fixed (``STORED_SCHEMA`` unless given): columns that
    older batches lack come back as NULL, so no footers are merged, and ``conform`` fills them in."""
    if not exists(spark, path):
        return None
    table = spark.read.schema(schema or STORED_SCHEMA).parquet(path)
    merged = merged_log(spark, path).newest({})[1]
    if any(merged.values()):
        moved = F.col("batch_id").isin(*[b for batches in merged.values() for b in batches])
        table = table.where(~moved).unionByName(_merged_rows(spark, path, merged, schema or STORED_SCHEMA))
    return conform(table)


def _merged_rows(spark: SparkSession, path: str, merged: dict[str, list[str]], schema: str) -> DataFrame:
    """The rows of merged batches: of each folder those of the batches that count there (others were replayed since)."""
    folders = [spark.read.schema(schema).parquet(f"{path.rstrip('/')}/_merged/{name}").where(F.col("batch_id").isin(*batches))
               for name, batches in merged.items() if batches]
    return reduce(DataFrame.unionByName, folders)


def conform(df: DataFrame) -> DataFrame:
    """K6: add ``company_domain`` / ``company_url`` with their '' default when a table lacks them."""
    for c, default in EVOLVED_COLS.items():
        if c not in df.columns:
            df = df.withColumn(c, F.lit(default))
        else:
            df = df.withColumn(c, F.coalesce(F.col(c), F.lit(default)))
    return df


def batch_urls(spark: SparkSession, path: str, batch_id: str) -> DataFrame:
    """(url, batch_id) of one appended batch; a batch without rows has none."""
    return spark.read.schema("url string, batch_id string").parquet(path).where(F.col("batch_id") == F.lit(batch_id))


def stored_urls(spark: SparkSession, path: str, exclude_batch: str | None = None) -> DataFrame:
    """The url column of the target (the unique key), without the batch being replayed."""
    t = read_target(spark, path)
    if t is None:
        return spark.createDataFrame([], "url string")
    if exclude_batch is not None:
        t = t.where(F.col("batch_id") != F.lit(exclude_batch))
    return t.select("url")
