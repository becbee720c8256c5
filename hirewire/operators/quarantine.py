"""Row quarantine (S2-S4, M3, F2, K1-K5): what a run read and didn't store, with its reason and source key.

One table, partitioned by ``batch_id`` like the jobs table, so a replayed batch rewrites its own rows. Four levels:

- ``registry``: entries that S2-S4 reject (``detail`` lists the missing keys);
- ``company``: companies of which an answer broke the parser as a whole;
- ``posting``: every parsed posting that wasn't stored, by run, company, search, page and position;
- ``batch``: two rows for each batch, ``n`` postings ``read`` and ``stored``, which also replace the rows of a batch
  that a replay finds nothing wrong with.

The rows come from tables that the run has written anyway: nothing is parsed again, and what the join of candidates with
their verdicts shuffles is keys and outcomes, no texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewire.session import observed

SCHEMA = ("level string, reason string, run_ts timestamp_ntz, platform string, company_seq bigint, search_id int, page_no int, "
          "item_pos bigint, detail string, n bigint")


def _rows(df: DataFrame, level: str, reason: Column, **given: Column) -> DataFrame:
    """``df`` in the table's shape: columns come from ``given``, then from ``df``, and are null otherwise."""
    given = {"level": F.lit(level), "reason": reason, "detail": F.lit(""), "n": F.lit(1), **given}
    names = [c.split() for c in SCHEMA.split(", ")]
    value = lambda c: given[c] if c in given else F.col(c) if c in df.columns else F.lit(None)
    return df.select(*[value(c).cast(t).alias(c) for c, t in names])


def of_registry(rejects: DataFrame) -> DataFrame:
    """The rejects of ``sources.registry.validate``."""
    return _rows(rejects, "registry", F.col("reason"), platform=F.col("ats_platform"), detail=F.array_join("missing", ","))


def of_companies(success: DataFrame) -> DataFrame:
    """The failed ones of M3's (platform, company_seq, failed)."""
    return _rows(success.where("failed"), "company", F.lit("undecodable_answer"))


def of_postings(outcomes: DataFrame) -> DataFrame:
    """The postings of a run's ``outcomes`` that weren't stored; one without an outcome counts as ``unknown``."""
    return _rows(outcomes.where(~F.col("outcome").eqNullSafe("new")), "posting", F.coalesce("outcome", F.lit("unknown")))


def of_batch(spark: SparkSession, read: int, stored: int) -> DataFrame:
    counts = spark.createDataFrame([("read", read), ("stored", stored)], "what string, n bigint")
    return _rows(counts, "batch", F.col("what"), n=F.col("n"))


def write(spark: SparkSession, outcomes: DataFrame, success: DataFrame, stats, path: str, batch_id: str,
          registry_rejects: DataFrame | None = None) -> int:
    """Write a batch's quarantine and return its postings, counted on their way into the files. ``stats`` is the run's row
    of M1; if the postings written and stored don't add up to those read, the batch raises ``RowsLost``."""
    rows = of_postings(outcomes).unionByName(of_companies(success))
    rows = rows.unionByName(of_batch(spark, stats["total_jobs_found"], stats["new_jobs_stored"]))
    if registry_rejects is not None:
        rows = rows.unionByName(of_registry(registry_rejects))
    counted, seen = observed(rows, "quarantine", {"postings": F.count_if(F.col("level") == "posting")})
    (counted.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))
    dropped = seen()["postings"]
    if dropped + stats["new_jobs_stored"] != stats["total_jobs_found"]:
        raise RowsLost(f"batch {batch_id}: {stats['total_jobs_found']} postings read, {stats['new_jobs_stored']} stored, {dropped} quarantined")
    return dropped


class RowsLost(RuntimeError):
    """Postings read, stored and quarantined don't add up."""


def read(spark: SparkSession, path: str) -> DataFrame:
    """All quarantined rows with their ``batch_id``."""
    return spark.read.schema(f"{SCHEMA}, batch_id string").parquet(path)
