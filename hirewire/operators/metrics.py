"""Funnel metrics and health gates (M1-M6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirewire.sources.landing import good_answer

COUNTERS = ["total_companies", "companies_succeeded", "companies_failed", "total_jobs_found", "jobs_after_filter",
            "new_jobs_stored", "duplicates_skipped", "db_errors"]


UNGUARDED = ["greenhouse", "lever", "ashby"]  # boards whose parsers don't guard the decoding of a body


def failed_companies(landing: DataFrame) -> DataFrame:
    """M3 input: (run_ts, platform, company_seq) of the companies of which a good list answer breaks the parser as
    a whole: undecodable JSON, or no object where one is read. Only the three boards that don't guard
    their decode are scanned."""
    doc = F.try_parse_json("body")
    bad = doc.isNull() | ((F.col("platform") != "lever") & ~F.schema_of_variant(doc).startswith("OBJECT"))
    lists = landing.where(F.col("platform").isin(UNGUARDED) & (F.col("kind") == "list") & good_answer())
    return lists.where(F.coalesce(bad, F.lit(True))).select("run_ts", "platform", "company_seq").distinct()


def company_success(companies: DataFrame, failed: DataFrame) -> DataFrame:
    """M3: per company, failed when it failed in one of the runs; no pages is a success."""
    f = failed.select(F.col("platform").alias("ats_platform"), "company_seq").distinct().withColumn("failed", F.lit(True))
    return companies.select("company_seq", "ats_platform").join(f, ["ats_platform", "company_seq"], "left") \
        .select(F.col("ats_platform").alias("platform"), "company_seq", F.coalesce("failed", F.lit(False)).alias("failed"))


def run_stats(outcomes: DataFrame, success: DataFrame) -> DataFrame:
    """M1: the eight counters as one row (``jobs_after_filter`` is declared but never counted,
    as in the original; ``candidates`` carries the real number). One aggregate over the
    job outcomes and the company results side by side."""
    jobs = outcomes.select(F.lit("job").alias("kind"), "outcome", F.lit(None).cast("boolean").alias("failed"))
    cos = success.select(F.lit("company").alias("kind"), F.lit(None).cast("string").alias("outcome"), "failed")
    both = jobs.unionByName(cos)
    job, co = F.col("kind") == "job", F.col("kind") == "company"
    return both.agg(
        F.count_if(co).alias("total_companies"),
        F.count_if(co & ~F.col("failed")).alias("companies_succeeded"),
        F.count_if(co & F.col("failed")).alias("companies_failed"),
        F.count_if(job).alias("total_jobs_found"),
        F.lit(0).cast("long").alias("jobs_after_filter"),
        F.count_if(job & (F.col("outcome") == "new")).alias("new_jobs_stored"),
        F.count_if(job & F.col("outcome").isin("duplicate", "gate_reject")).alias("duplicates_skipped"),
        F.count_if(job & (F.col("outcome") == "db_error")).alias("db_errors"),
        F.count_if(job & ~F.col("outcome").startswith("filtered")).alias("candidates"))


def staged_counters(unstorable: Column) -> dict[str, Column]:
    """What M1 needs of the staged rows (outcome, gate_ok), to be observed on their write."""
    cand = F.col("outcome") == "candidate"
    return {"found": F.count(F.lit(1)), "candidates": F.count_if(cand), "gate_reject": F.count_if(cand & ~F.col("gate_ok")),
            "refused": F.count_if(cand & F.col("gate_ok") & unstorable)}


def observed_stats(success: DataFrame, seen: dict[str, int], new: int, refused_late: int = 0) -> DataFrame:
    """M1 from what was observed on the writes of a run: no job outcome is read again. The same row as ``run_stats``."""
    co = success.agg(F.count(F.lit(1)).alias("n"), F.count_if("failed").alias("failed")).first()
    refused = seen["refused"] + refused_late
    row = {"total_companies": co["n"], "companies_succeeded": co["n"] - co["failed"], "companies_failed": co["failed"], "total_jobs_found": seen["found"],
           "jobs_after_filter": 0, "new_jobs_stored": new, "duplicates_skipped": seen["candidates"] - refused - new, "db_errors": refused, "candidates": seen["candidates"]}
    return success.sparkSession.createDataFrame([tuple(row.values())], ", ".join(f"{k} long" for k in row))


def stats_by_platform(outcomes: DataFrame) -> DataFrame:
    """M2: outcomes per platform and per company, with platform subtotals (ROLLUP)."""
    return outcomes.rollup("platform", "company_seq").agg(
        F.count(F.lit(1)).alias("found"),
        F.count_if(F.col("outcome") == "new").alias("new"),
        F.count_if(F.col("outcome").isin("duplicate", "gate_reject")).alias("skipped"))


def parse_counts(raw: DataFrame) -> DataFrame:
    """M6: jobs parsed per company."""
    return raw.groupBy("platform", "company_seq").agg(F.count(F.lit(1)).alias("jobs_parsed"))


def total_stats(rows: list) -> dict:
    """The counters of several batches, summed."""
    return {k: sum(r[k] for r in rows) for k in COUNTERS}


def check_health(stats_row) -> None:
    """M4/M5: fail the run on write errors with nothing stored, or on output that vanished."""
    if stats_row["db_errors"] > 0 and stats_row["new_jobs_stored"] == 0:
        raise RuntimeError(f"{stats_row['db_errors']} write errors and 0 jobs stored")
    if stats_row["total_jobs_found"] > 0 and stats_row["new_jobs_stored"] == 0 and stats_row["duplicates_skipped"] == 0:
        raise RuntimeError(f"found {stats_row['total_jobs_found']} jobs but stored 0 and skipped 0")
