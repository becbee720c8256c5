"""classify and filter raw postings, then project the stored record shape.

Order follows the per-job rule chain: title (C1/C2) -> location (C5) -> staleness (D9)
-> role category (C6). ``classify_all`` keeps every row with an ``outcome`` for the
funnel metrics; ``process_jobs`` keeps only the survivors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirewire.functions import classify as C
from hirewire.functions import dates as D
from hirewire.functions.text import col_

# Provenance columns that fix arrival order (first-wins dedup) and lineage.
ORDER_COLS = ["platform_rank", "company_seq", "page_no", "item_pos"]
RUN_ORDER = ["run_ts", "platform_rank", "company_seq", "search_id", "page_no", "item_pos"]

JOB_COLS = ["platform", "title", "company", "location", "url", "description", "posted_date",
            "salary_range", "company_logo", "company_url", "ats_type", "work_type", "role_category",
            "country", "experience_level"]


def _run_ts(run_ts) -> Column:
    return F.lit(run_ts).cast("timestamp_ntz") if isinstance(run_ts, str) else col_(run_ts)


def classify_all(raw: DataFrame, run_ts) -> DataFrame:
    """Every raw row plus its F2 ``outcome`` (filtered_* or 'candidate') and its classification as far as the rule chain
    gets: a country for entry-level rows, a role category for candidates."""
    ts = _run_ts(run_ts)
    staged = C.with_country_of(raw.withColumn("entry_level", C.is_entry_level("title")), "location", "entry_level")
    fresh = D.staleness_keep("posted_date", ts)
    outcome = (F.when(~F.col("entry_level"), F.lit("filtered_title"))
               .when(~C.located(), F.lit("filtered_location"))
               .when(~fresh, F.lit("filtered_stale"))
               .otherwise(F.lit("candidate")))
    staged = staged.withColumn("outcome", outcome)
    staged = C.with_role_category(staged, "title", "department", only=F.col("outcome") == "candidate")
    return staged.select(
        "*",
        F.when(F.col("entry_level"), C.experience_level("title")).alias("experience_level"),
        C.work_type("location").alias("work_type"),
    )


def process_jobs(raw: DataFrame, run_ts, keep=()) -> DataFrame:
    """the survivors, projected to the 15 stored columns (+ ``keep`` passthrough columns)."""
    ts = _run_ts(run_ts)
    kept = C.with_country(raw.filter(C.is_entry_level("title")), "location")
    kept = (kept.filter(C.located())
                .filter(D.staleness_keep("posted_date", ts)))
    kept = C.with_role_category(kept, "title", "department", "role_category")
    return kept.select(
        *[F.col(k) for k in keep],
        "platform", "title", "company", "location", "url",
        F.coalesce("description", F.lit("")).alias("description"),
        "posted_date",
        F.coalesce("salary_range", F.lit("")).alias("salary_range"),
        F.coalesce("company_logo", F.lit("")).alias("company_logo"),
        F.coalesce("company_url", F.lit("")).alias("company_url"),
        F.col("platform").alias("ats_type"),
        C.work_type("location").alias("work_type"),
        "role_category",
        "country",
        C.experience_level("title").alias("experience_level"),
    )
