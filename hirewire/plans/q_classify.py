"""Registered queries for classification, filtering and the flagship funnel (C*, D9, F1, F2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewire.functions import classify as C
from hirewire.functions import dates as D
from hirewire.operators.process import classify_all, process_jobs
from hirewire.plans import sqlgen as S
from hirewire.sources import fixtures as X

P = X.postings_sql()


def _postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.postings(spark, sf_dir)


def flagship(spark, sf_dir):
    """Entry-level US/CA postings by country, arrangement, level and role (F1 then a hash aggregate)."""
    jobs = process_jobs(_postings(spark, sf_dir), X.RUN_TS)
    return jobs.groupBy("country", "work_type", "experience_level", "role_category") \
               .agg(F.count(F.lit(1)).alias("n_jobs"))


FLAGSHIP_SQL = f"""WITH {P},
jobs AS (
  SELECT *, {S.country('location')} AS country FROM postings
  WHERE {S.is_entry_level('title')}
)
SELECT country, {S.work_type('location')} AS work_type, {S.experience_level('title')} AS experience_level,
       {S.role_category('title', 'department')} AS role_category, count(*) AS n_jobs
FROM jobs
WHERE location IS NOT NULL AND location <> '' AND country IS NOT NULL
  AND {S.staleness_keep('posted_date', X.RUN_TS)}
GROUP BY ALL"""


def c1_senior_exclusion(spark, sf_dir):
    p = _postings(spark, sf_dir)
    return p.select("posting_id", C.is_entry_level("title").alias("is_entry_level"))


C1_SQL = f"WITH {P} SELECT posting_id, {S.is_entry_level('title')} AS is_entry_level FROM postings"


def c2_experience_level(spark, sf_dir):
    p = _postings(spark, sf_dir).filter(C.is_entry_level("title"))
    return p.select("posting_id", C.experience_level("title").alias("experience_level"))


C2_SQL = (f"WITH {P} SELECT posting_id, {S.experience_level('title')} AS experience_level "
          f"FROM postings WHERE {S.is_entry_level('title')}")


def c3_work_type(spark, sf_dir):
    p = _postings(spark, sf_dir).filter(F.col("location").isNotNull())
    return p.select("posting_id", C.work_type("location").alias("work_type"))


C3_SQL = f"WITH {P} SELECT posting_id, {S.work_type('location')} AS work_type FROM postings WHERE location IS NOT NULL"


def c4_country(spark, sf_dir):
    return C.with_country(_postings(spark, sf_dir), "location").select("posting_id", "location", "country")


C4_SQL = f"WITH {P} SELECT posting_id, location, {S.country('location')} AS country FROM postings"


def c5_location_filter(spark, sf_dir):
    return C.with_country(_postings(spark, sf_dir), "location").where(C.located()).select("posting_id", "country", C.work_type("location").alias("work_type"))


C5_SQL = f"""WITH {P}, c AS (SELECT *, {S.country('location')} AS country FROM postings)
SELECT posting_id, country, {S.work_type('location')} AS work_type FROM c
WHERE location IS NOT NULL AND location <> '' AND country IS NOT NULL"""


def c6_role_category(spark, sf_dir):
    return C.with_role_category(_postings(spark, sf_dir), "title", "department").select("posting_id", "role_category")


C6_SQL = f"WITH {P} SELECT posting_id, {S.role_category('title', 'department')} AS role_category FROM postings"


def d9_staleness_filter(spark, sf_dir):
    p = _postings(spark, sf_dir)
    return p.filter(D.staleness_keep("posted_date", X.run_ts())).select("posting_id", "posted_date")


D9_SQL = f"WITH {P} SELECT posting_id, posted_date FROM postings WHERE {S.staleness_keep('posted_date', X.RUN_TS)}"


def f1_process_jobs(spark, sf_dir):
    return process_jobs(_postings(spark, sf_dir), X.RUN_TS, keep=["posting_id"])


F1_SQL = f"""WITH {P},
jobs AS (SELECT *, {S.country('location')} AS country FROM postings WHERE {S.is_entry_level('title')})
SELECT posting_id, platform, title, company, location, url, coalesce(description, '') AS description, posted_date,
       coalesce(salary_range, '') AS salary_range, coalesce(company_logo, '') AS company_logo,
       coalesce(company_url, '') AS company_url, platform AS ats_type, {S.work_type('location')} AS work_type,
       {S.role_category('title', 'department')} AS role_category, country,
       {S.experience_level('title')} AS experience_level
FROM jobs
WHERE location IS NOT NULL AND location <> '' AND country IS NOT NULL AND {S.staleness_keep('posted_date', X.RUN_TS)}"""


def f2_outcome(spark, sf_dir):
    c = classify_all(_postings(spark, sf_dir), X.RUN_TS)
    return c.groupBy("platform", "outcome").agg(F.count(F.lit(1)).alias("n_rows"))


F2_SQL = f"""WITH {P},
c AS (SELECT *, {S.is_entry_level('title')} AS entry_level, {S.country('location')} AS country FROM postings)
SELECT platform, CASE WHEN NOT entry_level THEN 'filtered_title'
                      WHEN NOT coalesce(location IS NOT NULL AND location <> '' AND country IS NOT NULL, false)
                        THEN 'filtered_location'
                      WHEN NOT {S.staleness_keep('posted_date', X.RUN_TS)} THEN 'filtered_stale'
                      ELSE 'candidate' END AS outcome,
       count(*) AS n_rows
FROM c GROUP BY ALL"""

QUERIES = {
    "flagship_funnel": (flagship, FLAGSHIP_SQL),
    "C1_senior_exclusion": (c1_senior_exclusion, C1_SQL),
    "C2_experience_level": (c2_experience_level, C2_SQL),
    "C3_work_type": (c3_work_type, C3_SQL),
    "C4_country": (c4_country, C4_SQL),
    "C5_location_filter": (c5_location_filter, C5_SQL),
    "C6_role_category": (c6_role_category, C6_SQL),
    "D9_staleness_filter": (d9_staleness_filter, D9_SQL),
    "F1_process_jobs": (f1_process_jobs, F1_SQL),
    "F2_outcome": (f2_outcome, F2_SQL),
}
