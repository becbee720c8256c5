"""Registered queries for the registry sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirewire.sources import fixtures as X
from hirewire.sources import registry as R
from hirewire.sources.fixtures import sql_list


def _entries(spark, sf_dir):
    return R.scan(X.registry_documents(spark, sf_dir))


_ENABLED_KEEP = [0, 1, 3, 9, 10]  # s_suppkey % 11 values whose 'enabled' is absent or truthy
_SUP = f"""sup AS (
  SELECT s_suppkey, s_name,
         (s_suppkey // {X.REGISTRY_DOC_SIZE}) * 4294967296
           + row_number() OVER (PARTITION BY s_suppkey // {X.REGISTRY_DOC_SIZE} ORDER BY s_suppkey) - 1 AS company_seq,
         list_extract({sql_list(X.REGISTRY_PLATFORMS)}, (s_suppkey % {len(X.REGISTRY_PLATFORMS)}) + 1) AS ats_platform,
         CASE WHEN s_suppkey % 19 = 0 OR s_suppkey % 23 = 0 THEN NULL ELSE 'slug' || s_suppkey END AS board_slug,
         CASE WHEN s_suppkey % 19 = 0 THEN 'board_slug' ELSE '' END AS missing_keys
  FROM supplier)"""
_VALID = f"ats_platform IN ({', '.join(repr(p) for p in X.PLATFORM_CYCLE)})"


def s1_registry_scan(spark, sf_dir):
    return _entries(spark, sf_dir).select("company_seq", "company_name", "ats_platform", "board_slug")


S1_SQL = f"WITH {_SUP} SELECT company_seq, s_name AS company_name, ats_platform, board_slug FROM sup"


def s2_registry_required_keys(spark, sf_dir):
    e = _entries(spark, sf_dir)
    return e.select("company_seq", F.array_join(R.missing_keys(F.col("keys")), ",").alias("missing_keys"))


S2_SQL = f"WITH {_SUP} SELECT company_seq, missing_keys FROM sup"


def s3_registry_valid_platform(spark, sf_dir):
    e = _entries(spark, sf_dir).where(F.size(R.missing_keys(F.col("keys"))) == 0)
    from hirewire.functions import dims
    from hirewire.functions.sqlexpr import in_list
    return e.where(F.coalesce(in_list(F.col("ats_platform"), dims.PLATFORMS), F.lit(False))) \
            .select("company_seq", "ats_platform")


S3_SQL = f"WITH {_SUP} SELECT company_seq, ats_platform FROM sup WHERE missing_keys = '' AND {_VALID}"


def s4_registry_enabled(spark, sf_dir):
    good, _ = R.validate(_entries(spark, sf_dir))
    return good.select("company_seq", "company_name", "ats_platform")


S4_SQL = (f"WITH {_SUP} SELECT company_seq, s_name AS company_name, ats_platform FROM sup "
          f"WHERE missing_keys = '' AND {_VALID} AND s_suppkey % 11 IN ({', '.join(map(str, _ENABLED_KEEP))})")


def s4b_registry_rejects(spark, sf_dir):
    _, bad = R.validate(_entries(spark, sf_dir))
    return bad.select("company_seq", "reason")


REJECTS_SQL = f"""WITH {_SUP} SELECT company_seq, ats_platform, missing_keys, CASE WHEN missing_keys <> '' THEN 'missing_keys'
  WHEN NOT coalesce({_VALID}, false) THEN 'bad_platform' ELSE 'disabled' END AS reason
FROM sup WHERE NOT (missing_keys = '' AND {_VALID} AND s_suppkey % 11 IN ({', '.join(map(str, _ENABLED_KEEP))}))"""


S4B_SQL = f"SELECT company_seq, reason FROM ({REJECTS_SQL})"


def s5_run_scope_filter(spark, sf_dir):
    good, _ = R.validate(_entries(spark, sf_dir))
    return R.scope(good, platform="workday").select("company_seq", "company_name")


S5_SQL = (f"WITH {_SUP} SELECT company_seq, s_name AS company_name FROM sup WHERE missing_keys = '' "
          f"AND ats_platform = 'workday' AND s_suppkey % 11 IN ({', '.join(map(str, _ENABLED_KEEP))})")


def s6_group_by_platform(spark, sf_dir):
    good, _ = R.validate(_entries(spark, sf_dir))
    return R.group_by_platform(good)


S6_SQL = f"""WITH {_SUP}, g AS (
  SELECT ats_platform, count(*) AS n_companies, min(company_seq) AS first_seq FROM sup
  WHERE missing_keys = '' AND {_VALID} AND s_suppkey % 11 IN ({', '.join(map(str, _ENABLED_KEEP))}) GROUP BY 1)
SELECT ats_platform, n_companies, CAST(rank() OVER (ORDER BY first_seq) AS INTEGER) AS platform_rank FROM g"""

QUERIES = {
    "S1_registry_scan": (s1_registry_scan, S1_SQL),
    "S2_registry_required_keys": (s2_registry_required_keys, S2_SQL),
    "S3_registry_valid_platform": (s3_registry_valid_platform, S3_SQL),
    "S4_registry_enabled": (s4_registry_enabled, S4_SQL),
    "S4_registry_rejects": (s4b_registry_rejects, S4B_SQL),
    "S5_run_scope_filter": (s5_run_scope_filter, S5_SQL),
    "S6_group_by_platform": (s6_group_by_platform, S6_SQL),
}
