"""Registered queries for URL normalisation, dedup and the search-site run (U*, K1-K3, S16, M7)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirewire.functions import urls as U
from hirewire.operators import dedup as K
from hirewire.operators.process import ORDER_COLS, process_jobs
from hirewire.operators.url_index import UrlIndex
from hirewire.plans import sqlgen as S
from hirewire.plans.common import table
from hirewire.session import ensure_checkpoint_dir, write_shared
from hirewire.sources import fixtures as X

UC = X.url_cases_sql()


def _cases(spark, sf_dir) -> DataFrame:
    return X.url_cases(spark, sf_dir)


def _split_sql(select: str, src: str = "url_cases", col: str = "url") -> str:
    ctes, last = S.url_split_ctes(src, col, "u")
    return "WITH " + ",\n".join([UC] + ctes) + f"\nSELECT {select} FROM {last}"


def u1_url_split(spark, sf_dir):
    c = U.with_url_parts(_cases(spark, sf_dir), "url", "")
    return c.select("page_id", "variant", "scheme", "netloc", "path", "query", "fragment")


U1_SQL = _split_sql("page_id, variant, _scheme AS scheme, _netloc AS netloc, _path AS path, _query AS query, "
                    "_fragment AS fragment")


def u2_path_trim(spark, sf_dir):
    c = _cases(spark, sf_dir)
    return U.with_url_parts(c, "url", "_").select("page_id", "variant", U.trim_path("_path").alias("path"))


U2_SQL = _split_sql(f"page_id, variant, {S.trim_path('_path')} AS path")


def u3_drop_tracking(spark, sf_dir):
    c = _cases(spark, sf_dir)
    kept = U.drop_tracking(U.query_pairs("_query"))
    return U.with_url_parts(c, "url", "_").select("page_id", "variant", F.array_join(F.transform(kept, lambda p: p["k"]), ",").alias("kept_names"))


U3_SQL = _split_sql("page_id, variant, array_to_string(list_transform("
                    f"{S.drop_tracking(S.query_pairs('_query'))}, lambda p: p.k), ',') AS kept_names")


def u4_sort_params(spark, sf_dir):
    c = _cases(spark, sf_dir)
    srt = U.sort_params(U.query_pairs("_query"))
    return U.with_url_parts(c, "url", "_").select("page_id", "variant",
                    F.array_join(F.transform(srt, lambda p: F.concat(p["k"], F.lit(":"), p["v"])), "|").alias("pairs"))


U4_SQL = _split_sql("page_id, variant, array_to_string(list_transform("
                    f"list_sort({S.query_pairs('_query')}), lambda p: p.k || ':' || p.v), '|') AS pairs")


def u5_encode_params(spark, sf_dir):
    c = _cases(spark, sf_dir)
    return U.with_url_parts(c, "url", "_").select("page_id", "variant", U.normalize_query("_query").alias("query"))


U5_SQL = _split_sql(f"page_id, variant, {S.normalize_query('_query')} AS query")


def u6_normalize_url(spark, sf_dir):
    c = _cases(spark, sf_dir)
    return U.with_normalized_url(c, "url", "normalized_url").select("page_id", "variant", "url", "normalized_url")


def _norm_sql(src_cte: str, src: str, url: str, out: str, select: str, tail: str = "") -> str:
    ctes, last = S.normalize_url_ctes(src, url, out)
    return "WITH " + ",\n".join([src_cte] + ctes) + f"\nSELECT {select} FROM {last} {tail}"


U6_SQL = _norm_sql(UC, "url_cases", "url", "normalized_url", "page_id, variant, url, normalized_url")

# --- K: gates, in-batch dedup, new-only -----------------------------------

P = X.postings_sql()
_JOBS_SQL = f"""jobs AS (
  SELECT p.*, {S.country('location')} AS country FROM postings p WHERE {S.is_entry_level('title')}),
kept AS (
  SELECT posting_id, platform_rank, company_seq, page_no, item_pos, platform, title, company, location, url,
         company_url, company_logo, posted_date, country, {S.work_type('location')} AS work_type,
         {S.role_category('title', 'department')} AS role_category, {S.experience_level('title')} AS experience_level
  FROM jobs WHERE location IS NOT NULL AND location <> '' AND country IS NOT NULL
    AND {S.staleness_keep('posted_date', X.RUN_TS)})"""
_KCOLS = ["posting_id", "platform", "title", "company", "location", "url", "posted_date", "country",
          "work_type", "role_category", "experience_level"]


def _candidates(spark, sf_dir) -> DataFrame:
    """F1 survivors with their normalised url, before the gate."""
    jobs = process_jobs(X.postings(spark, sf_dir), X.RUN_TS, keep=["posting_id"] + ORDER_COLS)
    return K.with_normalized_url(jobs)


def _gated(spark, sf_dir) -> DataFrame:
    c = _candidates(spark, sf_dir)
    return c.filter(K.quality_gate(c))


def _winners(spark, sf_dir) -> DataFrame:
    """K2 over the gated rows, which are written once, as a run writes its staged rows."""
    return K.first_wins(write_shared(spark, _gated(spark, sf_dir), "gated"), "url", ORDER_COLS)


def _gate_sql() -> str:
    blank = lambda x: f"({x} IS NULL OR {S.py_strip(x)} = '')"
    return f"nurl IS NOT NULL AND nurl <> '' AND NOT {blank('company')} AND NOT {blank('title')}"


def k1_quality_gate(spark, sf_dir):
    return _gated(spark, sf_dir).select(*_KCOLS)


_KSEL = ", ".join("nurl AS url" if c == "url" else c for c in _KCOLS)
K1_SQL = _norm_sql(f"{P},\n{_JOBS_SQL}", "kept", "url", "nurl", _KSEL, f"WHERE {_gate_sql()}")


def k2_in_batch_dedup(spark, sf_dir):
    return _winners(spark, sf_dir).select(*_KCOLS)


_RANKED = (f"(SELECT *, row_number() OVER (PARTITION BY nurl ORDER BY platform_rank, company_seq, page_no, "
           f"item_pos) AS rn FROM {{last}} WHERE {_gate_sql()}) r")


def _k2_sql(tail: str = "") -> str:
    ctes, last = S.normalize_url_ctes("kept", "url", "nurl")
    ranked = _RANKED.format(last=last)
    return ("WITH " + ",\n".join([f"{P},\n{_JOBS_SQL}"] + ctes)
            + f"\nSELECT {_KSEL} FROM {ranked} WHERE rn = 1 {tail}")


K2_SQL = _k2_sql()


def _stored_urls(spark, sf_dir) -> DataFrame:
    """The target's url column: what an earlier run stored (derived from 'view' events)."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "view")
    return ev.select(F.concat(F.lit("https://jobs.example.com/p/"), (F.col("event_id") % 703).cast("string"))
                     .alias("url"))


_STORED_SQL = ("SELECT 'https://jobs.example.com/p/' || CAST(event_id % 703 AS VARCHAR) AS url "
               "FROM events WHERE event_type = 'view'")


def k3_new_only_anti_join(spark, sf_dir):
    return K.new_only(_winners(spark, sf_dir).select(*_KCOLS), _stored_urls(spark, sf_dir))


def k3_indexed_new_only(spark, sf_dir):
    """K3 against a table of 100 stored batches through its URL index: only files that may hold a new row's URL are read."""
    stored = _stored_urls(spark, sf_dir).distinct().withColumn("batch_id", F.format_string("b-%09d", F.pmod(F.xxhash64("url"), F.lit(100))))
    index = UrlIndex(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/indexed-{uuid.uuid4().hex[:12]}")
    index.add(stored)
    index.compact(keep_last=24)
    return index.new_only(write_shared(spark, _winners(spark, sf_dir).select(*_KCOLS), "winners"))


K3_SQL = _k2_sql(f"AND nurl NOT IN ({_STORED_SQL})")


# --- S16 / M7: the search site's in-run dedup and per-search counts --------

SH = X.search_hits_sql()


def s16_search_run_dedup(spark, sf_dir):
    hits = X.search_hits(spark, sf_dir)
    return K.first_wins(hits, "url", ["search_id", "page_no", "item_pos"])


S16_SQL = (f"WITH {SH} SELECT search_id, page_no, item_pos, url FROM (SELECT *, row_number() OVER "
           f"(PARTITION BY url ORDER BY search_id, page_no, item_pos) AS rn FROM search_hits) WHERE rn = 1")


def m7_search_counts(spark, sf_dir):
    hits = X.search_hits(spark, sf_dir)
    firsts = K.first_wins(hits, "url", ["search_id", "page_no", "item_pos"])
    found = hits.groupBy("search_id").agg(F.count(F.lit(1)).alias("found"))
    new = firsts.groupBy("search_id").agg(F.count(F.lit(1)).alias("new_unique"))
    per = found.join(new, "search_id", "left").fillna(0, ["new_unique"])
    # The running total is over the eight-row aggregate, never over the hits.
    w = Window.orderBy("search_id").rowsBetween(Window.unboundedPreceding, 0)
    return per.select("search_id", "found", "new_unique", F.sum("new_unique").over(w).alias("total_unique"))


M7_SQL = f"""WITH {SH},
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY search_id, page_no, item_pos) AS rn
                          FROM search_hits) WHERE rn = 1),
per AS (SELECT f.search_id, f.found, coalesce(n.new_unique, 0) AS new_unique
        FROM (SELECT search_id, count(*) AS found FROM search_hits GROUP BY 1) f
        LEFT JOIN (SELECT search_id, count(*) AS new_unique FROM firsts GROUP BY 1) n USING (search_id))
SELECT search_id, found, new_unique,
       CAST(sum(new_unique) OVER (ORDER BY search_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
         AS total_unique
FROM per"""

QUERIES = {
    "U1_url_split": (u1_url_split, U1_SQL),
    "U2_path_trim": (u2_path_trim, U2_SQL),
    "U3_drop_tracking_params": (u3_drop_tracking, U3_SQL),
    "U4_sort_params": (u4_sort_params, U4_SQL),
    "U5_encode_params": (u5_encode_params, U5_SQL),
    "U6_normalize_url": (u6_normalize_url, U6_SQL),
    "K1_quality_gate": (k1_quality_gate, K1_SQL),
    "K2_in_batch_dedup": (k2_in_batch_dedup, K2_SQL),
    "K3_new_only_anti_join": (k3_new_only_anti_join, K3_SQL),
    "K3_I2_indexed_new_only": (k3_indexed_new_only, K3_SQL),
    "S16_search_run_dedup": (s16_search_run_dedup, S16_SQL),
    "M7_search_counts": (m7_search_counts, M7_SQL),
}
