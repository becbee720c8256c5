"""Landed payloads (S8-S15): from the ``landing`` table to the pages each parser reads.

``landing``: run_ts TIMESTAMP_NTZ, platform, company_seq BIGINT, search_id INT, kind
('list'|'detail'|'html_list'), page_no INT, item_key, status INT, attempt INT, body.
Partition it by ``platform`` (and run date) so each platform branch prunes to its files.
A run (``run_ts``) is the unit: the same request of another run is another request. All
that has landed is read; no shuffle carries a body unless a request has several answers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirewire.session import write_shared
from hirewire.sources.registry import opt

LANDING_SCHEMA = ("run_ts timestamp_ntz, platform string, company_seq bigint, search_id int, kind string, "
                  "page_no int, item_key string, status int, attempt int, body string")

REQUEST_KEY = ["run_ts", "platform", "company_seq", "search_id", "kind", "page_no", "item_key"]


def good_answer() -> Column:
    return F.coalesce(F.col("status").between(200, 299) & F.col("body").isNotNull(), F.lit(False))


def request_outcomes(landing: DataFrame) -> DataFrame:
    """One row per request of a run with ``ok``: whether any of its attempts got a usable answer (429s,
    timeouts, 404s and errors are none). A narrow aggregate; bodies are not shuffled."""
    return landing.groupBy(*REQUEST_KEY).agg(F.max(good_answer()).alias("ok"))


def usable_pages(landing: DataFrame) -> DataFrame:
    """One row per request of every run that got a good answer: the latest one, whatever its attempt.

    Nearly all requests were answered once. The keys of the others are found by an aggregate that reads no body and are
    written, so that Spark knows their size when it plans the joins; if there are none, that is all. Only the bodies of
    those requests are compared (latest attempt, then greatest hash) and shuffled, one for each request and input
    partition; an answer that landed twice byte for byte is one answer. All other bodies stay in the scan."""
    spark = landing.sparkSession
    cols = [c for c in landing.columns if c not in ("attempt", "status")]
    answered = landing.where(F.col("status").between(200, 299))
    several = answered.groupBy(*REQUEST_KEY).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*REQUEST_KEY)
    several = write_shared(spark, several, "several-answers")
    platforms = [r[0] for r in several.select("platform").distinct().collect()]
    good = landing.where(good_answer())
    if not platforms:
        return good.select(*cols)
    same = [F.col(f"k.{c}").eqNullSafe(F.col(f"g.{c}")) for c in REQUEST_KEY]
    once = good.alias("g").join(several.alias("k"), same, "left_anti").select(*cols)
    among = good.where(F.col("platform").isin(*platforms)).alias("g").join(several.alias("k"), same, "left_semi")
    latest = among.groupBy(*REQUEST_KEY).agg(F.max_by("body", F.struct("attempt", F.xxhash64("body"))).alias("body"))
    return once.unionByName(write_shared(spark, latest.select(*cols), "latest-answers", "platform"))


def config_ok(platform: Column, raw: Column, board_slug: Column) -> Column:
    """The company yields nothing when its platform's configuration is missing."""
    has = lambda k: F.trim(opt(raw, k)) != ""
    slug = lambda k: (F.trim(opt(raw, k)) != "") | (F.trim(F.coalesce(board_slug, F.lit(""))) != "")
    wd = F.regexp_replace(F.trim(opt(raw, "workday_url_template")), "/+$", "")
    return (F.when(platform == "workday", (wd != "") & wd.contains("/wday/cxs/"))
            .when(platform == "oracle", has("oracle_host"))
            .when(platform == "eightfold", has("eightfold_host") & has("eightfold_domain"))
            .when(platform == "taleo", has("taleo_host") & has("taleo_portal"))
            .when(platform == "successfactors", has("sf_host"))
            .when(platform == "phenom", has("phenom_host"))
            .when(platform == "talentplatform", has("tp_host"))
            .when(platform == "bamboohr", slug("bamboohr_subdomain"))
            .when(platform == "breezy", slug("breezy_subdomain"))
            .when(platform == "recruitee", slug("recruitee_subdomain"))
            .when(platform == "jobvite", slug("jobvite_company"))
            .otherwise(F.lit(True)))


def attach_details(items: DataFrame, details: DataFrame) -> DataFrame:
    """Each item gets the text of its detail payload of the same run, '' where none landed.
    ``details``: run_ts, platform, company_seq, item_key, detail (texts only, not the bodies)."""
    key = ["run_ts", "platform", "company_seq", "item_key"]
    one = details.groupBy(*key).agg(F.max("detail").alias("detail"))
    return items.join(one, key, "left").withColumn("detail", F.coalesce("detail", F.lit("")))


COMPANY_RUN = ("run_ts", "platform", "company_seq")


def lacking(fallback: DataFrame, primary: DataFrame, key=COMPANY_RUN) -> DataFrame:
    """The rows of ``fallback`` whose run and company have no row in ``primary``."""
    return fallback.join(primary.select(*key).distinct(), list(key), "left_anti")


def prefer(primary: DataFrame, fallback: DataFrame, key=COMPANY_RUN) -> DataFrame:
    """Per run and company, the primary rows when it has any, else the fallback rows."""
    return primary.unionByName(lacking(fallback, primary, key), allowMissingColumns=True)


def union_platforms(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL of every platform's raw jobs (provenance columns carry arrival order)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
