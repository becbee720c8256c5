"""Registered queries for company domain and logo resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirewire.functions import domains as L
from hirewire.functions import urls as U
from hirewire.plans import sqlgen as S
from hirewire.plans.common import table
from hirewire.sources import fixtures as X

P = X.postings_sql()


def _url_inputs(spark, sf_dir) -> DataFrame:
    """Page URLs and the postings' company URLs, tagged by source."""
    pages = table(spark, sf_dir, "pages").select(F.lit("page").alias("source"), F.col("page_id").alias("id"),
                                                   F.col("url"))
    posts = X.postings(spark, sf_dir).select(F.lit("posting").alias("source"), F.col("posting_id").alias("id"),
                                              F.col("company_url").alias("url"))
    return pages.unionByName(posts)


_URL_INPUTS_SQL = (f"{P},\nurl_inputs AS (SELECT 'page' AS source, page_id AS id, url FROM pages "
                   f"UNION ALL SELECT 'posting', posting_id, company_url FROM postings)")


def _name_inputs(spark, sf_dir) -> DataFrame:
    """Part names and the postings' company names, tagged by source."""
    parts = table(spark, sf_dir, "part").select(F.lit("part").alias("source"), F.col("p_partkey").alias("id"),
                                                  F.col("p_name").alias("name"))
    posts = X.postings(spark, sf_dir).select(F.lit("posting").alias("source"), F.col("posting_id").alias("id"),
                                              F.col("company").alias("name"))
    return parts.unionByName(posts)


_NAME_INPUTS_SQL = (f"{P},\nname_inputs AS (SELECT 'part' AS source, p_partkey AS id, p_name AS name FROM part "
                    f"UNION ALL SELECT 'posting', posting_id, company FROM postings)")


def l1_domain_from_url(spark, sf_dir):
    return L.with_domain_from_url(_url_inputs(spark, sf_dir), "url", "domain").select("source", "id", "domain")


def _l1_sql() -> str:
    ctes, last = S.domain_from_url_ctes("url_inputs", "url", "domain")
    return "WITH " + ",\n".join([_URL_INPUTS_SQL] + ctes) + f"\nSELECT source, id, domain FROM {last}"


def l2_registrable(spark, sf_dir):
    pages = U.with_url_parts(table(spark, sf_dir, "pages").select("page_id", "url"), "url", "_")
    host = pages.select("page_id", L.hostname(F.col("_netloc")).alias("host"))
    return host.select("page_id", "host", L.registrable("host").alias("registrable"))


def _l2_sql() -> str:
    ctes, last = S.url_split_ctes("pages", "url", "u")
    return ("WITH " + ",\n".join(ctes) + f",\nh AS (SELECT page_id, {S.hostname('_netloc')} AS host FROM {last})\n"
            f"SELECT page_id, host, {S.registrable('host')} AS registrable FROM h")


def l3_domain_from_logo_url(spark, sf_dir):
    p = X.postings(spark, sf_dir)
    return p.select("posting_id", L.domain_from_logo_url("company_logo").alias("logo_domain"))


L3_SQL = f"WITH {P} SELECT posting_id, {S.domain_from_logo_url('company_logo')} AS logo_domain FROM postings"


def l4_normalize_name(spark, sf_dir):
    return _name_inputs(spark, sf_dir).select("source", "id", L.normalize_name("name").alias("normalized_name"))


L4_SQL = f"WITH {_NAME_INPUTS_SQL} SELECT source, id, {S.normalize_name('name')} AS normalized_name FROM name_inputs"


def l5_domain_from_name(spark, sf_dir):
    return L.with_domain_from_name(_name_inputs(spark, sf_dir), "name", "domain").select("source", "id", "domain")


L5_SQL = f"WITH {_NAME_INPUTS_SQL} SELECT source, id, {S.domain_from_name('name')} AS domain FROM name_inputs"


def l6_resolve_domain(spark, sf_dir):
    p = X.postings(spark, sf_dir)
    r = L.with_resolved_logo(p, "company", "company_url", "company_logo", "_logo", "domain")
    return r.select("posting_id", F.when(F.col("domain") != "", F.col("domain")).alias("domain"))


def _resolve_ctes() -> tuple[list[str], str]:
    ctes, last = S.domain_from_url_ctes("postings", "company_url", "d_url")
    c = (f"r AS (SELECT *, coalesce(d_url, {S.domain_from_logo_url('company_logo')}, "
         f"{S.domain_from_name('company')}) AS dom FROM {last})")
    return [P] + ctes + [c], "r"


def _l6_sql() -> str:
    ctes, last = _resolve_ctes()
    return "WITH " + ",\n".join(ctes) + f"\nSELECT posting_id, dom AS domain FROM {last}"


def l7_resolve_logo(spark, sf_dir):
    p = X.postings(spark, sf_dir)
    r = L.with_resolved_logo(p, "company", "company_url", "company_logo", "logo", "domain")
    return r.select("posting_id", "logo", "domain")


def _l7_sql() -> str:
    ctes, last = _resolve_ctes()
    return ("WITH " + ",\n".join(ctes) + f"\nSELECT posting_id, CASE WHEN {S.real_logo('company_logo')} "
            f"THEN company_logo ELSE {S.favicon('dom')} END AS logo, coalesce(dom, '') AS domain FROM {last}")


def l8_search_logo(spark, sf_dir):
    p = X.postings(spark, sf_dir)
    return p.select("posting_id", L.search_logo("company").alias("logo"))


L8_SQL = f"WITH {P} SELECT posting_id, {S.search_logo('company')} AS logo FROM postings"

QUERIES = {
    "L1_domain_from_url": (l1_domain_from_url, _l1_sql()),
    "L2_registrable": (l2_registrable, _l2_sql()),
    "L3_domain_from_logo_url": (l3_domain_from_logo_url, L3_SQL),
    "L4_normalize_name": (l4_normalize_name, L4_SQL),
    "L5_domain_from_name": (l5_domain_from_name, L5_SQL),
    "L6_resolve_domain": (l6_resolve_domain, _l6_sql()),
    "L7_resolve_logo": (l7_resolve_logo, _l7_sql()),
    "L8_search_logo": (l8_search_logo, L8_SQL),
}
