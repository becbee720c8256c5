"""Registered queries for the payload extractors (P1-P16, X1-X8 inside them).

Spark side: the landed-payload fixture (written once per session under the checkpoint
dir, partitioned by platform) -> S8 -> registry join -> S9 -> the platform's parser.
Oracle side: the expected columns computed straight from ``postings`` (no JSON parsing).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hirewire.functions import dims
from hirewire.plans import sqlgen as S
from hirewire.plans.common import written_table
from hirewire.operators.extract import finish_descriptions
from hirewire.operators.metrics import failed_companies
from hirewire.operators.paging import PAGED, page_accounts
from hirewire.plans.run import board_pages, drop_failed_companies, platform_raw_jobs, raw_jobs, search_raw_jobs
from hirewire.sources import fixtures as X
from hirewire.sources import fixtures_landing as FL
from hirewire.sources import landing as LD
from hirewire.sources.fixtures import sql_list, sql_str

OUT = ["run_ts", "company_seq", "item_key", "title", "company", "location", "url", "posted_date", "department", "company_url",
       "company_logo", "description", "salary_range", "employment_type"]


def landing_table(spark, sf_dir):
    return written_table(spark, "landing", sf_dir,
                         lambda s, d: FL.landing(s, d).unionByName(FL.search_pages(s, d)), ["platform"])


def companies_table(spark, sf_dir):
    return written_table(spark, "companies", sf_dir, FL.companies)


def _platform_query(platform: str):
    def q(spark, sf_dir):
        land = landing_table(spark, sf_dir).where(F.col("platform") == platform)
        jobs = platform_raw_jobs(board_pages(land, companies_table(spark, sf_dir)), platform)
        return finish_descriptions(drop_failed_companies(jobs, failed_companies(land), platform)).select(*OUT)
    q.__name__ = f"extract_{platform}"
    q.__doc__ = f"Parse the landed {platform} payloads of all runs into raw jobs."
    return q


# Both landed runs; the second one has some companies again, with items that the first one lacks.
_RUNS = f"(VALUES (1, TIMESTAMP '{X.RUN_TS}'), (2, TIMESTAMP '{FL.SECOND_RUN}')) r(run, run_ts)"
_LANDED = (f"(CASE WHEN (posting_id % {FL.N_COMPANIES}) % 11 <> 0 THEN run = 1 WHEN posting_id % 5 = 4 THEN run = 2 ELSE TRUE END)")
_BASE = f"""{X.postings_sql()},
it AS (
  SELECT posting_id AS e, platform, title, location, department, posted_date,
         posting_id % {FL.N_COMPANIES} AS k, posting_id // {FL.N_COMPANIES} AS idx,
         CAST(posting_id AS VARCHAR) AS pid,
         list_extract({sql_list(X.COMPANIES)}, ((posting_id % {FL.N_COMPANIES}) % {len(X.COMPANIES)}) + 1) AS company,
         CASE WHEN (posting_id % {FL.N_COMPANIES}) % 4 <> 0
              THEN 'https://www.co' || CAST(posting_id % {FL.N_COMPANIES} AS VARCHAR) || '.com' ELSE '' END AS reg_url,
         CASE WHEN (posting_id % {FL.N_COMPANIES}) % 3 = 0
              THEN 'https://logo.clearbit.com/co' || CAST(posting_id % {FL.N_COMPANIES} AS VARCHAR) || '.com' ELSE '' END
           AS reg_logo,
         '<p>' || coalesce(title, '') || ' &amp; team</p><ul>'
           || repeat('<li>Ship it</li>', CASE WHEN posting_id % 50 = 0 THEN 400 ELSE 1 END) || '</ul>' AS html,
         run_ts
  FROM postings, {_RUNS} WHERE (posting_id % {FL.N_COMPANIES}) % 43 <> 0 AND {_LANDED})"""


_TEXT = S.strip_tags_nl(S.unescape4("html"))


def _sel(platform: str, item_key: str, title: str, location: str, url: str, posted: str, department: str,
         company_url: str = "reg_url", where: str = "TRUE", with_base: bool = True, description: str = "''",
         salary: str = "''", employment: str = "CAST(NULL AS VARCHAR)") -> str:
    return (f"WITH {_BASE}\n" if with_base else "") + (
        f"SELECT run_ts, CAST(k AS BIGINT) AS company_seq, {item_key} AS item_key, {title} AS title, company, {location} AS location, "
        f"{url} AS url, {posted} AS posted_date, {department} AS department, {company_url} AS company_url, reg_logo AS company_logo, "
        f"{description} AS description, {salary} AS salary_range, {employment} AS employment_type, 0 AS platform_rank, 0 AS page_no, "
        f"idx AS item_pos, CAST(e AS BIGINT) AS e, {sql_str(platform)} AS platform"
        f"\nFROM it WHERE platform = {sql_str(platform)} AND ({where})")


TRUTHY_TITLE = "title IS NOT NULL AND title <> ''"
# Companies whose landed payload includes an undecodable chunk fail as a whole (M3).
TRUTHY_NOT_FAILED = f"{TRUTHY_TITLE} AND k % {FL.BROKEN_MOD} <> 0"
KS = "CAST(k AS VARCHAR)"
SQL = {
    "greenhouse": _sel("greenhouse", "pid", "title", "coalesce(location, '')",
                       f"'https://boards.greenhouse.io/b' || {KS} || '/jobs/' || pid",
                       "date_trunc('second', posted_date)", "coalesce(department, '')", "''", f"{TRUTHY_NOT_FAILED} AND e % 30 <> 7",
                       description=S.strip_tags_nl(S.unescape4("(html || CASE WHEN e % 6 = 1 THEN '<p>$90,000 - $120,000</p>' ELSE '' END)")),
                       salary="CASE WHEN e % 6 = 0 THEN '$10 to $20' WHEN e % 6 = 1 THEN '$90,000 - $120,000' ELSE '' END"),
    "lever": _sel("lever", f"'https://jobs.lever.co/b' || {KS} || '/' || pid", "title", "coalesce(location, '')",
                  f"'https://jobs.lever.co/b' || {KS} || '/' || pid", "date_trunc('millisecond', posted_date)",
                  "coalesce(nullif(department, ''), '')", "''", TRUTHY_NOT_FAILED, description=S.strip_re(S.unescape4("title")),
                  salary="CASE WHEN e % 4 = 0 THEN '$50/hr' ELSE '' END", employment="'Full-time'"),
    "ashby": _sel("ashby", f"'https://jobs.ashbyhq.com/b' || {KS} || '/' || pid", "title", "coalesce(location, '')",
                  f"'https://jobs.ashbyhq.com/b' || {KS} || '/' || pid", "date_trunc('second', posted_date)",
                  "coalesce(department, '')", "''", TRUTHY_NOT_FAILED,
                  description=f"CASE WHEN e % 3 <> 0 THEN {_TEXT} ELSE {S.strip_re(S.unescape4(chr(40) + chr(39) + ' plain ' + chr(39) + ' || title)'))} END",
                  employment="CASE WHEN e % 2 = 0 THEN 'FullTime' ELSE '' END"),
}

_WD_CITY = f"list_extract({sql_list(FL.WORKDAY_CITIES)}, (e % {len(FL.WORKDAY_CITIES)}) + 1)"
_WD_CITY_SP = f"trim(replace({_WD_CITY}, '-', ' '))"
SQL["workday"] = _sel(
    "workday", f"'/job/' || {_WD_CITY} || '/Role_R' || pid", "title",
    f"CASE WHEN e % 3 = 0 THEN {_WD_CITY_SP} || ' (2 Locations)' WHEN coalesce(location, '') = '' THEN {_WD_CITY_SP} "
    f"ELSE location END",
    f"'https://acme' || {KS} || '.wd5.myworkdayjobs.com/External/job/' || {_WD_CITY} || '/Role_R' || pid",
    "run_ts - to_days(CAST(e % 40 AS INTEGER))", "CAST(NULL AS VARCHAR)", "reg_url",
    f"{TRUTHY_TITLE} AND k % 29 <> 0")
SQL["oracle"] = _sel(
    "oracle", "pid", "title",
    "CASE WHEN e % 5 = 0 THEN CASE WHEN coalesce(location, '') <> '' THEN location || ' (+1 more)' ELSE 'Toronto' END "
    "ELSE coalesce(location, '') END",
    f"CASE WHEN k % 2 = 0 THEN 'https://jobs.co' || {KS} || '.com/en/sites/CX_1/job/' || pid "
    f"ELSE 'https://fa' || {KS} || '.oraclecloud.com/hcmUI/CandidateExperience/en/sites/CX_1/job/' || pid END",
    "date_trunc('day', posted_date)", "coalesce(nullif(department, ''), '')", "reg_url",
    f"{TRUTHY_TITLE} AND (e % 3 <> 2 OR e % 5 = 0)", description=S.strip_tags_nl(S.unescape4("(html || chr(10) || '<p>Degree</p>')")))
_NA = " OR ".join(f"contains(lower(coalesce(location, '')), {sql_str(m)})" for m in dims.EIGHTFOLD_NA_MARKERS)
SQL["eightfold"] = _sel(
    "eightfold", "pid", "title", "coalesce(location, '')",
    f"'https://s' || {KS} || '.eightfold.ai/careers/job/' || pid", "date_trunc('second', posted_date)",
    "department", "reg_url", f"{TRUTHY_TITLE} AND ({_NA})", description=_TEXT)
_NO_BRACKETS = "regexp_replace(coalesce(location, ''), '[\\[\\]\"]', '', 'g')"
SQL["taleo"] = _sel(
    "taleo", "pid", f"CASE WHEN title IS NULL THEN 'None' ELSE {S.strip_re('title')} END",
    f"CASE WHEN e % 7 = 1 THEN {S.strip_re(_NO_BRACKETS)} ELSE coalesce(location, '') END",
    f"'https://co' || {KS} || '.taleo.net/careersection/2/jobdetail.ftl?job=' || pid || '&lang=en'",
    "date_trunc('day', posted_date)", "CAST(NULL AS VARCHAR)", "reg_url",
    f"title IS NULL OR {S.strip_re('title')} <> ''")
_T = "coalesce(title, '')"
_SLUG = f"replace(coalesce(location, '') || '-' || {_T}, ' ', '-')"
_RMK_LOC = f"regexp_replace({S.strip_re(f'replace(replace({_SLUG}, {chr(39)}-{chr(39)}, {chr(39)} {chr(39)}), {S.strip_re(_T)}, {chr(39)} {chr(39)})')}, '\\s{{2,}}', ' ', 'g')"
SQL["successfactors"] = (
    _sel("successfactors", "pid", S.strip_re("title"), S.strip_re("coalesce(location, '')"),
         f"'https://jobs.co' || {KS} || '.com/job/' || pid", "CAST(NULL AS TIMESTAMP)", "CAST(NULL AS VARCHAR)",
         "reg_url", f"{TRUTHY_TITLE} AND k % 3 <> 0 AND k % 5 <> 1")
    + "\nUNION ALL\n" +
    _sel("successfactors", f"'/job/' || {_SLUG} || '/' || pid || '/'", S.strip_re(_T), _RMK_LOC,
         f"'https://jobs.co' || {KS} || '.com/job/' || {_SLUG} || '/' || pid || '/'", "CAST(NULL AS TIMESTAMP)",
         "CAST(NULL AS VARCHAR)", "reg_url", f"k % 3 = 0 AND k % 5 <> 0 AND {S.strip_re(_T)} <> ''",
         with_base=False))
SQL["phenom"] = _sel(
    "phenom", "'JS' || pid", S.strip_re("title"), "coalesce(nullif(location, ''), '')",
    f"'https://careers.co' || {KS} || '.com/job/JS' || pid", "date_trunc('second', posted_date)",
    "coalesce(department, '')", "reg_url", TRUTHY_TITLE, description=S.collapse_ws("('  ' || coalesce(title, '') || chr(10) || '  team ')"))
_SUB = lambda pre: f"CASE WHEN k % 2 = 0 THEN '{pre}' || {KS} ELSE 'b' || {KS} END"
SQL["bamboohr"] = _sel(
    "bamboohr", "pid", S.strip_re("title"),
    "CASE WHEN e % 3 = 0 THEN coalesce(nullif(location, '') || ', ON', 'ON') WHEN coalesce(location, '') <> '' THEN location "
    "WHEN e % 4 = 0 THEN 'Remote' ELSE 'Hybrid' END",
    f"'https://' || {_SUB('bhr')} || '.bamboohr.com/careers/' || pid", "CAST(NULL AS TIMESTAMP)",
    "coalesce(department, '')", "reg_url", TRUTHY_TITLE, description=_TEXT)
_BZ_URL = f"CASE WHEN e % 2 = 0 THEN 'https://x.breezy.hr/p/' || pid ELSE 'https://' || {_SUB('bz')} || '.breezy.hr/p/' || pid END"
SQL["breezy"] = _sel(
    "breezy", _BZ_URL, S.strip_re("title"),
    "CASE WHEN e % 5 = 0 THEN coalesce(nullif(location, '') || ', Canada', 'Canada') ELSE coalesce(nullif(location, ''), '') END", _BZ_URL,
    "date_trunc('second', posted_date)", "coalesce(nullif(department, ''), '')", "reg_url", TRUTHY_TITLE, description=_TEXT)
SQL["recruitee"] = _sel(
    "recruitee", "'https://co.recruitee.com/o/s' || pid", S.strip_re("title"),
    "CASE WHEN e % 3 <> 0 AND coalesce(location, '') <> '' THEN location ELSE 'Toronto, Canada' END",
    "'https://co.recruitee.com/o/s' || pid", "date_trunc('day', posted_date)", "coalesce(department, '')", "reg_url",
    TRUTHY_TITLE, description=_TEXT)
_JV_LOC = S.strip_re(f"regexp_replace({S.strip_re(chr(40) + 'coalesce(location, ' + chr(39) + chr(39) + ') || ' + chr(39) + ', ' + chr(39) + chr(41))}, '^,+|,+$', '', 'g')")
SQL["jobvite"] = _sel(
    "jobvite", "'/co/job/' || pid", S.strip_re("coalesce(title, '')"), _JV_LOC,
    "'https://jobs.jobvite.com/co/job/' || pid", "CAST(NULL AS TIMESTAMP)", "CAST(NULL AS VARCHAR)", "reg_url",
    f"{S.strip_re('coalesce(title, ' + chr(39) + chr(39) + ')')} <> ''")
SQL["talentplatform"] = _sel(
    "talentplatform", "'tp' || pid", S.strip_re("title"), "coalesce(nullif(location, ''), '')",
    f"'https://join.co' || {KS} || '.com/jobs/tp' || pid", "date_trunc('second', posted_date)",
    "coalesce(department, '')", "reg_url", TRUTHY_TITLE, description=_TEXT)


def p16_search_results(spark, sf_dir):
    """P16 + S16: search-site cards zipped by index (date misalignment kept), first raw URL wins."""
    land = landing_table(spark, sf_dir).where(F.col("platform") == dims.SEARCH_PLATFORM)
    return search_raw_jobs(land).select("search_id", "item_pos", "title", "company", "location", "url",
                                        "posted_date", "company_logo")


_SEARCH_LOCS = sql_list([s[1] for s in dims.SEARCHES])
_FAV_PRE, _FAV_POST = dims.FAVICON_TEMPLATE.split("{domain}")
P16_CTES = f"""cards AS (
  SELECT posting_id // {FL.SEARCH_CARDS} AS search_id, posting_id AS e, title, company, location, posted_date,
         row_number() OVER (PARTITION BY posting_id // {FL.SEARCH_CARDS} ORDER BY posting_id) - 1 AS item_pos
  FROM postings),
dated AS (
  SELECT search_id, posted_date AS d,
         row_number() OVER (PARTITION BY search_id ORDER BY e) - 1 AS date_pos
  FROM cards WHERE posted_date IS NOT NULL),
joined AS (
  SELECT c.*, dt.d FROM cards c LEFT JOIN dated dt ON c.search_id = dt.search_id AND c.item_pos = dt.date_pos),
parsed AS (
  SELECT CAST(search_id AS INTEGER) AS search_id, CAST(item_pos AS INTEGER) AS item_pos,
         {S.strip_re("coalesce(title, '')")} AS title,
         {S.strip_re("coalesce(company, '')")} AS company,
         CASE WHEN location IS NULL THEN 'Somewhere' ELSE {S.strip_re('location')} END AS location,
         'https://www.linkedin.com/jobs/view/' || CAST(e * 31 % 100003 AS VARCHAR) AS url,
         CAST(CAST(d AS DATE) AS TIMESTAMP) AS posted_date
  FROM joined)"""
P16_SQL = f"""WITH {X.postings_sql()},
{P16_CTES}
SELECT search_id, item_pos, title, company, location, url, posted_date,
       CASE WHEN company <> '' THEN {sql_str(_FAV_PRE)} || replace(lower(company), ' ', '') || '.com' || {sql_str(_FAV_POST)}
            ELSE '' END AS company_logo
FROM parsed WHERE title <> ''"""

_IDS = {"greenhouse": "P1", "lever": "P2", "ashby": "P3", "workday": "P4", "oracle": "P5", "eightfold": "P6",
        "taleo": "P7", "successfactors": "P8_P9", "phenom": "P10", "bamboohr": "P11", "breezy": "P12",
        "recruitee": "P13", "jobvite": "P14", "talentplatform": "P15"}
def _only_out(sql: str) -> str:
    return f"SELECT {', '.join(OUT)} FROM ({sql})"


QUERIES = {f"{_IDS[p]}_extract_{p}": (_platform_query(p), _only_out(SQL[p])) for p in dims.PLATFORMS}
QUERIES["P16_search_results"] = (p16_search_results, P16_SQL)


# --- S7, S8, S9, S11 on the landed fixture ---------------------------------------

def s7_platform_dispatch(spark, sf_dir):
    """Raw jobs per platform after dispatching every landed page to its parser (search site included), with the RMK pages
    of the companies of mode rmk that landed CSB pages only: that mode leaves those out, and no posting may go with them."""
    land = landing_table(spark, sf_dir).unionByName(written_table(spark, "rmk-pages", sf_dir, FL.rmk_pages))
    rj = raw_jobs(land, companies_table(spark, sf_dir))
    return rj.groupBy("platform").agg(F.count(F.lit(1)).alias("raw_jobs"))


def _s7_sql() -> str:
    parts = [SQL[p].replace(f"WITH {_BASE}\n", "", 1) for p in dims.PLATFORMS]
    parts = [x.replace("(k % 3 = 0 AND k % 5 <> 0 AND", "((k % 3 = 0 AND k % 5 <> 0 OR k % 3 <> 0 AND k % 5 = 1) AND") for x in parts]
    return ("WITH " + _BASE.replace("WITH ", "") + ",\n" + P16_CTES + ",\nraw AS (" + "\nUNION ALL\n".join(parts)
            + ")\nSELECT platform, count(*) AS raw_jobs FROM raw GROUP BY ALL\n"
            "UNION ALL SELECT 'linkedin', count(*) FROM parsed WHERE title <> ''")


def s8_response_status_filter(spark, sf_dir):
    """One outcome per request of every run (lists, details and searches): usable or not."""
    return LD.request_outcomes(landing_table(spark, sf_dir))


_GAP = f"CASE WHEN k % {FL.GAP_MOD} = 3 AND idx >= {FL.GAP_FROM} THEN {FL.GAP_PAGES} ELSE 0 END"
_RMK = "(platform = 'successfactors' AND k % 3 = 0)"
_PAGE = (f"CAST(CASE WHEN {_RMK} THEN idx // {FL.PAGE_SIZE['rmk']} ELSE idx // (CASE "
         + " ".join(f"WHEN platform = {sql_str(p)} THEN {n}" for p, n in FL.PAGE_SIZE.items() if p != "rmk") + f" ELSE {FL.CHUNK} END) + (CASE "
         + " ".join(f"WHEN platform = {sql_str(p)} THEN {v}" for p, v in FL.FIRST_PAGE.items())
         + f" ELSE 0 END) END + CASE WHEN k % 19 = 0 THEN {FL.PAGE_SHIFT} ELSE 0 END + {_GAP} AS INTEGER)")
_CSB_PAGE, _RMK_PAGE = [f"CAST(idx // {FL.PAGE_SIZE[p]} + CASE WHEN k % 19 = 0 THEN {FL.PAGE_SHIFT} ELSE 0 END + {_GAP} AS INTEGER)" for p in ("successfactors", "rmk")]
_RMK_MODE_TOO = "(platform = 'successfactors' AND k % 3 = 0 AND k % 5 = 1)"
_BOTH_KINDS = "(platform = 'successfactors' AND k % 3 = 1 AND k % 5 = 2)"


def _s8_sql() -> str:
    cols = "platform, CAST(k AS BIGINT) AS company_seq, 0 AS search_id"
    return f"""WITH {X.postings_sql()},
it AS (SELECT run_ts, run, platform, posting_id AS e, posting_id % {FL.N_COMPANIES} AS k, posting_id // {FL.N_COMPANIES} AS idx
       FROM postings, {_RUNS} WHERE {_LANDED})
SELECT DISTINCT run_ts, {cols}, CASE WHEN {_RMK} OR platform = 'jobvite' THEN 'html_list' ELSE 'list' END AS kind, {_PAGE} AS page_no,
       '' AS item_key, k % 43 <> 0 AS ok FROM it
UNION ALL SELECT DISTINCT run_ts, {cols}, 'list', {_CSB_PAGE}, '', k % 43 <> 0 FROM it WHERE {_RMK_MODE_TOO}
UNION ALL SELECT DISTINCT run_ts, {cols}, 'html_list', {_RMK_PAGE}, '', k % 43 <> 0 FROM it WHERE {_BOTH_KINDS}
UNION ALL SELECT run_ts, {cols}, 'detail', 0, CAST(e AS VARCHAR), k % 43 <> 0 FROM it WHERE platform IN ('oracle', 'eightfold', 'bamboohr')
UNION ALL SELECT DISTINCT r.run_ts, {cols}, 'list', {FL.BROKEN_PAGE}, '', k % 43 <> 0 FROM it, {_RUNS}
  WHERE platform IN ('greenhouse', 'lever', 'ashby') AND k % {FL.BROKEN_MOD} = 0 AND (r.run = 1 OR k % 11 = 0)
UNION ALL SELECT DISTINCT TIMESTAMP '{X.RUN_TS}', 'linkedin', CAST(0 AS BIGINT), CAST(posting_id // {FL.SEARCH_CARDS} AS INTEGER), 'html_list', 0, '', TRUE
  FROM postings"""


def s9_company_config_gate(spark, sf_dir):
    co = companies_table(spark, sf_dir)
    return co.select("company_seq", F.col("ats_platform").alias("platform"),
                     LD.config_ok(F.col("ats_platform"), F.col("raw"), F.col("board_slug")).alias("config_ok"))


S9_SQL = (f"SELECT DISTINCT CAST(event_id % {FL.N_COMPANIES} AS BIGINT) AS company_seq, "
          f"list_extract({sql_list(X.PLATFORM_CYCLE)}, ((event_id % {FL.N_COMPANIES}) % 14) + 1) AS platform, "
          f"NOT ((event_id % {FL.N_COMPANIES}) % 14 = 3 AND (event_id % {FL.N_COMPANIES}) % 29 = 0) AS config_ok "
          f"FROM events")


WITH_DETAILS = ["bamboohr", "eightfold", "oracle"]


def s11_detail_join(spark, sf_dir):
    """Descriptions attached from the detail payloads of the same run, for every item that has one."""
    land = landing_table(spark, sf_dir).where(F.col("platform").isin(*WITH_DETAILS))
    pages = board_pages(land, companies_table(spark, sf_dir))
    jobs = LD.union_platforms([platform_raw_jobs(pages, p) for p in WITH_DETAILS])
    return finish_descriptions(jobs).select("run_ts", "platform", "item_key", "description")


def _s11_sql() -> str:
    parts = [f"SELECT run_ts, platform, item_key, description FROM ({SQL[p].replace(f'WITH {_BASE}' + chr(10), '', 1)})" for p in WITH_DETAILS]
    return "WITH " + _BASE + "\n" + "\nUNION ALL\n".join(parts)


def s10_landed_pages(spark, sf_dir):
    """Page accounts of all paged vendors and the search site: no stop rule, gap or page number leaves a page out."""
    pages = page_accounts(LD.usable_pages(landing_table(spark, sf_dir)))
    # as text, since a nullable number would surface as a float in pandas-based comparisons
    return pages.withColumns({c: F.col(c).cast("string") for c in ("announced", "short")})


_PAGED = sql_list(list(PAGED))
S10_SQL = f"""WITH {X.postings_sql()},
it AS (SELECT run_ts, run, platform, posting_id % {FL.N_COMPANIES} AS k, posting_id // {FL.N_COMPANIES} AS idx
       FROM postings, {_RUNS} WHERE {_LANDED} AND list_contains({_PAGED}, platform) AND (posting_id % {FL.N_COMPANIES}) % 43 <> 0),
landed AS (SELECT run_ts, platform, CASE WHEN {_RMK} THEN 'html_list' ELSE 'list' END AS kind, k, {_PAGE} AS page_no FROM it
  UNION ALL SELECT run_ts, platform, 'list', k, {_CSB_PAGE} FROM it WHERE {_RMK_MODE_TOO}
  UNION ALL SELECT run_ts, platform, 'html_list', k, {_RMK_PAGE} FROM it WHERE {_BOTH_KINDS}),
pages AS (SELECT run_ts, platform, kind, k, page_no, count(*) AS n FROM landed GROUP BY ALL),
gaps AS (SELECT *, coalesce(lag(page_no) OVER (PARTITION BY run_ts, platform, kind, k ORDER BY page_no) + 1,
    CASE WHEN platform IN ('taleo', 'talentplatform') THEN 1 ELSE 0 END) AS a FROM pages)
SELECT run_ts, platform, kind, CAST(k AS BIGINT) AS company_seq, 0 AS search_id, count(*) AS pages, CAST(sum(n) AS BIGINT) AS items,
    CASE WHEN kind = 'html_list' OR platform = 'phenom' OR (platform = 'workday' AND k % 5 = 0) THEN NULL ELSE CAST(sum(n) AS VARCHAR) END AS announced,
    CASE WHEN kind = 'html_list' OR platform = 'phenom' OR (platform = 'workday' AND k % 5 = 0) THEN NULL ELSE '0' END AS short,
    coalesce(string_agg(CASE WHEN a < page_no THEN CAST(a AS VARCHAR) || CASE WHEN a < page_no - 1 THEN '-' || CAST(page_no - 1 AS VARCHAR) ELSE '' END END, ','
             ORDER BY page_no), '') AS missing
FROM gaps GROUP BY run_ts, platform, kind, k
UNION ALL SELECT TIMESTAMP '{X.RUN_TS}', 'linkedin', 'html_list', CAST(0 AS BIGINT), CAST(posting_id // {FL.SEARCH_CARDS} AS INTEGER), 1, count(*), NULL, NULL, ''
FROM postings GROUP BY posting_id // {FL.SEARCH_CARDS}"""

QUERIES.update({
    "S7_platform_dispatch": (s7_platform_dispatch, _s7_sql()),
    "S8_response_status_filter": (s8_response_status_filter, _s8_sql()),
    "S9_company_config_gate": (s9_company_config_gate, S9_SQL),
    "S10_landed_pages": (s10_landed_pages, S10_SQL),
    "S11_detail_join": (s11_detail_join, _s11_sql()),
})
