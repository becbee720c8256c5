"""Inputs derived from the generated test tables, so that every query's work grows with them.

Each derivation is written twice from the same lists: a DataFrame (Spark) and a
SQL ``SELECT`` (the DuckDB oracle). ``events`` drives postings: one posting per event,
with list values picked by index arithmetic. List lengths are primes other than
3, 5 and 7, so every value occurs and the columns vary independently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewire.functions.sqlexpr import array_lit, pick

RUN_TS = "2024-02-15 00:00:00"

TITLES = [  # 41
    "Software Engineer Intern", "Software Engineer", "Co-op Developer", "New Grad Data Analyst",
    "Junior Accountant", "Engineer I", "Senior Software Engineer", "Staff Engineer", "Team Lead, Sales",
    "Marketing Manager", "Head of People", "Data Engineer", "ML Intern", "Machine Learning Engineer",
    "", None, "Backend Developer", "Product Designer", "Legal Counsel", "Customer Success Associate",
    "Supply Chain Analyst", "Business Analyst", "Technician", "Tax Associate", "Recruiter",
    "Product Owner", "Internal Auditor", "Leader in Training", "Coop Student", "Assembly Lead",
    "Principal Scientist", "Director of Ops", "VP Finance", "Graphic Artist", "Security Engineer Intern",
    "Zzz", "   ", "Research Scientist, NLP", "Full-Stack Web Developer", "Consultant, Advisory",
    "Sales Development Representative",
]
DEPTS = [  # 43
    "Engineering", "", None, "Legal", "Finance", "Marketing", "  Sales  ", "Human Resources",
    "Operations", "Design", "Data", "Zzz", "Customer Support", "R&D", "People & Culture",
    "Product", "IT", "Research", "Consulting", "Accounting", "Manufacturing", "Strategy",
    "Growth", "Compliance", "Security", "Platform", "Infrastructure", "Analytics", "Brand",
    "Procurement", "Logistics", "Support Engineer", "Talent Acquisition", "Quality Assurance",
    "Executive", "Treasury", "Payroll", "Creative", "Warehouse", "Advisory", "Admin", "Other", "Misc",
]
LOCATIONS = [  # 71
    "Toronto, ON", "Toronto, CA", "London, UK", "American Fork, UT", "Tbilisi, Georgia",
    "Paris, FR; Austin, TX", "San José, CA", "Lausanne", "Ottawa", "Remote", "In-Office", "Berlin",
    "", None, "Vatican City", "NYC", "Hybrid, Remote", "Remote - US", "New York, NY", "Vancouver, BC",
    "Montreal, QC", "Montréal", "Seattle", "United States", "U.S. Remote", "USA", "Canada",
    "\U0001f1fa\U0001f1f8 Anywhere", "\U0001f1e8\U0001f1e6 Anywhere", "Austin, Texas", "Calgary",
    "Halifax, Nova Scotia", "Ontario", "British Columbia", "Georgia", "Washington, DC",
    "Boston, MA", "Chicago, IL", "Mountain View", "Palo Alto", "Denver", "Mexico City", "Sydney",
    "Hybrid", "On-site", "Onsite - Paris", "Tokyo, JP", "Dublin, Ireland", "Waterloo", "North York",
    "remote", "Bangalore, KA", "Victoria", "Richmond", "Portland", "Dallas, TX or Remote", "Hamburg",
    "San Francisco, CA", "Kanata", "Zurich", "TX", "ON", "Mumbai, MH", "St. John's, NL",
    "Brooklyn", "Remote (Europe)", "Hybrid - London", "Miami", "Winnipeg, MB", "Oslo", "Singapore",
]
COMPANIES = [  # 47
    "TD Bank", "Acme Technologies Inc.", "The Group", "X", "", "Meta", "Shopify", "Globex Corp",
    "Initech LLC", "Umbrella Holdings", "Hooli", "Pied Piper", "Wayne Enterprises", "Stark Industries",
    "Royal Bank", "Sun Life", "Neo Financial", "Cyberdyne Systems", "Soylent Co", "Tyrell Corporation",
    "Wonka Labs", "Vandelay Industries", "Dunder Mifflin", "Massive Dynamic", "Aperture Science",
    "Black Mesa", "Oscorp", "Nakatomi Trading", "Gringotts", "Monarch Solutions", "Yoyodyne",
    "Kinaxis", "Clio", "Ciena", "Databricks", "OpenAI", "Jobber", "1Password", "Later", "Canonical",
    "A", "Q & A Services", "   ", "Acme", "Northwind Traders", "Contoso Ltd", "Fabrikam Software",
]
COMPANY_URLS = [  # 53
    "", "https://www.acme.com", "acme.co.uk", "https://jobs.foo.co.uk/careers", "http://bar.io:8080/x",
    "https://boards.greenhouse.io/acme", "ftp://files.acme.com", "localhost", "https://www.linkedin.com/company/x",
    "https://Careers.Globex.com/", "www.initech.com", "https://user@hooli.xyz", "https://piedpiper.com/about",
    "   ", "https://wayne.com.au", "https://stark.com.br/", "https://sub.domain.org.uk", "http://a.b.c.d.com",
    "https://google.com/x", "https://bit.ly/abc", "mailto:hr@oscorp.com", "https://gringotts.co.jp",
    "https://monarch.io", "https://yoyodyne.net", "https://kinaxis.com", "https://clio.com", "https://ciena.com",
    "https://databricks.com", "https://openai.com", "https://getjobber.com", "https://1password.com",
    "https://later.com", "https://canonical.com", "https://a.com", "https://qa.services", "https://www.acme.org",
    "https://northwind.example.com", "https://contoso.co.nz", "https://fabrikam.com", "http://", "https://x",
    "https://nodots", "https://www.", "https://WWW.MIXED.Example.COM", "https://tyrell.co.za",
    "https://massive.com.sg", "https://aperture.com.hk", "https://blackmesa.com.tr", "https://soylent.co.kr",
    "https://vandelay.co.in", "https://dunder.com.mx", "https://nakatomi.ac.uk", "https://wonka.gov.uk",
]
LOGOS = [  # 59
    "", "https://www.google.com/s2/favicons?domain=acme.com&sz=128", "https://logo.clearbit.com/globex.com",
    "https://logo.clearbit.com/initech.com?size=64", "https://icon.horse/icon/hooli.xyz",
    "https://cdn.example.com/logos/piedpiper.png", "http://img.example.net/wayne.svg", "ftp://x/logo.png",
    "logo.png", "https://api.apistemic.com/x.png", "https://logo.hunter.io/stark.com",
    "https://logo.clearbit.com/", "https://icon.horse/icon/?x=1", "https://x.com/a?domain=royal.ca&b=1",
    "https://static.example.org/sunlife.jpg",
] + [f"https://cdn{i}.example.com/logo{i}.png" for i in range(15, 59)]
URL_VARIANTS = ["", "/", "?utm_source=x", "?b=2&a=1", "#top"]  # 5
PLATFORM_CYCLE = [  # 14: the registry platforms
    "greenhouse", "lever", "ashby", "workday", "oracle", "eightfold", "taleo",
    "successfactors", "phenom", "bamboohr", "breezy", "recruitee", "jobvite", "talentplatform",
]


def _pick(values, key: Column) -> Column:
    return pick(values, key)


def sql_str(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def sql_list(values) -> str:
    return "CAST([" + ", ".join(sql_str(v) for v in values) + "] AS VARCHAR[])"


def _sql_pick(values, key: str) -> str:
    return f"list_extract({sql_list(values)}, ({key} % {len(values)}) + 1)"


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw posting per ``events`` row, carrying arrival-order provenance columns."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts")
    e = F.col("event_id")
    return ev.select(
        e.alias("posting_id"),
        _pick(PLATFORM_CYCLE, e).alias("platform"),
        (e % 14).cast("int").alias("platform_rank"),
        (e % 97).cast("int").alias("company_seq"),
        F.lit(0).alias("page_no"),
        e.alias("item_pos"),
        _pick(TITLES, e).alias("title"),
        _pick(DEPTS, e * 5).alias("department"),
        _pick(LOCATIONS, e * 7).alias("location"),
        _pick(COMPANIES, e * 3).alias("company"),
        _pick(COMPANY_URLS, e * 11).alias("company_url"),
        _pick(LOGOS, e * 13).alias("company_logo"),
        F.when(e % 11 != 0, F.col("ts").cast("timestamp_ntz")).alias("posted_date"),
        F.concat(F.lit("https://jobs.example.com/p/"), (e % 703).cast("string"), _pick(URL_VARIANTS, e)).alias("url"),
        F.lit("").alias("description"),
        F.lit("").alias("salary_range"),
    )


def postings_sql(alias: str = "postings") -> str:
    """The DuckDB twin of :func:`postings` as a CTE body."""
    e = "event_id"
    return f"""{alias} AS (
  SELECT event_id AS posting_id,
         {_sql_pick(PLATFORM_CYCLE, e)} AS platform,
         CAST(event_id % 14 AS INTEGER) AS platform_rank,
         CAST(event_id % 97 AS INTEGER) AS company_seq,
         0 AS page_no,
         event_id AS item_pos,
         {_sql_pick(TITLES, e)} AS title,
         {_sql_pick(DEPTS, e + ' * 5')} AS department,
         {_sql_pick(LOCATIONS, e + ' * 7')} AS location,
         {_sql_pick(COMPANIES, e + ' * 3')} AS company,
         {_sql_pick(COMPANY_URLS, e + ' * 11')} AS company_url,
         {_sql_pick(LOGOS, e + ' * 13')} AS company_logo,
         CASE WHEN event_id % 11 <> 0 THEN CAST(ts AS TIMESTAMP) END AS posted_date,
         'https://jobs.example.com/p/' || CAST(event_id % 703 AS VARCHAR) || {_sql_pick(URL_VARIANTS, e)} AS url,
         '' AS description,
         '' AS salary_range
  FROM events)"""


def run_ts() -> Column:
    return F.lit(RUN_TS).cast("timestamp_ntz")


# URL variants appended to every page URL: scheme case, params, tracking names in any
# case, duplicate keys, keyless and blank values, escapes, '+', '~', '*', fragments.
URL_CASE_SUFFIXES = [  # 7
    "", ";jsessionid=9?utm_medium=mail&UTM_Source=z&b=2", "?b=2&a=1&a=0&c&&d=", "?q=a+b%20c&t=%7E*~&bad=%zz%",
    "/?Ref=x&source=y&keep=1#frag", "//?z=1&y=%C3%A9&x", "?a=%2B&a=+&a=",
]


def url_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page URL with each suffix (and an upper-cased scheme on odd pages)."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    base = F.when(F.col("page_id") % 2 == 1, F.regexp_replace("url", "^https?", "HTTPS")).otherwise(F.col("url"))
    sfx = array_lit(URL_CASE_SUFFIXES)
    return pages.select("page_id", base.alias("base"), F.posexplode(sfx).alias("variant", "suffix")).select(
        "page_id", "variant", F.concat("base", "suffix").alias("url"))


def url_cases_sql(alias: str = "url_cases") -> str:
    vals = ", ".join(f"({i}, {sql_str(s)})" for i, s in enumerate(URL_CASE_SUFFIXES))
    return f"""{alias} AS (
  SELECT page_id, variant,
         CASE WHEN page_id % 2 = 1 THEN regexp_replace(url, '^https?', 'HTTPS') ELSE url END || suffix AS url
  FROM pages CROSS JOIN (VALUES {vals}) AS s(variant, suffix))"""


def search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search-site result cards: eight searches, raw job URLs that repeat across searches."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id")
    return ev.select(
        (F.col("event_id") % 8).cast("int").alias("search_id"),
        F.lit(0).alias("page_no"),
        (F.col("event_id") / 8).cast("long").alias("item_pos"),
        F.concat(F.lit("https://www.linkedin.com/jobs/view/"), (F.col("user_id") * 7 % 1009).cast("string"))
         .alias("url"),
    )


def search_hits_sql(alias: str = "search_hits") -> str:
    return f"""{alias} AS (
  SELECT CAST(event_id % 8 AS INTEGER) AS search_id, 0 AS page_no, CAST(event_id // 8 AS BIGINT) AS item_pos,
         'https://www.linkedin.com/jobs/view/' || CAST(user_id * 7 % 1009 AS VARCHAR) AS url
  FROM events)"""


# Registry fixture: one entry per supplier, grouped into documents of at most
# REGISTRY_DOC_SIZE entries (a group's size is fixed, never data-dependent).
REGISTRY_DOC_SIZE = 50
REGISTRY_PLATFORMS = PLATFORM_CYCLE + ["linkedin", "GreenHouse", "smartrecruiters"]  # 17
# 'enabled' variants by s_suppkey % 11 (None = key absent).
ENABLED_JSON = [None, "true", "false", '"false"', "0", '""', "[]", "{}", "null", "1", '"yes"']


def registry_entry_json() -> Column:
    """The JSON text of one registry entry, built from a ``supplier`` row."""
    k = F.col("s_suppkey")
    # A JSON scalar: the value part of to_json({"v": c}).
    js = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'^\{"v":(.*)\}$', 1)
    field = lambda name, c: F.concat(F.lit(f'"{name}":'), js(c))
    platform = pick(REGISTRY_PLATFORMS, k)
    name = F.col("s_name")
    slug = F.concat(F.lit("slug"), k.cast("string"))
    parts = [
        field("company_name", name),
        field("ats_platform", platform),
        F.when(k % 19 == 0, F.lit(None)).when(k % 23 == 0, F.lit('"board_slug":null'))
         .otherwise(field("board_slug", slug)),
        F.when(k % 11 != 0, F.concat(F.lit('"enabled":'), pick(ENABLED_JSON, k))),
        field("company_url", F.concat(F.lit("https://www."), F.lower(F.regexp_replace(name, "#", "")), F.lit(".com"))),
        F.when(k % 3 == 0, field("company_logo_url", F.concat(F.lit("https://logo.clearbit.com/s"), k.cast("string"),
                                                             F.lit(".io")))),
        F.when(k % 4 != 0, field("workday_url_template", F.concat(
            F.lit("https://acme"), k.cast("string"), F.lit(".wd5.myworkdayjobs.com/wday/cxs/acme/External")))),
        F.when(k % 5 != 0, field("oracle_host", F.concat(F.lit("fa-"), k.cast("string"), F.lit(".oraclecloud.com")))),
        F.when(k % 5 == 1, field("oracle_careers_host", F.concat(F.lit("jobs.s"), k.cast("string"), F.lit(".com")))),
        F.when(k % 6 != 0, field("eightfold_host", F.concat(F.lit("s"), k.cast("string"), F.lit(".eightfold.ai")))),
        F.when(k % 7 != 0, field("eightfold_domain", F.concat(F.lit("s"), k.cast("string"), F.lit(".com")))),
        F.when(k % 4 != 1, field("taleo_host", F.concat(F.lit("s"), k.cast("string"), F.lit(".taleo.net")))),
        F.when(k % 4 != 2, field("taleo_portal", k.cast("string"))),
        F.when(k % 8 != 0, field("sf_host", F.concat(F.lit("jobs.s"), k.cast("string"), F.lit(".com")))),
        F.when(k % 9 == 0, field("sf_mode", F.lit("csb"))),
        F.when(k % 10 != 0, field("phenom_host", F.concat(F.lit("careers.s"), k.cast("string"), F.lit(".com")))),
        F.when(k % 12 != 0, field("tp_host", F.concat(F.lit("join.s"), k.cast("string"), F.lit(".com")))),
        F.when(k % 13 == 0, field("bamboohr_subdomain", F.concat(F.lit("bhr"), k.cast("string")))),
        F.when(k % 13 == 1, field("jobvite_company", F.concat(F.lit("jv"), k.cast("string")))),
    ]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def registry_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``{"companies": [...]}`` documents of at most REGISTRY_DOC_SIZE suppliers each, plus one
    document per region that has no ``companies`` key."""
    sup = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_name")
    doc = (F.col("s_suppkey") / REGISTRY_DOC_SIZE).cast("long")
    entries = sup.select(doc.alias("doc_id"), F.struct("s_suppkey", registry_entry_json().alias("j")).alias("e"))
    docs = entries.groupBy("doc_id").agg(F.sort_array(F.collect_list("e")).alias("es"))
    body = F.concat(F.lit('{"companies":['), F.array_join(F.transform("es", lambda x: x["j"]), ","), F.lit("]}"))
    regions = spark.read.parquet(f"{sf_dir}/region.parquet").select(
        (F.lit(1_000_000) + F.col("r_regionkey")).cast("long").alias("doc_id"),
        F.concat(F.lit('{"region":"'), F.col("r_name"), F.lit('"}')).alias("text"))
    return docs.select("doc_id", body.alias("text")).unionByName(regions)
