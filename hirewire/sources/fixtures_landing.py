"""Landed payload fixture derived from ``events`` (through ``postings``).

A company is ``event_id % N_COMPANIES`` (its platform is the posting's platform); an
item's index inside its company is ``event_id // N_COMPANIES``, so page numbers come
from arithmetic, not from a window. Each body holds at most one page of items, so no
group grows with the data. Single-payload boards land as page-size chunks and every
chunk is read.

Two runs have landed, an hour apart: the second one holds companies with ``k % 11 == 0``
again, with their items of ``e % 5 == 4`` that the first one lacks. Anomalies: companies
with ``k % 7 == 0`` are rate-limited once per page before succeeding, ``k % 13 == 0``
twice; ``k % 17 == 0`` answer each request first with an empty body and then again in
full; ``k % 43 == 0`` get 404 for every page; ``k % 19 == 0`` number their pages from 40
on; ``k % 31 == 3`` leave out two page numbers after their fourth item; ``k % 23 == 0`` land
each last answer twice, byte for byte; successfactors companies of mode rmk with ``k % 3 == 0``
land CSB pages too, those of mode auto with ``k % 15 == 7`` RMK pages beside CSB pages;
workday companies with ``k % 5 == 0`` omit ``total``; greenhouse, lever and ashby
companies with ``k % 53 == 0`` also land one undecodable chunk. Every fiftieth posting has
a long description.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewire.functions import dims
from hirewire.functions.sqlexpr import pick
from hirewire.sources import fixtures as X

N_COMPANIES = 97 * 14
CHUNK = 100  # items per landed chunk for single-payload boards
PAGE_SIZE = {"workday": 20, "oracle": 50, "eightfold": 50, "taleo": 25, "successfactors": 10, "rmk": 25,
             "phenom": 20, "talentplatform": 100}
FIRST_PAGE = {"taleo": 1, "talentplatform": 1}
WORKDAY_CITIES = ["Ottawa", "New-York", "Austin", "Remote-US", "Berlin"]
BROKEN_PLATFORMS = ["greenhouse", "lever", "ashby"]
BROKEN_MOD = 53
BROKEN_PAGE = 99
PAGE_SHIFT = 40
GAP_MOD, GAP_FROM, GAP_PAGES = 31, 4, 2
AGAIN_MOD = 23
RMK_MODE_TOO, BOTH_KINDS = "company_seq % 3 = 0 AND company_seq % 5 = 1", "company_seq % 3 = 1 AND company_seq % 5 = 2"
RMK_ONLY = "company_seq % 3 <> 0 AND company_seq % 5 = 1"
SECOND_RUN = "2024-02-15 01:00:00"


def _j(c: Column) -> Column:
    """JSON text of a scalar column (null -> 'null')."""
    return F.when(c.isNull(), F.lit("null")).otherwise(
        F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'^\{"v":(.*)\}$', 1))


def _obj(**fields) -> Column:
    """A JSON object; a field whose value is NULL is omitted (absent key)."""
    parts = [F.concat(F.lit(f'"{k}":'), v) for k, v in fields.items()]  # null with its value, and left out then
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _s(c: Column) -> Column:
    return F.when(c.isNotNull(), _j(c))


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id")
    keys = ev.select((F.col("event_id") % N_COMPANIES).alias("company_seq")).distinct()
    k = F.col("company_seq")
    ks = k.cast("string")
    co = lambda a, b="": F.concat(F.lit(a), ks, F.lit(b))
    raw = _obj(
        company_name=_j(pick(X.COMPANIES, k)), ats_platform=_j(pick(X.PLATFORM_CYCLE, k)),
        board_slug=_j(co("b")),
        company_url=F.when(k % 4 != 0, _j(co("https://www.co", ".com"))),
        company_logo_url=F.when(k % 3 == 0, _j(co("https://logo.clearbit.com/co", ".com"))),
        workday_url_template=F.when(k % 29 != 0, _j(co("https://acme", ".wd5.myworkdayjobs.com/wday/cxs/acme/External"))),
        oracle_host=_j(co("fa", ".oraclecloud.com")),
        oracle_careers_host=F.when(k % 2 == 0, _j(co("jobs.co", ".com"))),
        eightfold_host=_j(co("s", ".eightfold.ai")), eightfold_domain=_j(co("co", ".com")),
        taleo_host=_j(co("co", ".taleo.net")), taleo_portal=_j(co("1")),
        sf_host=_j(co("jobs.co", ".com")), sf_mode=F.when(k % 5 == 0, F.lit('"csb"')).when(k % 5 == 1, F.lit('" RMK "')),
        phenom_host=_j(co("careers.co", ".com")), tp_host=_j(co("join.co", ".com")),
        bamboohr_subdomain=F.when(k % 2 == 0, _j(co("bhr"))), breezy_subdomain=F.when(k % 2 == 0, _j(co("bz"))),
        recruitee_subdomain=F.when(k % 2 == 0, _j(co("rc"))), jobvite_company=F.when(k % 2 == 0, _j(co("jv"))),
    )
    return keys.select(k.cast("long").alias("company_seq"), pick(X.COMPANIES, k).alias("company_name"),
                       pick(X.PLATFORM_CYCLE, k).alias("ats_platform"), co("b").alias("board_slug"),
                       F.parse_json(raw).alias("raw"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings of both runs with their company, in-company index and the fields every vendor shape uses."""
    p = X.postings(spark, sf_dir)
    e = F.col("posting_id")
    k = e % N_COMPANIES
    again = k % 11 == 0
    runs = F.when(~again, F.array(X.run_ts())).when(e % 5 == 4, F.array(second_run())).otherwise(F.array(X.run_ts(), second_run()))
    p = p.withColumn("run_ts", F.explode(runs))
    iso = F.date_format("posted_date", "yyyy-MM-dd'T'HH:mm:ss")
    lines = F.when(e % 50 == 0, F.repeat(F.lit("<li>Ship it</li>"), 400)).otherwise(F.lit("<li>Ship it</li>"))
    return p.select(
        "run_ts", "posting_id", "platform", "title", "location", "department", "posted_date",
        k.alias("company_seq"), (e / N_COMPANIES).cast("long").alias("idx"), iso.alias("iso"),
        F.concat(F.lit("<p>"), F.coalesce("title", F.lit("")), F.lit(" &amp; team</p><ul>"), lines, F.lit("</ul>")).alias("html"))


def second_run() -> Column:
    return F.lit(SECOND_RUN).cast("timestamp_ntz")


def landed_runs(keys: DataFrame) -> DataFrame:
    """(run_ts, ...) of companies: the second run holds some of them."""
    runs = F.when(F.col("company_seq") % 11 == 0, F.array(X.run_ts(), second_run())).otherwise(F.array(X.run_ts()))
    return keys.withColumn("run_ts", F.explode(runs))


def _item_json(platform: str) -> Column:
    """The vendor-shaped JSON of one posting."""
    e, k = F.col("posting_id"), F.col("company_seq")
    t, loc, dept, iso = F.col("title"), F.col("location"), F.col("department"), F.col("iso")
    pid = e.cast("string")
    if platform == "greenhouse":
        return _obj(id=pid, title=_s(t), location=_obj(name=_s(loc)), updated_at=_s(F.concat(iso, F.lit("Z"))),
                    departments=F.concat(F.lit("["), _obj(name=_s(dept)), F.lit("]")),
                    content=_s(F.concat(F.col("html"), F.when(e % 6 == 1, F.lit("<p>$90,000 - $120,000</p>")).otherwise(F.lit("")))),
                    metadata=F.when(e % 6 == 0, F.lit('[{"name":"Level","value":"I"},{"name":"Pay Range","value":"$10 to $20"}]'))
                    .when(e % 30 == 7, F.lit('[{"name":5,"value":"x"}]')))
    if platform == "lever":
        ms = F.floor(F.unix_micros(F.col("posted_date").cast("timestamp")) / 1000).cast("long")
        return _obj(text=_s(t), hostedUrl=_j(F.concat(F.lit("https://jobs.lever.co/b"), k.cast("string"),
                                                          F.lit("/"), pid)),
                    createdAt=F.when(ms.isNotNull(), ms.cast("string")),
                    categories=_obj(location=_s(loc), team=_s(dept), commitment=F.lit('"Full-time"')),
                    descriptionPlain=_s(t), additional=F.when(e % 4 == 0, F.lit('"Pay: $50/hr &amp; more"')))
    if platform == "ashby":
        lo = F.when(e % 2 == 0, _s(loc)).otherwise(_obj(name=_s(loc)))
        dp = F.when(e % 2 == 1, _s(dept)).otherwise(_obj(name=_s(dept)))
        return _obj(title=_s(t), location=lo, applyUrl=_j(F.concat(F.lit("https://jobs.ashbyhq.com/b"),
                                                                     k.cast("string"), F.lit("/"), pid)),
                    publishedAt=_s(F.concat(iso, F.lit("-05:00"))), department=dp, descriptionHtml=F.when(e % 3 != 0, _s(F.col("html"))),
                    descriptionPlain=_s(F.concat(F.lit(" plain "), F.coalesce(t, F.lit("")))),
                    employmentType=F.when(e % 2 == 0, F.lit('"FullTime"')))
    if platform == "workday":
        path = F.concat(F.lit("/job/"), pick(WORKDAY_CITIES, e), F.lit("/Role_R"), pid)
        lt = F.when(e % 3 == 0, F.lit("2 Locations")).otherwise(loc)
        return _obj(title=_s(t), externalPath=_j(path), locationsText=_s(lt),
                    postedOn=_j(F.concat(F.lit("Posted "), (e % 40).cast("string"), F.lit(" Days Ago"))))
    if platform == "oracle":
        ctry = pick(["US", "CA", "FR"], e)
        sec = F.when(e % 5 == 0, F.lit('[{"Name":"Toronto","CountryCode":"ca"}]'))
        return _obj(Id=pid, Title=_s(t), PrimaryLocation=_s(loc), PrimaryLocationCountry=_j(ctry),
                    PostedDate=_s(F.date_format("posted_date", "yyyy-MM-dd")), JobFamily=_s(dept),
                    secondaryLocations=sec)
    if platform == "eightfold":
        secs = F.unix_seconds(F.col("posted_date").cast("timestamp")).cast("string")
        url = F.when(e % 2 == 0, F.concat(F.lit("/careers/job/"), pid)).otherwise(
            F.concat(F.lit("https://s"), k.cast("string"), F.lit(".eightfold.ai/careers/job/"), pid))
        return _obj(id=pid, name=_s(t), locations=F.concat(F.lit("["), _j(loc), F.lit("]")), postedTs=secs,
                    publicUrl=_j(url), department=F.concat(F.lit("["), _j(dept), F.lit("]")))
    if platform == "taleo":
        months = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
        pdt = F.col("posted_date")
        dt = F.when(pdt.isNotNull(), F.concat(F.element_at(F.array(*[F.lit(m) for m in months]), F.month(pdt)),
                                               F.lit(" "), F.dayofmonth(pdt).cast("string"), F.lit(", "),
                                               F.year(pdt).cast("string"))).otherwise(F.lit("n/a"))
        cell = F.when(e % 7 == 1, F.coalesce(loc, F.lit(""))).otherwise(F.to_json(F.array(loc)))
        return _obj(jobId=pid, column=F.concat(F.lit("["), _j(t), F.lit(","), _j(cell), F.lit(","), _j(dt),
                                               F.lit("]")), locationsColumns=F.when(e % 7 == 0, F.lit("[9]")).otherwise(F.lit("[1]")))
    if platform == "successfactors":
        lo = F.when(e % 2 == 0, F.concat(F.lit("["), _j(loc), F.lit("]"))).otherwise(_s(loc))
        return _obj(response=_obj(id=pid, unifiedStandardTitle=_s(t), jobLocationShort=lo))
    if platform == "phenom":
        return _obj(title=_s(t), jobSeqNo=_j(F.concat(F.lit("JS"), pid)), location=_s(loc),
                    postedDate=_s(F.concat(iso, F.lit(".000+0000"))), category=_s(dept),
                    descriptionTeaser=_s(F.concat(F.lit("  "), F.coalesce(t, F.lit("")), F.lit("\n  team "))))
    if platform == "bamboohr":
        return _obj(id=pid, jobOpeningName=_s(t), location=_obj(city=_s(loc), state=F.when(e % 3 == 0, F.lit('"ON"'))),
                    isRemote=F.when(e % 4 == 0, F.lit("true")).otherwise(F.lit("false")),
                    locationName=F.lit('"Hybrid"'), departmentLabel=_s(dept))
    if platform == "breezy":
        where = (F.when(e % 5 == 0, _obj(city=_obj(name=_s(loc)), country=F.lit('"Canada"')))
                 .when(e % 5 == 1, _s(loc)).otherwise(_obj(name=_s(loc))))
        return _obj(_id=_j(pid), name=_s(t), location=where,
                    url=F.when(e % 2 == 0, _j(F.concat(F.lit("https://x.breezy.hr/p/"), pid))),
                    published_date=_s(F.concat(iso, F.lit("Z"))), department=_s(dept), description=_s(F.col("html")))
    if platform == "recruitee":
        return _obj(title=_s(t), slug=_j(F.concat(F.lit("s"), pid)),
                    location=F.when(e % 3 != 0, _s(loc)), city=F.lit('"Toronto"'), country=F.lit('"Canada"'),
                    careers_url=_j(F.concat(F.lit("https://co.recruitee.com/o/s"), pid)),
                    published_at=_s(F.concat(F.date_format("posted_date", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))),
                    department=_s(dept), description=_s(F.col("html")))
    if platform == "talentplatform":
        return _obj(data=_obj(title=_s(t), slug=_j(F.concat(F.lit("tp"), pid)), full_location=_s(loc),
                              posted_date=_s(iso), department=_s(dept), description=_s(F.col("html"))))
    raise ValueError(platform)


def _rmk_row() -> Column:
    t = F.coalesce(F.col("title"), F.lit(""))
    slug = F.regexp_replace(F.concat(F.coalesce(F.col("location"), F.lit("")), F.lit("-"), t), " ", "-")
    return F.concat(F.lit('<tr class="data-row"><td><a href="/job/'), slug, F.lit("/"), F.col("posting_id").cast("string"),
                    F.lit('/" class="jobTitle-link">'), t, F.lit("</a></td></tr>"))


def _jobvite_row() -> Column:
    return F.concat(F.lit('<tr><td class="jv-job-list-name"><a href="/co/job/'), F.col("posting_id").cast("string"),
                    F.lit('">'), F.coalesce(F.col("title"), F.lit("")), F.lit('</a></td><td class="jv-job-list-location">'),
                    F.coalesce(F.col("location"), F.lit("")), F.lit(", </td></tr>"))


_WRAP = {
    "greenhouse": ('{"jobs":[', "]}"), "lever": ("[", "]"), "ashby": ('{"jobs":[', "]}"),
    "oracle": ('{"items":[{"TotalJobsCount":{n},"requisitionList":[', "]}]}"),
    "eightfold": ('{"data":{"count":{n},"positions":[', "]}}"),
    "taleo": ('{"pagingData":{"totalCount":{n}},"requisitionList":[', "]}"),
    "successfactors": ('{"totalJobs":{n},"jobSearchResult":[', "]}"),
    "phenom": ('{"refineSearch":{"data":{"jobs":[', "]}}}"), "bamboohr": ('{"result":[', "]}"),
    "breezy": ("[", "]"), "recruitee": ('{"offers":[', "]}"),
    "workday": ("{\"total\":{n},\"jobPostings\":[", "]}"),
    "talentplatform": ('{"totalCount":{n},"jobs":[', "]}"),
}


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``landing`` table of both runs over every platform: each vendor's items get their JSON (or HTML row) and
    page number in a projection of their own, then items of all vendors are grouped into page bodies per
    (run, platform, company, kind, page); the company total comes from a window over the same partitioning."""
    from pyspark.sql import Window

    it = items(spark, sf_dir)
    plat, k = F.col("platform"), F.col("company_seq")
    staged = None
    for p in dims.PLATFORMS:
        mine = it.where(plat == p)
        size, first = F.lit(PAGE_SIZE.get(p, CHUNK)), F.lit(FIRST_PAGE.get(p, 0))
        parts = [(mine, size, "list", None)]
        if p == "jobvite":
            parts = [(mine, size, "html_list", _jobvite_row())]
        elif p == "successfactors":
            parts = [(mine.where((k % 3 != 0) | F.expr(RMK_MODE_TOO)), size, "list", None),
                     (mine.where((k % 3 == 0) | F.expr(BOTH_KINDS)), F.lit(PAGE_SIZE["rmk"]), "html_list", _rmk_row())]
        for rows, n, kind, row in parts:
            one = rows.select("run_ts", "platform", "company_seq", "idx", F.lit(kind).alias("kind"), _page_no(n, first).alias("page_no"),
                              (_item_json(p) if row is None else row).alias("j"))
            staged = one if staged is None else staged.unionByName(one)
    staged = staged.repartition("run_ts", "platform", "company_seq")
    g = staged.groupBy("run_ts", "platform", "company_seq", "kind", "page_no") \
              .agg(F.sort_array(F.collect_list(F.struct("idx", "j"))).alias("xs"), F.count(F.lit(1)).alias("m"))
    g = g.withColumn("n", F.sum("m").over(Window.partitionBy("run_ts", "platform", "company_seq", "kind")))
    n = F.col("n").cast("string")
    items_json = F.array_join(F.transform("xs", lambda x: x["j"]), ",")
    html = F.col("kind") == "html_list"
    body = F.lit(None).cast("string")
    for p in reversed(dims.PLATFORMS):
        if p == "jobvite":
            continue
        pre, post = _WRAP[p]
        head = F.concat(F.lit(pre.split("{n}")[0]), n, F.lit(pre.split("{n}")[1])) if "{n}" in pre else F.lit(pre)
        if p == "workday":
            head = F.when(k % 5 == 0, F.lit('{"jobPostings":[')).otherwise(head)
        body = F.when(plat == p, F.concat(head, items_json, F.lit(post))).otherwise(body)
    rows_html = lambda sep: F.array_join(F.transform("xs", lambda x: x["j"]), sep)
    body = (F.when(html & (plat == "jobvite"), F.concat(F.lit('<table class="jv-job-list">'), rows_html(""), F.lit("</table>")))
            .when(html, F.concat(F.lit("<html><table>"), rows_html("\n"), F.lit("</table></html>"))).otherwise(body))
    pages = g.select("run_ts", "platform", "company_seq", "page_no", "kind", F.lit("").alias("item_key"), body.alias("body"))
    # Boards that do not guard their JSON decode: an undecodable extra chunk fails the company.
    broken = landed_runs(it.where(plat.isin(*BROKEN_PLATFORMS) & (k % BROKEN_MOD == 0)).select("platform", "company_seq").distinct()) \
        .select("run_ts", "platform", "company_seq", F.lit(BROKEN_PAGE).alias("page_no"), F.lit("list").alias("kind"),
                F.lit("").alias("item_key"), F.lit('{"jobs": [{"title": "cut off').alias("body"))
    return _answered(pages.unionByName(_all_details(it)).unionByName(broken))


def _page_no(size: Column, first: Column) -> Column:
    k = F.col("company_seq")
    return (F.col("idx") / size).cast("int") + first + F.when(k % 19 == 0, F.lit(PAGE_SHIFT)).otherwise(F.lit(0)) \
        + F.when((k % GAP_MOD == 3) & (F.col("idx") >= GAP_FROM), F.lit(GAP_PAGES)).otherwise(F.lit(0))


def _answered(allp: DataFrame) -> DataFrame:
    """Pages with their attempts and answers, in the shape of ``landing``."""
    k = F.col("company_seq")
    twice, once, stale = k % 13 == 0, k % 7 == 0, k % 17 == 0
    attempts = F.when(twice, F.array(F.lit(0), F.lit(1), F.lit(2))).when(once | stale, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    attempts = F.when(k % AGAIN_MOD == 0, F.concat(attempts, F.slice(attempts, -1, 1))).otherwise(attempts)
    att = allp.select("*", F.explode(attempts).alias("attempt"))
    limited = F.when(twice, F.col("attempt") < 2).otherwise(once & (F.col("attempt") == 0))
    early = ~limited & F.coalesce(stale & ~twice & ~once & (F.col("attempt") == 0), F.lit(False))
    status = F.when(limited, F.lit(429)).when(k % 43 == 0, F.lit(404)).otherwise(F.lit(200))
    return att.select("run_ts", "platform", k.cast("long").alias("company_seq"), F.lit(0).alias("search_id"), "kind",
                      F.col("page_no").cast("int").alias("page_no"), "item_key", status.cast("int").alias("status"),
                      F.col("attempt").cast("int").alias("attempt"), F.when(early, F.lit("{}")).when(~limited, F.col("body")).alias("body"))


def rmk_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The RMK pages of the companies of mode rmk of which ``landing`` has CSB pages only, which that mode doesn't read."""
    it = items(spark, sf_dir).where(F.col("platform") == "successfactors").where(RMK_ONLY)
    rows = it.select("run_ts", "platform", "company_seq", "idx", _page_no(F.lit(PAGE_SIZE["rmk"]), F.lit(0)).alias("page_no"), _rmk_row().alias("j"))
    g = rows.groupBy("run_ts", "platform", "company_seq", "page_no").agg(F.sort_array(F.collect_list(F.struct("idx", "j"))).alias("xs"))
    body = F.concat(F.lit("<html><table>"), F.array_join(F.transform("xs", lambda x: x["j"]), "\n"), F.lit("</table></html>"))
    return _answered(g.select("run_ts", "platform", "company_seq", "page_no", F.lit("html_list").alias("kind"), F.lit("").alias("item_key"), body.alias("body")))


def _all_details(it: DataFrame) -> DataFrame:
    html = F.col("html")
    plat = F.col("platform")
    body = (F.when(plat == "oracle", F.concat(F.lit('{"items":['), _obj(ExternalDescriptionStr=_j(html),
                                              ExternalQualificationsStr=F.lit('"<p>Degree</p>"')), F.lit("]}")))
            .when(plat == "eightfold", _obj(data=_obj(jobDescription=_j(html))))
            .otherwise(_obj(result=_obj(jobOpening=_obj(description=_j(html))))))
    return it.where(plat.isin("oracle", "eightfold", "bamboohr")).select(
        "run_ts", "platform", "company_seq", F.lit(0).alias("page_no"), F.lit("detail").alias("kind"),
        F.col("posting_id").cast("string").alias("item_key"), body.alias("body"))


# --- search-site result pages -----------------------------------------------------

SEARCH_CARDS = 25


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search-site result pages: 25 consecutive events form one search's single page."""
    p = X.postings(spark, sf_dir)
    e = F.col("posting_id")
    card = F.concat(
        F.lit('<li><div class="base-card" data-entity-urn="urn:li:jobPosting:'), (e * 31 % 100003).cast("string"),
        F.lit('"><h3 class="base-search-card__title">\n  '), F.coalesce("title", F.lit("")),
        F.lit('\n</h3><h4 class="base-search-card__subtitle"><a href="x">\n '),
        F.replace(F.coalesce("company", F.lit("")), F.lit("&"), F.lit("&amp;")),
        F.lit(' </a></h4><span class="job-search-card__location">\n '),
        F.coalesce("location", F.lit("Somewhere")), F.lit(' </span>'),
        F.when(F.col("posted_date").isNotNull(),
               F.concat(F.lit('<time class="job-search-card__listdate" datetime="'),
                        F.date_format("posted_date", "yyyy-MM-dd"), F.lit('">x</time>'))).otherwise(F.lit("")),
        F.lit("</div></li>"))
    g = p.select((e / SEARCH_CARDS).cast("int").alias("search_id"), F.struct(e.alias("e"), card.alias("c")).alias("x")) \
         .groupBy("search_id").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    return g.select(X.run_ts().alias("run_ts"), F.lit("linkedin").alias("platform"), F.lit(0).cast("long").alias("company_seq"),
                    "search_id", F.lit("html_list").alias("kind"), F.lit(0).alias("page_no"), F.lit("").alias("item_key"),
                    F.lit(200).alias("status"), F.lit(0).alias("attempt"),
                    F.concat(F.lit("<ul>"), F.array_join(F.transform("xs", lambda x: x["c"]), "\n"), F.lit("</ul>"))
                    .alias("body"))
