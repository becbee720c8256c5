"""A1: one run -- landed payloads to new rows for the jobs table, with funnel metrics.

landing -S8-> usable pages -join companies, S9-> per-platform parsers (S10-S14, P, X)
-S15-> raw jobs -F1/F2-> candidates -U6, K1-> gated -K2-> winners -K3-> new -K4-> enriched
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewire.functions import dims
from hirewire.operators import extract as P
from hirewire.operators import metrics as M
from hirewire.operators.url_index import UrlIndex
from hirewire.session import write_counted, write_shared
from hirewire.sources import landing as LD

KEY = ["run_ts", "platform", "company_seq", "search_id", "page_no", "item_pos"]
SEARCH_RANK = len(dims.PLATFORMS) + 1  # the search site runs after every board
TEXTS = ["title", "company", "location", "url", "description", "salary_range", "company_logo", "company_url", "department"]


def join_companies(pages: DataFrame, companies: DataFrame) -> DataFrame:
    """Attach each page's registry entry; Spark picks the join by the registry's size."""
    cols = companies.select("company_seq", "company_name", "board_slug", "raw", F.col("ats_platform").alias("platform"))
    return pages.join(cols, ["platform", "company_seq"], "inner")


def drop_failed_companies(frame: DataFrame, failed: DataFrame, platform: str) -> DataFrame:
    """M3: a body that breaks greenhouse/lever/ashby parsing fails the whole company in that run (no rows)."""
    if platform not in M.UNGUARDED:
        return frame
    mine = failed.where(F.col("platform") == platform)
    return frame.join(mine, ["run_ts", "platform", "company_seq"], "left_anti")


def platform_raw_jobs(pages: DataFrame, platform: str, with_details: bool = True) -> DataFrame:
    """A platform's raw jobs; without details, the texts of the vendors that send them apart are left out."""
    sel = pages.where(F.col("platform") == platform)
    fn = P.EXTRACTORS[platform]
    if platform in P.WITH_DETAILS and not with_details:
        return fn(sel.where(F.col("kind") == "list"))
    if platform in P.WITH_DETAILS:
        lists = sel.where(F.col("kind") == "list")
        details = sel.where(F.col("kind") == "detail").select("run_ts", "platform", "company_seq", "item_key", "body")
        return fn(lists, details)
    return fn(sel)


def board_pages(landing: DataFrame, companies: DataFrame) -> DataFrame:
    """Usable pages of all boards with their registry entries."""
    return gated_pages(LD.usable_pages(landing.where(F.col("platform") != dims.SEARCH_PLATFORM)), companies)


def gated_pages(usable: DataFrame, companies: DataFrame) -> DataFrame:
    return join_companies(usable, companies).where(LD.config_ok(F.col("platform"), F.col("raw"), F.col("board_slug")))


def raw_jobs(landing: DataFrame, companies: DataFrame, platforms=None, with_search: bool = True,
             failed: DataFrame | None = None, searches: DataFrame | None = None) -> DataFrame:
    """S8, S9, S7 dispatch, S15 union: the ``raw_job`` rows with arrival-order columns. Details are no part of them: no
    detail body is read here (``late_details`` gets those of the rows that need one)."""
    usable = LD.usable_pages(landing.where(F.coalesce(F.col("kind") != "detail", F.lit(True))))
    pages = gated_pages(usable.where(F.col("platform") != dims.SEARCH_PLATFORM), companies)
    failed = M.failed_companies(landing) if failed is None else failed
    frames = [drop_failed_companies(platform_raw_jobs(pages, p, False), failed, p) for p in (platforms or dims.PLATFORMS)]
    if with_search:
        frames.append(search_cards(usable, searches))
    return LD.union_platforms(frames)


def default_searches(spark: SparkSession) -> DataFrame:
    """The search site's searches: (search_id, search_location)."""
    return spark.createDataFrame([(i, s[1]) for i, s in enumerate(dims.SEARCHES)], "search_id int, search_location string")


def search_raw_jobs(landing: DataFrame, searches: DataFrame | None = None) -> DataFrame:
    """P16 then S16: search-site cards of all landed pages."""
    return search_cards(LD.usable_pages(landing.where(F.col("platform") == dims.SEARCH_PLATFORM)), searches)


def search_cards(usable: DataFrame, searches: DataFrame | None = None) -> DataFrame:
    """P16 then S16: cards of the search site's usable pages; within a run the first raw URL wins across searches.
    A card without a location takes its search's (a row of ``searches``; '' for a search not in it)."""
    from hirewire.operators.dedup import first_wins
    spark = usable.sparkSession
    searches = default_searches(spark) if searches is None else searches
    pages = usable.where(F.col("platform") == dims.SEARCH_PLATFORM).join(searches, "search_id", "left") \
              .withColumn("raw", F.lit(None).cast("variant")).withColumn("board_slug", F.lit(None).cast("string")) \
              .withColumn("company_name", F.lit(""))
    rows = write_shared(spark, P.search_results(pages, F.coalesce("search_location", F.lit(""))), "search-cards")
    return first_wins(rows, ["run_ts", "url"], ["search_id", "page_no", "item_pos"])


def platform_ranks(companies: DataFrame) -> DataFrame:
    """Registry order of first appearance per platform; the search site comes last (<= 15 rows)."""
    from hirewire.sources.registry import group_by_platform
    g = group_by_platform(companies).select(F.col("ats_platform").alias("platform"), "platform_rank")
    return g.unionByName(g.sparkSession.createDataFrame([(dims.SEARCH_PLATFORM, SEARCH_RANK)],
                                                       "platform string, platform_rank int"))


def late_details(rows: DataFrame, landing: DataFrame) -> DataFrame:
    """S11 after C1-K3: ``rows`` with the texts of their detail pages. The details are cut down to the rows' keys before
    anything else, so that no text of a filtered or known posting is parsed or shuffled."""
    key, sent = ["run_ts", "platform", "company_seq", "item_key"], F.col("platform").isin(*sorted(P.WITH_DETAILS))
    wanted = write_shared(rows.sparkSession, rows.where(sent).select(*key).distinct(), "wanted-details")
    if wanted.isEmpty():
        return rows
    details = landing.where(sent & (F.col("kind") == "detail")).join(wanted, key, "left_semi")
    return P.describe_late(rows, LD.usable_pages(details))


def plan_run(spark, landing: DataFrame, companies: DataFrame, target_urls, platform: str | None = None,
             company: str | None = None, searches: DataFrame | None = None):
    """Everything of a run except the write. Returns (new_rows, outcomes, stats, success). ``target_urls`` is the stored
    URLs: a DataFrame (url) or a ``UrlIndex``, of which only the files that may hold one of the run's URLs are read.

    ``landing`` may hold several runs: each row is judged by its own ``run_ts``, and of a URL that several runs
    found the earliest counts. A scope without companies gives nothing, as does the search site's name, which
    is no platform of the registry."""
    from hirewire.operators import dedup as K
    from hirewire.operators import sink as SK
    from hirewire.operators.process import RUN_ORDER, classify_all
    from hirewire.sources.registry import scope

    scoped = scope(companies, platform, company)
    if scoped.isEmpty():
        landing = landing.where(F.lit(False))
    platforms = [platform] if platform in dims.PLATFORMS else dims.PLATFORMS
    failed = write_shared(spark, M.failed_companies(landing), "failed-companies")
    # The search site runs only without a platform filter (a company filter does not stop it).
    raw = raw_jobs(landing, scoped, platforms, platform is None, failed, searches)
    ranked = raw.join(F.broadcast(platform_ranks(scoped)), "platform", "left").fillna({"platform_rank": SEARCH_RANK})
    classified = classify_all(ranked, F.col("run_ts"))
    is_cand = F.col("outcome") == "candidate"
    staged = K.with_normalized_url(classified.withColumn("_cand_url", F.when(is_cand, F.col("url"))), "_cand_url", "_cand_url")
    staged = staged.withColumn("url", F.when(is_cand, F.col("_cand_url"))).drop("_cand_url")
    staged = staged.withColumn("gate_ok", is_cand & K.quality_gate(staged))
    # Written once: every later action reads it, and a lost executor does not send the run back to parsing.
    # Rows that were filtered keep only their key and outcome.
    wide = [c for c in staged.columns if c not in (*KEY, *RUN_ORDER, "outcome", "gate_ok")]
    staged = staged.select(*KEY, "platform_rank", "outcome", "gate_ok", *[F.when(is_cand, F.col(c)).alias(c) for c in wide])
    bad = SK.unstorable([c for c in TEXTS if c in staged.columns])
    staged, seen = write_counted(spark, staged, "staged", M.staged_counters(bad))
    cand = staged.where(is_cand)
    usable = cand.where("gate_ok")
    storable = usable.where(~bad)
    # K2, K3 on narrow rows; the stored columns are joined back by the winners' keys, and the winners get their details
    first = K.first_keys(storable, "url", [*RUN_ORDER, "platform"])
    new_keys = (target_urls.new_only(first) if isinstance(target_urls, UrlIndex) else K.new_only(first, target_urls)).select(*KEY)
    new_keys, n_new = write_counted(spark, new_keys, "new-keys", {"n": F.count(F.lit(1))})
    stored, refused_late = n_new["n"], 0
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"c.{c}")) for c in KEY]
    among = lambda rows, keys, how="left_semi": rows.alias("c").join(keys.alias("n"), same, how)
    new = write_shared(spark, late_details(among(cand, new_keys), landing), "new-rows")
    no_text = SK.unstorable(["description"])
    verdicts = new_keys.withColumn("verdict", F.lit("new"))
    refused = new.where(no_text)
    if n_refused := refused.count():
        # A detail text that the database refuses: the next row of its URL is tried, with its detail
        again = write_shared(spark, late_details(storable.join(refused.select("url").distinct(), "url", "left_semi"), landing), "second-rows")
        second = write_shared(spark, K.first_keys(again.where(~no_text), "url", [*RUN_ORDER, "platform"]).select(*KEY), "second-keys")
        verdicts = (among(new_keys, refused, "left_anti").select(*KEY).unionByName(second).withColumn("verdict", F.lit("new"))
                    .unionByName(again.where(no_text).select(*KEY).withColumn("verdict", F.lit("db_error"))))
        new = new.where(~no_text).unionByName(among(again, second))
        stored, refused_late = stored - n_refused + second.count(), again.where(no_text).count()
    new_rows = SK.enrich(new.drop("company_domain"))
    new_rows = P.finish_descriptions(new_rows)  # the Arrow UDF runs only on rows being stored
    narrow = cand.select(*KEY, "gate_ok", bad.alias("bad"))
    marked = among(narrow, verdicts, "left")
    judged = marked.select(*[F.col(f"c.{c}") for c in KEY], F.when(~F.col("gate_ok"), F.lit("gate_reject")).when(F.col("bad"), F.lit("db_error"))
                           .otherwise(F.coalesce("verdict", F.lit("duplicate"))).alias("outcome"))
    outcomes = staged.where(~is_cand).select(*KEY, "outcome").unionByName(judged)
    success = M.company_success(scoped, failed)
    return new_rows, outcomes, M.observed_stats(success, seen, stored, refused_late), success


def run(spark, landing: DataFrame, companies: DataFrame, target: str, batch_id: str, platform: str | None = None,
        company: str | None = None, searches: DataFrame | None = None, raise_on_gates: bool = True, rejects: str | None = None,
        registry_rejects: DataFrame | None = None):
    """A1: run the pipeline and append the new rows to ``target``; returns the stats row.
    Replaying a ``batch_id`` rewrites only its own partition (the anti-join ignores it). The batch's URLs are indexed
    after its write; a run that dies in between is made up for by the next one's ``sync``. The health gates (M4, M5)
    are judged after the write; inside a stream's batch the caller judges them at the end instead. ``rejects`` is the path
    of the quarantine table: what wasn't stored goes there with its reason, ``registry_rejects`` too if given."""
    from hirewire.operators import quarantine as Q
    from hirewire.operators import sink as SK

    index = UrlIndex(spark, target, exclude_batch=batch_id)
    index.sync(exclude=batch_id)
    new_rows, outcomes, stats, success = plan_run(spark, landing, companies, index, platform, company, searches)
    SK.append(SK.to_stored(new_rows, F.col("run_ts"), batch_id), target)
    index.add(SK.batch_urls(spark, target, batch_id))
    row = stats.collect()[0]
    if rejects is not None:
        Q.write(spark, outcomes, success, row, rejects, batch_id, registry_rejects)
    if raise_on_gates:
        M.check_health(row)
    return row
