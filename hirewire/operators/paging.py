"""Accounts of landed pages for every paged vendor: what came, what the vendor announced, what is missing.

A vendor's pages are numbered from its first page on. Missing page numbers are found as gaps between islands:
a number is an island's edge when it landed and the one before it did not, or the other way round. Each landed
page is looked at beside its neighbour only, in one aggregate over (source, page number), so a source with a
third of all pages is spread like any other; what meets per source is its islands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirewire.functions import dims
from hirewire.operators.extract import search_card_count, rmk_row_count

# Where each vendor's body holds its items and the announced total (None: it announces none), its first page.
PAGED = {
    "workday": ("$.jobPostings", "$.total", 0),
    "oracle": ("$.items[0].requisitionList", "$.items[0].TotalJobsCount", 0),
    "eightfold": ("$.data.positions", "$.data.count", 0),
    "taleo": ("$.requisitionList", "$.pagingData.totalCount", 1),
    "successfactors": ("$.jobSearchResult", "$.totalJobs", 0),
    "phenom": ("$.refineSearch.data.jobs", None, 0),
    "talentplatform": ("$.jobs", "$.totalCount", 1),
}
HTML_PAGED = {"successfactors": rmk_row_count, dims.SEARCH_PLATFORM: search_card_count}
SOURCE = ["run_ts", "platform", "kind", "company_seq", "search_id"]


def _by_platform(values: dict, otherwise: Column) -> Column:
    out = otherwise
    for platform, value in values.items():
        out = F.when(F.col("platform") == platform, value).otherwise(out)
    return out


def page_sizes(pages: DataFrame) -> DataFrame:
    """(source, page_no, n_items, announced) of the usable pages of paged vendors; a body without items has 0, an
    unreadable one too. Details and boards that answer in one piece are left out."""
    doc = F.try_parse_json("body")
    none = F.lit(None).cast("long")
    json_items = _by_platform({p: F.size(F.try_variant_get(doc, items, "array<variant>")) for p, (items, _, _) in PAGED.items()}, F.lit(None).cast("int"))
    html_items = _by_platform({p: count(F.col("body")) for p, count in HTML_PAGED.items()}, F.lit(None).cast("int"))
    total = _by_platform({p: F.try_variant_get(doc, t, "long") for p, (_, t, _) in PAGED.items() if t}, none)
    is_list, is_html = F.col("kind") == "list", F.col("kind") == "html_list"
    paged = pages.where((is_list & F.col("platform").isin(*PAGED)) | (is_html & F.col("platform").isin(*HTML_PAGED)))
    items = F.greatest(F.coalesce(F.when(is_list, json_items).otherwise(html_items), F.lit(0)), F.lit(0))
    return paged.select(*SOURCE, "page_no", items.cast("long").alias("n_items"), F.when(is_list, total).alias("announced"))


def _same(a: str, b: str) -> Column:
    out = F.lit(True)
    for c in SOURCE:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def page_accounts(pages: DataFrame) -> DataFrame:
    """One row for each source (run, vendor, kind, company, search) with landed pages: pages, items, announced (the largest
    announced total, null if none), short (announced less items, null likewise) and missing (page numbers from the
    vendor's first page on to the last landed one that did not land, as '3-5,9'; '' if none)."""
    sizes = page_sizes(pages)
    totals = sizes.groupBy(*SOURCE).agg(F.count(F.lit(1)).alias("pages"), F.sum("n_items").alias("items"), F.max("announced").alias("announced"))
    beside = F.array(F.struct(F.col("page_no").alias("n"), F.lit(True).alias("here")), F.struct((F.col("page_no") + 1).alias("n"), F.lit(False).alias("here")))
    marks = sizes.select(*SOURCE, F.explode(beside).alias("m")).select(*SOURCE, "m.n", "m.here")
    edges = marks.groupBy(*SOURCE, "n").agg(F.bool_or("here").alias("here"), F.bool_or(~F.col("here")).alias("after")).where(F.col("here") != F.col("after"))
    islands = edges.groupBy(*SOURCE).agg(F.sort_array(F.collect_list(F.when(F.col("here"), F.col("n")))).alias("begins"),
                                         F.sort_array(F.collect_list(F.when(F.col("after"), F.col("n")))).alias("ends"))
    first = _by_platform({p: F.lit(n) for p, (_, _, n) in PAGED.items()}, F.lit(0))
    gaps = F.transform("begins", lambda b, i: F.struct(F.when(i == 0, F.col("first")).otherwise(F.get("ends", i - 1)).alias("a"), (b - 1).alias("z")))
    texts = F.transform(F.filter(gaps, lambda g: g["a"] <= g["z"]), lambda g: F.when(g["a"] == g["z"], g["a"].cast("string")).otherwise(F.concat(g["a"].cast("string"), F.lit("-"), g["z"].cast("string"))))
    missing = islands.withColumn("first", first).select(*SOURCE, F.array_join(texts, ",").alias("missing"))
    both = totals.alias("t").join(missing.alias("m"), _same("t", "m"))
    return both.select(*[F.col(f"t.{c}") for c in SOURCE], "pages", "items", "announced", (F.col("announced") - F.col("items")).alias("short"), "missing")
