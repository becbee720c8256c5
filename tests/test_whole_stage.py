"""What a run compiles and how it lands: methods that the JVM compiles (it interprets those of over 8000 bytes), requests
spread over all files."""

import datetime as dt
import re

from pyspark.sql import functions as F

from hirewire.functions import dates as D
from hirewire.functions import urls as U
from hirewire.operators import dedup as K
from hirewire.operators import sink as SK
from hirewire.operators.process import classify_all
from hirewire.plans.q_run import land_run
from tests.conftest import rows

RUN = dt.datetime(2024, 2, 15)
RAW = "title string, location string, department string, posted_date timestamp_ntz, url string, company string, company_url string, company_logo string"


def postings(spark, tmp_path):
    """Read from files, so that no row is known to the planner."""
    data = [("Software Engineer Intern", "Toronto, ON", "Data", RUN, "https://a.com/p/?b=2&a=1#x", "Acme", "https://www.acme.com", ""),
            ("Senior Engineer", "Austin, TX", None, RUN, "https://a.com/q", "Acme", "", ""),
            ("Data Analyst", "Paris", "Legal", RUN, "https://a.com/r", "Beta", None, None),
            ("Accountant", "Remote", "Legal", dt.datetime(2020, 1, 1), "https://a.com/s", "Beta", None, None),
            (None, None, None, None, None, None, None, None)]
    spark.createDataFrame(data, RAW).write.parquet(str(tmp_path / "raw"))
    return spark.read.schema(RAW).parquet(str(tmp_path / "raw"))


def largest_method(df, capsys):
    df.explain("codegen")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out))


def test_classification_fits_the_compiler(spark, tmp_path, capsys):
    done = K.with_normalized_url(classify_all(postings(spark, tmp_path), "2024-02-15 00:00:00"), "url", "url")
    assert largest_method(done, capsys) <= 8000
    # The country is projected by compiled code, not by a generator that is interpreted
    assert not [n for n in re.findall(r"Generate inline\(([^\n]*)", done._jdf.queryExecution().executedPlan().toString()) if "AS country" in n or "Toronto" in n or "RLIKE" in n]
    got = {r["title"]: (r["outcome"], r["country"], r["role_category"], r["url"]) for r in done.collect()}
    assert got["Software Engineer Intern"][0::3] == ("candidate", "https://a.com/p?a=1&b=2") and got["Software Engineer Intern"][1] == "CA"
    assert got["Senior Engineer"][:3] == ("filtered_title", None, None)
    assert got["Data Analyst"][:3] == ("filtered_location", None, None)
    assert got["Accountant"][:3] == ("filtered_stale", "US", None)
    assert got[None][:3] == ("filtered_title", None, None)


def test_enrichment_fits_the_compiler(spark, tmp_path, capsys):
    done = SK.enrich(postings(spark, tmp_path))
    assert largest_method(done, capsys) <= 8000
    assert sorted(rows(done, "company_domain")) == ["", "acme.com", "acme.com", "beta.com", "beta.com"]


def test_a_run_lands_spread_over_the_files(spark, tmp_path):
    """All pages of one source in one file would be parsed by one task."""
    n = 64
    pages = spark.range(n).select(F.lit(RUN).cast("timestamp_ntz").alias("run_ts"), F.lit("linkedin").alias("platform"), F.lit(0).cast("long").alias("company_seq"),
                                  F.col("id").cast("int").alias("search_id"), F.lit("html_list").alias("kind"), F.lit(0).alias("page_no"), F.lit("").alias("item_key"),
                                  F.lit(200).alias("status"), F.lit(0).alias("attempt"), F.concat(F.lit("page "), F.col("id").cast("string")).alias("body"))
    path = str(tmp_path / "landing")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        land_run(pages, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    landed = spark.read.parquet(path)
    assert landed.select(F.input_file_name()).distinct().count() > 1
    assert sorted(rows(landed, "body")) == sorted(f"page {i}" for i in range(n))


def test_plain_iso_texts_and_others(spark):
    texts = ["2024-02-15", "2024-02-15T10:11:12.5Z", "2024-02-15T10:11:12+0500", "2024-02-30T10:11:12", "20240215T1011", "2024-02-15 10:11", "2024-02-15T10:11:12.1234567", "x", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    day = dt.datetime(2024, 2, 15)
    at = lambda *a: day.replace(hour=10, minute=11, second=a[0], microsecond=a[1])
    assert rows(df.select("i", D.iso_naive("s").alias("d")).orderBy("i"), "d") == \
        [day, at(12, 500000), at(12, 0), None, at(0, 0), at(0, 0), at(12, 123456), None, None]


def test_url_parts_of_one_match(spark):
    urls = ["HTTP://u@h:8/p;x/q;y?a=1?b#f#g", "//h", "mailto:a@b", "a b?#", "", None]
    got = U.with_url_parts(spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string"), "u").orderBy("i")
    assert rows(got, "_u_scheme", "_u_netloc", "_u_path", "_u_query", "_u_fragment") == [
        ("http", "u@h:8", "/p;x/q", "a=1?b", "f#g"), ("", "h", "", "", ""), ("mailto", "", "a@b", "", ""),
        ("", "", "a b", "", ""), ("", "", "", "", ""), (None, "", None, None, None)]


def test_a_batch_is_read_from_its_files(spark, tmp_path):
    """Of a micro-batch each vendor's branch opens that vendor's files only, whatever is encoded in their names."""
    from hirewire.sources.landing import LANDING_SCHEMA
    from hirewire.streaming.incremental import as_files, landing_stream
    folder = str(tmp_path / "landing 100% +é")
    pages = spark.createDataFrame([(RUN, p, i, 0, "list", 0, "", 200, 0, f"{p} {i}") for p in ("lever", "ashby", "a b%2F[c]") for i in range(5)], LANDING_SCHEMA)
    land_run(pages, folder)
    seen = []

    def batch(df, _):
        read = as_files(df, folder)
        plan = read.where("platform = 'lever'")._jdf.queryExecution().executedPlan().toString()
        seen.append((sorted(rows(read, "body")), sorted(rows(df, "body")), read.columns == df.columns, "PartitionFilters: [isnotnull(platform" in plan))

    landing_stream(spark, folder).writeStream.foreachBatch(batch).option("checkpointLocation", str(tmp_path / "ck")) \
        .trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 1 and seen[0][0] == seen[0][1] and len(seen[0][0]) == 15 and seen[0][2:] == (True, True)
    assert as_files(pages, folder) is pages  # not of files
