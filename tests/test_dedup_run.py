"""K1-K3 first-wins and new-only semantics; the driver contract."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from hirewire.operators import dedup as K
from hirewire.operators.process import ORDER_COLS

from .conftest import rows


def _batch(spark):
    data = [(2, 0, 0, 5, "https://x/a?utm_source=1", "A", "t1"),
            (1, 0, 0, 9, "https://x/a/", "B", "t2"),
            (1, 0, 0, 3, "https://x/a#f", "   ", "t3"),   # blank company -> gated out, cannot win
            (0, 7, 0, 1, "https://x/b", "C", "t4"),
            (0, 7, 0, 0, "https://x/b", "D", "   ")]       # blank title -> gated out
    return spark.createDataFrame(data, "platform_rank int, company_seq int, page_no int, item_pos long, url string, "
                                       "company string, title string")


def test_first_wins_after_gate(spark):
    b = K.with_normalized_url(_batch(spark))
    gated = b.where(K.quality_gate(b))
    win = K.first_wins(gated, "url", ORDER_COLS)
    assert sorted(rows(win, "url", "company")) == [("https://x/a", "B"), ("https://x/b", "C")]


def test_first_wins_independent_of_partitioning(spark):
    df = spark.range(0, 2000).select((F.col("id") % 37).cast("string").alias("url"),
                                     (F.col("id") * 7919 % 2000).alias("item_pos"),
                                     F.lit(0).alias("platform_rank"), F.lit(0).alias("company_seq"),
                                     F.lit(0).alias("page_no"), F.col("id").alias("payload"))
    a = sorted(rows(K.first_wins(df.repartition(1), "url", ORDER_COLS), "url", "payload"))
    b = sorted(rows(K.first_wins(df.repartition(13, "payload"), "url", ORDER_COLS), "url", "payload"))
    assert a == b and len(a) == 37


def test_new_only(spark):
    batch = spark.createDataFrame([("u1", 1), ("u2", 2), ("u3", 3), (None, 4)], "url string, v int")
    stored = spark.createDataFrame([("u2",), ("u9",), (None,)], "url string")
    assert sorted(rows(K.new_only(batch, stored), "url"), key=str) == [None, "u1", "u3"]


def test_contract_keys(spark):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs) and len(qs) >= 80
    df = E.entry(spark)
    assert set(df.columns) == {"country", "work_type", "experience_level", "role_category", "n_jobs"}
    assert df.count() > 0


def _fixture(spark):
    from hirewire.plans.q_extract import companies_table, landing_table
    sf = "/root/testdata/sf0.001"
    return landing_table(spark, sf), companies_table(spark, sf)


def test_run_replay_is_idempotent(spark, tmp_path):
    from hirewire.plans import run as R

    land, co = _fixture(spark)
    target = str(tmp_path / "jobs")
    first = R.run(spark, land, co, target, "b1")
    n1 = spark.read.parquet(target).count()
    again = R.run(spark, land, co, target, "b1")
    assert n1 == first["new_jobs_stored"] > 0 and again["new_jobs_stored"] == first["new_jobs_stored"]
    assert spark.read.parquet(target).count() == n1
    later = R.run(spark, land, co, target, "b2")
    assert later["new_jobs_stored"] == 0 and later["duplicates_skipped"] == first["candidates"]
    assert spark.read.parquet(target).select("url").distinct().count() == n1


LAND = ("run_ts timestamp_ntz, platform string, company_seq bigint, search_id int, kind string, page_no int, item_key string, "
        "status int, attempt int, body string")
COMPANY = "company_seq bigint, company_name string, ats_platform string, board_slug string, j string"
H1, H2 = dt.datetime(2024, 2, 15, 1), dt.datetime(2024, 2, 15, 2)


def _job(i, title="Software Engineer Intern"):
    return json.dumps({"id": i, "title": title, "location": {"name": "Toronto, ON"}, "updated_at": "2024-02-14T00:00:00Z", "departments": []})


def _board(spark, rows_):
    """Landed greenhouse answers: (run_ts, page, status, attempt, job ids); NULL search ids, as boards have none."""
    data = [(ts, "greenhouse", 1, None, "list", page, None, status, attempt,
             None if ids is None else '{"jobs":[' + ",".join(i if isinstance(i, str) else _job(i) for i in ids) + "]}")
            for ts, page, status, attempt, ids in rows_]
    co = spark.createDataFrame([(1, "Acme", "greenhouse", "acme", "{}")], COMPANY).withColumn("raw", F.parse_json("j")).drop("j")
    return spark.createDataFrame(data, LAND), co


def _empty(spark):
    return spark.createDataFrame([], "url string")


def test_runs_pages_and_attempts_are_all_read(spark):
    """Two runs, a page gap, a page beyond any old limit, a late third attempt and a superseded answer; outcomes of
    rows whose search_id is NULL."""
    from hirewire.plans import run as R

    land, co = _board(spark, [(H1, 0, 200, 0, [1, 2]), (H2, 0, 200, 0, [2, 3]), (H1, 7, 200, 0, [4]), (H1, 900, 200, 0, [5]),
                              (H1, 1, 429, 0, None), (H1, 1, -1, 1, None), (H1, 1, 200, 2, [6]), (H1, 2, 200, 0, [7]), (H1, 2, 200, 1, [8]),
                              (H1, 3, 404, 0, None)])
    new, outcomes, stats, _ = R.plan_run(spark, land, co, _empty(spark))
    got = sorted((r["url"].rsplit("/", 1)[1], r["run_ts"].hour) for r in new.collect())
    assert got == [("1", 1), ("2", 1), ("3", 2), ("4", 1), ("5", 1), ("6", 1), ("8", 1)]
    assert sorted(r["outcome"] for r in outcomes.collect()) == ["duplicate"] + ["new"] * 7
    row = stats.first()
    assert (row["total_jobs_found"], row["new_jobs_stored"], row["duplicates_skipped"], row["db_errors"]) == (8, 7, 1, 0)


def test_rows_are_judged_by_their_own_run(spark):
    from hirewire.plans import run as R

    late = dt.datetime(2024, 6, 1)
    land, co = _board(spark, [(H1, 0, 200, 0, [1]), (late, 0, 200, 0, [2])])  # both posted in February
    assert sorted(r["outcome"] for r in R.plan_run(spark, land, co, _empty(spark))[1].collect()) == ["filtered_stale", "new"]


def test_failing_rows_and_write_error_gate(spark, tmp_path):
    from hirewire.plans import run as R

    bad = _job(1, "Software Engineer Intern \x00")
    land, co = _board(spark, [(H1, 0, 200, 0, [bad, 2])])
    row = R.run(spark, land, co, str(tmp_path / "a"), "b1")
    assert (row["db_errors"], row["new_jobs_stored"]) == (1, 1)
    land, co = _board(spark, [(H1, 0, 200, 0, [bad])])
    with pytest.raises(RuntimeError, match="write errors"):
        R.run(spark, land, co, str(tmp_path / "b"), "b1")


def test_scope_without_companies_gives_nothing(spark):
    from hirewire.plans import run as R

    land, co = _fixture(spark)
    for kw in ({"platform": "linkedin"}, {"platform": "nosuch"}, {"company": "nobody"}):
        new, _, stats, _ = R.plan_run(spark, land, co, _empty(spark), **kw)
        assert new.count() == 0
        assert all(v == 0 for v in stats.first().asDict().values())


def test_unguarded_board_fails_in_its_own_run(spark):
    from hirewire.plans import run as R

    land, co = _board(spark, [(H1, 0, 200, 0, [1]), (H2, 0, 200, 0, [2])])
    broken = _board(spark, [(H2, 1, 200, 0, [])])[0].withColumn("body", F.lit("{cut"))
    new, _, stats, success = R.plan_run(spark, land.unionByName(broken), co, _empty(spark))
    assert [r["run_ts"].hour for r in new.collect()] == [1] and success.first()["failed"]
    assert stats.first()["companies_failed"] == 1


def test_all_details_and_whole_texts(spark):
    """More details than any old limit, and a text of 20,000 characters."""
    from hirewire.operators.extract import finish_descriptions
    from hirewire.plans import run as R

    n, long = 450, "x" * 20_000
    items = ",".join(json.dumps({"id": i, "jobOpeningName": f"T{i}", "location": {"city": "Ottawa"}}) for i in range(1, n + 1))
    data = [(H1, "bamboohr", 1, 0, "list", 0, "", 200, 0, '{"result":[' + items + "]}")]
    data += [(H1, "bamboohr", 1, 0, "detail", 0, str(i), 200, 0, json.dumps({"result": {"jobOpening": {"description": f"<p>{long}&amp;{i}</p>"}}}))
             for i in range(1, n + 1)]
    co = spark.createDataFrame([(1, "Acme", "bamboohr", "acme", "{}")], COMPANY).withColumn("raw", F.parse_json("j")).drop("j")
    jobs = finish_descriptions(R.platform_raw_jobs(R.board_pages(spark.createDataFrame(data, LAND), co), "bamboohr"))
    assert sorted(rows(jobs, "description")) == sorted(f"{long}&{i}" for i in range(1, n + 1))


def test_missing_target_is_empty_but_a_broken_one_raises(spark, tmp_path):
    from hirewire.operators import sink as SK

    assert SK.read_target(spark, str(tmp_path / "none")) is None
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        SK.stored_urls(spark, str(tmp_path / "broken")).collect()


def test_stream_over_runs_restart_and_new_checkpoint(spark, tmp_path):
    """Three batches, one holding a company's later page alone; a replayed batch; a stream started anew."""
    from hirewire.streaming.incremental import process_batch, run_available, stream_name

    co = _board(spark, [])[1]
    target, ck = str(tmp_path / "jobs"), str(tmp_path / "ck")
    src = str(tmp_path / "landing")
    for k, answers in enumerate([[(H1, 0, 200, 0, [1, 2])], [(H1, 1, 200, 0, [3])], [(H2, 0, 200, 0, [2, 4])]]):
        batch = _board(spark, answers)[0]
        batch.coalesce(1).write.mode("append").parquet(src)
        run_available(spark, src, co, target, ck, max_files_per_trigger=1)
        assert len({r["url"] for r in spark.read.parquet(target).collect()}) == [2, 3, 4][k]
    stored = sorted((r["url"], r["batch_id"]) for r in spark.read.parquet(target).collect())
    process_batch(co, target, stream_name(ck), [])(batch, 2)  # the last batch once more
    assert sorted((r["url"], r["batch_id"]) for r in spark.read.parquet(target).collect()) == stored
    results = run_available(spark, src, co, target, str(tmp_path / "other"))
    assert sum(r["new_jobs_stored"] for r in results) == 0
    assert sorted((r["url"], r["batch_id"]) for r in spark.read.parquet(target).collect()) == stored

def test_byte_equal_answers_count_once(spark):
    """The same answer landed twice is one answer, in rows and in the found and skipped counters; of several attempts the last good one counts."""
    from hirewire.plans import run as R

    land, co = _board(spark, [(H1, 0, 200, 0, [1, 2]), (H1, 0, 200, 0, [1, 2]), (H1, 1, 200, 0, [3]), (H1, 1, 200, 1, [4]), (H1, 1, 200, 1, [4]),
                              (H1, 1, 200, 2, None), (H1, 1, 500, 3, [9])])
    new, outcomes, stats, _ = R.plan_run(spark, land, co, _empty(spark))
    assert sorted(r["url"].rsplit("/", 1)[1] for r in new.collect()) == ["1", "2", "4"]
    assert stats.first()["total_jobs_found"] == 3 and stats.first()["duplicates_skipped"] == 0
    assert {r["outcome"] for r in outcomes.collect()} == {"new"}


def test_no_body_in_the_aggregate_of_answers(spark, tmp_path):
    """What finds the requests with several answers reads no body."""
    from hirewire.sources import landing as LD

    _board(spark, [(H1, 0, 200, 0, [1])])[0].write.parquet(str(tmp_path / "landing"))
    land = spark.read.parquet(str(tmp_path / "landing"))
    several = land.where(F.col("status").between(200, 299)).groupBy(*LD.REQUEST_KEY).agg(F.count(F.lit(1)).alias("n"))
    assert "body" not in several._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1].split("\n")[0]
    pages = LD.usable_pages(land)  # every request answered once: a plain scan
    assert "Join" not in pages._jdf.queryExecution().executedPlan().toString() and pages.count() == 1


SF_COMPANY = '{"sf_host":"jobs.x.com"%s}'


def _successfactors(spark, companies):
    """companies: (seq, sf_mode or None, CSB titles or None, RMK titles or None) -> raw jobs by company."""
    from hirewire.plans import run as R

    data = []
    for seq, _, csb, rmk in companies:
        if csb is not None:
            items = ",".join(json.dumps({"response": {"id": f"{seq}{i}", "jobTitle": t}}) for i, t in enumerate(csb, 1))
            data.append((H1, "successfactors", seq, 0, "list", 0, "", 200, 0, '{"jobSearchResult":[' + items + "]}"))
        if rmk is not None:
            rows_ = "".join(f'<tr class="data-row"><td><a href="/job/Ottawa-{i}/{seq}{i}/" class="jobTitle-link">{t}</a></td></tr>' for i, t in enumerate(rmk, 1))
            data.append((H1, "successfactors", seq, 0, "html_list", 0, "", 200, 0, f"<table>{rows_}</table>"))
    co = spark.createDataFrame([(seq, f"C{seq}", "successfactors", "b", SF_COMPANY % ("" if mode is None else f',"sf_mode":"{mode}"')) for seq, mode, _, _ in companies],
                               COMPANY).withColumn("raw", F.parse_json("j")).drop("j")
    jobs = R.platform_raw_jobs(R.board_pages(spark.createDataFrame(data, LAND), co), "successfactors")
    return sorted((r["company_seq"], r["title"]) for r in jobs.collect())


def test_successfactors_modes(spark):
    """auto prefers CSB rows and falls back per company, csb never falls back, rmk and unknown modes read RMK pages only."""
    got = _successfactors(spark, [(1, None, ["csb"], ["rmk"]), (2, "auto", [], ["rmk"]), (3, "csb", [], ["rmk"]), (4, "csb", ["csb"], ["rmk"]), (5, " RMK ", ["csb"], ["rmk"]),
                                  (6, "rmk", ["csb"], None), (7, "other", ["csb"], ["rmk"]), (8, "auto", ["", "csb"], None), (9, "AUTO", [""], ["rmk", "rmk2"]), (10, "  ", ["csb"], ["rmk"])])
    assert got == [(1, "csb"), (2, "rmk"), (4, "csb"), (5, "rmk"), (7, "rmk"), (8, "csb"), (9, "rmk"), (9, "rmk2"), (10, "rmk")]


def _bamboo(spark, details):
    """A bamboohr board of jobs 1..n; ``details``: job id -> description or None (no detail landed)."""
    items = ",".join(json.dumps({"id": i, "jobOpeningName": t, "location": {"city": "Ottawa"}}) for i, (t, _) in details.items())
    data = [(H1, "bamboohr", 1, 0, "list", 0, "", 200, 0, '{"result":[' + items + "]}")]
    data += [(H1, "bamboohr", 1, 0, "detail", 0, str(i), 200, 0, json.dumps({"result": {"jobOpening": {"description": d}}})) for i, (_, d) in details.items() if d is not None]
    co = spark.createDataFrame([(1, "Acme", "bamboohr", "acme", "{}")], COMPANY).withColumn("raw", F.parse_json("j")).drop("j")
    return spark.createDataFrame(data, LAND), co


def test_details_come_late(spark, monkeypatch):
    """Only the details of new rows are looked at: filtered and known postings cost no text."""
    from hirewire.plans import run as R

    intern = "Software Engineer Intern"
    land, co = _bamboo(spark, {1: (intern, "<p>one &amp; all</p>"), 2: ("Senior Software Engineer", "<p>two</p>"), 3: (intern, None), 4: (intern, "<p>known</p>"), 5: (intern, "")})
    stored = spark.createDataFrame([("https://acme.bamboohr.com/careers/4",)], "url string")
    seen, plain = [], R.LD.usable_pages

    def spy(pages):
        seen.extend(r["item_key"] for r in pages.where("kind = 'detail'").collect())
        return plain(pages)
    monkeypatch.setattr(R.LD, "usable_pages", spy)
    new = R.plan_run(spark, land, co, stored)[0]
    assert sorted((r["item_key"], r["description"]) for r in new.collect()) == [("1", "one & all"), ("3", ""), ("5", "")]
    assert sorted(seen) == ["1", "5"]


def test_details_that_the_database_refuses(spark):
    """A new row whose detail holds a NUL is a write error, and the next row of its URL takes its place."""
    from hirewire.plans import run as R

    intern = "Software Engineer Intern"
    land, co = _bamboo(spark, {1: (intern, "bad \x00"), 2: (intern, "good")})
    again = land.where("kind = 'list'").withColumn("page_no", F.lit(1))
    detail = land.where("item_key = '2'").withColumn("item_key", F.lit("1")).withColumn("page_no", F.lit(0)).withColumn("attempt", F.lit(0))
    new, outcomes, stats, _ = R.plan_run(spark, land, co, _empty(spark))
    assert [r["item_key"] for r in new.collect()] == ["2"] and stats.first()["db_errors"] == 1 and stats.first()["new_jobs_stored"] == 1
    # the same URL with a good detail in a later run: that row is stored
    later = again.withColumn("run_ts", F.lit(H2)).unionByName(detail.withColumn("run_ts", F.lit(H2)))
    new, outcomes, stats, _ = R.plan_run(spark, land.unionByName(later), co, _empty(spark))
    assert sorted((r["item_key"], r["run_ts"].hour, r["description"]) for r in new.collect()) == [("1", 2, "good"), ("2", 1, "good")]
    assert sorted(r["outcome"] for r in outcomes.collect()) == ["db_error", "duplicate", "new", "new"]
    from hirewire.operators.metrics import run_stats
    success = spark.createDataFrame([("bamboohr", 1, False)], "platform string, company_seq long, failed boolean")
    assert run_stats(outcomes, success).first() == stats.first()  # observed on the writes, or counted over the outcomes


def test_page_accounts(spark):
    """Pages, items, announced totals and the ranges of missing pages, from the vendor's first page on."""
    from hirewire.operators.paging import page_accounts

    wd = lambda n, total: json.dumps({"total": total, "jobPostings": [{"title": "x"}] * n})
    row = lambda platform, seq, page, body, kind="list", search=0: (H1, platform, seq, search, kind, page, "", body)
    data = [row("workday", 1, p, wd(20, 95)) for p in (0, 1, 4, 5, 9)] + [row("workday", 2, 3, "{cut")] + [row("workday", 3, 0, wd(2, None))]
    data += [row("taleo", 1, p, json.dumps({"pagingData": {"totalCount": 7}, "requisitionList": [{}] * 3})) for p in (1, 2)] + [row("greenhouse", 1, 0, '{"jobs":[{}]}')]
    data += [row("oracle", 1, 1, json.dumps({"items": [{"TotalJobsCount": 60, "requisitionList": [{}] * 10}]}))]
    data += [row("successfactors", 1, 0, '<tr class="data-row">x</tr><tr class="data-row">y</tr>', "html_list")]
    data += [row("linkedin", 0, 0, 'data-entity-urn="urn:li:jobPosting:7" ' * 3, "html_list", 4)]
    pages = spark.createDataFrame(data, "run_ts timestamp_ntz, platform string, company_seq bigint, search_id int, kind string, page_no int, item_key string, body string")
    got = {(r["platform"], r["kind"], r["company_seq"], r["search_id"]): tuple(r)[5:] for r in page_accounts(pages).collect()}
    assert got == {("workday", "list", 1, 0): (5, 100, 95, -5, "2-3,6-8"), ("workday", "list", 2, 0): (1, 0, None, None, "0-2"), ("workday", "list", 3, 0): (1, 2, None, None, ""),
                   ("taleo", "list", 1, 0): (2, 6, 7, 1, ""), ("oracle", "list", 1, 0): (1, 10, 60, 50, "0"), ("successfactors", "html_list", 1, 0): (1, 2, None, None, ""),
                   ("linkedin", "html_list", 0, 4): (1, 3, None, None, "")}
    assert page_accounts(pages.limit(0)).count() == 0
