"""Registry (S1-S6) and landing (S8, S10-S12) behaviour on literal inputs."""

import datetime as dt
import json

from hirewire.sources import landing as LD
from hirewire.sources import registry as R

from .conftest import rows


def test_registry_truthiness_and_keys(spark, tmp_path):
    base = {"ats_platform": "lever", "board_slug": "s"}
    entries = [
        {"company_name": "absent", **base},
        {"company_name": "null", **base, "enabled": None},
        {"company_name": "false", **base, "enabled": False},
        {"company_name": "str-false", **base, "enabled": "false"},
        {"company_name": "zero", **base, "enabled": 0},
        {"company_name": "empty-str", **base, "enabled": ""},
        {"company_name": "empty-list", **base, "enabled": []},
        {"company_name": "empty-obj", **base, "enabled": {}},
        {"company_name": "no-slug", "ats_platform": "lever"},
        {"company_name": "null-slug", "ats_platform": "lever", "board_slug": None},
        {"company_name": "bad-platform", "ats_platform": "Lever", "board_slug": "s"},
        {"company_name": "str-list", **base, "enabled": "[]"},
    ]
    (tmp_path / "a.json").write_text(json.dumps({"companies": entries}))
    (tmp_path / "b.json").write_text(json.dumps({"other": []}))
    good, bad = R.load_registry(spark, str(tmp_path))
    assert rows(good.orderBy("company_seq"), "company_name") == ["absent", "str-false", "null-slug", "str-list"]
    reasons = dict(rows(bad, "company_name", "reason"))
    assert reasons["no-slug"] == "missing_keys" and reasons["bad-platform"] == "bad_platform"
    assert reasons["zero"] == "disabled" and reasons["null"] == "disabled"
    assert R.scope(good, company="ABSENT").count() == 1 and R.scope(good, platform="greenhouse").count() == 0


LAND = ("run_ts timestamp_ntz, platform string, company_seq bigint, search_id int, kind string, page_no int, item_key string, "
        "status int, attempt int, body string")


def test_latest_good_answer_of_each_request_and_run(spark):
    def answer(company, status, attempt, body, hour=0, search=0):
        return (dt.datetime(2024, 2, 15, hour), "phenom", company, search, "list", 0, "", status, attempt, body)

    data = [answer(1, 429, 0, None), answer(1, 200, 1, "ok"), answer(2, 404, 0, None), answer(2, 200, 1, "late"),
            answer(3, 429, 0, None), answer(3, -1, 1, None), answer(3, 200, 9, "ninth"), answer(4, 200, 0, "old"), answer(4, 200, 1, "new"),
            answer(4, 200, 0, "next hour", hour=1), answer(5, 500, 0, "error page"), answer(6, 200, 0, "a", search=None),
            answer(6, 200, 1, "b", search=None)]
    land = spark.createDataFrame(data, LAND)
    got = sorted((r["company_seq"], r["run_ts"].hour, r["body"]) for r in LD.usable_pages(land).collect())
    assert got == [(1, 0, "ok"), (2, 0, "late"), (3, 0, "ninth"), (4, 0, "new"), (4, 1, "next hour"), (6, 0, "b")]
    ok = {(r["company_seq"], r["run_ts"].hour): r["ok"] for r in LD.request_outcomes(land).collect()}
    assert ok == {(1, 0): True, (2, 0): True, (3, 0): True, (4, 0): True, (4, 1): True, (5, 0): False, (6, 0): True}


def test_attach_details_and_prefer(spark):
    t = "run_ts string, platform string, company_seq bigint, "
    items = spark.createDataFrame([("r", "oracle", 1, i, str(i)) for i in range(500)], t + "item_pos int, item_key string")
    det = spark.createDataFrame([("r", "oracle", 1, str(i), f"d{i}") for i in range(499)] + [("s", "oracle", 1, "499", "other run")],
                                t + "item_key string, detail string")
    out = LD.attach_details(items, det)
    assert sorted(rows(out, "item_pos", "detail")) == [(i, f"d{i}") for i in range(499)] + [(499, "")]
    a = spark.createDataFrame([("r", "s", 1, "csb")], t + "v string")
    b = spark.createDataFrame([("r", "s", 1, "rmk"), ("r", "s", 2, "rmk"), ("q", "s", 1, "rmk")], t + "v string")
    assert sorted(rows(LD.prefer(a, b), "run_ts", "company_seq", "v")) == [("q", 1, "rmk"), ("r", 1, "csb"), ("r", 2, "rmk")]


def test_dispatch_counts_postings_of_rmk_companies(spark, tmp_path):
    """A company of mode rmk that landed CSB pages only counts with its RMK pages; other companies count once."""
    from hirewire.plans.q_extract import s7_platform_dispatch
    from hirewire.sources import fixtures as X
    from hirewire.sources import fixtures_landing as FL

    titled = [e for e in range(7, 20_000, 14) if X.TITLES[e % len(X.TITLES)] and X.TITLES[e % len(X.TITLES)].strip() and e % FL.N_COMPANIES % 43 and e % FL.N_COMPANIES % 11]
    of = lambda test: [e for e in titled if test(e % FL.N_COMPANIES)][:3]
    ids = of(lambda k: k % 3 and k % 5 == 1) + of(lambda k: k % 3 and k % 5 == 3) + of(lambda k: k % 3 == 0 and k % 5 == 1)
    spark.createDataFrame([(e,) for e in ids], "event_id long").selectExpr("event_id", "timestamp_ntz'2024-02-14 00:00:00' AS ts").write.parquet(str(tmp_path / "events.parquet"))
    assert {tuple(r) for r in s7_platform_dispatch(spark, str(tmp_path)).collect()} == {("successfactors", 9), ("linkedin", 9)}
