"""Quarantine of a run's rows: reasons, source keys, sums, replays."""

import json

import pytest
from pyspark.sql import functions as F

from hirewire.operators import quarantine as Q

from .test_dedup_run import H1, H2, _board, _job


def _reasons(spark, path):
    return sorted((r["batch_id"], r["level"], r["reason"], r["page_no"], r["item_pos"], r["n"]) for r in Q.read(spark, path).collect()
                  if r["level"] == "posting")


def _sums(spark, path):
    got = {(r["batch_id"], r["reason"]): r["n"] for r in Q.read(spark, path).where("level = 'batch'").collect()}
    lost = {r["batch_id"]: r["count"] for r in Q.read(spark, path).where("level = 'posting'").groupBy("batch_id").count().collect()}
    return got, lost


def test_every_row_is_stored_or_quarantined(spark, tmp_path):
    from hirewire.plans import run as R

    abroad = json.dumps({**json.loads(_job(4)), "location": {"name": "Paris, France"}})
    old = json.dumps({**json.loads(_job(5)), "updated_at": "2020-01-01T00:00:00Z"})
    land, co = _board(spark, [(H1, 0, 200, 0, [1, _job(2, "Senior Director"), _job(3, "Software Engineer Intern \x00"), abroad, old]),
                              (H1, 7, 200, 0, [1, 6])])
    bad = spark.createDataFrame([(9, "Nix", None, "missing_keys", ["board_slug"])],
                                "company_seq long, company_name string, ats_platform string, reason string, missing array<string>")
    target, rejects = str(tmp_path / "jobs"), str(tmp_path / "rejects")
    for _ in range(2):  # a replay rewrites its own rows
        row = R.run(spark, land, co, target, "b1", rejects=rejects, registry_rejects=bad)
        assert [(r[2], r[3]) for r in _reasons(spark, rejects)] == [("db_error", 0), ("duplicate", 7), ("filtered_location", 0),
                                                                    ("filtered_stale", 0), ("filtered_title", 0)]
        sums, lost = _sums(spark, rejects)
        assert sums == {("b1", "read"): 7, ("b1", "stored"): 2} and lost == {"b1": 5} and row["new_jobs_stored"] == 2
    entry = Q.read(spark, rejects).where("level = 'registry'").collect()
    assert [(r["company_seq"], r["platform"], r["reason"], r["detail"]) for r in entry] == [(9, None, "missing_keys", "board_slug")]
    R.run(spark, _board(spark, [(H2, 0, 200, 0, [1, 8])])[0], co, target, "b2", rejects=rejects)
    sums, lost = _sums(spark, rejects)
    assert sums[("b2", "read")] == 2 and lost == {"b1": 5, "b2": 1}
    # a replay that finds nothing wrong leaves no old rows behind
    R.run(spark, _board(spark, [(H2, 0, 200, 0, [8])])[0], co, target, "b2", rejects=rejects)
    assert _sums(spark, rejects)[1] == {"b1": 5}


def test_failed_company_and_empty_landing(spark, tmp_path):
    from hirewire.plans import run as R

    land, co = _board(spark, [(H1, 0, 200, 0, [1])])
    rejects = str(tmp_path / "rejects")
    R.run(spark, land.withColumn("body", F.lit("no json")), co, str(tmp_path / "a"), "b1", raise_on_gates=False, rejects=rejects)
    R.run(spark, land.limit(0), co, str(tmp_path / "b"), "b2", raise_on_gates=False, rejects=rejects)
    got = sorted((r["batch_id"], r["level"], r["reason"], r["company_seq"], r["n"]) for r in Q.read(spark, rejects).collect())
    assert got == [("b1", "batch", "read", None, 0), ("b1", "batch", "stored", None, 0), ("b1", "company", "undecodable_answer", 1, 1),
                   ("b2", "batch", "read", None, 0), ("b2", "batch", "stored", None, 0)]


def test_lost_rows_raise(spark, tmp_path):
    outcomes = spark.createDataFrame([("greenhouse", 1, "duplicate"), ("greenhouse", 1, None)], "platform string, company_seq long, outcome string")
    success = spark.createDataFrame([], "platform string, company_seq long, failed boolean")
    stats = {"total_jobs_found": 4, "new_jobs_stored": 1}
    with pytest.raises(Q.RowsLost, match="4 postings read, 1 stored, 2 quarantined"):
        Q.write(spark, outcomes, success, stats, str(tmp_path / "r"), "b")
    assert Q.write(spark, outcomes, success, {**stats, "new_jobs_stored": 2}, str(tmp_path / "r"), "b") == 2


def test_stream_batches_leave_their_rejects(spark, tmp_path):
    from hirewire.streaming.incremental import run_available

    land, co = _board(spark, [(H1, 0, 200, 0, [1, _job(2, "Senior Director")])])
    land.write.partitionBy("platform").parquet(str(tmp_path / "landing"))
    rejects = str(tmp_path / "rejects")
    stats = run_available(spark, str(tmp_path / "landing"), co, str(tmp_path / "jobs"), str(tmp_path / "checkpoint"), rejects=rejects)
    assert [r["new_jobs_stored"] for r in stats] == [1]
    assert [r[2:4] for r in _reasons(spark, rejects)] == [("filtered_title", 0)]
