"""I2 bounded alternative: URL dedup within a watermark on a file-source stream."""

import datetime as dt

from hirewire.streaming.incremental import dedup_within_watermark


def test_dedup_within_watermark(spark, tmp_path):
    src = tmp_path / "in"
    rows = [(dt.datetime(2024, 1, 1), "u1"), (dt.datetime(2024, 1, 1), "u1"), (dt.datetime(2024, 1, 2), "u2"),
            (dt.datetime(2024, 1, 3), "u1")]
    spark.createDataFrame(rows, "run_ts timestamp, url string").write.parquet(str(src))
    stream = spark.readStream.schema("run_ts timestamp, url string").parquet(str(src))
    q = (dedup_within_watermark(stream, "run_ts", "30 days").writeStream.format("memory")
         .queryName("dedup_wm").option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = sorted(r["url"] for r in spark.sql("SELECT url FROM dedup_wm").collect())
    assert got == ["u1", "u2"]
