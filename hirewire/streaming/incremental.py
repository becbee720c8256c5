"""Incremental runs over landed payloads (I1-I4) with Structured Streaming.

I1: a file-source stream on the ``landing`` directory; ``trigger(availableNow=True)``
    processes whatever has landed since the last run, then stops (the hourly job).
I2: the stored table is the dedup state: each micro-batch anti-joins its URLs against
    the stored ``url`` column, so no unbounded state lives in the stream.
I3: every row is judged by its own ``run_ts`` (not by a watermark: rows without a date
    pass), also when a micro-batch holds several runs or a late one.
I4: a micro-batch writes only its ``batch_id`` partition (dynamic overwrite) and the
    anti-join ignores that partition, so a replayed batch rewrites the same rows. The id
    names the stream by its checkpoint location and the batch by its number: a stream
    started anew with another checkpoint numbers from 0 again, but under its own name.

``dedup_within_watermark`` is the bounded-state alternative (different semantics: it
forgets URLs older than the watermark), offered as a separate operator.
"""

from __future__ import annotations

import hashlib
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewire.sources.landing import LANDING_SCHEMA


def landing_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(LANDING_SCHEMA).option("basePath", landing_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(landing_dir)


def stream_name(checkpoint_location: str) -> str:
    return hashlib.sha256(checkpoint_location.rstrip("/").encode()).hexdigest()[:12]


def as_files(batch: DataFrame, landing_dir: str | None) -> DataFrame:
    """A micro-batch as a table over the files that it consists of. Spark hands a batch on as rows of an RDD, from which neither
    columns nor the partitions of other platforms are pruned, so that each vendor's branch would read all bodies of all vendors,
    in tasks dealt for the whole batch. What goes to the driver is the files' names. A batch that isn't of files is left as it is."""
    names = [r[0] for r in batch.select(F.input_file_name()).distinct().collect()]
    if landing_dir is None or not names or not all(names):
        return batch
    paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(n)) for n in names]  # names are URL-encoded, and a reader's paths are patterns
    return batch.sparkSession.read.schema(LANDING_SCHEMA).option("basePath", landing_dir).parquet(*paths).select(*batch.columns)


def process_batch(companies: DataFrame, target: str, name: str, results: list, rejects: str | None = None, landing_dir: str | None = None):
    """The foreachBatch body: one pipeline run per micro-batch; its stats row joins ``results``. ``landing_dir`` is the folder
    that the stream reads."""
    from hirewire.plans.run import run

    def fn(batch: DataFrame, epoch_id: int) -> None:
        results.append(run(batch.sparkSession, as_files(batch, landing_dir), companies, target, f"{name}-{epoch_id:09d}", raise_on_gates=False,
                           rejects=rejects))
    return fn


def start_incremental(spark: SparkSession, landing_dir: str, companies: DataFrame, target: str, checkpoint_location: str,
                      available_now: bool = True, max_files_per_trigger: int | None = None, results: list | None = None,
                      rejects: str | None = None):
    """Start the stream (``availableNow`` by default) and return the StreamingQuery; ``rejects`` as in ``run``."""
    fn = process_batch(companies, target, stream_name(checkpoint_location), [] if results is None else results, rejects, landing_dir)
    w = (landing_stream(spark, landing_dir, max_files_per_trigger).writeStream.foreachBatch(fn)
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    return w.start()


def run_available(spark: SparkSession, landing_dir: str, companies: DataFrame, target: str, checkpoint_location: str,
                  max_files_per_trigger: int | None = None, rejects: str | None = None) -> list:
    """Process all that has landed and judge the health gates (M4, M5) once, over all batches: a gate that
    raised inside a batch would stop the stream at that batch on every restart."""
    from hirewire.operators.metrics import check_health, total_stats

    results: list = []
    start_incremental(spark, landing_dir, companies, target, checkpoint_location, True, max_files_per_trigger, results, rejects).awaitTermination()
    if results:
        check_health(total_stats(results))
    return results


def dedup_within_watermark(stream: DataFrame, event_time: str = "run_ts", delay: str = "30 days") -> DataFrame:
    """I2 bounded alternative: drop repeated URLs seen within the watermark delay."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["url"])
