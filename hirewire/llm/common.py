"""Small helpers of the training-data operators."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from hirewire.session import ensure_checkpoint_dir

#: Rows and bytes in one Arrow batch to a Python worker: whole texts are long, so batches stay small.
ARROW_ROWS, ARROW_BYTES = 512, 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound a Python worker's memory by the rows and bytes of a batch, as whole texts have no bound of their own."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def joined(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Batches put together as soon as they hold ``least`` bytes; the last one may hold less."""
    waiting, size = [], 0
    for b in batches:
        waiting.append(b)
        size += b.nbytes
        if size >= least:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
            waiting, size = [], 0
    if waiting:
        yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()


_HELD: dict[str, object] = {}


def held(name: str | None, make: Callable[[], object] | None = None) -> object:
    """What a Python worker keeps from task to task: one thing at a time. A worker outlives the stages of a pipeline, so
    what an operator holds (a tokenizer with its caches) goes as soon as another operator's task asks for something
    else, or for nothing (None)."""
    if name not in _HELD:
        if _HELD:
            _HELD.clear()
            gc.collect()
        if name is None:
            return None
        _HELD[name] = make()
    return _HELD[name]


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that Spark takes it for, so that workers open the same store."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, so later stages that lose an
    executor read files instead of computing the whole chain again."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` doesn't have (names compare without case)."""
    have = {c.lower() for c in df.columns}
    while wanted.lower() in have:
        wanted = f"_{wanted}"
    return wanted
