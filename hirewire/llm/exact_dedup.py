"""Exact duplicates of whole texts, with frequent texts split off (heavy hitters).

Texts become SHA-256 digests in the scan; only digests, ids and row numbers move. Each partition keeps a
Misra-Gries summary of at most ``counters`` digests. The summaries' counters, added up by digest, fall short of the
true counts by at most n / (counters + 1) of n rows, so every digest of more than 2 n / (counters + 1) rows has a sum above
n / (counters + 1), and fewer than ``counters + 1`` digests can: the candidates are bounded whatever the input. Their groups
are counted exactly, and the winners of those that are verified as frequent are broadcast, so that their rows are judged where
they are. The other digests, none of which has more rows than that, are grouped by an ordinary shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirewire.llm.common import free_name, written

#: Counters of a summary: at most as many digests are broadcast, and no key of the shuffle holds more than 2 in 1,025 rows.
COUNTERS = 1024


class Summary:
    """A Misra-Gries summary of values, merged batch by batch: what is counted falls short by at most
    n / (counters + 1), and at most ``counters`` values are held."""

    def __init__(self, counters: int):
        self.counters, self.count = counters, {}

    def add(self, values: list, counts: np.ndarray) -> None:
        """``values`` are distinct; ``counts`` says how often each of them came."""
        if len(values) > self.counters:  # of a large batch, only what can outlast the cut is looked at one by one
            counts = counts - np.partition(counts, -self.counters - 1)[-self.counters - 1]
            keep = np.flatnonzero(counts > 0)
            values, counts = [values[i] for i in keep], counts[keep]
        for v, n in zip(values, counts.tolist()):
            self.count[v] = self.count.get(v, 0) + n
        if len(self.count) > self.counters:
            least = sorted(self.count.values(), reverse=True)[self.counters]
            self.count = {v: n - least for v, n in self.count.items() if n > least}


def _summaries(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(counters)
        for batch in batches:
            seen = batch.column(0).value_counts()
            summary.add(seen.field(0).to_pylist(), seen.field(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(list(summary.count), pa.binary()), pa.array(list(summary.count.values()), pa.int64())],
                                         ["digest", "n"])
    return run


def candidates(marks: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(digest): fewer than ``counters + 1`` digests, among them all of more than 2 n / (counters + 1) of the n rows."""
    least = marks.count() / (counters + 1)
    parts = marks.select("digest").mapInArrow(_summaries(counters), "digest binary, n long")
    return parts.groupBy("digest").agg(F.sum("n").alias("n")).where(F.col("n") > F.lit(least)).select("digest")


def _rank(largest: bool) -> Column:
    """What the row that stays has most of: an id, then the largest (or smallest) id, then the first place in the table."""
    return F.struct(F.col("id").isNotNull().alias("has"), (F.col("id") if largest else -F.col("id")).alias("by"), (-F.col("row")).alias("at"), "id", "row")


def groups(marks: DataFrame, largest: bool = True, counters: int = COUNTERS) -> DataFrame:
    """Rows of ``marks`` (row, id, digest) with ``keep_id``, ``keep_row`` and ``group_size`` of their digest's group."""
    totals = [F.count(F.lit(1)).alias("group_size"), F.max(_rank(largest)).alias("best")]
    heavy = written(candidates(marks, counters), "frequent-digests")
    # Verified: counted over all rows, one row for each digest and input partition before the shuffle
    verified = marks.join(F.broadcast(heavy), "digest", "left_semi").groupBy("digest").agg(*totals).where("group_size > 1")
    winners = written(verified.select("digest", "group_size", F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row")), "frequent-winners")
    cols = ["row", "id", "digest", "group_size", "keep_id", "keep_row"]
    frequent = marks.join(F.broadcast(winners), "digest").select(*cols)
    rest = marks.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    own = Window.partitionBy("digest")
    best = F.max(_rank(largest)).over(own)
    rest = rest.select("row", "id", "digest", F.count(F.lit(1)).over(own).alias("group_size"), best.alias("best"))
    return frequent.unionByName(rest.withColumn("keep_id", F.col("best.id")).withColumn("keep_row", F.col("best.row")).select(*cols))


def digest_of(text: Column, normalize: Callable[[Column], Column] | None = None) -> Column:
    """SHA-256 of the normalised text in UTF-8; null counts as empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.unhex(F.sha2((normalize(text) if normalize else text).cast("binary"), 256))


def _marks(df: DataFrame, id_col: str, text_col: str, normalize, name: str) -> DataFrame:
    return df.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"),
                     digest_of(F.col(f"`{text_col}`"), normalize).alias("digest")).transform(lambda d: written(d, name))


def duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalize: Callable[[Column], Column] | None = None,
               keep: str = "largest", counters: int = COUNTERS) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256): one row for each row of ``df``, dropped ones too.

    Texts are equal when they are identical after ``normalize`` (a function of a column; no change if None). Of equal
    texts the row with the ``largest`` (or ``smallest``) id stays; integer ids are taken. Null texts are empty ones; a
    null id stays only where the group has no other; of repeated rows with the id that stays the first one of the table
    stays, so each group keeps exactly one row; very long texts are hashed whole; an empty table gives no rows; other
    columns are not read, so names can't clash."""
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    grouped = groups(_marks(df, id_col, text_col, normalize, "digests"), keep == "largest", counters)
    return grouped.select(F.col("id").alias(id_col), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                          F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalize: Callable[[Column], Column] | None = None,
             keep: str = "largest", counters: int = COUNTERS) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns; cases as in ``duplicates``. The table is written once with its
    row numbers, so that the numbers stay the same when a lost executor's part is computed again."""
    row, digest = free_name(df, "_row"), free_name(df, "_digest")
    numbered = df.withColumn(row, F.monotonically_increasing_id()).withColumn(digest, digest_of(F.col(f"`{text_col}`"), normalize))
    numbered = written(numbered, "numbered")
    marks = numbered.select(F.col(row).alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(digest).alias("digest"))
    stay = groups(marks, keep == "largest", counters).where("row = keep_row").select(F.col("row").alias(row))
    return numbered.join(stay, row, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
