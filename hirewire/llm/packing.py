"""Bulk-synchronous best-fit packing of token pieces into sequences of a fixed length.

Pieces and gaps (the room left in open sequences) are whole numbers up to the sequence length, so the two
range-sorted lists that a sweep matches are run-length coded: a run of pieces is (length, ranks), a run of
gaps is (gap, ranks of sequences). One round takes all pieces of the largest size left, sweeps the gaps from
the smallest that fits (the successor) upwards, deals gaps to pieces in order of rank, which settles who gets
a gap that several want, opens sequences for the rest, updates the gaps and repeats. The result has as many
sequences as best-fit decreasing run piece by piece, whatever the number of rows. Only the count of pieces of each length (at most
one row for each length) reaches the driver; ranks are given and placements are looked up where the rows are.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirewire.llm.common import joined, small_batches, written
from hirewire.llm.tokens import library_encoder

TEXT_BYTES = 4 << 20  # batches of texts are put together to so many, as each of their distinct chunks is looked up once


def cut_lengths(total: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only one longer than ``size`` is cut, and then only the first
    piece may be shorter than ``size``."""
    if total <= size:
        return [(0, total)] if total else []
    first = total % size or size
    return [(0, first), *((s, size) for s in range(first, total, size))]


def pieces_of(df: DataFrame, path: str, end_id: int, size: int, id_col: str = "doc_id", text_col: str = "text",
              keep_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, task, nth[, ids]): the token pieces of each whole text with
    ``end_id`` appended; null texts count as empty. ``nth`` numbers the pieces of a length within the task that
    made them, which is what ranks are built from later without sorting anything."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, task = library_encoder(path), TaskContext.get().partitionId()
        end, seen = np.array([end_id], "<u4").tobytes(), defaultdict(int)
        for b in joined(batches, TEXT_BYTES):
            rows = []
            for doc, ids in zip(b.column(0).to_pylist(), encoder.encode_all(b.column(1))):
                ids += end
                for i, (start, n) in enumerate(cut_lengths(len(ids) // 4, size)):
                    part = ids[4 * start:4 * (start + n)]
                    rows.append((doc, i, start, n, zlib.crc32(part), task, seen[n], part))
                    seen[n] += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows))[:len(kinds)], kinds)], names)

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()] + [pa.binary()] * keep_ids
    names = ["id", "piece", "start", "length", "ids_crc32", "task", "nth"] + ["ids"] * keep_ids
    schema = "id long, piece int, start long, length long, ids_crc32 long, task int, nth long" + ", ids binary" * keep_ids
    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                     F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, schema)


def best_fit_plan(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Rounds of successor sweeps over run-length coded lists: (length, first rank, ranks, first sequence,
    offset) says that the pieces of that length with these ranks go to consecutive sequences at that offset.

    Its length depends on the distinct lengths (at most ``size``), not on the rows."""
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs (first sequence, sequences)
    plan, opened = [], 0

    def fill(length: int, rank: int, first: int, n: int, gap: int, want: int) -> int:
        """Pieces put into ``n`` sequences with that gap. One that took a piece and can take another is the best
        fit for the next piece, so each sequence takes as many as it can before the next one gets any."""
        each = gap // length
        full, rest = divmod(min(want, n * each), each)
        done = 0
        for k in range(each):
            here = full + (k < rest)
            if here:
                plan.append((length, rank + done, here, first, size - gap + k * length))
                done += here
        for at, many, left in ((first, full, gap - each * length), (first + full, int(rest > 0), gap - rest * length),
                               (first + full + (rest > 0), n - full - (rest > 0), gap)):
            if many and left:
                gaps[left].append((at, many))
        return done

    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        rank, left = 0, counts[length]
        for gap in range(length, size):
            runs = gaps.pop(gap, []) if left else []
            for first, n in runs:
                if left:
                    done = fill(length, rank, first, n, gap, left)
                    rank, left = rank + done, left - done
                else:
                    gaps[gap].append((first, n))
        if left:
            n = -(-left // (size // length))
            fill(length, rank, opened, n, size, left)
            opened += n
    return plan


def pack(pieces: DataFrame, size: int) -> DataFrame:
    """``pieces`` (written, see ``pieces_of``) with sequence_id and offset.

    Ranks within a length come from per-task counts: a window over (length, task) counts, never over rows, so
    one length that holds a third of all rows is no hot group. The placement of a rank is found by binary
    search in the plan, whose size is bounded by the sequence length."""
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = counts.select(F.col("length").alias("_l"), F.col("task").alias("_t"), before.alias("_base"))
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= size rows
    plan = sorted(best_fit_plan(total, size))
    lengths = np.array([p[0] for p in plan], np.int64)
    ranks, firsts, offsets = (np.array([p[k] for p in plan], np.int64) for k in (1, 3, 4))
    start_of = np.searchsorted(lengths, np.arange(size + 2))

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(), rank.to_numpy()
        at = np.empty(len(n), np.int64)
        for x in np.unique(n):
            lo, hi = start_of[x], start_of[x + 1]
            mine = n == x
            at[mine] = lo + np.searchsorted(ranks[lo:hi], r[mine], side="right") - 1
        return pd.DataFrame({"sequence_id": firsts[at] + r - ranks[at], "offset": offsets[at]})

    ranked = pieces.join(base, (pieces["length"] == base["_l"]) & (pieces["task"] == base["_t"]))
    put = ranked.withColumn("_put", placed("length", F.col("nth") + F.col("_base")))
    keep = [c for c in pieces.columns if c not in ("task", "nth")]
    return put.select(*keep, "_put.sequence_id", "_put.offset")


def pack_documents(df: DataFrame, path: str, end_id: int, size: int = 1024, id_col: str = "doc_id",
                   text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pack all documents into as few sequences of at most ``size`` tokens as best fit finds: one row for each
    piece: id, piece, start, length, ids_crc32, sequence_id, offset[, ids].

    Null and empty texts are a piece of one token (the end id); null ids, repeated rows and ties are packed
    like any other row; an empty table gives no rows; other columns are not read. The pieces are written to
    the shared folder first: texts are tokenized once, and ranks can't change when a task runs again."""
    out = pack(written(pieces_of(df, path, end_id, size, id_col, text_col, keep_ids), "pieces"), size)
    return out.withColumnRenamed("id", id_col)


def assemble(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids binary): whole sequences from packed pieces that kept their ids. A group is
    one sequence, bounded by its length."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "length")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("n_tokens"))
