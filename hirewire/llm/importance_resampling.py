"""Target-distribution importance resampling over hashed n-grams.

Words are cut by one byte table, which lower-cases A-Z and blanks separators, and ``bytes.split``; an n-gram's bucket is
the CRC-32 of its UTF-8 bytes, each longer n-gram going on from the checksum of the one before; Counters reduce. From
the counts of all documents and of the target texts each bucket gets a gain (the scaled log ratio of its smoothed
shares), a document's weight is the mean gain of its features, and Gumbel noise drawn from a hash of its id turns the
weights into a draw without replacement: the highest scores.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirewire.llm.common import small_batches, written

#: Separators become blanks, A-Z become a-z; digits, letters and all bytes of longer characters stay.
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
BLOCK = 1 << 20  # bytes of a text that are split at once
SCALE = 1000


@dataclass(frozen=True)
class Features:
    """Runs of 1 to ``longest`` words, dealt to ``buckets``."""
    longest: int = 1
    buckets: int = 10_000


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists of bounded size; a word is never cut."""
    text = text.translate(TABLE)
    start = 0
    while start < len(text):
        end = start + BLOCK
        if end < len(text):
            end = text.find(b" ", end)
            end = len(text) if end < 0 else end
        words = text[start:end].split()
        start = end
        if words:
            yield words


def checksums(text: bytes | None, longest: int) -> Iterator[list[int]]:
    """CRC-32 of each run of 1 to ``longest`` words, joined by one space, in lists of bounded size. A checksum of n
    words is the seed of that of n + 1."""
    before: list[bytes] = []
    for words in word_blocks(text or b""):
        new, words = len(words), before + words
        level = list(map(crc32, words))
        yield level[len(words) - new:]
        if longest > 1:
            spaced = [b" " + w for w in words]
            for n in range(1, longest):
                level = list(map(crc32, spaced[n:], level))  # level[i]: the run of n + 1 words from word i on
                yield level[max(0, len(words) - new - n):]  # runs that end in this block
            before = words[1 - longest:]


def bucket_counts(df: DataFrame, text_col: str, features: Features) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket; at most one row for each bucket and
    partition is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(features.buckets, np.int64)
        for batch in batches:
            found: Counter = Counter()
            for text in batch.column(0):
                for level in checksums(text.as_py(), features.longest):
                    found.update(level)
                if len(found) > BLOCK:
                    _into(total, found)
            _into(total, found)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    small_batches(df.sparkSession)
    texts = df.select(F.col(f"`{text_col}`").cast("string").cast("binary").alias("text")).where("text is not null")
    return texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _into(total: np.ndarray, found: Counter) -> None:
    if found:
        at = np.fromiter(found, np.int64, len(found)) % len(total)
        total += np.bincount(at, np.fromiter(found.values(), np.int64, len(found)), len(total)).astype(np.int64)
        found.clear()


def train(df: DataFrame, target: DataFrame, features: Features = Features(), text_col: str = "text", target_col: str = "text") -> list[int]:
    """The gain of each bucket: floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))), from the counts s and t of
    the bucket and S and T of all features in ``df`` and ``target``. Two numbers for each bucket reach the driver."""
    n = features.buckets
    sides = []
    for frame, col in ((df, text_col), (target, target_col)):
        counts = [0] * n
        for r in bucket_counts(frame, col, features).collect():
            counts[r["bucket"]] = r["n"]
        sides.append((counts, sum(counts)))
    (source, all_source), (goal, all_goal) = sides
    return [math.floor(SCALE * math.log(float(t + 1) * float(all_source + n) / (float(s + 1) * float(all_goal + n)))) for s, t in zip(source, goal)]


def noise(seed: int, doc_id) -> int:
    """Scaled standard Gumbel noise, fixed by the seed and the id (a null id counts as an empty text)."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(df: DataFrame, gains: list[int], features: Features = Features(), seed: int = 2024, least_words: int = 20,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_features, weight, score, eligible) of every row; the gains, one number for each bucket, go with the task."""
    small_batches(df.sparkSession)
    gain = np.array(gains, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n = total = words = 0
                for k, level in enumerate(checksums(text.as_py(), features.longest)):
                    at = np.fromiter(level, np.int64, len(level)) % features.buckets
                    n, total = n + len(level), total + int(gain[at].sum())
                    words += len(level) if k % features.longest == 0 else 0
                weight = total // n if n else 0
                rows.append((key, n, weight, weight + noise(seed, key), words >= least_words))
            cols = list(zip(*rows)) or [()] * 5
            kinds = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["id", "n_features", "weight", "score", "eligible"])

    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_features long, weight long, score long, eligible boolean")


def draw(scored: DataFrame, fraction_percent: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... down the scores (ties: smaller id) of the floor(percent N / 100) drawn of the
    N eligible rows, null for the others.

    Scores are integers within some ten thousands, so their histogram finds the score down to which rows may be drawn.
    Those rows are range-sorted; a rank is a row's place in its part and the rows of the parts before. Rows with the same
    score and id are told apart by a row number, so that no run of them need stay in one part."""
    spark = scored.sparkSession
    scored = written(scored.withColumn("row", F.monotonically_increasing_id()), "resampling-scores")
    histogram = sorted(((r["score"], r["n"]) for r in scored.where("eligible").groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    drawn = fraction_percent * sum(n for _, n in histogram) // 100
    least, above = None, 0
    for value, n in histogram:
        if above >= drawn:
            break
        least, above = value, above + n
    if not drawn:
        return scored.withColumn("rank", F.lit(None).cast("long")).drop("row")
    may = F.col("eligible") & (F.col("score") >= least)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = scored.where(may).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = written(ranged.withColumn("place", F.monotonically_increasing_id()), "resampling-order")
    part, place = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    before, so_far = {}, 0
    for r in ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():
        before[r["part"]] = so_far
        so_far += r["n"]
    starts = spark.createDataFrame(list(before.items()), "part long, before long")
    ranked = ranged.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("rank", F.col("before") + place + 1)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).select(*scored.columns, "rank")
    others = scored.where(~may).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(others).drop("row")


def resample(df: DataFrame, target: DataFrame, fraction_percent: int = 10, least_words: int = 20, seed: int = 2024, features: Features = Features(),
             id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """(id, n_features, weight, score, rank) of every row of ``df``; drawn rows have a rank.

    Null, empty and wordless texts have no features and weight 0; very long texts are read whole, a block at a time; a
    null id takes the noise of an empty one and comes last among ties; repeated rows are drawn each for itself; an empty
    ``df`` gives no rows and an empty ``target`` counts as one without features; other columns are not read."""
    gains = train(df, target, features, text_col, target_col)
    ranked = draw(scores(df, gains, features, seed, least_words, id_col, text_col), fraction_percent)
    return ranked.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
