"""SimHash near-duplicates: fingerprints of word shingles, linked through BK-trees.

Fingerprints are 64 bits. Distinct ones are dealt to shards so that every link lies in one: of the 64 bits
cut into d + 1 blocks, two fingerprints that differ in at most d bits agree on a whole block, and of the other
bits cut again into d + 1 blocks they agree on one more. A shard is the fingerprints with the same two blocks.
Each shard has a BK-tree, whose children are keyed by their Hamming distance to the parent; a search follows
only edges within the radius of the distance just measured. Trees stay with their shard: broadcasting those
of all shards would send all fingerprints of the corpus to every executor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirewire.llm.common import free_name, held, small_batches, written
from hirewire.llm.components import connected_components

BITS = 64
HASHES_AT_ONCE = 1 << 16  # shingle hashes whose bits are counted together


def fingerprint(text: str | None, words_per_shingle: int, seed: int) -> int:
    """Null, empty and blank texts: 0. Fewer words than a shingle has: the whole sequence is the shingle."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    joined, hash64 = b" ".join(words), xxhash.xxh64_intdigest
    n = len(words) - words_per_shingle + 1
    if n <= 1:
        hashes = np.array([hash64(joined, seed)], np.uint64)
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[:n].tolist()
        hashes = np.fromiter((hash64(joined[i:j], seed) for i, j in zip(starts, ends[words_per_shingle - 1:].tolist())), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), HASHES_AT_ONCE):
        block = hashes[i:i + HASHES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def with_fingerprints(df: DataFrame, name: str, text_col: str = "text", words_per_shingle: int = 3, seed: int = 42) -> DataFrame:
    """``df`` with the signed 64-bit fingerprint of each whole text."""
    small_batches(df.sparkSession)

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        held(None)
        return pd.Series([v - (1 << 64) if (v := fingerprint(t, words_per_shingle, seed)) >> 63 else v for t in texts], dtype="int64")

    return df.withColumn(name, fp(F.col(f"`{text_col}`").cast("string")))


class BKTree:
    """Integers by Hamming distance, in flat lists: node i has ``value[i]`` and children by distance."""

    def __init__(self):
        self.value: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, x: int) -> int:
        self.value.append(x)
        self.children.append({})
        new = len(self.value) - 1
        at = 0
        while at != new:
            d = (self.value[at] ^ x).bit_count()
            at = self.children[at].setdefault(d, new)
        return new

    def within(self, x: int, radius: int) -> list[int]:
        """Indexes of all values at most ``radius`` bits from x."""
        found, todo = [], [0] if self.value else []
        while todo:
            at = todo.pop()
            d = (self.value[at] ^ x).bit_count()
            if d <= radius:
                found.append(at)
            kids = self.children[at]
            if kids:
                if len(kids) <= 2 * radius + 1:
                    todo.extend(k for e, k in kids.items() if d - radius <= e <= d + radius)
                else:
                    todo.extend(kids[e] for e in range(d - radius, d + radius + 1) if e in kids)
        return found


def shard_links(values: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """Links of one shard, without those whose ends other links of the shard join already."""
    tree, parent = BKTree(), list(range(len(values)))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for x in values:
        near = tree.within(x, radius)
        me = tree.add(x)
        for other in near:
            a, b = top(other), top(me)
            if a != b:
                parent[b] = a
                yield tree.value[other], x


def _blocks(bits: list[int], n: int) -> list[list[int]]:
    return [bits[k * len(bits) // n:(k + 1) * len(bits) // n] for k in range(n)]


def shard_keys(fp, radius: int):
    """An array of shard keys of a fingerprint column: one for each choice of a block and, of the bits outside
    it (taken in turn, so that neighbouring bits fall apart), a second block."""
    def mask(bits):
        m = sum(1 << b for b in bits)
        return F.lit(m - (1 << 64) if m >> 63 else m)

    keys, n = [], 0
    for block in _blocks(list(range(BITS)), radius + 1):
        rest = [b for b in range(BITS) if b not in block]
        for k in range(radius + 1):
            keys.append(F.struct(F.lit(n).alias("way"), fp.bitwiseAND(mask(block + rest[k::radius + 1])).alias("bits")))
            n += 1
    return F.array(*keys)


def fingerprint_links(fingerprints: DataFrame, radius: int) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fp``) that differ in at most ``radius`` bits; all
    links are followed, and enough of them returned that the same fingerprints are joined."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, values, out = None, [], []
        for b in batches:
            ways, bits, fps = (b.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            fps = fps.astype(np.int64).view(np.uint64)
            new = np.flatnonzero((ways[1:] != ways[:-1]) | (bits[1:] != bits[:-1])) + 1
            for lo, hi in zip([0, *new.tolist()], [*new.tolist(), len(fps)]):
                if lo == hi:
                    continue
                if (ways[lo], bits[lo]) != key:
                    if len(values) > 1:
                        out.extend(shard_links(values, radius))
                    key, values = (ways[lo], bits[lo]), []
                values.extend(fps[lo:hi].tolist() if hi - lo > 1 else (int(fps[lo]),))
            if len(out) > 50_000:
                yield pairs(out)
                out = []
        if len(values) > 1:
            out.extend(shard_links(values, radius))
        yield pairs(out)

    def pairs(out):
        return pa.RecordBatch.from_arrays([pa.array(np.array([p[k] for p in out], np.uint64).view(np.int64)) for k in (0, 1)], ["a", "b"])

    dealt = fingerprints.select(F.explode(shard_keys(F.col("fp"), radius)).alias("k"), "fp").select("k.way", "k.bits", "fp")
    sorted_ = dealt.repartition("way", "bits").sortWithinPartitions("way", "bits", "fp")
    return sorted_.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(df: DataFrame, words_per_shingle: int = 3, max_bits: int = 2, seed: int = 42, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id): 16 hexadecimal digits, and the smallest id whose document can be reached
    over fingerprints that differ in at most ``max_bits`` bits.

    Null, empty and blank texts have the fingerprint 0 and are linked like any other; rows with a null id get
    their fingerprint and the component's smallest id that isn't null (null if there is none); repeated rows
    stay; an empty table gives no rows; other columns are not read. Documents with one fingerprint are one node
    with their smallest id, found by an aggregation that combines before it shuffles: a group of copies that
    holds a third of all rows becomes one row."""
    rows = df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    marks = written(with_fingerprints(rows, "fp", "_text", words_per_shingle, seed).select("_id", "fp"), "fingerprints")
    of = fingerprint_components(marks.groupBy("fp").agg(F.min("_id").alias("low")), max_bits)
    return marks.join(of, "fp").select(F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                       F.col("low").alias("component_id"))


def fingerprint_components(nodes: DataFrame, max_bits: int) -> DataFrame:
    """(fp, low): for distinct fingerprints with a comparable value ``low`` the least ``low`` of their component."""
    nodes = written(nodes, "simhash-nodes")
    parts = connected_components(fingerprint_links(nodes.select("fp"), max_bits))
    rooted = nodes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("low"))
    return rooted.select("fp", "root").join(lowest, "root").select("fp", "low")


def keep_one(df: DataFrame, words_per_shingle: int = 3, max_bits: int = 2, seed: int = 42, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``df`` without near copies: of each component the row with the smallest id stays (null ids
    come last; of rows with that id, the first one of the table). All columns stay as they are."""
    fp, row = free_name(df, "_fp"), free_name(df, "_row")
    marked = with_fingerprints(df, fp, text_col, words_per_shingle, seed).withColumn(row, F.monotonically_increasing_id())
    marked = written(marked, "fingerprinted")
    first = F.struct(F.col(f"`{id_col}`").isNull().alias("none"), F.col(f"`{id_col}`").alias("id"), F.col(row).alias("row"))
    lows = fingerprint_components(marked.groupBy(F.col(fp).alias("fp")).agg(F.min(first).alias("low")), max_bits)
    stay = lows.select(F.col("low.row").alias(row)).distinct()
    return marked.join(stay, row, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
