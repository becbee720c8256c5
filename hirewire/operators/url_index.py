"""K3/I2 at scale: an index of the stored URLs, so that a batch opens only the files that may hold its URLs.

Beside the jobs table (``<target>/_url_index``) every appended batch leaves a segment:

    keys/segment=<name>/slot=<n>/   its URLs (url, batch_id), dealt to 2^k slots by the low bits of their hash
    words/segment=<name>/           its Bloom filter: 2^m words of 64 bits (word, bits, size, slots); a URL sets
                                    ``PROBES`` bits of the one word that the low bits of its hash name
    versions/<number>               which segments count (see ``versions``)

A batch's URLs meet the words in an equi-join on (size, word), a few bytes for each stored URL; only slots in which some
URL has all its bits set are opened, and there the URLs themselves are compared, so the result is exact. Segments
appear and go by the version alone: a failed or repeated attempt leaves files that no version names. ``compact`` merges small segments, which bounds how many filters a URL meets.
"""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewire.operators.versions import VersionLog
from hirewire.session import write_shared

PROBES = 6  # bits that a URL sets, of the 64 in its word
BITS_PER_KEY = 32  # with these, about one in 5,000 absent URLs looks present in a segment
KEYS_PER_FILE = 1 << 20


@dataclass(frozen=True)
class Segment:
    name: str
    keys: int
    words: int
    slots: int
    batches: list[str] = field(default_factory=list)


def _power(n: float) -> int:
    """The least power of two that isn't below ``n``."""
    return 1 << max(0, int(-(-n // 1)) - 1).bit_length()


def _hash(url: Column) -> Column:
    return F.xxhash64(url)


def _mask(url: Column) -> Column:
    """The bits that a URL sets in its word: six bits of a second hash name each of them."""
    h = F.xxhash64(url, F.lit("probe"))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(PROBES)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


class UrlIndex:
    """The index of one jobs table. All methods read the newest version first, so several sessions can share it."""

    def __init__(self, spark: SparkSession, target: str, keys_per_file: int = KEYS_PER_FILE, bits_per_key: int = BITS_PER_KEY,
                 exclude_batch: str | None = None):
        self.spark, self.target, self.path = spark, target.rstrip("/"), f"{target.rstrip('/')}/_url_index"
        self.keys_per_file, self.bits_per_key, self.exclude_batch = keys_per_file, bits_per_key, exclude_batch
        self.log = VersionLog(spark, f"{self.path}/versions")

    def _version(self) -> tuple[int, list[Segment]]:
        number, segments = self.log.newest([])
        return number, [Segment(**s) for s in segments]

    def segments(self) -> list[Segment]:
        return self._version()[1]

    def _commit(self, number: int, segments: list[Segment]) -> None:
        self.log.commit(number, [asdict(s) for s in segments])

    # --- writing ------------------------------------------------------------------------

    def _write(self, keys: DataFrame) -> list[Segment]:
        """One segment for each value of ``segment`` in ``keys`` (url, batch_id, segment); rows without a URL don't count."""
        keys = write_shared(self.spark, keys.where(F.col("url").isNotNull()).distinct(), "index-keys")
        found = keys.groupBy("segment").agg(F.countDistinct("url").alias("n"), F.sort_array(F.collect_set("batch_id")).alias("b")).collect()
        segments = [Segment(r["segment"], r["n"], _power(r["n"] * self.bits_per_key / 64), 1, r["b"]) for r in found]
        segments = [Segment(s.name, s.keys, s.words, min(s.words, _power(s.keys / self.keys_per_file)), s.batches) for s in segments]
        segments.sort(key=lambda s: s.batches[0])
        if not segments:
            return []
        sizes = self.spark.createDataFrame([(s.name, s.words, s.slots) for s in segments], "segment string, size long, slots long")
        sized = keys.join(F.broadcast(sizes), "segment").withColumn("h", _hash(F.col("url")))
        dealt = sized.withColumn("slot", F.col("h").bitwiseAND(F.col("slots") - 1))
        dealt.repartition("segment", "slot").select("url", "batch_id", "segment", "slot").write.mode("append").partitionBy("segment", "slot").parquet(f"{self.path}/keys")
        words = sized.groupBy("segment", "size", "slots", F.col("h").bitwiseAND(F.col("size") - 1).alias("word")).agg(F.bit_or(_mask(F.col("url"))).alias("bits"))
        words.repartition("segment").write.mode("append").partitionBy("segment").parquet(f"{self.path}/words")
        return segments

    def add(self, rows: DataFrame) -> None:
        """Index the rows (url, batch_id) of appended batches, each as a segment. A batch that has a segment of its own
        already (a replay) gets a new one in its place; one that was merged with others is left as it is."""
        number, have = self._version()
        merged = {b for s in have if len(s.batches) > 1 for b in s.batches}
        tag = uuid.uuid4().hex[:8]
        rows = rows.select("url", "batch_id")
        if merged:
            rows = rows.where(~F.col("batch_id").isin(*merged))
        new = self._write(rows.withColumn("segment", F.concat(F.substring(F.sha2("batch_id", 256), 1, 16), F.lit(f"-{tag}"))))
        mine = {b for s in new for b in s.batches}
        self._commit(number, [s for s in have if len(s.batches) > 1 or not mine & set(s.batches)] + new)

    def sync(self, exclude: str | None = None) -> None:
        """Index the target's batches that no segment has: a table that is older than its index, or a batch whose run died
        between its write and its indexing."""
        from hirewire.operators import sink as SK

        have = {b for s in self.segments() for b in s.batches}
        there = {unquote(n.split("=", 1)[1]) for n in self.log.names(self.target) if n.startswith("batch_id=")}
        there |= {b for batches in SK.merged_log(self.spark, self.target).newest({})[1].values() for b in batches}
        missing = sorted(b for b in there if b not in have and b != exclude)
        if missing:
            stored = SK.read_target(self.spark, self.target, "url string, batch_id string")
            self.add(stored.where(F.col("batch_id").isin(*missing)))

    def compact(self, keep_last: int = 24, most_keys: int | None = None) -> None:
        """Merge all segments but the newest ``keep_last`` and those of over ``most_keys`` URLs (64 files' worth unless given)
        into one. Readers keep the version they have read; ``vacuum`` removes what no version names."""
        number, have = self._version()
        limit = 64 * self.keys_per_file if most_keys is None else most_keys
        small = [s for s in have[:len(have) - keep_last] if s.keys <= limit] if keep_last else [s for s in have if s.keys <= limit]
        if len(small) < 2:
            return
        merged = self._write(self._keys([s.name for s in small]).withColumn("segment", F.lit(f"merged-{uuid.uuid4().hex[:12]}")))
        gone = {s.name for s in small}
        self._commit(number, merged + [s for s in have if s.name not in gone])

    def vacuum(self, keep_versions: int = 10) -> list[str]:
        """Remove segments that none of the newest ``keep_versions`` versions names; returns their names. Not to be called
        while a writer that hasn't committed yet is at work."""
        named = {s["name"] for v in self.log.numbers()[-keep_versions:] for s in self.log.at(v)}
        there = {n.split("=", 1)[1] for kind in ("keys", "words") for n in self.log.names(f"{self.path}/{kind}") if n.startswith("segment=")}
        for name in there - named:
            for kind in ("keys", "words"):
                self.log.delete(f"{self.path}/{kind}/segment={name}")
        return sorted(there - named)

    # --- reading ------------------------------------------------------------------------

    def _keys(self, names: list[str]) -> DataFrame:
        paths = [f"{self.path}/keys/segment={n}" for n in names]
        return self.spark.read.schema("url string, batch_id string").option("recursiveFileLookup", True).parquet(*paths)

    def maybe_stored(self, urls: DataFrame) -> DataFrame:
        """(url, segment, slot) for the rows of ``urls`` (url) whose bits are all set in the filter of a segment. All that
        is read of the index is its words."""
        live = self.segments()
        sizes = sorted({s.words for s in live})
        h = F.col("h")
        cand = urls.where(F.col("url").isNotNull()).select("url", _hash(F.col("url")).alias("h"), _mask(F.col("url")).alias("mask"))
        asked = cand.select("url", "h", "mask", F.explode(F.array(*[F.lit(n).cast("long") for n in sizes])).alias("size"))
        asked = asked.withColumn("word", h.bitwiseAND(F.col("size") - 1))
        words = self.spark.read.schema("size long, slots long, word long, bits long, segment string").parquet(f"{self.path}/words") \
            .where(F.col("segment").isin(*[s.name for s in live]))
        hit = words.join(asked, ["size", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
        return hit.select("url", "segment", h.bitwiseAND(F.col("slots") - 1).alias("slot"))

    def files_for(self, urls: DataFrame) -> list[tuple[str, int]]:
        """The (segment, slot) folders that may hold one of the URLs: a list of files, not of URLs."""
        if not self.segments():
            return []
        return sorted(tuple(r) for r in self.maybe_stored(urls).select("segment", "slot").distinct().collect())

    def new_only(self, batch: DataFrame, key: str = "url") -> DataFrame:
        """K3: the rows of ``batch`` whose key isn't stored (by a batch other than ``exclude_batch``). Rows without a key
        stay. Only folders that may hold one of the batch's URLs are opened."""
        folders = self.files_for(batch.select(F.col(key).alias("url")).distinct())
        if not folders:
            return batch
        stored = self.spark.read.schema("url string, batch_id string") \
            .parquet(*[f"{self.path}/keys/segment={name}/slot={slot}" for name, slot in folders])
        if self.exclude_batch is not None:
            stored = stored.where(F.col("batch_id") != F.lit(self.exclude_batch))
        return batch.join(stored.select(F.col("url").alias(key)), key, "left_anti")
