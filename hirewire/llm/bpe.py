"""BPE encoding and decoding by dynamic programming over prefixes.

For each prefix of a word there is exactly one token that can end its encoding. A suffix automaton over the
vocabulary lists the tokens that end at each position, longest first; the first one that is compatible with
the token that ends the prefix before it is stored. Following these tokens back from the word's end gives
the ids. Time is linear in the text, also for one word of a million characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirewire.llm.common import held, small_batches
from hirewire.llm.tokens import Cache, Splitting

PAIRS_KEPT = 1_000_000
END = 0xE000  # the last character of a word is shifted by this much, so that word ends are characters of their own


class BpeCodec:
    """Encoder and decoder of one tokenizer file whose model is BPE.

    ``encode``: null and empty texts give no ids; strings of special tokens in a text give their ids.
    ``decode``: unknown ids are left out, special tokens stay; without a decoder in the file the tokens are
    joined by one space, with a byte-level one their bytes are joined."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        self.split = Splitting(path)
        if self.split.kind == "whole":
            raise ValueError(f"{path}: its way of splitting text isn't known")
        model = self.split.spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab = {self._symbols(t): i for t, i in model["vocab"].items()}
        self.rank: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right, whole = (model["vocab"][x] for x in (a, b, a + b))
            self.merge.setdefault((left, right), r)
            if whole not in self.rank:
                self.rank[whole], self.halves[whole] = r, (left, right)
        self.reach: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for symbols, i in vocab.items():
            if self._reachable(i):
                self.automaton.add_word(symbols, (i, len(symbols)))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.added = {t["content"]: t["id"] for t in self.split.spec.get("added_tokens", [])}
        self.token = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.added.items()}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.bytes_of = {c: b for b, c in enumerate(self.split.alphabet)}
        self.byte_level = (self.split.spec.get("decoder") or {}).get("type") == "ByteLevel"
        self.by_word = Cache(self._word)
        self.by_chunk = Cache(lambda c: tuple(i for w in self.split.words(c) for i in self.by_word[w]))

    def _symbols(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix) and token != self.suffix:
            body = token[: -len(self.suffix)]
            return body[:-1] + chr(END + ord(body[-1]))
        return token

    def _reachable(self, token: int) -> bool:
        """Whether merging a token's own characters gives that token; it does if its halves can be reached and
        no earlier merge crosses between them."""
        if token not in self.reach:
            if token not in self.halves:
                self.reach[token] = True
            else:
                a, b = self.halves[token]
                r = self.rank[token]
                self.reach[token] = self._reachable(a) and self._reachable(b) and self._apart(a, b, r, r)
        return self.reach[token]

    def _apart(self, x: int, y: int, until_x: float, until_y: float) -> bool:
        """Whether no merge joins the last part of x to the first part of y before both are whole. Merges are
        undone latest first; x and y stand beside each other until one of them is merged into its parent, and
        of two equal merges the left one comes first."""
        rank, merge, halves = self.rank, self.merge, self.halves
        while True:
            m = merge.get((x, y))
            if m is not None and m < until_x and m <= until_y:
                return False
            rx, ry = rank.get(x, -1), rank.get(y, -1)
            if rx < 0 and ry < 0:
                return True
            if rx > ry:
                until_x, x = rx, halves[x][1]
            else:
                until_y, y = ry, halves[y][0]

    def _compatible(self, x: int, y: int) -> bool:
        known = self.pairs.get((x, y))
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[x, y] = self._apart(x, y, float("inf"), float("inf"))
        return known

    def _word(self, word: str) -> tuple[int, ...]:
        if self.suffix:
            word = word[:-1] + chr(END + ord(word[-1]))
        n = len(word)
        last: list[tuple[int, int] | None] = [None] * (n + 1)  # of each prefix: its last token, and that one's length
        for end, (token, size) in self.automaton.iter(word):
            if last[end + 1] is None:
                start = end + 1 - size
                before = last[start]
                if start == 0 or before is not None and self._compatible(before[0], token):
                    last[end + 1] = (token, size)
        ids = []
        while n:
            token, size = last[n]
            ids.append(token)
            n -= size
        return tuple(reversed(ids))

    def _plain(self, text: str) -> list[int]:
        chunks = self.split.chunks(text) if self.split.kind == "words" else None
        if chunks is None:
            if self.split.kind == "words":
                text = self.split.tokenizer.normalizer.normalize_str(text)
            words = [w for w, _ in self.split.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
            return [i for w in words for i in self.by_word[w]]
        return [i for ids in map(self.by_chunk.__getitem__, chunks) for i in ids]

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.specials is None or not self.specials.search(text):
            return self._plain(text)
        return [i for part in self.specials.split(text) if part
                for i in ([self.added[part]] if part in self.added else self._plain(part))]

    def decode(self, ids) -> str:
        tokens = [self.token[i] for i in ids if i in self.token]
        if not self.byte_level:
            return " ".join(tokens)
        out = bytearray()
        for t in tokens:
            out += t.encode() if t in self.added else bytes(map(self.bytes_of.__getitem__, t))
        return out.decode("utf-8", errors="replace")


def codec(path: str) -> BpeCodec:
    """The codec of a file, which a Python worker holds while its tasks ask for it."""
    return held(f"codec {path}", lambda: BpeCodec(path))


def encode_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of each row's whole text. Null and empty texts: an empty array; repeated rows stay;
    other columns are not read, whatever their names."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            ids = pa.array([c.encode(t) for t in b.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], ["id", "ids"])

    kind = df.schema[id_col].dataType
    out = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(
        run, T.StructType([T.StructField("id", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))]))
    return out.withColumnRenamed("id", id_col)


def decode_documents(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded string) of each row's ids; null and empty arrays: the empty string."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            texts = pa.array([c.decode(ids or ()) for ids in b.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), texts], ["id", "decoded"])

    kind = df.schema[id_col].dataType
    out = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").alias("ids")).mapInArrow(
        run, T.StructType([T.StructField("id", kind), T.StructField("decoded", T.StringType())]))
    return out.withColumnRenamed("id", id_col)


def round_trip_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each whole text in one pass: (id, n_tokens, ids_sha256, decoded_sha256).

    Null and empty texts have no tokens and the digests of the empty string. No shuffle; the memory of a task
    is one batch, the vocabulary and a bounded cache. Only ``path`` goes to the workers, which read the
    vocabulary from their own machine's copy."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            rows = []
            for text in b.column(1).to_pylist():
                ids = c.encode(text)
                rows.append((len(ids), hashlib.sha256(" ".join([str(i) for i in ids]).encode()).hexdigest(),
                             hashlib.sha256(c.decode(ids).encode()).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    out = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, schema)
    return out.withColumnRenamed("id", id_col)
