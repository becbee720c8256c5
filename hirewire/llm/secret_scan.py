"""Secret scans: fixed patterns, and character Markov models for strings that no pattern knows.

Two first-order models, one of random strings and one of ordinary identifiers, give each run of token
characters, less what a pattern matched in it, a log-likelihood ratio; runs and parts of runs that are likelier random
are spans of kind ``markov``. The models are
trained from all documents: ordinary are the runs that no pattern matches, random are values that patterns matched
and strings drawn uniformly from the usual key alphabets.
"""

from __future__ import annotations

import random
import re
import string
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirewire.llm.common import free_name, held, small_batches

# The base patterns, each with the length that a match must have.
KINDS = ["assign", "access", "hex", "markov"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_VALUE = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # 18 characters or more; a run is matched whole or not at all
HEX = re.compile(r"[0-9a-f]{16,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")  # every hexadecimal match lies within one of these
LEAST, JOINERS = 16, "+/_=-"  # characters that a span of the models has at least; those that join parts of a run
ANY_RUN = re.compile(r"[A-Za-z0-9+/_=-]{4,}")

#: Letters count without case: capitals are no sign of randomness.
ALPHABET = string.ascii_lowercase + string.digits + "+/_=-"
START = len(ALPHABET)
CODE = {c: i for i, c in enumerate(ALPHABET)} | {c.upper(): i for i, c in enumerate(ALPHABET) if c.isalpha()}
CODES = np.full(256, -1, np.int64)  # by byte; a line break starts a string
CODES[[ord(c) for c in CODE]], CODES[ord("\n")] = list(CODE.values()), START
KEY_ALPHABETS = ["0123456789abcdef", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/",
                 string.ascii_letters + string.digits + "-_", string.ascii_uppercase + "234567"]


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the patterns' matches, leftmost and non-overlapping within a kind; an ``assign``
    match counts if its value is long enough, and is used up either way."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)]
    for run in RUN.finditer(text):
        found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text, run.start(), run.end())]
    return found


def transitions(strings) -> np.ndarray:
    """Counts of steps between characters of each string; other characters are passed over."""
    text = "\n".join(["", *strings]).encode("ascii", "ignore")
    codes = CODES[np.frombuffer(text, np.uint8)]
    codes = codes[codes >= 0]
    last, following = codes[:-1], codes[1:]
    steps = (last * START + following)[following != START]
    return np.bincount(steps, minlength=(START + 1) * START).reshape(START + 1, START).astype(float)


def secret_values(text: str, spans: list[tuple[int, str, int]]) -> list[str]:
    """What the patterns matched, of ``assign`` only the value; overlapping matches once. Values of one kind of
    character, digits or letters, say little and are left out."""
    places = sorted((ASSIGN.match(text, s, e).start(2) if kind == "assign" else s, e) for s, kind, e in spans)
    out, at = [], 0
    for s, e in places:
        if e > at:
            out.append(text[max(s, at):e])
            at = e
    return [v for v in out if not v.isdigit() and not v.isalpha()]


def log_model(counts: np.ndarray, smoothing: float = 0.5) -> np.ndarray:
    return np.log((counts + smoothing) / (counts.sum(axis=1, keepdims=True) + smoothing * START))


def random_samples(n: int = 2000, length: int = 32, seed: int = 7) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choices(a, k=length)) for a in KEY_ALPHABETS for _ in range(n // len(KEY_ALPHABETS))]


def nearest_joints(run: str, s: int, e: int) -> tuple[int, int]:
    """Each end of a part moved to the joining character (or end of the run) nearest to it, outwards if both are as near
    and by the part's length at most; joining characters at the new ends stay outside."""
    low, high = max(0, 2 * s - e), min(len(run), 2 * e - s)
    a = next((i for i in range(s, low, -1) if run[i - 1] in JOINERS), s if low else 0)
    inner = next((i for i in range(s, min(e, 2 * s - a)) if run[i] in JOINERS), None)
    a = a if inner is None else inner
    b = next((i for i in range(e, high) if run[i] in JOINERS), high if high == len(run) else e)
    inner = next((i for i in range(e, max(a, 2 * e - b), -1) if run[i - 1] in JOINERS), None)
    b = b if inner is None else inner
    while a < b and run[a] in JOINERS:
        a += 1
    while b > a and run[b - 1] in JOINERS:
        b -= 1
    return a, b


class MarkovPair:
    """``ratio[last, next]``: log-likelihood of a step under the random model less that under the ordinary one."""

    def __init__(self, random_counts: np.ndarray, ordinary_counts: np.ndarray, min_ratio: float = 12.0,
                 min_per_char: float = 0.35, min_distinct: int = 8):
        self.ratio = (log_model(random_counts) - log_model(ordinary_counts)).tolist()
        self.min_ratio, self.min_per_char, self.min_distinct = min_ratio, min_per_char, min_distinct

    def score(self, run: str) -> float:
        last, total = START, 0.0
        for c in run:
            i = CODE[c]
            total += self.ratio[last][i]
            last = i
        return total

    def varied(self, run: str) -> bool:
        """Some variety and a digit or two cases of letters (a plain word has neither); no part has it if the run hasn't."""
        return len(set(run)) >= self.min_distinct and (any(c.isdigit() for c in run) or run != run.lower() and run != run.upper())

    def is_random(self, run: str) -> bool:
        """Both the whole and the mean step speak for random, and the run is varied."""
        if not self.varied(run):
            return False
        score = self.score(run)
        return score >= self.min_ratio and score >= self.min_per_char * len(run)

    def best_parts(self, run: str) -> list[tuple[int, int]]:
        """The maximal parts of a run by the sum of ratios, each step less ``min_per_char`` (Ruzzo and Tompa): disjoint,
        in order, in linear time."""
        parts: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum after, last part with a smaller sum before
        last, total = START, 0.0
        for at, c in enumerate(run):
            i = CODE[c]
            before, step = total, self.ratio[last][i] - self.min_per_char
            last, total = i, total + step
            if step <= 0:
                continue
            start, k = at, len(parts) - 1
            while True:
                while k >= 0 and parts[k][2] >= before:
                    k = parts[k][4]
                if k < 0 or parts[k][3] >= total:
                    break
                start, before = parts[k][0], parts[k][2]
                del parts[k:]
                k = len(parts) - 1
            parts.append((start, at + 1, before, total, k))
        return [p[:2] for p in parts]

    def random_parts(self, run: str) -> list[tuple[int, int]]:
        """(start, end) of what is random: the whole run, or else its best parts, each end moved to the nearest
        joining character where that is random too."""
        if self.is_random(run):
            return [(0, len(run))]
        if not self.varied(run):
            return []
        out: list[tuple[int, int]] = []
        for s, e in self.best_parts(run):
            if self.score(run[s:e]) < self.min_ratio:
                continue
            for x, y in (nearest_joints(run, s, e), (s, e)):
                if y - x >= LEAST and self.is_random(run[x:y]):
                    if out and x < out[-1][1]:
                        out[-1] = (out[-1][0], max(y, out[-1][1]))
                    else:
                        out.append((x, y))
                    break
        return out


def merged(spans) -> list[tuple[int, int]]:
    """The spans in order, overlapping ones as one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def free_parts(s: int, e: int, taken: list[tuple[int, int]], text: str) -> list[tuple[int, int]]:
    """What the sorted spans ``taken`` leave of a run, without the joining characters beside a span."""
    out, at = [], s
    for a, b in [*((a, b) for a, b in taken if a < e and b > s), (e, e)]:
        end = min(a, e)
        begin = at
        while begin > s and begin < end and text[begin] in JOINERS:
            begin += 1
        while end < e and end > begin and text[end - 1] in JOINERS:
            end -= 1
        if end - begin >= LEAST:
            out.append((begin, end))
        at = max(at, b)
    return out


def all_spans(text: str | None, model: MarkovPair) -> list[tuple[int, str, int]]:
    """Base spans and, in what they leave of each run, what the models call random; by start, then kind."""
    if not text:
        return []
    found = base_spans(text)
    taken, k = merged((s, e) for s, _, e in found), 0
    for m in RUN.finditer(text):
        s, e = m.span()
        while k < len(taken) and taken[k][1] <= s:
            k += 1
        n = bisect_left(taken, (e,))
        for a, b in free_parts(s, e, taken[k:n], text):
            found += [(a + x, "markov", a + y) for x, y in model.random_parts(text[a:b])]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[1])))


def train(df: DataFrame, text_col: str = "text") -> MarkovPair:
    """Train both models on all documents. Workers return counts of steps (at most one row for each pair of
    characters); no text reaches the driver. Without any text the models are those of the random samples and
    a flat one."""
    small_batches(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        rnd, plain = np.zeros((START + 1, START)), np.zeros((START + 1, START))
        for b in batches:
            for text in b.column(0).to_pylist():
                if not text:
                    continue
                spans = base_spans(text)
                if not spans:
                    plain += transitions(ANY_RUN.findall(text))
                    continue
                rnd += transitions(secret_values(text, spans))
                taken, k, ordinary = merged((s, e) for s, _, e in spans), 0, []
                for m in ANY_RUN.finditer(text):
                    while k < len(taken) and taken[k][1] <= m.start():
                        k += 1
                    if k == len(taken) or taken[k][0] >= m.end():
                        ordinary.append(m.group())
                plain += transitions(ordinary)
        for k, counts in enumerate((rnd, plain)):
            at = np.argwhere(counts)
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(at), pa.int32()), pa.array(at[:, 0], pa.int32()),
                                              pa.array(at[:, 1], pa.int32()), pa.array(counts[counts > 0], pa.float64())],
                                             ["model", "last", "next", "n"])

    steps = df.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(count, "model int, last int, next int, n double")
    steps = steps.groupBy("model", "last", "next").agg(F.sum("n").alias("n"))
    counts = np.zeros((2, START + 1, START))
    for r in steps.collect():  # at most 2 * 42 * 41 rows
        counts[r["model"], r["last"], r["next"]] = r["n"]
    return MarkovPair(counts[0] + transitions(random_samples()), counts[1])


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))


def scan(df: DataFrame, model: MarkovPair, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): for each whole text its spans as (kind, start, end), code points, end exclusive, by start and
    then kind. Null and empty texts have none; repeated rows and null ids stay; an empty table gives no rows;
    other columns are not read."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [[{"kind": k, "start": s, "end": e} for s, k, e in all_spans(t, model)] for t in b.column(1).to_pylist()]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, kind)], ["id", "spans"])

    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("spans", SPANS)])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def redacted_text(text: str | None, model: MarkovPair, mark: str) -> str | None:
    spans = sorted((s, e) for s, _, e in all_spans(text, model))
    if not spans:
        return text
    out, at = [], 0
    for s, e in spans:
        if e > at:
            if s >= at:
                out += [text[at:s], mark]
            at = e
    return "".join(out) + text[at:]


def redact(df: DataFrame, model: MarkovPair, text_col: str = "text", length_col: str | None = "n_chars", mark: str = "[secret]") -> DataFrame:
    """``df`` with each secret of ``text_col`` replaced by ``mark`` (overlapping ones by one mark) and
    ``length_col``, if there, set to the new length where the text changed. No row goes; null stays null."""
    small_batches(df.sparkSession)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([redacted_text(t, model, mark) for t in texts], dtype=object)

    old, new = F.col(f"`{text_col}`"), clean(F.col(f"`{text_col}`").cast("string"))
    tmp = free_name(df, "_new_text")
    out = df.select("*", new.alias(tmp))
    changed = ~F.col(tmp).eqNullSafe(old)
    cols = []
    for c in df.columns:
        if c == text_col:
            cols.append(F.col(tmp).alias(c))
        elif c == length_col:
            cols.append(F.when(changed, F.length(tmp).cast(df.schema[c].dataType)).otherwise(F.col(f"`{c}`")).alias(c))
        else:
            cols.append(F.col(f"`{c}`"))
    return out.select(*cols)


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by kind, the digest of the base spans and all spans as one string."""
    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def of(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return scanned.select(id_col, of("assign"), of("access"), of("hex"), of("markov"),
                          F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
