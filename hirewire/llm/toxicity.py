"""Toxicity by a linear-chain conditional random field over tokens.

Tokens are tagged clean or toxic. A token's score is a sum of weights of its word and its character n-grams;
transitions and starts have weights of their own. Forward-backward gives each token's marginal; a document's
score comes from its marginals by a logistic layer, and the tokens with a marginal over one half are its
offending offsets. Labels of documents become labels of tokens first: in a toxic document the tokens with a
feature that toxic documents have significantly more often are toxic, all others are clean.

Training runs on a bounded sample of labelled rows (``max_rows`` of each class with at most ``max_chars``
characters); everything else covers all documents and whole texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirewire.llm.common import held, small_batches, written

TOKEN = re.compile(r"[^\W\d_]+")
BITS = 18  # features are hashed to 2^18 weights, which bounds the model
NGRAMS = (3, 4, 5)
LANE = 512  # tokens of a lane, see ``marginals``
FORGET = 1e-12
LAYER = 5  # inputs of the logistic layer
CACHE_SIZE = 200_000  # emissions that a worker keeps


def features(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of tokens without their case, as (feature, number of its token): the word, and the character
    n-grams of the word with its ends marked. All tokens are hashed together."""
    marked = [f"^{t.lower()}$" for t in tokens]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    owner = np.repeat(np.arange(len(marked)), sizes)
    chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    found = [np.fromiter((zlib.crc32(m.encode("utf-8", "surrogatepass")) for m in marked), np.uint64, len(marked)) & np.uint64((1 << BITS) - 1)]
    owners = [np.arange(len(marked))]
    for n in NGRAMS:
        last = len(chars) - n + 1
        if last <= 0:
            continue
        h = np.full(last, n, np.uint64)
        for k in range(n):
            h = (h ^ chars[k:k + last]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        whole = owner[:last] == owner[n - 1:]
        found.append((h >> np.uint64(64 - BITS))[whole])
        owners.append(owner[:last][whole])
    return np.concatenate(found).astype(np.int64), np.concatenate(owners)


def marginals(emission: np.ndarray, starts: np.ndarray, trans: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of the toxic tag before and after each token: (forward, backward).

    ``emission``: log-odds of each token of some sequences laid end to end; ``starts``: where they begin;
    ``trans[i, j]``: log-weight of a step from tag i to j (0 clean, 1 toxic). Tokens are cut into lanes that
    run side by side; a lane begins early enough that its first message is forgotten: a step shrinks the
    distance of two messages by tanh(|d| / 4), d being the log-odds ratio of the transitions, whatever the
    tokens, so the result is exact to ``FORGET``."""
    n = len(emission)
    if not n:
        return np.zeros(0), np.zeros(0)
    first = np.zeros(n + 1, bool)
    first[starts[starts < n]] = True
    first[n] = True
    shrink = np.tanh(abs(trans[0, 0] + trans[1, 1] - trans[0, 1] - trans[1, 0]) / 4)
    early = 2 if shrink < 1e-6 else int(np.ceil(np.log(FORGET) / np.log(min(shrink, 0.999)))) + 2
    a = np.exp(trans)
    e = np.clip(emission, -30, 30)
    lanes = -(-n // LANE)
    begin = np.arange(lanes) * LANE

    def sweep(odds: np.ndarray, reset: np.ndarray, a00, a01, a10, a11, at_reset: float, after: bool) -> np.ndarray:
        """log odds m[t]: at a reset at_reset, else from m[t-1]; with ``after`` the token's own odds come last."""
        out = np.empty(n)
        m = np.ones(lanes)
        for k in range(-early, LANE):
            t = begin + k
            live = (t >= 0) & (t < n)
            i = np.where(live, t, 0)
            if after:
                step = (a01 + a11 * m) / (a00 + a10 * m)
                m = np.where(reset[i], at_reset, step) * odds[i]
            else:
                prev = m * odds[np.maximum(i - 1, 0)]
                m = np.where(reset[i], at_reset, (a10 + a11 * prev) / (a00 + a01 * prev))
            m = np.clip(m, 1e-40, 1e40)
            if k >= 0:
                out[t[live]] = m[live]
        return out

    odds = np.exp(e)
    forward = sweep(odds, first[:n], a[0, 0], a[0, 1], a[1, 0], a[1, 1], float(np.exp(start)), True)
    back = sweep(odds[::-1], first[1:][::-1], a[0, 0], a[0, 1], a[1, 0], a[1, 1], 1.0, False)[::-1]
    return np.log(forward), np.log(back)


@dataclass
class Crf:
    """Weights of the field and of the logistic layer. Untrained (no toxic or no clean labels): every score is
    the share of toxic labels, or 0 without any."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: float = 0.0
    layer: np.ndarray = field(default_factory=lambda: np.zeros(LAYER))
    constant: float | None = 0.0

    def emissions(self, tokens: list[str]) -> np.ndarray:
        at, owner = features(tokens)
        return np.bincount(owner, weights=self.weights[at], minlength=len(tokens))

    def tagged(self, token_lists: list[list[str]], known: dict[str, float]) -> list[np.ndarray]:
        """Marginal probabilities of the toxic tag of each token. ``known``: emissions kept between batches, which
        start anew when there are many."""
        if len(known) > CACHE_SIZE:
            known.clear()
        lengths = np.fromiter(map(len, token_lists), np.int64, len(token_lists))
        new = list({t for ts in token_lists for t in ts if t not in known})
        known.update(zip(new, self.emissions(new).tolist()))
        emission = np.fromiter((x for ts in token_lists for x in map(known.__getitem__, ts)), np.float64, int(lengths.sum()))
        return self._split(emission, lengths)

    def marked(self, ids: list[np.ndarray], emission: np.ndarray) -> list[np.ndarray]:
        """``tagged`` for documents of word numbers, with the emission of each word."""
        return self._split(emission[np.concatenate(ids)] if ids else np.zeros(0), np.array([len(d) for d in ids], np.int64))

    def _split(self, emission: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        ends = np.cumsum(lengths)
        forward, back = marginals(emission, ends - lengths, self.trans, self.start)
        p = 1 / (1 + np.exp(-np.clip(forward + back, -60, 60)))
        return np.split(p, ends[:-1]) if len(ends) else []

    def score(self, p: list[np.ndarray]) -> np.ndarray:
        """Document scores from marginals; a text without tokens counts as one clean token."""
        if self.constant is not None:
            return np.full(len(p), self.constant)
        z = np.array([layer_input(x) for x in p]).reshape(-1, LAYER) @ self.layer
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def layer_input(p: np.ndarray) -> list[float]:
    """What the logistic layer sees of a document: its most toxic token, how many toxic tokens are expected in it,
    for how sure ones too, and its length."""
    top = float(p.max()) if len(p) else 0.0
    return [1.0, float(np.clip(np.log((top + 1e-5) / (1 - top + 1e-5)), -6, 6)) / 3, float(np.log1p(p[p > 0.02].sum())),
            float(np.log1p(p[p > 0.5].sum())), float(np.log1p(len(p))) / 6]


WORDS_AT_ONCE = 20_000  # words of the sample whose features are looked at together, which bounds a fit's memory


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(flat, edges): the features of word i are flat[edges[i]:edges[i + 1]]."""
    flat, sizes = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
    for i in range(0, len(words), WORDS_AT_ONCE):
        block = words[i:i + WORDS_AT_ONCE]
        at, owner = features(block)
        flat.append(at[np.argsort(owner, kind="stable")].astype(np.int32))
        sizes.append(np.bincount(owner, minlength=len(block)))
    return np.concatenate(flat), np.cumsum(np.concatenate(sizes))


def word_blocks(edges: np.ndarray) -> Iterator[tuple[int, int]]:
    n = len(edges) - 1
    return ((lo, min(lo + WORDS_AT_ONCE, n)) for lo in range(0, n, WORDS_AT_ONCE))


def word_sums(weights: np.ndarray, flat: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The sum of each word's feature weights."""
    out = np.zeros(len(edges) - 1)
    for lo, hi in word_blocks(edges):
        out[lo:hi] = np.add.reduceat(weights[flat[edges[lo]:edges[hi]]], edges[lo:hi] - edges[lo])
    return out


def feature_sums(by_word: np.ndarray, flat: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """For each feature the sum over the words that have it."""
    out = np.zeros(1 << BITS)
    for lo, hi in word_blocks(edges):
        out += np.bincount(flat[edges[lo]:edges[hi]], weights=np.repeat(by_word[lo:hi], np.diff(edges[lo:hi + 1])), minlength=1 << BITS)
    return out


def fit(texts: list[str], labels: list[int], prior: float | None = None, folds: int = 3) -> Crf:
    """Train on labelled texts; runs on one machine, on a sample of bounded size. The logistic layer learns from
    marginals of documents that the field it uses hasn't seen (``folds``), the final field from all. ``prior``:
    the share of toxic labels among all, if the sample's is another."""
    y = np.array(labels)
    share = float(y.mean()) if len(y) else 0.0
    if share in (0.0, 1.0):
        return Crf(constant=share)
    prior = min(max(share if prior is None else prior, 1e-6), 1 - 1e-6)
    index: dict[str, int] = {}
    ids = [np.fromiter((index.setdefault(w, len(index)) for w in TOKEN.findall(t.lower())), np.int64) for t in texts]
    words = list(index)
    del index
    flat, edges = word_features(words)
    model = _field(ids, y, flat, edges)
    if model is None:
        return Crf(constant=prior)
    x = np.zeros((len(y), LAYER))
    for k in range(folds):
        mine = np.arange(len(y)) % folds == k
        part = _field([d for d, m in zip(ids, mine) if not m], y[~mine], flat, edges) or model
        x[mine] = [layer_input(p) for p in part.marked([d for d, m in zip(ids, mine) if m], word_sums(part.weights, flat, edges))]
    w = np.zeros(LAYER)
    w[0] = np.log(share / (1 - share))
    calm = np.diag([1e-3] + [1.0] * (LAYER - 1))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + calm, x.T @ (p - y) + calm @ w)
        w -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    w[0] += np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    model.layer, model.constant = w, None
    return model


def _field(ids: list[np.ndarray], y: np.ndarray, flat: np.ndarray, edges: np.ndarray, min_evidence: float = 16.0,
           min_share: float = 0.3, rounds: int = 32, l2: float = 2e-3) -> Crf | None:
    """The field of documents given as word numbers; ``flat``, ``edges``: features of words. None if no feature tells
    toxic documents from others."""
    share = float(y.mean())
    if share in (0.0, 1.0):
        return None
    # features that toxic documents have significantly more often than their share of documents
    seen = np.zeros((2, 1 << BITS))
    for d, label in zip(ids, y):
        if len(d):
            seen[label, np.unique(np.concatenate([flat[edges[w]:edges[w + 1]] for w in np.unique(d)]))] += 1
    k, n = seen[1], seen.sum(axis=0)
    q = np.clip(k / np.maximum(n, 1), 1e-9, 1 - 1e-9)
    gain = 2 * (k * np.log(q / share) + (n - k) * np.log((1 - q) / (1 - share)))
    telling = (gain >= min_evidence) & (q >= max(min_share, 1.5 * share if share < 0.6 else share))
    toxic_word = word_sums(telling.astype(float), flat, edges) > 0
    lengths = np.array([len(d) for d in ids])
    tokens = np.concatenate(ids) if len(ids) else np.zeros(0, np.int64)
    tag = toxic_word[tokens] & np.repeat(y == 1, lengths)
    if not tag.any():
        return None
    starts = np.cumsum(lengths) - lengths
    model = Crf(constant=None)
    _train_field(model, tokens, tag, starts[lengths > 0], flat, edges, rounds, l2)
    return model


def _train_field(model: Crf, tokens, tag, starts, flat, edges, rounds, l2) -> None:
    """Maximum conditional likelihood by Adam on the whole sample; toxic tokens weigh as their number does."""
    n_words, n = len(edges) - 1, len(tokens)
    w = np.zeros(1 << BITS)
    trans = np.log(np.array([[0.9, 0.1], [0.5, 0.5]]))
    start = -2.0
    follows = np.ones(n, bool)
    follows[starts] = False
    prev = np.flatnonzero(follows) - 1
    nxt = prev + 1
    state = [np.zeros(1 << BITS), np.zeros(1 << BITS), np.zeros((2, 2)), np.zeros((2, 2)), 0.0, 0.0]
    pairs = np.zeros((2, 2))
    for i in (0, 1):
        for j in (0, 1):
            pairs[i, j] = np.sum((tag[prev] == i) & (tag[nxt] == j))
    scale = max(1, int(tag.sum()))
    for r in range(1, rounds + 1):
        emission = word_sums(w, flat, edges)[tokens]
        f, b = marginals(emission, starts, trans, start)
        p = 1 / (1 + np.exp(-np.clip(f + b, -60, 60)))
        by_word = np.bincount(tokens, weights=tag - p, minlength=n_words)
        grad = feature_sums(by_word, flat, edges) / scale - l2 * w
        # expected steps: message before, transition, token and message after
        after = b[nxt] + np.clip(emission[nxt], -30, 30)
        logs = np.stack([trans[i, j] + i * f[prev] + j * after for i in (0, 1) for j in (0, 1)])
        logs -= logs.max(axis=0)
        share = np.exp(logs)
        expected = (share / share.sum(axis=0)).sum(axis=1).reshape(2, 2)
        grad_trans = (pairs - expected) / scale - l2 * trans
        grad_start = float((tag[starts] - p[starts]).sum()) / scale - l2 * start
        for k, (g, value) in enumerate(((grad, w), (grad_trans, trans))):
            m, v = state[2 * k], state[2 * k + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value += 0.15 * (m / (1 - 0.9 ** r)) / (np.sqrt(v / (1 - 0.99 ** r)) + 1e-6)
        state[4] += 0.1 * (grad_start - state[4])
        state[5] += 0.01 * (grad_start ** 2 - state[5])
        start += 0.15 * (state[4] / (1 - 0.9 ** r)) / (np.sqrt(state[5] / (1 - 0.99 ** r)) + 1e-6)
        np.clip(trans, -4, 4, out=trans)
    model.weights, model.trans, model.start = w.astype(np.float32), trans, float(start)


def held_out(id_col) -> object:
    """Rows that are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, max_rows: int = 1200, max_chars: int = 20_000, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic") -> Crf:
    """Fit on at most ``max_rows`` labelled documents of each class (those whose ids have the smallest hashes) of at
    most ``max_chars`` characters, held-out rows left out. That bounds what the driver gets, at any size of the
    tables. They are drawn among the ids that have such a document, so a label without one costs no place. Rows
    without a label, an id or a text aren't learned from; an id with several labels counts as toxic if one of them is."""
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y")))
    prior = known.agg(F.avg("y")).first()[0]
    order = F.xxhash64(F.col("id").cast("string"))
    texts = documents.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    small = texts.where(F.col("text").isNotNull() & (F.length("text") <= max_chars))
    usable = written(known.join(small.select("id").distinct(), "id", "left_semi"), "usable-labels")
    picked = [usable.where(F.col("y") == value).orderBy(order, "id").limit(max_rows) for value in (0, 1)]
    sample = small.join(F.broadcast(picked[0].unionByName(picked[1])), "id").groupBy("id").agg(F.min("text").alias("text"), F.max("y").alias("y"))
    rows = sorted((r["id"], r["text"], r["y"]) for r in sample.collect())  # <= 2 * max_rows texts of max_chars
    return fit([r[1] for r in rows], [r[2] for r in rows], prior)


def score_texts(model: Crf, texts: list[str | None], known: dict[str, float]) -> tuple[np.ndarray, list[np.ndarray]]:
    tokens = [TOKEN.findall(t) if t else [] for t in texts]
    p = model.tagged(tokens, known)
    return model.score(p), p


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                                  T.StructField("p", T.DoubleType())]))


def score_documents(df: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """(id, score, predicted, spans): the score of each whole text, 1 if it reaches ``threshold``, and its offending
    tokens (code points, end exclusive, marginal). Null and empty texts have no tokens and the score of one
    clean token; repeated rows and null ids stay; an empty table gives no rows; other columns are not read.
    The model, of fixed size, is broadcast."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        crf = shared.value
        known: dict[str, float] = {}
        for b in batches:
            texts = b.column(1).to_pylist()
            score, p = score_texts(crf, texts, known)
            spans = [[{"start": m.start(), "end": m.end(), "p": float(q)} for m, q in zip(TOKEN.finditer(t), x) if q > 0.5]
                     if len(x) and x.max() > 0.5 else [] for t, x in zip(texts, p)]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32)),
                                              pa.array(spans, kind)], ["id", "score", "predicted", "spans"])

    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType()), T.StructField("spans", SPANS)])
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def keep_clean(df: DataFrame, model: Crf, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``df`` whose score is below ``threshold``, all columns as they are."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held(None)
        crf = shared.value
        known: dict[str, float] = {}
        for texts in batches:
            yield pd.Series(score_texts(crf, list(texts), known)[0])

    return df.where(score(F.col(f"`{text_col}`").cast("string")) < threshold)
