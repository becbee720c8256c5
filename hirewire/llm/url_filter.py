"""URL filters: rules first, then a multinomial naive Bayes model over the words of host and path.

Host labels and path tokens are split into words by a unigram Viterbi, whose word frequencies come from the
text of all pages. The Bayes model is trained on all pages too: a page whose host has one of the seed words is
a labelled example of a URL to block, every other page one to allow. Both vocabularies keep what makes up
more than a fixed share of all occurrences, so whatever the size of the corpus they have at most one entry
for each such share; that is what may be broadcast.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirewire.llm.common import small_batches, written
from hirewire.llm.tokens import Cache

LONGEST_WORD = 24
#: Words make up at least this share of all words (at most 200,000 words), tokens this one of all URL tokens.
WORD_SHARE, TOKEN_SHARE = 5e-6, 5e-6
# Seed words of hosts to block, by topic.
SEEDS = ("adult", "porn", "xxx", "sex", "escort", "casino", "poker", "slots", "bet", "bets", "betting", "gambling", "lottery",
         "pills", "viagra", "cialis", "spam", "ads", "adserver", "tracker", "malware", "phishing", "warez", "payday", "loans")
PARTS = re.compile(r"[a-z]+|[0-9]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and all its subdomains where the URL's path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parse(url: str | None) -> tuple[str, str]:
    """(host, path): the host follows the first ``://`` and has A-Z lower-cased; null or no ``://``: both empty."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3:]
    cut = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    slash = rest.find("/", 0, cut)
    end = cut if slash < 0 else slash
    return rest[:end].translate(UPPER), rest[end:cut]


class Rules:
    """Rules by host; of those that fit a URL the longest wins (of equally long ones the first by text)."""

    def __init__(self, rules: list[Rule]):
        self.by_host: dict[str, list[Rule]] = {}
        for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
            self.by_host.setdefault(r.host, []).append(r)

    def of(self, host: str, path: str) -> Rule | None:
        labels = host.split(".")
        fit = [r for i in range(len(labels)) for r in self.by_host.get(".".join(labels[i:]), ()) if path.startswith(r.path)]
        return min(fit, key=lambda r: (-len(r.text), r.text), default=None)


@dataclass
class Segmenter:
    """Viterbi over unigram log-probabilities; an unknown word costs more the longer it is."""

    log_p: dict[str, float] = field(default_factory=dict)
    unknown: float = -12.0

    @staticmethod
    def from_counts(counts: dict[str, int], total: int, seeds=SEEDS) -> Segmenter:
        seed_count = max(1, int(total * 1e-5))
        counts = {**counts, **{s: max(counts.get(s, 0), seed_count) for s in seeds}}
        n = max(total, 1)
        return Segmenter({w: math.log(c / n) for w, c in counts.items()}, math.log(1 / n) - 2)

    def words(self, letters: str) -> list[str]:
        best: list[tuple[float, int]] = [(0.0, 0)]
        for end in range(1, len(letters) + 1):
            options = []
            for start in range(max(0, end - LONGEST_WORD), end):
                w = letters[start:end]
                p = self.log_p.get(w)
                options.append((best[start][0] + (self.unknown - 2.3 * len(w) if p is None else p), start))
            best.append(max(options))
        out, end = [], len(letters)
        while end:
            start = best[end][1]
            out.append(letters[start:end])
            end = start
        return out[::-1]


@dataclass
class UrlModel:
    """Segmenter and naive Bayes log-odds (block over allow) of tokens; unseen tokens say nothing."""

    segmenter: Segmenter = field(default_factory=Segmenter)
    seeds: frozenset = frozenset(SEEDS)
    prior: float = -20.0
    odds: dict[str, float] = field(default_factory=dict)

    def __post_init__(self):
        self.cache = Cache(self._words)

    def _words(self, part: str) -> tuple[str, ...]:
        return (f"#{min(len(part), 9)}",) if part[0].isdigit() else tuple(self.segmenter.words(part))

    def words_of(self, text: str) -> list[str]:
        return [w for part in PARTS.findall(text) for w in self.cache[part]]

    def tokens(self, host: str, path: str) -> list[str]:
        """Host words, and path words marked as such; digits count by their number."""
        return self.words_of(host) + [f"/{w}" for w in self.words_of(path.translate(UPPER))]

    def score(self, host: str, path: str) -> float:
        return self.prior + sum(self.odds.get(t, 0.0) for t in self.tokens(host, path))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "cache"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()


def word_counts(pages: DataFrame, text_col: str = "html") -> tuple[dict[str, int], int]:
    """Counts of words (a-z, up to the longest length) in the text outside tags of all pages, those above
    ``WORD_SHARE`` of all of them; and how many there are in all."""
    text = F.regexp_replace(F.lower(F.col(f"`{text_col}`").cast("string")), "<[^>]*>", " ")
    words = pages.select(F.explode(F.split(text, "[^a-z]+")).alias("w")).where((F.length("w") > 1) & (F.length("w") <= LONGEST_WORD))
    counts = written(words.groupBy("w").agg(F.count("*").alias("n")), "word-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = counts.where(F.col("n") >= max(1.0, WORD_SHARE * total))
    return {r["w"]: r["n"] for r in often.collect()}, total  # at most 1 / WORD_SHARE rows


def train(pages: DataFrame, url_col: str = "url", text_col: str = "html", seeds=SEEDS, smoothing: float = 1.0) -> UrlModel:
    """Train on all pages. Null URLs and texts count for nothing; without pages the model allows everything."""
    counts, total = word_counts(pages, text_col)
    model = UrlModel(Segmenter.from_counts(counts, total, seeds), frozenset(seeds))
    shared = pages.sparkSession.sparkContext.broadcast(model)
    small_batches(pages.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        n: Counter = Counter()
        for b in batches:
            for url in b.column(0).to_pylist():
                host, path = parse(url)
                if host:
                    block = not m.seeds.isdisjoint(m.words_of(host))
                    n["", block] += 1
                    n.update((t, block) for t in m.tokens(host, path))
            if len(n) > 200_000:
                yield rows(n)
                n = Counter()
        yield rows(n)

    def rows(n):
        return pa.RecordBatch.from_pydict({"token": pa.array([k[0] for k in n], pa.string()), "block": pa.array([k[1] for k in n], pa.bool_()),
                                           "n": pa.array(list(n.values()), pa.int64())})

    parts = pages.select(F.col(f"`{url_col}`").cast("string").alias("url")).mapInArrow(count, "token string, block boolean, n long")
    by_token = parts.groupBy("token").agg(F.sum(F.when(F.col("block"), F.col("n")).otherwise(0)).alias("block"), F.sum("n").alias("n"))
    sums = {r["whole"]: r for r in by_token.groupBy((F.col("token") == "").alias("whole")).agg(F.sum("block").alias("block"), F.sum("n").alias("n")).collect()}
    if True not in sums or not sums[True]["block"]:
        return model
    urls, all_tokens = sums[True], sums[False]
    kept = by_token.where((F.col("token") != "") & (F.col("n") >= max(1.0, TOKEN_SHARE * all_tokens["n"]))).collect()  # <= 1 / TOKEN_SHARE rows
    n_block, n_allow = all_tokens["block"], all_tokens["n"] - all_tokens["block"]
    base = math.log((n_allow + smoothing * len(kept)) / (n_block + smoothing * len(kept)))
    model.odds = {r["token"]: base + math.log((r["block"] + smoothing) / (r["n"] - r["block"] + smoothing)) for r in kept}
    model.prior = math.log((urls["block"] + 0.5) / (urls["n"] - urls["block"] + 0.5))
    return model


RESULT = [("host", T.StringType()), ("path", T.StringType()), ("rule", T.StringType()), ("verdict", T.StringType()), ("score", T.DoubleType()),
          ("words", T.StringType())]


def judge(pages: DataFrame, rules: list[Rule], model: UrlModel, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, score, words): the verdict is the longest fitting rule's, else ``block`` where
    the model's log-odds are above 0 and ``allow`` where not; ``words`` are the host's, joined by spaces.

    Null URLs and such without ``://`` have empty hosts and paths and are allowed; repeated rows and null ids
    stay; an empty table gives no rows; other columns are not read. One pass without a shuffle."""
    small_batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast((Rules(rules), model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, m = shared.value
        for b in batches:
            rows = []
            for url in b.column(1).to_pylist():
                host, path = parse(url)
                rule, score = known.of(host, path), m.score(host, path) if host else m.prior
                rows.append((host, path, rule and rule.text, rule.verdict if rule else "block" if host and score > 0 else "allow",
                             score, " ".join(m.words_of(host))))
            columns = zip(*rows) if rows else [[]] * len(RESULT)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.float64() if k == "score" else pa.string()) for c, (k, _) in zip(columns, RESULT)]],
                                             ["id", *[k for k, _ in RESULT]])

    schema = T.StructType([T.StructField("id", pages.schema[id_col].dataType), *[T.StructField(k, t) for k, t in RESULT]])
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
