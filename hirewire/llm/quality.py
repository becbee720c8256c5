"""Quality rules on DataFrame functions only: counts of one document, and lines that many documents share.

Lines are normalised (case, digits, white space) and hashed; a line that more distinct documents of a host
contain than the limit allows is removed from all of them but its first; documents that this depletes are
rejected. Documents with the same set of lines count as one, so a group of copies doesn't make its own lines
common; near copies with a line of their own count apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirewire.llm.common import free_name, written

# What separates words, and the characters counted as symbols.
SPACES = "[ \\t-\\r]+"
SYMBOLS = "[#*$%&|<>]"
NOT_BLANK = "[^ \\t-\\r]"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 8
SALTS = 16  # parts that the rows of one line are dealt to


@dataclass(frozen=True)
class Limits:
    """``min_words`` and ``repeat_percent``: the base rules. A line is common in a host if more than
    ``line_documents`` distinct documents contain it, however many the host has. A document is depleted if its
    common lines hold more than ``depleted_percent`` of its words."""

    min_words: int = 20
    repeat_percent: int = 30
    line_documents: int = 20
    depleted_percent: int = 80


def words(text: Column) -> Column:
    """Without separators at its ends, a text splits into words and nothing else."""
    inner = F.trim(text, F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACES))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body's lambdas ask for it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def windows(ws: Column) -> Column:
    """Hashes of the windows of ``WINDOW`` words; null for fewer words."""
    def hashed(hs):
        places = F.sequence(F.lit(0), F.size(hs) - WINDOW)
        return F.transform(places, lambda i: F.xxhash64(*[F.get(hs, i + k) for k in range(WINDOW)]))

    return F.when(F.size(ws) >= WINDOW, let(F.transform(ws, lambda w: F.xxhash64(w)), hashed))


def repeat_words(grams: Column) -> Column:
    """Number of words that lie in a window found twice or more, the first one included, from the hashes of all
    windows. Sorted by hash and place, a window is repeated if a neighbour has its hash; each repeated window
    adds the words up to the next one's start."""
    placed = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def same(sorted_, s, k):
        return F.coalesce(F.get(sorted_, k)["h"] == s["h"], F.lit(False))

    def repeated(sorted_):
        marked = F.transform(sorted_, lambda s, k: F.when(same(sorted_, s, k - 1) | same(sorted_, s, k + 1), s["i"]))
        return F.array_sort(F.filter(marked, lambda i: i.isNotNull()))

    def covered(starts):
        steps = F.transform(starts, lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - at, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, s: a + s)

    return let(let(placed, repeated), covered)


def base_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each whole text (null: none);
    columns of these names are replaced. A projection in steps, each intermediate computed once; only texts
    with a repeated window pay for its places."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    t, w, l, g, again = (free_name(df, n) for n in ("_t", "_w", "_l", "_g", "_again"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_BLANK))
    one = df.select("*", text.alias(t), words(text).alias(w), lines.alias(l))
    two = one.select("*", windows(F.col(w)).alias(g))
    three = two.select("*", (F.size(F.array_distinct(g)) < F.size(g)).alias(again))
    counts = {
        "n_words": F.size(w), "word_chars": F.length(F.array_join(w, "")), "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)),
        "n_dup_lines": F.size(l) - F.size(F.array_distinct(l)),
        "n_repeat_words": F.when(F.col(again), repeat_words(F.col(g))).otherwise(0)}
    return three.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in counts], *[v.cast("long").alias(k) for k, v in counts.items()])


def short_hash(text: Column) -> Column:
    """64 bits as hexadecimal digits."""
    return F.substring(F.md5(text.cast("binary")), 1, 16)


def normalised(line: Column) -> Column:
    """Lower case, digits as one 0, single spaces between words; only runs of white space that aren't one space match."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]+", "0"), "[ \\t-\\r]*[\\t-\\r][ \\t-\\r]*|  +", " "))


def word_count(normal: Column) -> Column:
    return F.when(normal == "", F.lit(0)).otherwise(F.length(normal) - F.length(F.translate(normal, " ", "")) + 1)


def document_lines(df: DataFrame, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """(host, doc, key, place, line, n) for each line with a word: ``doc`` is the hash of the whole text, ``line``
    that of the normalised line, ``key`` that of the sorted set of all the document's lines, ``n`` the line's words.
    Written to the shared folder, as three steps read it and it is a small part of the texts."""
    text = F.col(f"`{text_col}`").cast("string")
    lines = F.transform(F.split(text, "\n"), lambda x: normalised(x))
    pairs = F.transform(lines, lambda x, i: F.struct(i.alias("place"), short_hash(x).alias("line"), word_count(x).alias("n")))
    rows = df.select(F.col(f"`{host_col}`").cast("string").alias("host"), short_hash(F.coalesce(text, F.lit(""))).alias("doc"), F.filter(pairs, lambda p: p["n"] > 0).alias("p"))
    key = short_hash(F.array_join(F.array_sort(F.array_distinct(F.transform("p", lambda p: p["line"]))), ""))
    flat = rows.select("host", "doc", "p", key.alias("key")).select("host", "doc", "key", F.explode("p").alias("q"))
    return written(flat.select("host", "doc", "key", "q.place", "q.line", "q.n"), "lines")


def common_lines(lines: DataFrame, limits: Limits) -> DataFrame:
    """(host, line, n_documents, first): the lines above the limit, ``first`` being the least document hash that
    has it. Null hosts are one host. Documents of a line are distinct if the sets of their other lines are, and as
    they share the line, if the sets of all their lines are; finding them by (host, line, key) spreads the rows of
    a line before its counts meet."""
    per_key = lines.groupBy("host", "line", "key").agg(F.min("doc").alias("first"))
    counts = per_key.groupBy("host", "line").agg(F.count("*").alias("n_documents"), F.min("first").alias("first"))
    return counts.where(F.col("n_documents") > limits.line_documents).select("host", "line", "n_documents", "first")


def removals(lines: DataFrame, common: DataFrame) -> DataFrame:
    """(h, d, removed, gone): for each distinct text that loses lines, the words that go and the hashes of the lines.
    The rows of one line are dealt to ``SALTS`` parts, each with a copy of the (few) common lines, as a common
    line may be in a third of all documents; then repeated rows of a text count once."""
    salted = lines.withColumn("salt", F.pmod(F.crc32("doc"), F.lit(SALTS)).cast("int"))
    copies = common.select(F.col("host").alias("h"), F.col("line").alias("cl"), "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("cs"))
    hit = salted.join(copies, F.col("host").eqNullSafe(F.col("h")) & (F.col("line") == F.col("cl")) & (F.col("salt") == F.col("cs"))
                      & (F.col("doc") != F.col("first")))
    places = hit.select("host", "doc", "place", "line", "n").distinct()
    return places.groupBy(F.col("host").alias("h"), F.col("doc").alias("d")).agg(F.sum("n").alias("removed"), F.collect_set("line").alias("gone"))


def judge(df: DataFrame, limits: Limits = Limits(), host_col: str = "source", text_col: str = "text") -> DataFrame:
    """``df`` with the base counts, base_failed, n_removed_words, gone (hashes of removed lines) and kept.

    Null, empty and blank texts have no words and fail; null hosts are one host; repeated rows get equal results;
    columns of df with these names are replaced; an empty table gives no rows. kept is false if the base rules
    fail or the common lines hold more than ``depleted_percent`` of the words."""
    lines = document_lines(df, host_col, text_col)
    gone = removals(lines, common_lines(lines, limits))
    host, doc = free_name(df, "_host"), free_name(df, "_doc")
    keyed = df.withColumns({host: F.col(f"`{host_col}`").cast("string"), doc: short_hash(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))})
    counted = base_counts(keyed, text_col)
    failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words"))
    own = {"base_failed", "n_removed_words", "gone", "kept"}
    counted = counted.select(*[F.col(f"`{c}`") for c in counted.columns if c.lower() not in own])
    h, d, words_gone = (free_name(counted, n) for n in ("_gone_host", "_gone_doc", "_gone_words"))
    gone = gone.select(F.col("h").alias(h), F.col("d").alias(d), F.col("removed").alias(words_gone), "gone")
    out = counted.join(gone, F.col(host).eqNullSafe(F.col(h)) & (F.col(doc) == F.col(d)), "left")
    removed = F.coalesce(words_gone, F.lit(0)).cast("long")
    kept = ~failed & (100 * removed <= limits.depleted_percent * F.col("n_words"))
    cols = [c for c in counted.columns if c not in (host, doc)]
    return out.select(*[F.col(f"`{c}`") for c in cols], failed.alias("base_failed"), removed.alias("n_removed_words"), "gone", kept.alias("kept"))


def without_lines(text: Column, gone: Column) -> Column:
    """The text without the lines whose hashes are in ``gone`` (null: none)."""
    stay = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(gone, short_hash(normalised(x))))
    return F.when(gone.isNull(), text).otherwise(F.array_join(stay, "\n"))


def keep_good(df: DataFrame, limits: Limits = Limits(), host_col: str = "source", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The kept rows of ``df`` without their common lines; ``length_col`` follows where the text changed. All other columns
    stay as they are, whatever their names; cases as in ``judge``."""
    names = {c: f"_c{i}" for i, c in enumerate(df.columns)}  # apart from the names that judge gives
    judged = judge(df.toDF(*names.values()), limits, names[host_col], names[text_col]).where("kept")
    text, changed = without_lines(F.col(names[text_col]), F.col("gone")), F.col("gone").isNotNull()
    new = {text_col: text}
    if length_col in names:
        new[length_col] = F.when(changed, F.length(text).cast("long")).otherwise(F.col(names[length_col]))
    return judged.select(*[new.get(c, F.col(name)).alias(c) for c, name in names.items()])
