"""Importance resampling, conversation repair and exact dedup against brute force and on odd rows."""
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirewire.llm import conversation_repair as cr
from hirewire.llm import exact_dedup, importance_resampling as ir

SF = "/root/testdata/sf0.001"
TOKENS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# --- exact dedup ------------------------------------------------------------------------

def groups_of(rows, keep=max):
    by = defaultdict(list)
    for i, text in rows:
        by[text or ""].append(i)
    out = Counter()
    for text, ids in by.items():
        known = [i for i in ids if i is not None]
        best, left = keep(known) if known else None, 1
        for i in sorted(ids, key=lambda i: i != best):
            out[i, best, len(ids), left == 1 and i == best, hashlib.sha256(text.encode()).hexdigest()] += 1
            left = 0
    return out


@pytest.mark.parametrize("counters", [1, 8, 1024])
def test_exact_dedup(spark, documents, odd_rows, counters):
    draw = random.Random(3)
    rows = odd_rows + [(100 + k, "hot text" if k % 3 == 0 else f"text {draw.randint(0, 60)}") for k in range(600)]
    rows += [(None, "hot text"), (None, None), (100, "hot text"), (50, "Hot text"), (51, "hot text ")]
    df = documents(rows).repartition(5).withColumn("digest", F.lit("clash")).withColumn("row", F.lit(1)).withColumn("keep_id", F.lit(2))
    for keep, pick in (("largest", max), ("smallest", min)):
        got = exact_dedup.duplicates(df, keep=keep, counters=counters).collect()
        assert Counter(map(tuple, got)) == groups_of(rows, pick)
    stay = exact_dedup.keep_one(df, counters=counters)
    assert stay.columns == df.columns
    assert Counter((r["doc_id"], r["text"] or "") for r in stay.collect()) == Counter({(k[0], t): 1 for k in groups_of(rows) if k[3]
                                                                                    for t in {x or "" for _, x in rows} if hashlib.sha256(t.encode()).hexdigest() == k[4]})
    assert exact_dedup.duplicates(documents([]), counters=counters).count() == 0 and exact_dedup.keep_one(documents([])).count() == 0


def test_exact_dedup_normalised(spark, documents):
    got = exact_dedup.duplicates(documents([(1, "A b"), (2, "a B"), (3, "c")]), normalize=F.lower).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in got) == [(1, 2, False), (2, 2, True), (3, 3, True)]
    with pytest.raises(ValueError):
        exact_dedup.duplicates(documents([]), keep="any")


def test_misra_gries_bound():
    """Counts fall short by at most n / (counters + 1), over merges of batches and of summaries."""
    draw = np.random.default_rng(5)
    for counters in (1, 4, 16):
        total, summed, n = Counter(), Counter(), 0
        for _ in range(6):
            summary = exact_dedup.Summary(counters)
            for _ in range(5):
                batch = (draw.zipf(1.5, 200) % 97).tolist()
                seen = Counter(batch)
                total.update(seen)
                n += len(batch)
                summary.add(list(seen), np.array(list(seen.values())))
                assert len(summary.count) <= counters
            summed.update(summary.count)
        assert all(total[v] - n / (counters + 1) <= summed[v] <= total[v] for v in total)


def test_candidates_are_bounded_and_complete(spark):
    n, counters = 5000, 8
    marks = spark.range(0, n, 1, 7).select(F.col("id").alias("row"), "id", F.sha2(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 4 == 1, F.lit("warm"))
                                                                                 .otherwise(F.col("id").cast("string")).cast("binary"), 256).cast("binary").alias("digest"))
    got = {bytes(r["digest"]).decode() for r in exact_dedup.candidates(marks, counters).collect()}
    assert len(got) <= counters and {hashlib.sha256(t).hexdigest() for t in (b"hot", b"warm")} <= got


# --- importance resampling ----------------------------------------------------------------

def features_of(text, longest):
    words = [w.encode() for w in TOKENS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    grams = [b" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), grams


def resampled(rows, target, longest=1, buckets=10_000, percent=10, least_words=20, seed=2024):
    count = lambda texts: Counter(zlib.crc32(g) % buckets for t in texts for g in features_of(t, longest)[1])
    s, t = count(x for _, x in rows), count(target)
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(float(t[b] + 1) * float(S + buckets) / (float(s[b] + 1) * float(T + buckets))))
    out = []
    for i, text in rows:
        n, grams = features_of(text, longest)
        weight = math.floor(sum(gain(zlib.crc32(g) % buckets) for g in grams) / len(grams)) if grams else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n >= least_words])
    order = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(order[:percent * len(order) // 100]):
        r[4] = k + 1
    return Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("longest,block", [(1, 1 << 20), (1, 7), (3, 1 << 20), (3, 7)])
def test_checksums(monkeypatch, longest, block):
    monkeypatch.setattr(ir, "BLOCK", block)
    draw = random.Random(longest)
    for _ in range(60):
        text = "".join(draw.choice(["a", "Bc", "é", "日本", " ", "-", "\n", "9", "\x7f", "\x80", "['"]) for _ in range(draw.randint(0, 60)))
        got = [c for level in ir.checksums(text.encode(), longest) for c in level]
        assert Counter(got) == Counter(map(zlib.crc32, features_of(text, longest)[1])), text
    assert list(ir.checksums(None, longest)) == []


@pytest.mark.parametrize("longest", [1, 2])
def test_resampling(spark, documents, odd_rows, longest):
    draw = random.Random(8)
    rows = odd_rows + [(1000 + k, " ".join(draw.choice(["Alpha", "beta", "gamma-delta", "été", "x9"]) for _ in range(draw.randint(0, 60)))) for k in range(400)]
    rows += [(2000, rows[-1][1])] * 40 + [(None, "word " * 30)]
    target = ["alpha alpha beta", None, "", "été"]
    df = documents(rows).repartition(3).withColumn("weight", F.lit("clash")).withColumn("rank", F.lit(1)).withColumn("row", F.lit(0))
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    features = ir.Features(longest, 500)
    for percent in (10, 100, 0):
        got = ir.resample(df, goal, percent, features=features).collect()
        assert Counter(map(tuple, got)) == resampled(rows, target, longest, 500, percent), percent
    assert ir.resample(documents([]), goal).count() == 0
    none = ir.resample(df, goal.limit(0), features=features).collect()
    assert Counter(map(tuple, none)) == resampled(rows, [], longest, 500)


def test_resampling_query(spark):
    from hirewire.llm.queries import op11_importance_resampling
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = op11_importance_resampling(spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == resampled(rows, target)


# --- conversation repair --------------------------------------------------------------------

GRAMMAR = re.compile("(s?(ua)+)?")


def brute(turns):
    """The cheapest audit by searching all edits, Dijkstra over (turns read, what was emitted last)."""
    @lru_cache(None)
    def best(i, state, inserts):
        options = []
        if i == len(turns) and state in "0a":
            options.append((0, ""))
        emit = {"0": "u", "s": "u", "u": "a", "a": "u"}[state]
        if inserts:
            c, a = best(i, emit, inserts - 1)
            options.append((5 + c, "I" + a))
        if i < len(turns):
            t = turns[i]
            c, a = best(i + 1, state, inserts)
            options.append((2 + c, "D" + a))
            if t != "d":
                more = 5 if t.isupper() else 0
                if t.lower() == emit or (t.lower() == "s" and state == "0"):
                    c, a = best(i + 1, t.lower(), inserts)
                    options.append((more + c, "K" + a))
                c, a = best(i + 1, emit, inserts)
                options.append((more + 1 + c, "R" + a))
        return min(options, default=(10 ** 6, ""))
    return best(0, "0", len(turns) // 2 + 3)


def test_alignment_exhaustive():
    """All conversations of up to 5 turns, and drawn longer ones, by targets and by the cycle."""
    letters = "suaxdUA"
    for n in range(5):
        for turns in map("".join, itertools.product(letters, repeat=n)):
            assert cr._written_out(turns) == brute(turns) == cr._folded(turns), turns
    draw = random.Random(2)
    for _ in range(400):
        turns = "".join(draw.choice("uauauausSUAXdx") for _ in range(draw.randint(5, 40)))
        assert cr._written_out(turns) == brute(turns) == cr._folded(turns), turns


def test_alignment_of_long_conversations():
    draw = random.Random(4)
    turns = "s" + "".join(draw.choice(["ua"] * 6 + ["d", "U", "s", "a"]) for _ in range(400))
    assert cr._written_out(turns) == cr._folded(turns)
    cost, audit = cr.cheapest(turns * 30)
    assert cost > 0 and len(audit) >= len(turns) * 30


def repaired(rows):
    """The contract, plainly: rows (conv, turn, role, text) after damage -> results by conversation."""
    by = defaultdict(list)
    for conv, turn, role, text, lost in rows:
        by[conv]
        if not lost:
            by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, turns in by.items():
        md5 = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), md5(r)))
        seen, codes, faults = set(), "", Counter()
        for _, role, text in turns:
            core = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
            seen.add((role, text))
            faults[fault] += 1
            code = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "d" if fault in ("blank", "duplicate") else code.upper() if fault else code
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit = brute(codes)
        left, result, symbol = iter(turns), [], "u"
        for edit in audit:
            if edit == "I":
                pair = ({"u": "user", "a": "assistant"}[symbol], "")
            else:
                _, role, text = next(left)
                if edit == "D":
                    continue
                pair = (role if edit == "K" else {"u": "user", "a": "assistant"}[symbol], text)
            result.append(pair)
            symbol = "u" if pair[0][0] in "sa" else "a"
        assert GRAMMAR.fullmatch("".join(r[:1] for r, _ in result))
        joined = "\n".join(f"{r}:{t}" for r, t in result)
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256(joined.encode()).hexdigest(), result)
    return out


CONV = "conv_id long, turn long, role string, text string, lost boolean"


def test_repair_of_odd_conversations(spark):
    draw = random.Random(6)
    rows = [(1, 0, "user", "Hi.", False), (1, 2, "assistant", "Hello", False), (1, 2, "assistant", "Hello", False), (1, None, "system", "Be kind!", False),
            (2, None, None, None, False), (2, None, "", "", False), (3, 5, "user", "gone.", True), (None, 1, "user", "who?", False), (None, 1, "tool", "x.", False),
            (4, 1, "user", "x" * 100_000 + ".", False), (4, 2, "assistant", "é🙂! \n\t", False), (5, -3, "assistant", ".", False), (5, 1 << 40, "user", ".", False)]
    for conv in range(10, 60):
        for turn in range(draw.randint(0, 9)):
            rows.append((conv, draw.choice([None, turn, turn, turn]), draw.choice(["user", "assistant", "user", "assistant", "system", "tool", None]),
                         draw.choice(["a.", "b!", "c?", "cut", "", " ", None, f"{turn} fine."]), draw.random() < 0.1))
    df = spark.createDataFrame(rows, CONV).repartition(4).withColumn("audit", F.lit("clash")).withColumn("same", F.lit(0)).withColumn("conv", F.lit(9))
    got = cr.audit_and_digest(df, gone=F.col("lost")).collect()
    want = repaired(rows)
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == {k: v[:8] for k, v in want.items()} and len(got) == len(want)
    turns = defaultdict(list)
    for r in sorted(cr.repair(df, gone=F.col("lost")).collect(), key=lambda r: r["place"]):
        turns[r["conv_id"]].append((r["role"], r["text"]))
    assert turns == {k: v[8] for k, v in want.items() if v[8]}
    assert cr.audit_and_digest(df.limit(0)).count() == 0 and cr.repair(df.limit(0)).count() == 0
    assert cr.damage(df.limit(0)).count() == 0


def test_repair_of_a_hot_conversation(spark):
    rows = [(7, k, "user" if k % 2 == 0 else "assistant", "cut" if k % 50 == 7 else f"text {k}." if k % 9 else "again.", False) for k in range(3000)]
    rows += [(8, 0, "user", "one.", False)]
    got = {r["conv_id"]: tuple(r)[1:] for r in cr.audit_and_digest(spark.createDataFrame(rows, CONV)).collect()}
    codes = [r for r in rows if r[0] == 7]
    assert got[7][2] == len([1 for k in range(3000) if k % 9 == 0 and k % 50 != 7]) + len([1 for k in range(3000) if k % 50 == 7]) - 3
    assert len(got[7][6]) >= len(codes) and got[8][5] == 2 and got[8][6] == "D"


def test_repair_query(spark):
    from hirewire.llm.queries import op12_conversation_repair
    rows = []
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        conv, turn, role, text = r
        fault = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        rows += [(conv, turn, "user" if fault == 4 else role, text, fault == 0)] * (2 if fault == 3 else 1)
    got = op12_conversation_repair(spark, SF).collect()
    want = repaired(rows)
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == {k: v[:8] for k, v in want.items()} and len(got) == len(want)
