"""SimHash, embeddings, components, resharding and the pipeline against brute force."""
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from hirewire.llm import embedding_dedup, sharding, simhash
from hirewire.llm.common import shared_path
from hirewire.llm.components import connected_components


def find(parent, x):
    while parent.setdefault(x, x) != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def join(parent, a, b):
    a, b = find(parent, a), find(parent, b)
    parent[max(a, b)] = min(a, b)


def test_components(spark):
    draw = random.Random(2)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5), (None, 3), (2000, 7)] * 2
    parent = {}
    for a, b in links:
        if a is not None and a != b:
            join(parent, a, b)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(parent, x) for x in list(parent)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_bk_tree_finds_what_brute_force_does():
    draw = random.Random(5)
    values = [draw.getrandbits(64) for _ in range(50)]
    values += [v ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for v in values for _ in range(4)]
    values = list(dict.fromkeys(values))
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in values:
        assert sorted(tree.value[i] for i in tree.within(v, 2)) == sorted(x for x in values if (x ^ v).bit_count() <= 2)


def test_shards_hold_every_link(spark):
    draw = random.Random(6)
    seeds = [draw.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1]
    values = {v for s in seeds for v in [s, *(s ^ (1 << a) ^ (1 << b) for a, b in [(draw.randrange(64), draw.randrange(64)) for _ in range(15)])]}
    parent = {v: v for v in values}
    ordered = sorted(values)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                join(parent, a, b)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    nodes = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    mine = {v: v for v in values}
    for r in simhash.fingerprint_links(nodes, 2).collect():
        a, b = r["a"] % (1 << 64), r["b"] % (1 << 64)
        assert (a ^ b).bit_count() <= 2
        join(mine, a, b)
    assert all(find(mine, v) == find(parent, v) for v in values)


def test_near_duplicates(spark, documents, odd_rows):
    draw = random.Random(7)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    rows = list(odd_rows)
    for k in range(12):
        ws = [word() for _ in range(150)]
        rows.append((100 + 10 * k, " ".join(ws)))
        for j in range(1, 4):
            near = list(ws)
            near[draw.randrange(150)] = word()
            rows.append((100 + 10 * k + j, " ".join(near)))
    df = documents(rows).withColumn("fingerprint", F.lit("clash"))
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    parent = {}
    for a in {f for _, f in fps}:
        for b in {f for _, f in fps}:
            if (a ^ b).bit_count() <= 2:
                join(parent, a, b)
    low = defaultdict(list)
    for i, f in fps:
        if i is not None:
            low[find(parent, f)].append(i)
    expect = sorted((str(i), f"{f:016x}", str(min(low[find(parent, f)], default=None))) for i, f in fps)
    got = simhash.near_duplicates(df).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == expect
    kept = simhash.keep_one(documents(rows))
    assert kept.columns == documents([]).columns
    roots = [find(parent, f) for _, f in fps]
    found = [(r["doc_id"], find(parent, plain_fingerprint(r["text"]))) for r in kept.collect()]
    assert sorted(r for _, r in found) == sorted(set(roots))
    assert all(i == min(low[r], default=None) for i, r in found)
    assert simhash.near_duplicates(documents([])).count() == 0 and simhash.keep_one(documents([])).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, n_links string"


def test_embeddings(spark):
    draw = np.random.default_rng(3)
    rows = []
    for k in range(60):
        v = draw.normal(size=16).astype(np.float32)
        for j in range(int(draw.integers(1, 9))):
            w = v if j == 1 else (v * (2.0 if j == 2 else 1.0) + draw.normal(size=16) * 0.02).astype(np.float32)
            rows.append((100 * k + j, [float(x) for x in w], int(k % 3) if j != 5 else None, "clash"))
    rows += [(9000, None, 1, ""), (9001, [], 1, ""), (9002, [0.0] * 16, 1, ""), (9003, [0.0] * 16, 1, ""), (9004, [1.0] * 15 + [None], 1, ""),
             (9005, [float("nan")] + [1.0] * 15, 1, ""), (9006, [float("inf")] + [1.0] * 15, 1, ""), (9007, [3.0], 1, ""), (9008, [5.0], 1, ""),
             (9009, [1.0, 0.0, 0.0], 1, ""), (9009, [1.0, 0.0, 0.0], 1, "")]
    usable = [r for r in rows if r[1] and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    links, parent = defaultdict(int), {}
    for i, a in enumerate(usable):
        for b in usable[i + 1:]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], np.float64), np.array(b[1], np.float64)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links[a[0]] += 1
                    if a[0] != b[0]:
                        links[b[0]] += 1
                    join(parent, a[0], b[0])
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS), target_recall=1.0).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_links"], r["component_id"]) == (links[r["vec_id"]], find(parent, r["vec_id"])), r
        assert r["kept"] == (r["component_id"] == r["vec_id"])
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_traversal_order_and_recall():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(600, 16))
    x /= np.sqrt((x ** 2).sum(1))[:, None]
    near = 0.98 * x + np.sqrt(1 - 0.98 ** 2) * (lambda a: a / np.sqrt((a ** 2).sum(1))[:, None])((a := draw.normal(size=x.shape)) - (a * x).sum(1)[:, None] * x)
    for target in (0.9, 0.999, 1.0):
        m = embedding_dedup.fit(x, 0.98, 6, target)
        (_, b1), (_, b2) = m.nearest_and_bounds(x)
        (c1, _), (c2, _) = m.nearest_and_bounds(near)
        found = 0
        for r in range(len(x)):
            cells = list(embedding_dedup.traverse(b1[r], b2[r], m.stop))
            far = [b1[r][i] ** 2 + b2[r][j] ** 2 for i, j in cells]
            assert far == sorted(far) and len(set(cells)) == len(cells)
            found += (c1[r], c2[r]) in set(cells)
        assert found >= (target - 0.05) * len(x) if target < 1 else found == len(x)


def test_min_cost_flow_moves_the_fewest_bytes():
    draw = random.Random(8)
    for _ in range(40):
        n, m = draw.randint(1, 6), draw.randint(1, 7)
        supply = [draw.randint(0, 50) for _ in range(n)]
        capacity = sharding.capacities(sum(supply), m)
        flow = sharding.min_cost_flow(supply, capacity, lambda i, j: int(i != j))
        for i in range(n):
            assert sum(a for (x, _), a in flow.items() if x == i) == supply[i]
        for j in range(m):
            assert sum(a for (_, y), a in flow.items() if y == j) == capacity[j]
        moved = sum(a for (i, j), a in flow.items() if i != j)
        assert moved == sum(max(0, s - (capacity[i] if i < m else 0)) for i, s in enumerate(supply))


def test_reshard(spark, documents, odd_rows):
    draw = random.Random(9)
    rows = [*odd_rows, *((50 + k, "wörd " * draw.randint(0, 300)) for k in range(700))]
    df = documents(rows).withColumn("shard", F.lit("clash"))
    got = sharding.reshard(df, shared_path(spark, "reshard-test"), 6, 8).collect()
    text = {(i, zlib.crc32((t or "").encode())): t for i, t in rows}
    assert sorted((str(r["doc_id"]), r["text_crc32"]) for r in got) == sorted((str(i), zlib.crc32((t or "").encode())) for i, t in rows)
    sizes, slots, old = defaultdict(int), defaultdict(list), defaultdict(int)
    for r in got:
        assert r["size"] == len((text[r["doc_id"], r["text_crc32"]] or "").encode()) + 16
        sizes[r["shard"]] += r["size"]
        old[r["old"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    rest = sorted(sizes.values())[:-1]  # one shard has the very long document
    assert len(sizes) == 8 and rest[-1] - rest[0] < 0.02 * rest[-1]
    assert sharding.reshard(documents([]), shared_path(spark, "reshard-test"), 6, 8).count() == 0


def test_slots_in_several_groups(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 10)
    rows = spark.range(300).select(F.col("id"), F.lit(0).cast("long").alias("text_crc32"), (F.col("id") % 3).cast("int").alias("shard"))
    got = defaultdict(list)
    for r in sharding.with_slots(rows, 300, 3).collect():
        got[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(100)) for v in got.values())


def test_pipeline(spark, tmp_path, documents, odd_rows):
    from tests.llm.test_filters import toxic_corpus

    draw = random.Random(11)
    corpus = toxic_corpus(400)
    rows = [(i, t) for i, t, _ in corpus] + [(1000 + i, t) for i, t, y in corpus[:60]] + [(i and i + 5000, t) for i, t in odd_rows]
    rows.append((7000, " ".join(f"u{draw.random():.6f}" for _ in range(60)) + " token = 9f8e7d6c5b4a39281706f5e4"))
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, y, 1) for i, _, y in corpus], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "secrets", "packing"]
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path)).cache()
        assert out.columns == docs.columns
        seen[name] = {r["doc_id"]: r["text"] for r in out.collect()}
        docs = spark.createDataFrame(out.collect(), docs.schema)
    truth = {i: y for i, _, y in corpus}
    kept = [i for i in seen["toxicity"] if i in truth]
    assert sum(truth[i] for i in kept) <= 3 and len(kept) >= 0.97 * sum(not y for y in truth.values())
    assert all(len((t or "").split()) >= 20 for t in seen["quality"].values())
    assert not [i for i in seen["near_duplicates"] if i and 1000 <= i < 1060 and i - 1000 in seen["quality"]]
    assert seen["secrets"][7000].endswith("[secret]")
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in final} == set(seen["secrets"])
