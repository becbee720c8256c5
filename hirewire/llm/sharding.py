"""Resharding by minimum-cost flow: the block transfers that move the fewest bytes.

Documents of an old shard are grouped into blocks by size class and a hash of their id; blocks are what files
hold and what moves. From the old shards' sizes and the new shards' capacities a minimum-cost flow says how
many bytes go from where to where (a byte that stays costs nothing); blocks are then dealt to meet the flow,
large ones first, so that the smallest blocks even out what is left. Only the files of blocks that move are
rewritten. The driver sees sums of blocks: old shards times size classes times parts, whatever the rows.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PARTS = 16  # blocks of one old shard and size class
SLOT_ROWS = 50_000  # rows that are numbered together


def sized(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32): UTF-8 bytes of the text (null: none) plus 16, and its unsigned CRC-32."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return df.select(F.col(f"`{id_col}`").alias("id"), (F.octet_length(text) + 16).cast("long").alias("size"),
                     F.crc32(text.cast("binary")).alias("text_crc32"))


def block_columns(id_col, size_col, old_shards: int) -> dict:
    """Old shard, size class and part of a document. The old layout hashes ids over ``old_shards`` shards."""
    h = F.xxhash64(F.col(id_col).cast("string"), F.lit("block"))
    return {"old": F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(old_shards)).cast("int"),
            "size_class": F.floor(F.log2(F.col(size_col).cast("double"))).cast("int"), "part": F.pmod(h, F.lit(PARTS)).cast("int")}


def capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> dict[tuple[int, int], int]:
    """{(i, j): amount}: all supply to shards with capacity (in sum enough), at the least ``cost(i, j)`` in sum.

    Successive shortest paths with potentials; the graph has a node for each shard, so this is small whatever
    the amounts."""
    n, m = len(supply), len(capacity)
    source, sink = n + m, n + m + 1
    edges: list[list[int]] = []  # to, left, cost; the reverse edge is the one beside
    out: list[list[int]] = [[] for _ in range(n + m + 2)]

    def edge(a: int, b: int, room: int, price: int) -> None:
        out[a].append(len(edges))
        edges.append([b, room, price])
        out[b].append(len(edges))
        edges.append([a, 0, -price])

    for i, s in enumerate(supply):
        edge(source, i, s, 0)
    for j, c in enumerate(capacity):
        edge(n + j, sink, c, 0)
    links = {}
    for i, s in enumerate(supply):
        for j in range(m):
            links[len(edges)] = (i, j)
            edge(i, n + j, s, cost(i, j))
    potential = [0] * (n + m + 2)
    while True:
        dist: list[float] = [float("inf")] * (n + m + 2)
        via = [-1] * (n + m + 2)
        dist[source] = 0
        todo = [(0, source)]
        while todo:
            d, a = heapq.heappop(todo)
            if d > dist[a]:
                continue
            for e in out[a]:
                b, room, price = edges[e]
                if room > 0 and d + price + potential[a] - potential[b] < dist[b]:
                    dist[b] = d + price + potential[a] - potential[b]
                    via[b] = e
                    heapq.heappush(todo, (dist[b], b))
        if via[sink] < 0:
            break
        for v, d in enumerate(dist):
            if d < float("inf"):
                potential[v] += int(d)
        path, v = [], sink
        while v != source:
            path.append(via[v])
            v = edges[via[v] ^ 1][0]
        amount = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= amount
            edges[e ^ 1][1] += amount
    return {links[e]: edges[e ^ 1][1] for e in links if edges[e ^ 1][1]}


def deal_blocks(blocks: list[tuple], flow: dict[tuple[int, int], int]) -> dict[tuple, int]:
    """{block key: new shard}: blocks (old shard, ..., bytes) dealt to meet the flow, large ones first, each to the
    shard that still lacks most from its old shard, less what other old shards have overfilled it by."""
    lacks: dict[int, dict[int, int]] = {}
    for (i, j), amount in flow.items():
        lacks.setdefault(i, {})[j] = amount
    dealt, over = {}, {}
    for *key, size in sorted(blocks, key=lambda b: (-b[-1], b[:-1])):
        mine = lacks[key[0]]
        j = max(mine, key=lambda k: (mine[k] - over.get(k, 0), k == key[0], -k))
        dealt[tuple(key)] = j
        over[j] = over.get(j, 0) + max(0, size - mine[j])
        mine[j] = max(0, mine[j] - size)
    return dealt


def plan(documents: DataFrame, old_shards: int, new_shards: int) -> dict[tuple, int]:
    """{(old, size_class, part): new shard} for ``documents`` with id and size."""
    blocks = documents.withColumns(block_columns("id", "size", old_shards)).groupBy("old", "size_class", "part").agg(F.sum("size").alias("n"))
    rows = [tuple(r) for r in blocks.collect()]  # at most old shards * 64 size classes * parts
    alone = larger_than_share(rows, new_shards)
    rows = [r for r in rows if r[:3] not in alone]
    supply = [0] * old_shards
    for r in rows:
        supply[r[0]] += r[3]
    free = [j for j in range(new_shards) if j not in set(alone.values())]
    flow = min_cost_flow(supply, capacities(sum(supply), len(free)), lambda i, j: int(i != free[j]))
    return {**alone, **deal_blocks(rows, {(i, free[j]): n for (i, j), n in flow.items()})}


def larger_than_share(blocks: list[tuple], shards: int) -> dict[tuple, int]:
    """{block key: new shard} of blocks (a very long document, as a rule) larger than an equal share of what is left
    to the other shards: each fills a shard of its own, its old one if that is free."""
    left, alone, taken = sum(b[3] for b in blocks), {}, set()
    for b in sorted(blocks, key=lambda b: (-b[3], b[:3])):
        n = shards - len(alone)
        if n < 2 or b[3] * n <= left:
            break
        j = b[0] if b[0] < shards and b[0] not in taken else min(j for j in range(shards) if j not in taken)
        alone[b[:3]] = j
        taken.add(j)
        left -= b[3]
    return alone


def with_shards(documents: DataFrame, dealt: dict[tuple, int], old_shards: int) -> DataFrame:
    """``documents`` (id, size, ...) with old and shard; the plan, bounded by blocks, is broadcast."""
    spark = documents.sparkSession
    table = spark.createDataFrame([(*k, v) for k, v in dealt.items()], "old int, size_class int, part int, shard int")
    return documents.withColumns(block_columns("id", "size", old_shards)).join(F.broadcast(table), ["old", "size_class", "part"]).drop("size_class", "part")


def with_slots(rows: DataFrame, n_rows: int, shards: int) -> DataFrame:
    """``rows`` (id, text_crc32, shard, ...) with slot, gapless from 0 in each shard. A shard is numbered in groups by
    hash of the id, as many as its rows need; where groups begin comes from their counts."""
    groups = max(1, -(-n_rows // (shards * SLOT_ROWS)))
    keyed = rows.withColumn("_g", F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("slot")), F.lit(groups)).cast("int"))
    counts = keyed.groupBy("shard", "_g").agg(F.count("*").alias("n"))
    begin = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = counts.select(F.col("shard").alias("_s"), F.col("_g").alias("_h"), begin.alias("_begin"))
    number = F.row_number().over(Window.partitionBy("shard", "_g").orderBy(F.col("id").asc_nulls_last(), "text_crc32"))
    numbered = keyed.withColumn("_n", number)
    joined = numbered.join(begins, (F.col("shard") == F.col("_s")) & (F.col("_g") == F.col("_h")))
    return joined.withColumn("slot", (F.col("_begin") + F.col("_n") - 1).cast("long")).drop("_s", "_h", "_g", "_n", "_begin")


def rewrite_moved(df: DataFrame, dealt: dict[tuple, int], old_shards: int, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the documents of blocks that move below ``folder``, a folder for each new shard, and read them back:
    (id, text, old, shard). Blocks that stay keep their files."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), (F.octet_length(text) + 16).cast("long").alias("size"))
    moved = with_shards(rows, dealt, old_shards).where("old <> shard").drop("size")
    parts = moved.withColumn("_p", F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("file")), F.lit(4)))
    parts.repartition("shard", "_p").drop("_p").withColumn("new_shard", F.col("shard")).write.partitionBy("new_shard").parquet(folder)
    return df.sparkSession.read.schema(moved.schema).parquet(folder)


def reshard(df: DataFrame, folder: str, old_shards: int, new_shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, old, shard, slot) of all documents after resharding to near equal bytes.

    Rows of blocks that moved come from their rewritten files. Null texts have size 16; null ids are one block's;
    repeated rows stay; a document larger than a shard's share makes its shard that much larger; an empty table
    gives no rows; other columns are not read."""
    documents = sized(df, id_col, text_col)
    dealt = plan(documents, old_shards, new_shards)
    n_rows = df.count()
    stayed = with_shards(documents, dealt, old_shards).where("old = shard")
    moved = rewrite_moved(df, dealt, old_shards, folder, id_col, text_col)
    text = F.coalesce("text", F.lit(""))
    again = moved.select("id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), "old", "shard")
    rows = stayed.select("id", "size", "text_crc32", "old", "shard").unionByName(again)
    return with_slots(rows, n_rows, new_shards).withColumnRenamed("id", id_col)
