"""Embedding near-duplicates through an inverted multi-index.

Vectors are scaled to length one and cut in halves; each half has a codebook of its own, and a pair of
codewords is a cell of the product grid. A vector is indexed in the cell of its nearest codewords and searches
cells in the order of their distance, taken from the two sorted codeword lists by a heap (multi-sequence
traversal), until the cells left can't hold what the target recall asks for. Found pairs are verified by the
cosine in double precision.

A cell's distance is how far the vector's halves are from the regions of its codewords. No vector within the
radius of the similarity threshold lies in a cell farther than the radius, so for a target recall of 1 the
traversal stops there. Below 1 it stops at the distance within which that share of neighbours is found
that lie exactly at the threshold in random directions from sample vectors; closer ones are found more often.

Codebooks are trained on a bounded sample; all vectors are indexed. Equal vectors are one row with a weight.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirewire.llm.common import small_batches, written
from hirewire.llm.components import connected_components

BLOCK = 512  # indexed vectors, and searching ones, that meet in one block


@dataclass
class MultiIndex:
    """Two codebooks (rows are codewords) and the squared distance up to which cells are visited."""

    books: tuple[np.ndarray, np.ndarray]
    stop: float

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.books[0].shape[1]
        return x[:, :cut], x[:, cut:]

    def nearest_and_bounds(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each half: the nearest codeword, and for every codeword a lower bound of the distance to its region.
        The region of i lies beyond the planes between i and each other codeword k."""
        out = []
        for half, book in zip(self.halves(x), self.books):
            d2 = ((half ** 2).sum(1)[:, None] - 2 * half @ book.T + (book ** 2).sum(1)[None]).clip(min=0)
            apart = np.sqrt(((book[:, None] - book[None]) ** 2).sum(2))
            bound = np.zeros_like(d2)
            for k in range(len(book)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    b = (d2 - d2[:, k:k + 1]) / (2 * apart[:, k])
                bound = np.maximum(bound, np.nan_to_num(b, nan=0.0, posinf=0.0, neginf=0.0))
            out.append((d2.argmin(1), bound))
        return out


def traverse(first: np.ndarray, second: np.ndarray, stop: float) -> Iterator[tuple[int, int]]:
    """Cells (i, j) by ascending first[i]^2 + second[j]^2 up to ``stop``."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = (first[a] ** 2).tolist(), (second[b] ** 2).tolist()
    heap, seen = [(x[0] + y[0], 0, 0)], {(0, 0)}
    while heap:
        d, i, j = heapq.heappop(heap)
        if d > stop:
            return
        yield int(a[i]), int(b[j])
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(x) and q < len(y) and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(heap, (x[p] + y[q], p, q))


def codebook(x: np.ndarray, size: int, rounds: int = 12) -> np.ndarray:
    """k-means from evenly spaced sample rows; at most ``size`` distinct codewords."""
    distinct = np.unique(x, axis=0)
    book = distinct[np.linspace(0, len(distinct) - 1, min(size, len(distinct))).astype(int)].copy()
    for _ in range(rounds):
        near = (-2 * x @ book.T + (book ** 2).sum(1)).argmin(1)
        for k in range(len(book)):
            mine = x[near == k]
            if len(mine):
                book[k] = mine.mean(0)
    return np.unique(book, axis=0)


def fit(sample: np.ndarray, min_cosine: float, codewords: int, target_recall: float, seed: int = 5) -> MultiIndex:
    """Codebooks from unit vectors, and the distance at which to stop for the target recall."""
    cut = sample.shape[1] // 2
    radius2 = max(0.0, 2 - 2 * min_cosine) * (1 + 1e-9) + 1e-12
    index = MultiIndex((codebook(sample[:, :cut], codewords), codebook(sample[:, cut:], codewords)), radius2)
    if target_recall < 1.0 and len(sample):
        away = np.random.default_rng(seed).normal(size=sample.shape)
        away -= (away * sample).sum(1)[:, None] * sample
        away /= np.maximum(np.sqrt((away ** 2).sum(1)), 1e-12)[:, None]
        cells = [c for c, _ in index.nearest_and_bounds(min_cosine * sample + np.sqrt(1 - min_cosine ** 2) * away)]
        rows = np.arange(len(sample))
        needed = sum(bound[rows, c] ** 2 for (_, bound), c in zip(index.nearest_and_bounds(sample), cells))
        index.stop = min(radius2, float(np.quantile(needed, target_recall)) + 1e-9)
    return index


def codewords_for(vectors: int) -> int:
    """As many codewords in each half as keep the mean cell at about 128 vectors, up to 256."""
    return int(min(256, max(2, round((vectors / 128) ** 0.5))))


def distinct_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, vectors): all rows as id, label, v (null where a vector can't link), and the distinct (label, v) with
    rid, low (smallest id) and copies. Copies are counted before they are shuffled."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").cast("array<float>").alias("v"))
    usable = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    good = F.coalesce(F.col("label").isNotNull() & usable, F.lit(False))
    rows = rows.select("id", F.when(good, F.col("label")).alias("label"), F.when(good, F.col("v")).alias("v"))
    groups = rows.where("v is not null").groupBy("label", "v").agg(F.min("id").alias("low"), F.count("*").alias("copies"))
    return rows, written(groups.withColumn("rid", F.monotonically_increasing_id()), "vectors")


def unit_vectors(column: pa.Array) -> np.ndarray:
    """Rows of equally long vectors as unit vectors in double precision."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)
    return x / np.sqrt((x ** 2).sum(1))[:, None]


def find_links(vectors: DataFrame, index: MultiIndex, min_cosine: float) -> DataFrame:
    """(rid, n, other): for each block in which a vector has links, the copies of the vectors linked to it (its own
    not counted), and the smallest vector that the block joins it to."""
    session = vectors.sparkSession
    shared = session.sparkContext.broadcast(index)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            (c1, b1), (c2, b2) = m.nearest_and_bounds(unit_vectors(b.column(2)))
            at, cell = [], []
            width = len(m.books[1])
            for r in range(b.num_rows):
                for i, j in traverse(b1[r], b2[r], m.stop):
                    at.append(r)
                    cell.append(i * width + j)
            at = np.array(at)
            own = (c1 * width + c2)[at]
            yield pa.RecordBatch.from_arrays(
                [b.column(k).take(pa.array(at)) for k in range(4)] + [pa.array(cell, pa.int32()), pa.array(own == cell)],
                ["rid", "label", "v", "copies", "cell", "own"])

    label = vectors.schema["label"].dataType.simpleString()
    visits = vectors.select("rid", "label", "v", "copies").mapInArrow(cells, f"rid long, label {label}, v array<float>, copies long, cell int, own boolean")
    visits = written(visits, "visits")
    # a crowded cell is cut into blocks of indexed and of searching vectors; every pair of blocks meets once
    sizes = visits.groupBy("label", "cell").agg(F.count(F.when(F.col("own"), 1)).alias("indexed"), F.count("*").alias("searching"))
    sizes = sizes.where("indexed > 0").select(F.col("label").alias("l"), F.col("cell").alias("c"), F.ceil(F.col("indexed") / BLOCK).cast("int").alias("ni"),
                                              F.ceil(F.col("searching") / BLOCK).cast("int").alias("ns"))
    placed = visits.join(sizes, (F.col("label") == F.col("l")) & (F.col("cell") == F.col("c"))).drop("l", "c")
    h = F.xxhash64("rid", "cell")
    indexed = placed.where("own").withColumn("i", F.pmod(h, F.col("ni")).cast("int")).withColumn("s", F.explode(F.sequence(F.lit(0), F.col("ns") - 1)))
    searching = placed.withColumn("s", F.pmod(h, F.col("ns")).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("ni") - 1)))
    keys = ["label", "cell", "i", "s"]

    def verify(block: pa.Table) -> pa.Table:
        searches = block.column("searches").to_numpy()
        left, right = block.filter(pa.array(~searches)), block.filter(pa.array(searches))
        if not left.num_rows or not right.num_rows:
            return pa.table({"rid": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "other": pa.array([], pa.int64())})
        p, q = left.column("rid").to_numpy(), right.column("rid").to_numpy()
        near = unit_vectors(right.column("v")) @ unit_vectors(left.column("v")).T >= min_cosine
        near &= q[:, None] != p[None]
        n = near @ left.column("copies").to_numpy()
        # the smallest vector that each one is joined to within the block, by repeated minima over the links
        rows, columns = near.any(1), near.any(0)
        small = near[rows][:, columns]
        top_q, top_p = q[rows].copy(), p[columns].copy()
        far = np.iinfo(np.int64).max
        while small.size:
            new_q = np.minimum(top_q, np.where(small, top_p[None], far).min(1))
            new_p = np.minimum(top_p, np.where(small, new_q[:, None], far).min(0))
            if (new_q == top_q).all() and (new_p == top_p).all():
                break
            top_q, top_p = new_q, new_p
        return pa.table({"rid": pa.array(np.concatenate([q[rows], p[columns]])), "n": pa.array(np.concatenate([n[rows], np.zeros(int(columns.sum()), np.int64)]).astype(np.int64)),
                         "other": pa.array(np.concatenate([top_q, top_p]))})

    pick = [*keys, "rid", "v", "copies"]
    met = indexed.select(*pick, F.lit(False).alias("searches")).unionByName(searching.select(*pick, F.lit(True).alias("searches")))
    # dealt anew by block: the join above has left all blocks of a crowded cell in one partition
    return met.repartition(*keys).groupBy(*keys).applyInArrow(verify, "rid long, n long, other long")


def near_duplicates(df: DataFrame, min_cosine: float = 0.98, codewords: int | None = None, target_recall: float = 0.999,
                    sample_rows: int = 8192, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept): how many other vectors of the same label have a cosine of at least
    ``min_cosine`` with this one, the smallest id reachable by links, and whether that is the row's own.

    Null, empty and zero vectors, such with null or non-finite components and rows without a label link with
    nothing and are their own component; vectors of different lengths don't link; repeated rows count each;
    a null id takes part, but isn't a component's smallest unless all are null; an empty table gives no rows."""
    small_batches(df.sparkSession)
    rows, vectors = distinct_vectors(df, id_col, vector_col, label_col)
    done = []
    for n, many in sorted((r["n"], r["many"]) for r in vectors.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("many")).collect()):
        mine = vectors.where(F.size("v") == n)  # lengths of vectors: one, as a rule
        if n == 1:
            mine = mine.withColumn("v", F.concat("v", "v"))  # each half needs a component
        sample = mine.select("v", "rid").orderBy(F.xxhash64("rid"), "rid").limit(sample_rows).collect()
        x = np.array([r["v"] for r in sample], np.float64)
        x /= np.sqrt((x ** 2).sum(1))[:, None]
        done.append(find_links(mine, fit(x, min_cosine, codewords or codewords_for(many), target_recall), min_cosine))
    if not done:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
                           F.col("id").isNotNull().alias("kept"))
    links = done[0]
    for more in done[1:]:
        links = links.unionByName(more)
    links = written(links, "links")
    roots = connected_components(links.select(F.col("rid").alias("a"), F.col("other").alias("b")))
    counts = links.groupBy("rid").agg(F.sum("n").alias("n"))
    known = vectors.join(counts, "rid", "left").join(roots.withColumnRenamed("node", "rid"), "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    known = written(known.select("label", "v", "low", "root", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "linked")
    lows = known.groupBy("root").agg(F.min("low").alias("component_id"))
    of = known.join(lows, "root").select(F.col("label").alias("l"), F.col("v").alias("w"), "n_links", "component_id")
    out = rows.join(of, (F.col("label") == F.col("l")) & (F.col("v") == F.col("w")), "left")
    component = F.when(F.col("w").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
