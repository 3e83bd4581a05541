"""Nearest neighbours by inner product through an inverted multi-index.

The two halves of the vectors are quantised separately (k-means with ``CELLS``
centroids each, fitted on a bounded sample); a row's cell is its pair of
centroids. For a query the pairs are visited in order of summed distance (the
negated inner products of its halves with the centroids) by a heap over the
two sorted lists, until the cells hold ``SHARE`` of all rows. The rows of those
cells are reranked by the exact inner product.

Queries meet rows in blocks of bounded size on both sides, keyed by the first
centroid; a block pair only computes the cells its queries asked for and
returns ``k`` rows a query.
"""
from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

CELLS = 64  # centroids of a half; at most 64, as a query's second centroids travel as bits of a long
SAMPLE_ROWS = 20_000  # bound on the rows that the quantisers are fitted on
SHARE = 0.6  # share of all rows that a query's cells hold at least
BLOCK_ROWS = 2048
BLOCK_QUERIES = 1024


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, v binary of doubles) of rows that take part, and their dimension.

    NULL and zero vectors, vectors with NULL or non-finite components and rows
    without an id take no part, nor do vectors whose length is not the most
    common one (of equally common, the smaller).
    """
    v = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    v = v.filter(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
    top = v.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    dim = int(top["d"]) if top else 0
    return v.filter(F.size("v") == dim), dim


def kmeans(x: np.ndarray, k: int, seed: int, steps: int = 20) -> np.ndarray:
    distinct = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    c = distinct[rng.permutation(len(distinct))[:k]].copy()
    for _ in range(steps):
        near = nearest(x, c)
        n = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c**2).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dim)


def visit(s1: np.ndarray, s2: np.ndarray, counts: np.ndarray, need: int) -> dict[int, int]:
    """Cells of a query by falling summed score until they hold ``need`` rows: {first centroid: bits of second centroids}."""
    o1, o2 = np.argsort(-s1, kind="stable"), np.argsort(-s2, kind="stable")
    a, b = s1[o1].tolist(), s2[o2].tolist()
    o1, o2 = o1.tolist(), o2.tolist()
    heap, got, bits = [(-a[0] - b[0], 0, 0)], 0, {}
    while heap and got < need:
        _, i, j = heapq.heappop(heap)
        n = int(counts[o1[i], o2[j]])
        if n:
            got += n
            bits[o1[i]] = bits.get(o1[i], 0) | 1 << o2[j]
        if i + 1 < len(a) and j == 0:
            heapq.heappush(heap, (-a[i + 1] - b[0], i + 1, 0))
        if j + 1 < len(b):
            heapq.heappush(heap, (-a[i] - b[j + 1], i, j + 1))
    return bits


def best_of_block(q_id, q, q_bits, v_id, v, v_cell, k: int):
    """(query, row, score) of the ``k`` best of a block for each of its queries, by exact score, then id."""
    s = np.full((len(q), len(v)), -np.inf)
    for c in np.unique(v_cell):
        rows = np.flatnonzero(v_cell == c)
        asks = np.flatnonzero((q_bits >> np.uint64(c)) & np.uint64(1))
        if len(asks):
            s[np.ix_(asks, rows)] = q[asks] @ v[rows].T
    s[q_id[:, None] == v_id[None, :]] = -np.inf
    edge = np.partition(s, len(v) - k, axis=1)[:, len(v) - k] if len(v) > k else np.full(len(q), -np.inf)
    qi, vi = np.nonzero((s >= edge[:, None] - 1e-9) & (s > -np.inf))
    exact = np.empty(len(qi))
    for at in range(0, len(qi), 1 << 16):  # one order of additions, so equal vectors score equal
        part = slice(at, at + (1 << 16))
        exact[part] = (q[qi[part]] * v[vi[part]]).sum(axis=1)
    order = np.lexsort((v_id[vi], -exact, qi))
    qi, vi, exact = qi[order], vi[order], exact[order]
    first = np.searchsorted(qi, qi, "left")
    top = np.arange(len(qi)) - first < k
    return q_id[qi[top]], v_id[vi[top]], exact[top]


def search(
    vectors: DataFrame, queries, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", cells: int = CELLS, share: float = SHARE, sample_rows: int = SAMPLE_ROWS, seed: int = 42
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that the condition
    ``queries`` (a Column over ``vec_id``) holds for, its ``k`` nearest found
    among all other rows, by inner product in double precision, ties to the
    smaller id.

    Fewer rows than ``k`` give all of them. Rows that repeat an id are
    candidates each on their own, never of a query with that id; such a query
    is asked once, with the least of its vectors. An empty table gives no rows.
    """
    rows, dim = usable(vectors, id_col, vec_col)
    out_schema = "query_id bigint, vec_id bigint, score double"
    half = max(1, dim // 2)
    sample = stage(rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample_rows), "multi-index-sample").toPandas()
    sample = sample.sort_values("vec_id", kind="stable")
    x = np.array(sample["v"].tolist(), dtype=np.float64).reshape(-1, dim) if len(sample) else np.zeros((1, 2))
    c1, c2 = kmeans(x[:, :half], cells, seed), kmeans(x[:, half:], cells, seed + 1)

    def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _matrix(b.column(1), dim)
            raw = [r.tobytes() for r in m]
            first, second = nearest(m[:, :half], c1), nearest(m[:, half:], c2)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(raw, pa.binary()), pa.array(first.astype(np.int32)), pa.array(second.astype(np.int32))],
                ["vec_id", "v", "c1", "c2"],
            )

    index = stage(rows.mapInArrow(to_cells, "vec_id bigint, v binary, c1 int, c2 int"), "multi-index")
    counts = np.zeros((len(c1), len(c2)), np.int64)
    for r in index.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n")).collect():  # at most CELLS^2 rows
        counts[r["c1"], r["c2"]] = r["n"]
    need = int(np.ceil(share * counts.sum())) + k + 1
    asked = rows.filter(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    chunks = max(1, -(-rows.filter(queries).count() // BLOCK_QUERIES))

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _matrix(b.column(1), dim)
            s1, s2 = m[:, :half] @ c1.T, m[:, half:] @ c2.T
            ids, raw, first, bits = [], [], [], []
            for n, q in enumerate(b.column(0).to_pylist()):
                for c, seconds in visit(s1[n], s2[n], counts, need).items():
                    ids.append(q)
                    raw.append(m[n].tobytes())
                    first.append(c)
                    bits.append(seconds - (1 << 64) if seconds >> 63 else seconds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(raw, pa.binary()), pa.array(first, pa.int32()), pa.array(bits, pa.int64())],
                ["query_id", "q", "c1", "bits"],
            )

    blocks = F.element_at(F.array(*[F.lit(int(max(1, -(-n // BLOCK_ROWS)))) for n in counts.sum(axis=1)]), F.col("c1") + 1)
    asks = asked.mapInArrow(traverse, "query_id bigint, q binary, c1 int, bits bigint")
    asks = asks.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int"))
    asks = asks.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    held = index.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), blocks).cast("int"))
    held = held.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    key = ["c1", "block", "chunk"]

    def meet(left, right):
        import pandas as pd

        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
        v = np.frombuffer(b"".join(left["v"]), np.float64).reshape(-1, dim)
        q = np.frombuffer(b"".join(right["q"]), np.float64).reshape(-1, dim)
        found = best_of_block(
            right["query_id"].to_numpy(), q, right["bits"].to_numpy(np.int64).view(np.uint64), left["vec_id"].to_numpy(), v, left["c2"].to_numpy(), k
        )
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found)))

    near = held.groupBy(*key).cogroup(asks.groupBy(*key)).applyInPandas(meet, out_schema)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
