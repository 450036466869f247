"""Exact top-k inner products with a pivot-distance index.

Components are whole numbers (floor of 1024 x). With M the largest norm, every vector x gets one more
component sqrt(M^2 - |x|^2) and every query a 0: the distance d of the two then gives the inner product,
2 q.x = |q|^2 + M^2 - d^2, so the largest products are the nearest vectors.

The index keys every vector by its nearest pivot and by the annulus its distance falls in. Pivots and
annuli are fitted on a bounded sample; every vector is indexed. There are about sqrt(n) / 8 pivots, up to PIVOTS
(their bound and the sample's are what the driver holds). For a query, the annuli are sorted by the
least distance the triangle inequality allows, max(d(q, p) - outer, inner - d(q, p)). The first ones, until
they hold k vectors, are searched to get a k-th score; then all others whose bound can still reach it,
the search stops at the bound. Scores are computed exactly, so the result is exact.

How much the bounds skip depends on the vectors alone: clustered ones leave few blocks, vectors without any
structure leave all of them, and then the search is exact by brute force (README has figures).

Vectors and queries meet in blocks: a cell (pivot, annulus) is split by a hash into parts of some
thousand vectors and queries into parts of some thousand, so a vector that a third of all rows repeat is
no large group.

Ties: the smaller vector id is the better one, among equal scores of a vector repeated under one id each row counts.

Vectors that are null, or hold null or non-finite components, and rows without id take no part. Missing
components of shorter vectors count as 0. Scores beyond 64 bits are clipped. Repeated ids: each row is
a candidate, and one query runs for an id, that with the least vector. Fewer than k candidates: all of them. Empty tables: empty
result. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

#: Rows of the sample that fits pivots and annuli; pivots, annuli of each, vectors and queries of a block.
SAMPLE, PIVOTS, RINGS, BLOCK, QUERIES = 8192, 1024, 8, 4096, 4096
#: Queries of a block that are scored at once, so that their scores take 16 MB.
AT_ONCE = 512
_KIND = "id long, vec binary"


@dataclass(frozen=True)
class Index:
    """What a search has to know: at most PIVOTS x RINGS cells."""

    dim: int
    top: float
    pivots: np.ndarray
    edges: np.ndarray
    cell: np.ndarray
    count: np.ndarray
    parts: np.ndarray
    inner: np.ndarray
    outer: np.ndarray

    def cells_of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance to its pivot) of rows of x."""
        rest = np.sqrt(np.maximum(self.top**2 - (x**2).sum(1), 0.0))
        d = _distances(np.column_stack((x, rest)), self.pivots)
        near = d.argmin(1)
        own = d[np.arange(len(x)), near]
        ring = (own[:, None] > self.edges[near]).sum(1)
        return near * RINGS + ring, own

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Largest inner product that each cell can give with each row of q."""
        d = _distances(np.column_stack((q, np.zeros(len(q)))), self.pivots)[:, self.cell // RINGS]
        slack = 1e-7 * (1 + self.top)
        least = np.maximum(np.maximum(d - self.outer, self.inner - d) - slack, 0.0)
        return ((q**2).sum(1)[:, None] + self.top**2 - least**2) / 2 * (1 + 1e-9) + 1


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    # differences, not products: near vectors of large norm keep their digits
    out = np.empty((len(x), len(p)))
    for j, row in enumerate(p):
        out[:, j] = np.sqrt(((x - row) ** 2).sum(1))
    return out


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim))
    for i, raw in enumerate(column.to_pylist()):
        own = np.frombuffer(raw, "<f8")
        out[i, : len(own)] = own
    return out


def whole_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, vec): floor(scale * x) as doubles in bytes, of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, out = [], []
            for row in batch.column(1).to_pylist():
                x = np.floor(scale * np.array(row, float))
                keep.append(bool(np.isfinite(x).all()))
                out.append(x.astype("<f8").tobytes())
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), pa.array(out, pa.binary()).filter(mask)], ["id", "vec"])

    x = F.col(vec_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).filter(F.col("id").isNotNull() & F.col("x").isNotNull() & ~F.coalesce(F.exists("x", lambda v: v.isNull()), F.lit(False)))
    return rows.mapInArrow(run, _KIND)


def _pick_pivots(x: np.ndarray, n: int) -> np.ndarray:
    """Centres of a few rounds of nearest-centre means, started from spread-out rows."""
    chosen = [0]
    d = _distances(x, x[:1])[:, 0]
    while len(chosen) < n and d.max() > 0:
        chosen.append(int(d.argmax()))
        d = np.minimum(d, _distances(x, x[chosen[-1] :][:1])[:, 0])
    centres = x[chosen]
    for _ in range(5):
        near = _distances(x, centres).argmin(1)
        centres = np.array([x[near == j].mean(0) if (near == j).any() else centres[j] for j in range(len(centres))])
    return centres


def build(vectors: DataFrame) -> tuple[Index, DataFrame]:
    """The index of written vectors, and (id, vec, cell, part) for all of them."""

    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).to_pylist()
            norm = max((float((np.frombuffer(x, "<f8") ** 2).sum()) for x in raw), default=0.0)
            yield pa.RecordBatch.from_arrays([pa.array([len(raw)], pa.int64()), pa.array([max(map(len, raw), default=0) // 8], pa.int64()), pa.array([norm], pa.float64())], ["n", "dim", "norm"])

    total = vectors.mapInArrow(size, "n long, dim long, norm double").agg(F.sum("n").alias("n"), F.max("dim").alias("dim"), F.max("norm").alias("norm")).first()
    n, dim, top = total["n"] or 0, total["dim"] or 0, float(np.sqrt(total["norm"] or 0.0))
    share = min(1.0, SAMPLE / max(1, n))
    sample = vectors.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < max(1, int(share * 1_000_000))).select("vec").limit(2 * SAMPLE).collect() or vectors.select("vec").limit(1).collect()
    x = np.zeros((len(sample), dim))
    for i, r in enumerate(sample):
        own = np.frombuffer(bytes(r["vec"]), "<f8")
        x[i, : len(own)] = own
    x = np.column_stack((x, np.sqrt(np.maximum(top**2 - (x**2).sum(1), 0.0))))
    pivots = _pick_pivots(np.unique(x, axis=0), max(1, min(PIVOTS, round(n**0.5 / 8)))) if len(x) else np.zeros((1, dim + 1))
    d = _distances(x, pivots)
    near = d.argmin(1) if len(x) else np.zeros(0, int)
    quantiles = np.arange(1, RINGS) / RINGS
    edges = np.array([np.quantile(own, quantiles) if len(own := d[near == j, j]) else np.zeros(RINGS - 1) for j in range(len(pivots))])
    empty = np.zeros(0)
    draft = Index(dim, top, pivots, edges, empty, empty, empty, empty, empty)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, own = draft.cells_of(_matrix(batch.column(1), dim))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int64()), pa.array(own, pa.float64())], ["id", "vec", "cell", "distance"])

    keyed = written(vectors.mapInArrow(key, f"{_KIND}, cell long, distance double"), "cells")
    found = sorted(keyed.groupBy("cell").agg(F.count("*").alias("n"), F.min("distance").alias("lo"), F.max("distance").alias("hi")).collect())
    cell, count, lo, hi = (np.array([r[i] for r in found]) for i in range(4))
    parts = -(-count.astype(np.int64) // BLOCK)
    index = Index(dim, top, pivots, edges, cell.astype(np.int64), count, parts, lo.astype(float), hi.astype(float))
    table = vectors.sparkSession.createDataFrame([(int(c), int(p)) for c, p in zip(cell, parts, strict=True)], "cell long, parts long")
    placed = keyed.join(F.broadcast(table), "cell")  # PIVOTS x RINGS rows at most
    return index, placed.select("id", "vec", "cell", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"))


def _needs(queries: DataFrame, index: Index, k: int, second: bool) -> DataFrame:
    """(id, vec, group, cell, part) of the blocks each query has to meet. First: the nearest annuli that hold k others. Second: what the bound leaves; queries then carry their k-th score as `kth`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                if not len(index.cell):
                    return
                bound = index.bounds(_matrix(batch.column(1), index.dim))
                order = np.argsort(-bound, axis=1, kind="stable")
                held = np.cumsum(index.count[order], axis=1)
                early = np.concatenate((np.ones((len(order), 1), bool), held[:, :-1] < k + 1), axis=1)
                first = np.zeros_like(early)
                np.put_along_axis(first, order, early, 1)
                if second:
                    kth = np.array([-np.inf if v is None else float(v) for v in batch.column(3).to_pylist()])
                    first = ~first & (bound >= kth[:, None])
                q, c = np.nonzero(first)
                times = index.parts[c]
                q, cell = np.repeat(q, times), np.repeat(index.cell[c], times)
                part = np.arange(len(q)) - np.repeat(np.cumsum(times) - times, times)
                take = pa.array(q)
                yield pa.RecordBatch.from_arrays([*(x.take(take) for x in batch.columns[:3]), pa.array(cell), pa.array(part)], ["id", "vec", "grp", "cell", "part"])

    return queries.mapInArrow(run, f"{_KIND}, grp long, cell long, part long")


def _scores(vectors: DataFrame, needs: DataFrame, index: Index, k: int) -> DataFrame:
    """(query, vec_id, score): the k best of each query in each block."""
    key = ["cell", "part", "grp"]

    def best(one: pa.Table, two: pa.Table) -> pa.Table:
        ids, queries = one["id"].to_numpy(), two["id"].to_numpy()
        out: tuple[list, list, list] = ([], [], [])
        if len(ids) and len(queries):
            x, q = _matrix(one["vec"], index.dim), _matrix(two["vec"], index.dim)
            by_id = np.argsort(ids, kind="stable")
            ids, x = ids[by_id], x[by_id]
            small = np.abs(x).max(initial=0) * np.abs(q).max(initial=0) * max(1, index.dim) < 2**52
            for i, query in enumerate(queries):
                if i % AT_ONCE == 0:
                    some = q[i : i + AT_ONCE]
                    if small:
                        score = (some @ x.T).astype(np.int64)
                    else:  # whole numbers without limit, then clipped
                        a, b = (np.array([[int(v) for v in row] for row in m], object) for m in (some, x))
                        score = np.array([[max(min(int(v), 2**63 - 1), -(2**63)) for v in row] for row in a @ b.T], np.int64)
                row, own = (score[i % AT_ONCE], ids) if query not in ids else (score[i % AT_ONCE][ids != query], ids[ids != query])
                at = np.arange(len(row))
                if len(row) > k:
                    at = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k])
                at = at[np.argsort(-row[at].astype(object) if len(row) and row.min() == -(2**63) else -row[at], kind="stable")][:k]
                out[0].extend([query] * len(at))
                out[1].extend(own[at].tolist())
                out[2].extend(row[at].tolist())
        return pa.table([pa.array(c, pa.int64()) for c in out], ["query", "vec_id", "score"])

    wanted = needs.select(*key).distinct().toDF("c", "p", "grp")
    left = vectors.join(wanted, (F.col("cell") == F.col("c")) & (F.col("part") == F.col("p"))).select("id", "vec", *[F.col(n).alias(f"own_{n}") for n in key])
    return left.groupBy(*[f"own_{n}" for n in key]).cogroup(needs.groupBy(*key)).applyInArrow(best, "query long, vec_id long, score long")


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return scores.withColumn("rank", rank).filter(F.col("rank") <= k)


def top_k(df: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024) -> DataFrame:  # noqa: ANN001
    """(query_id, rank, vec_id, score): for each row where is_query (a column of `id`) holds, its k best others."""
    index, vectors = build(written(whole_vectors(df, id_col, vec_col, scale), "vectors"))
    queries = vectors.filter(is_query).groupBy("id").agg(F.min("vec").alias("vec"))
    groups = max(1, -(-queries.count() // QUERIES))
    queries = written(queries.withColumn("grp", F.pmod(F.xxhash64("id"), F.lit(groups))), "queries")
    first = written(_ranked(_scores(vectors, _needs(queries, index, k, False), index, k), k), "first")
    kth = first.filter(F.col("rank") == k).select(F.col("query").alias("id"), F.col("score").alias("kth"))
    rest = _scores(vectors, _needs(queries.join(kth, "id", "left").select("id", "vec", "grp", "kth"), index, k, True), index, k)
    both = first.select("query", "vec_id", "score").unionByName(rest)
    return _ranked(both, k).select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")
