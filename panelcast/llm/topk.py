"""Exact top-k inner-product search by multi-resolution segment statistics.

A vector is cut into segments of equal width w. With the segments' means m and deviations
s, the squared distance of two vectors is at least the sum over segments of
w * ((m - m')^2 + (s - s')^2). As a score is (|q|^2 + |v|^2 - distance^2) / 2, such a lower
bound on the distance is an upper bound on the score. Bounds are taken coarse to fine; a
pair goes on only while its bound reaches the query's k-th exact score found so far, and
exact scores are computed for the survivors.

Queries and candidates meet as blocks of bounded size (a grid of block pairs), so each
task holds two blocks whatever the table sizes; partial top-k rows are merged by a ranking
window that Spark limits before its shuffle.

Vectors that are null or hold a null or non-finite component take no part. Vectors of
unequal length compare as if the shorter were padded with zeros. Null ids take no part.
Repeated ids are separate rows; a query does not match rows of its own id. Ties go to the
smaller id. Empty input gives no rows.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare

#: Vectors in a block of queries or of candidates.
BLOCK = 4096
#: Segments per vector, coarse to fine.
RESOLUTIONS = (1, 4, 16)
#: Beyond this share of live pairs a level is computed densely.
DENSE = 0.2


def quantised(vectors: DataFrame, scale: int = 64, id_col: str = "vec_id",
              vec_col: str = "embedding") -> DataFrame:
    """(vec_id long, v array<double>) with v = floor(scale * x), valid vectors only."""
    odd = F.exists(F.col(vec_col), lambda x: x.isNull() | F.isnan(x)
                   | (F.abs(x) == F.lit(float("inf"))))
    return (vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull())
            .filter(~odd)
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(F.col(vec_col).cast("array<double>"),
                                lambda x: F.floor(F.lit(float(scale)) * x).cast("double")
                                ).alias("v")))


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column, zero-padded to ``width``."""
    rows = column.combine_chunks()
    offsets = np.asarray(rows.offsets)
    flat = np.asarray(rows.values)
    lengths = np.diff(offsets)
    out = np.zeros((len(rows), width))
    if len(rows) and (lengths == width).all():
        return flat[offsets[0]:offsets[-1]].reshape(-1, width).astype(np.float64)
    for i, (a, n) in enumerate(zip(offsets[:-1], lengths)):
        out[i, :n] = flat[a:a + n]
    return out


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each segment, scaled by sqrt(w): the product of two rows of
    features is (|q|^2 + |v|^2 - lower bound on distance^2) / 2."""
    n, d = x.shape
    w = -(-d // segments) if d else 1
    if segments * w != d:
        x = np.pad(x, ((0, 0), (0, segments * w - d)))
    cut = x.reshape(n, segments, w)
    return np.hstack([cut.mean(axis=2), cut.std(axis=2)]) * np.sqrt(w)


def exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products of paired rows; Python integers where int64 could overflow."""
    top = (np.abs(q).max(initial=0.0)) * (np.abs(c).max(initial=0.0)) * max(1, q.shape[1])
    if top < 2.0**53:
        return np.einsum("ij,ij->i", q, c).astype(np.int64)
    return np.array([sum(int(a) * int(b) for a, b in zip(x, y)) for x, y in zip(q, c)], object)


def search_block(q: np.ndarray, qid: np.ndarray, c: np.ndarray, cid: np.ndarray, k: int):
    """Top-k rows (query index, candidate index, score) of a block pair."""
    order = np.argsort(cid, kind="stable")
    c, cid = c[order], cid[order]
    small = np.abs(q).max(initial=0.0) * np.abs(c).max(initial=0.0) * max(1, q.shape[1]) < 2.0**53
    levels = [(segment_features(q, s), segment_features(c, s)) for s in RESOLUTIONS if s <= max(1, q.shape[1])]
    slack = 1e-9 * (1 + np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(c, axis=1).max(initial=0.0))
    out = []
    for lo in range(0, len(q), 256):
        rows = slice(lo, min(lo + 256, len(q)))
        nq, take = rows.stop - rows.start, min(k + 1, len(c))
        other = qid[rows, None] != cid[None, :]
        # first scores: the best bounds at the second resolution, computed exactly
        fq, fc = levels[min(1, len(levels) - 1)]
        bound = np.where(other, fq[rows] @ fc.T, -np.inf)
        best = np.argpartition(-bound, take - 1, axis=1)[:, :take]
        if small:
            seen = np.einsum("id,ikd->ik", q[rows], c[best])
        else:
            seen = np.einsum("id,ikd->ik", q[rows].astype(object), c[best].astype(object)).astype(float)
        seen = np.where(np.take_along_axis(other, best, 1), seen, -np.inf)
        floor = (np.sort(seen, axis=1)[:, take - k] if take >= k else np.full(nq, -np.inf))
        live = other
        for fq, fc in levels:
            need = floor[:, None] - slack[rows]
            if live.mean() > DENSE:
                live = live & (fq[rows] @ fc.T >= need)
            else:
                i, j = np.nonzero(live)
                keep = np.einsum("ij,ij->i", fq[rows][i], fc[j]) >= need[i, 0]
                live = np.zeros_like(live)
                live[i[keep], j[keep]] = True
        if small and live.mean() > DENSE:
            score = np.where(live, q[rows] @ c.T, -np.inf)
            if score.shape[1] > k:
                kth = -np.partition(-score, k - 1, axis=1)[:, k - 1]
                live &= score >= kth[:, None]
            i, j = np.nonzero(live)
            s = score[i, j].astype(np.int64)
        else:
            i, j = np.nonzero(live)
            s = exact(q[rows][i], c[j])
        rank = np.lexsort((j, -s, i)) if s.dtype != object else np.array(
            sorted(range(len(s)), key=lambda x: (i[x], -s[x], j[x])), np.int64)
        i, j, s = i[rank], j[rank], s[rank]
        start = np.searchsorted(i, i, "left")
        first = np.arange(len(i)) - start < k
        out.append((qid[rows][i[first]], cid[j[first]], s[first]))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.array([], np.int64)] * 3


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20, block: int = BLOCK) -> DataFrame:
    """(query_id long, rank int, vec_id long, score long): the k highest inner products of
    each query with every candidate but the rows of its own id.

    Both inputs: (vec_id long, v array<double>) with whole-number components.
    """
    spark = queries.sparkSession
    prepare(spark)
    nq = max(1, -(-queries.count() // block))
    nc = max(1, -(-candidates.count() // block))
    # every block of queries meets every block of candidates once
    left = (queries.withColumn("qb", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(nq)).cast("int"))
            .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(nc - 1)))))
    right = (candidates.withColumn("cb", F.pmod(F.xxhash64("vec_id"), F.lit(nc)).cast("int"))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1)))))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        width = max([0, *(pc.max(pc.list_value_length(t.column("v"))).as_py() or 0
                          for t in (a, b))])
        got = [np.array([], np.int64)] * 3
        if len(a) and len(b):
            got = search_block(matrix(a.column("v"), width), a.column("vec_id").to_numpy(),
                               matrix(b.column("v"), width), b.column("vec_id").to_numpy(), k)
        return pa.table({n: pa.array(x.tolist() if x.dtype == object else x, pa.int64())
                         for n, x in zip(("query_id", "vec_id", "score"), got)})
    part = (left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb"))
            .applyInArrow(run, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (part.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
