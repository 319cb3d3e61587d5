"""Exact top-k by inner product with no-random-access aggregation.

Each component is a list of candidates sorted by value; a query reads a list from the end that its weight favours, step by step. What a
candidate has in the lists read so far is summed; the rest lies between the last value read and the far end of each list, which bounds its score from
below and above. Each step reads on in the lists that leave most open. Reading stops once no outsider's upper bound reaches the k-th lower bound, or
only few can; their scores are then resolved.

Candidates stay where they are, in blocks whose lists are sorted once. Queries come to them in broadcast groups of a bounded size, and a task carries each
query's k best scores from block to block, so that blocks are left early. A task's first candidates, a bounded number, are resolved without lists, for scores to beat.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronosift.llm.common import written

#: The share of the lists read at first, in a task's first block.
FIRST = 1 / 16
#: Candidates of a task that are resolved first, at most; in a small table a sixteenth of it.
FIRST_ROWS = 2048


def quantised(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component, x as double; null unless all are finite (an empty vector is not a vector)."""
    wide = vector.cast("array<double>")
    fine = (F.size(wide) > 0) & ~F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # floor gives a long; beyond its range the double itself is whole
    return F.when(fine, F.transform(wide, lambda x: F.when(F.abs(x * scale) < 2.0**52, F.floor(x * scale).cast("double")).otherwise(x * scale)))


def _scores(x: np.ndarray, q: np.ndarray) -> list[int]:
    """Exact integer scores; beyond 2**63 they are held at the ends of the range."""
    bound = float(np.abs(x).max(initial=0) * np.abs(q).max(initial=0) * max(1, x.shape[1]))
    if bound < 2.0**53:
        return (x @ q).astype(np.int64).tolist()
    whole = [int(v) for v in q]
    return [max(-(1 << 63), min((1 << 63) - 1, sum(int(a) * b for a, b in zip(row, whole, strict=True)))) for row in x]


class Block:
    """Candidates of a block, and their sorted lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        down = np.argsort(-vectors, axis=0, kind="stable").T
        self.order = np.ascontiguousarray(np.stack([down, down[:, ::-1]]))  # list by list, from the top and from the bottom
        self.values = np.take_along_axis(vectors.T[None], self.order, axis=2)
        self.read = self.resolved = 0  # list entries read, products computed for scores

    def search(self, query_id: int, query: np.ndarray, k: int, best: list[tuple[int, int]], start: float = FIRST) -> tuple[list[tuple[int, int]], float]:
        """(-score, id) of the k best among ``best`` and this block, equal scores by smaller id, the query's own row left out; and how much
        of the lists to read at first next time: a little less than what sufficed, or a little more than what steps ended with. ``start`` is that share now."""
        n = len(self.ids)
        used = np.flatnonzero(query)
        weight = query[used]
        side = (weight < 0).astype(np.int64)  # the end that each list is read from
        far = weight * self.values[side, used, n - 1]
        big = float(np.abs(far).sum() + np.abs(weight * self.values[side, used, 0]).sum())
        slack = 0.0 if big < 2.0**53 else big * 1e-12  # beyond 2**53 bounds are rounded; they then keep more
        full = len(best) >= k
        least = -best[k - 1][0] if full else -np.inf
        upper = np.zeros(n)  # what a candidate has above the last values read
        lower = np.zeros(n)  # what it has above the far ends
        depth = np.zeros(len(used), np.int64)
        last = weight * self.values[side, used, 0]  # the most that an unread entry adds
        deepen, to = np.arange(len(used)), min(n, max(1, math.ceil(start * n)))
        few = max(4 * k, n // 50)
        steps = 0
        while True:
            steps += 1
            groups = [(deepen, to)] if np.isscalar(to) else [(deepen[to == t], int(t)) for t in np.unique(to)]
            for lists, end in groups:
                rows = self.order[side[lists], used[lists], :end].ravel()
                adds = self.values[side[lists], used[lists], :end]
                adds *= weight[lists, None]
                now = adds[:, -1].copy() if end < n else far[lists]
                if not full:
                    fresh = np.arange(end)[None, :] >= depth[lists][:, None]
                    lower += np.bincount(rows, ((adds - far[lists][:, None]) * fresh).ravel(), n)
                # entries read before rise by how far the last value fell, new ones by what they have above it
                if depth[lists].any():
                    np.minimum(adds, last[lists, None], out=adds)
                adds -= now[:, None]
                upper += np.bincount(rows, adds.ravel(), n)
                self.read += int((end - depth[lists]).sum())
                depth[lists], last[lists] = end, now
            top = upper + last.sum()
            top[self.ids == query_id] = -np.inf
            if not full:
                bottom = lower + far.sum()
                bottom[self.ids == query_id] = -np.inf
                least = np.partition(bottom, n - k)[n - k] if n > k else -np.inf
            rows = np.flatnonzero((top >= least - slack) & (top > -np.inf))
            open_ = last - far
            if len(rows) <= few or not open_.any():
                break
            # the lists that hold half of what is open, the widest first
            order = np.argsort(-open_, kind="stable")
            deepen = order[: int(np.searchsorted(np.cumsum(open_[order]), open_.sum() / 2)) + 1]
            deepen = deepen[depth[deepen] < n]
            to = np.minimum(n, np.maximum(depth[deepen] + max(1, n // 16), (depth[deepen] * 5) // 4))
        self.resolved += len(rows) * len(used)
        found = zip([-v for v in _scores(self.vectors[rows], query)], self.ids[rows].tolist(), strict=True)
        return sorted([*best, *found])[:k], float(depth.mean()) / n * (0.98 if steps == 1 else 1.01) if len(used) else start


def resolved(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, query: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
    """(-score, id) of the k best of all candidates for each query, equal scores by smaller id, the query's own row left out."""
    out = []
    for at in range(0, len(query), 256):
        some = query[at : at + 256]
        exact = float(np.abs(vectors).max(initial=0) * np.abs(some).max(initial=0) * max(1, vectors.shape[1])) < 2.0**53
        scores = some @ vectors.T if exact else None
        for i, q in enumerate(query_ids[at : at + 256]):
            own = scores[i] if exact else np.array(_scores(vectors, some[i]), object)
            rows = np.flatnonzero(ids != q)
            if exact and len(rows) > k:
                least = np.partition(own[rows], len(rows) - k)[len(rows) - k]
                rows = rows[own[rows] >= least]
            out.append(sorted((-int(own[j]), int(ids[j])) for j in rows)[:k])
    return out


def _matrix(vectors: list[list[float]], dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims))
    for i, x in enumerate(vectors):
        out[i, : len(x)] = x
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding", cand_rows: int = 4096, query_rows: int = 16_384) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest integer inner products of each query over all other rows.

    Queries are the rows where ``is_query`` holds. Equal scores rank by smaller vec_id; with fewer than k others all are
    given. Vectors that are null, empty or hold null or non-finite components take no part, nor do rows without id; shorter vectors count as
    padded with 0. A repeated id is a row each as candidate; as query only one (the smallest vector) is answered, and none of its
    own rows is its candidate. An empty table gives an empty table.

    Work grows with queries times rows, as the task does. Groups of ``query_rows`` queries, by hash, are sent to all tasks (8 bytes a component) one group
    after the other; a task holds a block of ``cand_rows`` candidates and k results for each query of the group, and what leaves it is k rows a query.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), is_query.alias("q"), quantised(F.col(vector_col), scale).alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    n, n_query, dims = rows.agg(F.count("*"), F.count(F.when(F.col("q"), 1)), F.max(F.size("v"))).first()
    dims, groups = dims or 0, max(1, -(-(n_query or 0) // query_rows))
    spark = vectors.sparkSession

    def found_by(group: int) -> DataFrame:
        own = rows.where("q").where(F.pmod(F.xxhash64("id"), F.lit(groups)) == group).groupBy("id").agg(F.min("v").alias("v")).orderBy("id").collect()
        sent = spark.sparkContext.broadcast(([r.id for r in own], _matrix([r.v for r in own], dims)))

        def search(batches):
            ids, query = sent.value
            best: list[list[tuple[int, int]]] = [[] for _ in ids]
            depth = [FIRST] * len(ids)

            def take(held_ids, held):
                nonlocal best, most
                if most < cand_rows:
                    best, most = resolved(np.array(held_ids, np.int64), _matrix(held, dims), np.array(ids, np.int64), query, k), cand_rows
                    return
                block, common = Block(np.array(held_ids, np.int64), _matrix(held, dims)), 0.0
                for i, q in enumerate(ids):
                    best[i], reached = block.search(q, query[i], k, best[i], max(depth[i], common))
                    # queries and blocks are alike: the next is read nearly as far at once
                    common = 0.0 if depth[i] > FIRST else reached
                    depth[i] = max(FIRST, min(1.0, reached))

            most = max(1, min(cand_rows - 1, FIRST_ROWS, n // 16))
            held_ids, held = [], []
            for batch in batches:
                at = 0
                while at < batch.num_rows:
                    part = batch.slice(at, most - len(held))
                    at += part.num_rows
                    held_ids += part.column(0).to_pylist()
                    held += part.column(1).to_pylist()
                    if len(held) >= most:
                        take(held_ids, held)
                        held_ids, held = [], []
            if held:
                take(held_ids, held)
            out = [(q, v, -score) for q, own in zip(ids, best, strict=True) for score, v in own]
            for at in range(0, len(out), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out[at : at + 100_000], strict=True)], names=["query_id", "vec_id", "score"])

        return rows.select("id", "v").mapInArrow(search, "query_id long, vec_id long, score long")

    found = functools.reduce(DataFrame.union, [written(found_by(g), "best") if groups > 1 else found_by(g) for g in range(groups)])
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
