"""SimHash near-duplicates, paired exactly with vantage-point trees.

A tree cuts the Hamming space into shards: a node has a vantage point and a radius, fingerprints within the radius go inside, the
others outside. By the triangle bound a pair at distance <= r can be parted only if the inner one is within r of the boundary; such
fingerprints are sent to both sides. So every pair meets in some shard. Shards that are too large grow a subtree, from vantage
points sampled among their own, until all fit; one that no vantage point cuts is compared in blocks, each pair of blocks a task. A shard finds its pairs exactly, with two more vantage points to skip what the bounds exclude, and gives
one link for each fingerprint to its group there, never all pairs. Groups of shards are joined by large-star and
small-star rounds over the links.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronosift.llm.common import give_back, id_text, text_slices, written

#: Words of a shingle, and differing bits of linked fingerprints.
SHINGLE, RADIUS = 3, 3
#: The share of a shard's rows that each side of a vantage point gets: half, and those near the boundary.
SHRINK = 0.665


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 bits: bit b is set where more than half of the shingles' XXH64 (seed 42) have it; 0 for a text without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    whole = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    size = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(size + 1) - size - 1
    end = (start + size)[len(words) - n :]
    hashed = xxhash.xxh64_intdigest
    marks = zip(start[:n].tolist(), end.tolist(), strict=True)
    h = np.fromiter((hashed(whole[a:b], 42) for a, b in marks), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        part = h[at : at + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long) of every whole text; null and empty texts have 0."""

    def run(batches):
        for ids, texts in text_slices(batches):
            made = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(made.view(np.int64))], names=["doc_id", "fp"])
        give_back()

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def plant(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and radii of ``depth`` levels in heap order, fitted to a sample of a shard's fingerprints."""
    point = np.zeros((1 << depth) - 1, np.uint64)
    cut = np.full((1 << depth) - 1, 64, np.int64)
    rows = [sample]
    for node in range(len(point)):
        own = rows[node]
        if len(own) > 1:
            # the vantage point whose distances spread most: fewest fingerprints near the boundary
            tries = own[np.linspace(0, len(own) - 1, 8).astype(int)]
            apart = np.bitwise_count(own[None, :] ^ tries[:, None]).astype(np.int64)
            best = int(apart.std(axis=1).argmax())
            point[node], cut[node] = tries[best], int(np.median(apart[best]))
        inside = np.bitwise_count(own ^ point[node]) <= cut[node]
        rows += [own[inside], own[~inside]]
    return point, cut


class Tree:
    """Vantage points with a radius each, and where their two sides lead: to a node, or (negative) to a shard. It starts as one shard, -1."""

    def __init__(self, radius: int) -> None:
        self.radius, self.root, self.last = radius, -1, -1
        self.point, self.cut = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.sides = np.zeros((0, 2), np.int64)  # inside, outside

    def grow(self, shard: int, point: np.ndarray, cut: np.ndarray) -> list[int]:
        """Put a subtree in heap order in the place of a shard; the new shards."""
        at, n = len(self.point), len(point)
        child = 2 * np.arange(n)[:, None] + [1, 2]
        new = [self.last - 1 - i for i in range(n + 1)]
        sides = np.where(child < n, child + at, np.array(new)[np.clip(child - n, 0, n)])
        if self.root == shard:
            self.root = at
        self.sides[self.sides == shard] = at
        self.point, self.cut, self.sides = np.concatenate([self.point, point]), np.concatenate([self.cut, cut]), np.concatenate([self.sides, sides])
        self.last = new[-1]
        return new

    def route(self, fps: np.ndarray, start: np.ndarray | int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(index, shard) for every shard that each fingerprint goes to, from the root or from the nodes ``start``."""
        index, node = np.arange(len(fps)), np.full(len(fps), self.root) if start is None else np.broadcast_to(start, len(fps))
        ended: list[tuple[np.ndarray, np.ndarray]] = []
        while len(node):
            there = node < 0
            ended.append((index[there], node[there]))
            index, node = index[~there], node[~there]
            d = np.bitwise_count(fps[index] ^ self.point[node]).astype(np.int64)
            inside = d <= self.cut[node]
            both = inside & (d > self.cut[node] - self.radius)
            node, index = np.concatenate([self.sides[node, 1 - inside], self.sides[node[both], 1]]), np.concatenate([index, index[both]])
        return np.concatenate([i for i, _ in ended]), np.concatenate([n for _, n in ended])


def _spread(x: np.ndarray) -> np.ndarray:
    """Fingerprints spread evenly over 64 bits, for samples and blocks."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def groups_within(fps: np.ndarray, radius: int) -> np.ndarray:
    """For distinct fingerprints, the index of the first member of each one's group under links at <= radius.

    Two vantage points bound distances from below: only stripes whose distances to both differ by the radius or less are
    compared. Work is in blocks; no list of all pairs is made.
    """
    n = len(fps)
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    if n < 2:
        return np.arange(n)
    d1 = np.bitwise_count(fps ^ fps[0]).astype(np.int64)
    far = fps[int(np.abs(d1 - 32).argmin())]
    d2 = np.bitwise_count(fps ^ far).astype(np.int64)
    order = np.lexsort((d2, d1))
    x, a, b = fps[order], d1[order], d2[order]
    label = np.arange(n)  # of the sorted ones; refreshed from parent
    starts = np.searchsorted(a, np.arange(66 + radius))

    def join(rows: np.ndarray, cols: np.ndarray) -> None:
        """Link the pairs of two runs of sorted places."""
        for at in range(0, len(rows), 256):
            r = rows[at : at + 256]
            close = np.bitwise_count(x[r][:, None] ^ x[cols][None, :]) <= radius
            while True:
                close &= label[r][:, None] != label[cols][None, :]
                hit = np.flatnonzero(close.any(axis=0))
                if not len(hit):
                    break
                for i, j in zip(r[close[:, hit].argmax(axis=0)].tolist(), cols[hit].tolist(), strict=True):
                    i, j = root(i), root(j)
                    if i != j:
                        parent[max(i, j)] = min(i, j)
                for run in (r, cols):
                    label[run] = [root(i) for i in run.tolist()]

    for v in range(65):
        own = np.arange(starts[v], starts[v + 1])
        if not len(own):
            continue
        stripe = np.arange(starts[v], starts[min(v + radius + 1, 65 + radius)])
        stripe = stripe[np.argsort(b[stripe], kind="stable")]
        at = b[stripe]
        for w in np.unique(b[own]):
            rows = own[b[own] == w]
            lo, hi = np.searchsorted(at, [w - radius, w + radius + 1])
            join(rows, stripe[lo:hi])
    roots = np.array([root(i) for i in range(n)])
    first = np.full(n, n)
    np.minimum.at(first, roots, order)
    out = np.empty(n, np.int64)
    out[order] = first[roots]
    return out


def _drawing(share: dict[int, float]):
    """Keeps rows (shard, fp) with the shard's chance, by hash."""

    def run(frames):
        for pdf in frames:
            even = (_spread(pdf["fp"].to_numpy(np.int64).view(np.uint64)) >> np.uint64(11)).astype(float) * 2.0**-53
            yield pdf[even < pdf["shard"].map(share)]

    return run


def _sending(tree: Tree, entry: dict[int, int]):
    """Rows (shard, fp) to the shards of the subtree that their shard has grown."""

    def run(batches):
        for batch in batches:
            shard, own = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            names, at = np.unique(shard, return_inverse=True)
            index, to = tree.route(own.view(np.uint64), np.array([entry[s] for s in names.tolist()], np.int64)[at])
            yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(own[index])], names=["shard", "fp"])

    return run


def _planting(depth: dict[int, int]):
    """A subtree for the sample of one shard."""

    def run(key, pdf):
        point, cut = plant(np.sort(pdf["fp"].to_numpy(np.int64)).view(np.uint64), depth[key[0]])
        return pd.DataFrame({"shard": key[0], "point": [point.view(np.int64).tolist()], "cut": [cut.tolist()]})

    return run


def links(fps: DataFrame, radius: int = RADIUS, shard_rows: int = 100_000, sample_rows: int = 16_384) -> DataFrame:
    """Links (a, b), a > b, whose connected groups are those of all pairs of distinct fp at <= radius.

    ``fps`` has one column fp of distinct longs. Shards hold ``shard_rows`` at most (a second of comparing), or ``sample_rows`` rows are drawn of each that doesn't (by hash, in one task a
    shard) and it grows a subtree; its rows are dealt anew and written. The driver holds the tree only: 32 bytes for each shard. A shard that a subtree leaves whole is compared in blocks.
    """
    tree, blocks, done = Tree(radius), {}, []
    n = fps.count()
    placed = fps.select(F.lit(-1).cast("long").alias("shard"), "fp")
    size = {-1: n} if n > shard_rows else {}
    while size:
        share = {s: min(1.0, sample_rows / n) for s, n in size.items()}
        depth = {s: int(np.clip(np.ceil(np.log(n / shard_rows) / -np.log(SHRINK)), 1, np.log2(max(128, sample_rows) / 64))) for s, n in size.items()}
        big = F.broadcast(fps.sparkSession.createDataFrame([(s,) for s in size], "shard long"))  # shards, not rows
        over = placed.join(big, "shard")
        found = over.mapInPandas(_drawing(share), "shard long, fp long").groupBy("shard").applyInPandas(_planting(depth), "shard long, point array<long>, cut array<long>")
        came: dict[int, int] = {}
        entry: dict[int, int] = {}
        for r in sorted(found.collect(), key=lambda r: r.shard):
            entry[r.shard] = len(tree.point)
            came.update(dict.fromkeys(tree.grow(r.shard, np.array(r.point, np.int64).view(np.uint64), np.array(r.cut, np.int64)), r.shard))
        blocks.update({s: int(-(-2 * n // shard_rows)) for s, n in size.items() if s not in entry})
        grown = F.broadcast(fps.sparkSession.createDataFrame([(s,) for s in entry], "shard long"))
        done.append(placed.join(grown, "shard", "left_anti"))
        placed = written(placed.join(grown, "shard").mapInArrow(_sending(tree, entry), "shard long, fp long"), "shards")
        now = {r["shard"]: r["count"] for r in placed.groupBy("shard").count().where(F.col("count") > shard_rows).collect()}
        stuck = {s: n for s, n in now.items() if n > 0.9 * size[came[s]]}
        blocks.update({s: int(-(-2 * n // shard_rows)) for s, n in stuck.items()})
        size = {s: n for s, n in now.items() if s not in stuck}
    sent = functools.reduce(DataFrame.union, [*done, placed])

    def paired(frames):
        """Rows of shards to compare in blocks go to every pair of blocks that theirs is in; block numbers follow the hash."""
        for pdf in frames:
            n = pdf["shard"].map(blocks).fillna(1).to_numpy(np.int64)
            own = (_spread(pdf["fp"].to_numpy(np.int64).view(np.uint64)) % n.astype(np.uint64)).astype(np.int64)
            at = np.repeat(np.arange(len(pdf)), n)
            other = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            yield pd.DataFrame({"shard": pdf["shard"].to_numpy()[at], "i": np.minimum(own[at], other), "j": np.maximum(own[at], other), "fp": pdf["fp"].to_numpy()[at]})

    def pair(pdf: pd.DataFrame) -> pd.DataFrame:
        own = np.sort(pdf["fp"].to_numpy(np.int64))
        group = groups_within(own.view(np.uint64), radius)
        joined = group != np.arange(len(own))
        give_back()
        return pd.DataFrame({"a": own[joined], "b": own[group[joined]]})

    sent = sent.mapInPandas(paired, "shard long, i long, j long, fp long") if blocks else sent.select("shard", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp")
    return sent.groupBy("shard", "i", "j").applyInPandas(pair, "a long, b long")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(a, b): each linked vertex but the smallest of its connected group, and that smallest one.

    Alternates large-star and small-star steps until nothing changes; each round is written, so that plans stay short and
    lost executors cost one round. A vertex with very many neighbours is only ever summed and joined.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    seen = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a")
        small = moved.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).distinct()
        edges = written(small, "small")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if now == seen:
            return edges
        seen = now
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id reachable over links) of every row.

    Texts without words have fingerprint 0 and are linked like any other. Repeated rows share a component. Rows without a
    doc_id take part; a component of such rows alone has a null id. An empty table gives an empty table. Copies share a
    fingerprint and meet as one row in the search.
    """
    marked = written(fingerprints(docs, shingle, id_col, text_col), "simhash")
    least = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fp")
    group = components(links(least.select("fp"), radius)).select(F.col("a").alias("fp"), F.col("b").alias("root"))
    placed = least.join(group, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(named, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component; of repeated rows with that id one stays.

    Rows without an id go, as they can't be named as the first. Texts are shuffled once, by id.
    """
    found = near_duplicates(docs, shingle, radius, id_col)
    first = found.where(F.col("component_id") == F.col("doc_id")).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(first.hint("shuffle_hash"), id_col, "left_semi").dropDuplicates([id_col])


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
