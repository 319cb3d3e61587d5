"""Near-duplicates by Jaccard likeness of word shingles: candidates from SimHash links and MinHash bands, then an exact check.

Texts with the same set of shingles share a key and meet as one. Fingerprints that the vantage-point trees link are candidates; as few pairs at the bound are that
close (see the README), bands find the others. A set has 40 bands of 5 MinHash values; sets that share a band are
candidates, so a pair at likeness 0.8 is missed with a chance of (1 - 0.8 ** 5) ** 40 = 1.3e-7, one at 0.9 with 1e-15.
Connected candidates meet in one task, each text once, where likenesses are counted from the whole sets and only pairs at or over the
bound are linked. A group of candidates that is too large for a task is cut into blocks, and each pair of blocks is a task; the links are joined afterwards.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronosift.llm.common import free_names, give_back, text_slices, written
from chronosift.llm.simhash import RADIUS, components, fingerprint, links

#: Words of a shingle, and the least likeness of linked texts in hundredths.
SHINGLE, PERCENT = 5, 80
BANDS, EACH = 40, 5

_RNG = np.random.default_rng(42)
_TIMES = _RNG.integers(0, 1 << 32, BANDS * EACH, dtype=np.uint32) | np.uint32(1)
_PLUS = _RNG.integers(0, 1 << 32, BANDS * EACH, dtype=np.uint32)
_IN_BAND = _RNG.integers(0, 1 << 63, (BANDS, EACH), dtype=np.uint64) | np.uint64(1)
_OF_BAND = _RNG.integers(0, 1 << 63, BANDS, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingles(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``shingle`` words; a shorter text is one run, one without words has none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(words) - shingle + 1
    out = np.zeros(n, np.uint64)
    for at in range(shingle):
        out = _mix(out + h[at : at + n])
    return np.unique(out)


def _least(marks: np.ndarray) -> np.ndarray:
    """The MinHash values of a set."""
    short = (marks >> np.uint64(32)).astype(np.uint32)
    out = np.full(BANDS * EACH, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 512):
        np.minimum(out, (short[at : at + 512, None] * _TIMES + _PLUS).min(axis=0), out=out)
    return out


def _bands(least: np.ndarray) -> np.ndarray:
    parts = least.reshape(-1, BANDS, EACH).astype(np.uint64)
    return _mix(_mix((parts * _IN_BAND).sum(axis=2, dtype=np.uint64) + _OF_BAND)).view(np.int64)


def groups_of(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """The index of the first member of each set's group; sets are linked where 100 |a & b| >= percent |a | b|.

    A member is compared with all sets of fitting size that have no group yet, so each set joins once, however many links it has.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    group = np.full(len(sets), -1)
    group[sizes == 0] = np.flatnonzero(sizes == 0)[:1].repeat((sizes == 0).sum())
    order = np.argsort(sizes, kind="stable")
    order = order[sizes[order] > 0]
    if not len(order):
        return group
    marks, ids = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    own = dict(zip(order.tolist(), np.split(ids, np.cumsum(sizes[order])[:-1]), strict=True))
    flag = np.zeros(len(marks), bool)
    free = order  # in order of size, as are the marks of these sets one after the other
    held, ends = ids, np.cumsum(sizes[free])
    for seed in range(len(sets)):
        if group[seed] >= 0:
            continue
        group[seed] = seed
        todo = [seed]
        while todo:
            i = todo.pop()
            left = group[free] < 0
            if left.sum() * 2 < len(free):
                free = free[left]
                held = np.concatenate([own[j] for j in free.tolist()]) if len(free) else ids[:0]
                ends = np.cumsum(sizes[free])
            n = sizes[free]
            lo, hi = np.searchsorted(n * 100, percent * sizes[i]), np.searchsorted(n * percent, 100 * sizes[i], "right")
            if hi <= lo:
                continue
            first = ends[lo] - n[lo]
            flag[own[i]] = True
            both = np.add.reduceat(flag[held[first : ends[hi - 1]]], ends[lo:hi] - n[lo:hi] - first, dtype=np.int64)
            flag[own[i]] = False
            found = free[lo:hi][(100 * both >= percent * (n[lo:hi] + sizes[i] - both)) & (group[free[lo:hi]] < 0)]
            group[found] = seed
            todo += found.tolist()
    return group


def _signed(rows: DataFrame, shingle: int) -> DataFrame:
    """id, th, key of the set, fingerprint and bands of every row with columns id, th and text."""

    def run(batches):
        for batch in batches:
            ths, at = batch.column(1), 0
            for ids, texts in text_slices([batch.select([0, 2])]):
                sets = [shingles(t, shingle) for t in texts]
                keys = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
                bands = _bands(np.array([_least(s) for s in sets]))
                listed = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel()))
                fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), ths.slice(at, len(ids)), pa.array(keys), pa.array(fps), listed], names=["id", "th", "key", "fp", "bands"])
                at += len(ids)
        give_back()

    return rows.mapInArrow(run, "id long, th long, key long, fp long, bands array<long>")


#: Rows of (id, hash, key, root) that are sent to all tasks at most: 32 MB. More are joined by a shuffle of the texts.
LIGHT = 1_000_000


def _light(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.limit(LIGHT + 1).count() <= LIGHT else rows


def _by_simhash(signed: DataFrame, radius: int) -> DataFrame:
    """(a, b): keys that connect those whose fingerprints are linked at ``radius`` bits: each with the smallest key of its fingerprint, and these along the links."""
    least = written(signed.groupBy("fp").agg(F.min("key").alias("low")), "fingerprints")
    own = signed.select("key", "fp").distinct().join(least, "fp").select(F.col("key").alias("a"), F.col("low").alias("b"))
    ends = [least.select(F.col("fp").alias(end), F.col("low").alias(f"low_{end}")) for end in "ab"]
    along = links(least.select("fp"), radius).join(ends[0], "a").join(ends[1], "b").select(F.col("low_a").alias("a"), F.col("low_b").alias("b"))
    return own.union(along)


def _linked(texts: DataFrame, shingle: int, percent: int, block_bytes: int, block_rows: int) -> DataFrame:
    """(key, root) of each text (key, root, text) but the smallest key of its linked group, and that key. ``root`` on the way in is the group of candidates."""

    def pair(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key")
        keys = pdf["key"].to_numpy(np.int64)
        group = groups_of([shingles(t or "", shingle) for t in pdf["text"]], percent)
        joined = group != np.arange(len(keys))
        give_back()
        return pd.DataFrame({"key": keys[joined], "root": keys[group[joined]]})

    size = F.greatest(F.ceil(F.sum(F.octet_length(F.coalesce("text", F.lit("")))) / block_bytes), F.ceil(F.count("*") / block_rows))
    large = written(texts.groupBy("root").agg(size.cast("int").alias("blocks")).where("blocks > 1"), "large-groups")
    if large.isEmpty():
        return written(texts.groupBy("root").applyInPandas(pair, "key long, root long"), "linked")
    n = F.coalesce("blocks", F.lit(1))
    cut = texts.join(large, "root", "left").select("root", "key", "text", F.pmod(F.xxhash64("key"), n).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), n - 1)).alias("other"))
    cut = cut.select("key", "root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "text")
    found = cut.groupBy("root", "i", "j").applyInPandas(pair, "key long, root long")
    return components(found.select(F.col("key").alias("a"), F.col("root").alias("b"))).select(F.col("a").alias("key"), F.col("b").alias("root"))


def keep_first(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 1 << 25, block_rows: int = 8192) -> DataFrame:
    """One row of ``docs`` for each group of rows that are linked, directly or over others, by likeness of their shingles.

    It is the row with the smallest id, nulls last, then with the smallest hash of its text; of the same id and text one stays. Rows that
    share an id but not a group stay both. Null, empty and blank texts are one group. An empty table gives an empty table. A task compares candidates of
    ``block_bytes`` and ``block_rows`` at most, or two such blocks of a larger group; one longer text is a block of its own.
    """
    th = free_names(docs, "th")[0]
    text_hash = F.xxhash64(F.col(text_col).cast("string"), F.lit(7))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_hash.alias("th"), F.col(text_col).cast("string").alias("text"))
    signed = written(_signed(rows, shingle), "sketches")
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th"))
    at = written(signed.groupBy("key").agg(least.alias("row")), "sets")
    banded = signed.select("key", F.explode("bands").alias("h"))
    shared = banded.groupBy("h").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high").select("h", "low")
    near = banded.join(shared, "h").where("key > low").select(F.col("key").alias("a"), F.col("low").alias("b"))
    placed = components(near.union(_by_simhash(signed, RADIUS)))
    placed = placed.select(F.col("a").alias("key"), F.col("b").alias("root")).union(placed.select(F.col("b").alias("key"), F.col("b").alias("root")).distinct())
    wanted = at.join(placed, "key").select("row.id", "row.th", "key", "root")
    wanted = _light(written(wanted, "wanted"))
    same = [rows["id"].eqNullSafe(wanted["id"]), rows["th"] == wanted["th"]]
    texts = rows.join(wanted, same).select("key", "root", "text").dropDuplicates(["key"])

    linked = _linked(texts, shingle, percent, block_bytes, block_rows)
    first = at.join(linked, "key", "left").groupBy(F.coalesce("root", "key")).agg(F.min("row").alias("row")).select("row.id", "row.th")
    kept = written(first, "first")
    same = [signed["id"].eqNullSafe(kept["id"]), signed["th"] == kept["th"]]
    gone = written(signed.join(kept, same, "left_anti").select("id", "th").distinct(), "gone")
    marked = docs.withColumn(th, text_hash)
    stays = marked.join(_light(gone), [marked[id_col].cast("long").eqNullSafe(gone["id"]), marked[th] == gone["th"]], "left_anti")
    twice = signed.groupBy("id", "th").agg(F.count("*").alias("n")).where("n > 1")
    if not twice.isEmpty():  # repeated rows: texts move only then
        stays = stays.dropDuplicates([id_col, th])
    return stays.select(*docs.columns)
