"""Document fingerprints by winnowing.

Every k-gram of a text gets a rolling (polynomial) hash; of each window of ``w`` consecutive k-grams the smallest hash
is chosen, the rightmost of equals; choices and their positions make the fingerprint. Two texts that share w + k - 1
characters in a row share a choice.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronosift.llm.common import id_text, text_slices

K, W = 8, 32
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def winnow(text: str, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes (32 bits, as uint64) and their positions, ascending.

    A text shorter than k has the hash of the whole as its one k-gram, one with fewer than w k-grams one window; an empty one has none.
    """
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    n = len(code)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k = min(k, n)
    with np.errstate(over="ignore"):
        h, have, grams = (code + np.uint64(1)) * _MIX, 1, None
        done = 0
        # k-grams by doubling: the hash of 2m characters from those of m; the bits of k say which to join
        power, bits = _BASE, k
        while bits:
            if bits & 1:
                grams = h if grams is None else grams[: len(h) - done] * np.uint64(power) + h[done:] if done else h
                done += have
            bits >>= 1
            if bits:
                h = h[:-have] * np.uint64(power) + h[have:] if len(h) > have else h[:0]
                have *= 2
                power = power * power % (1 << 64)
        grams = grams[: n - k + 1]
        grams = (grams ^ (grams >> np.uint64(29))) * _MIX
    # smallest hash first, of equals the rightmost: the position counts down in the low bits
    last = len(grams) - 1
    low = grams & np.uint64(0xFFFFFFFF00000000) | (np.uint64(0xFFFFFFFF) - np.arange(last + 1, dtype=np.uint64))
    w = min(w, last + 1)
    span = 1
    while span < w:
        step = min(span, w - span)
        low = np.minimum(low[: len(low) - step], low[step:])
        span += step
    new = np.empty(len(low), bool)
    new[0] = True
    np.not_equal(low[1:], low[:-1], out=new[1:])
    low = low[new]
    return low >> np.uint64(32), (np.uint64(0xFFFFFFFF) - (low & np.uint64(0xFFFFFFFF))).astype(np.int64)


def shown(hashes: np.ndarray) -> str:
    """Eight hex digits for each choice, in the order of positions."""
    return hashes.astype(">u4").tobytes().hex()


def places(at: np.ndarray) -> str:
    """Positions, joined by commas."""
    return ",".join(map(str, at.tolist()))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of the sets of choices, 1 for two empty ones."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """doc_id, hashes (array of long) and positions (array of long) of every whole text, null being empty.

    Empty texts have no choices; repeated rows each get theirs; an empty table gives an empty table. Other columns are not read.
    """

    def run(batches):
        for ids, texts in text_slices(batches):
            made = [winnow(t, k, w) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([h.astype(np.int64) for h, _ in made], pa.list_(pa.int64())), pa.array([p for _, p in made], pa.list_(pa.int64()))],
                names=["doc_id", "hashes", "positions"],
            )

    return id_text(docs).mapInArrow(run, "doc_id long, hashes array<long>, positions array<long>")


def with_next(docs: DataFrame, rows_each: int = 2000, most_parts: int = 131_072) -> tuple[DataFrame, int]:
    """(part, ahead, id, doc_id, text) such that, sorted by part, ahead and descending id, each document is followed by its next;
    and the number of parts.

    Parts are ranges of doc_id. A part ends with a copy (``ahead`` true) of the first document of the part after it, the last part with
    that of the first; so the texts are shuffled once and no task reads more than its range. Cut points are quantiles;
    the driver gets one row for each part, ``most_parts`` at most; beyond that parts grow, and tasks stream through them in longer time but no more memory. A null
    doc_id comes after all others. All rows of one doc_id are in one part, sorted on disk if need be.
    """
    placed = docs.select(F.coalesce(F.col("doc_id"), F.lit(-(1 << 62))).alias("id"), "doc_id", "text")
    n = placed.count()
    parts = max(1, min(most_parts, -(-n // rows_each)))
    cuts = placed.stat.approxQuantile("id", [i / parts for i in range(1, parts)], 0.1 / parts) if parts > 1 else []
    cuts = -np.array(sorted({int(c) for c in cuts}, reverse=True), dtype=np.int64)

    def number(ids: pd.Series) -> np.ndarray:
        return np.searchsorted(cuts, -ids.to_numpy(), side="left").astype(np.int64)

    @F.pandas_udf("long")
    def part_of(ids: pd.Series) -> pd.Series:
        return pd.Series(number(ids))

    tops = sorted(tuple(r) for r in placed.select("id", part_of("id").alias("part")).groupBy("part").agg(F.max("id").alias("top")).select("part", "top").collect())
    # the first document of a part is next to the last of the part before
    goes_to = {top: tops[i - 1][0] for i, (_, top) in enumerate(tops)}

    @F.pandas_udf("array<struct<part: long, ahead: boolean>>")
    def places(ids: pd.Series) -> pd.Series:
        out = []
        for i, p in zip(ids.tolist(), number(ids).tolist(), strict=True):
            out.append([{"part": p, "ahead": False}] + ([{"part": goes_to[i], "ahead": True}] if i in goes_to else []))
        return pd.Series(out, dtype=object)

    return placed.select(F.explode(places("id")).alias("to"), "id", "doc_id", "text").select("to.part", "to.ahead", "id", "doc_id", "text"), parts


def compare_with_edits(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness; the columns of op7's contract.

    The next document is the one with the next smaller doc_id, after the last the first; rows of one doc_id follow each
    other in the order of their texts. A lone document is its own next. Null texts are empty. An empty table gives an empty table. Texts of any length
    are winnowed whole, two at a time in a task, at some 50 bytes a character. ``positions`` and ``edited_positions`` say where the choices stand, comma-joined.
    """
    parts, n_parts = with_next(id_text(docs))
    # twice as many tasks as parts: parts seldom meet in one, and a task's share doesn't grow with the table
    sorted_parts = parts.repartition(2 * n_parts, "part").sortWithinPartitions("part", "ahead", F.desc("id"), F.desc("doc_id"), "text")

    def row(doc_id, text, nxt, own, following):
        n = len(text)
        cut = n // 3
        edited = text[: n - cut] + nxt[:cut]
        (own, at), (other, other_at) = own, (own if edited == text else winnow(edited, k, w))
        return (doc_id, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), shown(own), shown(other), likeness(own, other), likeness(own, following), places(at), places(other_at))

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "positions", "edited_positions"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.string(), pa.string()]

    def run(batches):
        before, closed = None, None  # the row that waits for its next; the part whose last row has got it
        for batch in batches:
            out, size = [], 0
            for part, ahead, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if ahead and closed == part:
                    continue  # more rows with the id of the first document
                text = text or ""
                mark = winnow(text, k, w)
                if before is not None:
                    out.append(row(before[0], before[1], text, before[2], mark[0]))
                    size += len(text)
                before = None if ahead else (doc_id, text, mark)
                closed = part if ahead else None
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return sorted_parts.select("part", "ahead", "doc_id", "text").mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, positions string, edited_positions string")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _op7_sql(k: int = K, w: int = W) -> str:
    """The definition, in whole numbers of 128 bits: k-gram hashes as sums over the next k characters, choices as window minima."""
    mod, powers = 1 << 64, [pow(_BASE, i, 1 << 64) for i in range(k)]
    term = " + ".join(f"coalesce(lead(h, {j}) OVER g * pw[kk - {j}] % {mod}, 0)" for j in range(k))
    return f"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id DESC NULLS LAST, coalesce(text, '')) AS r, doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT r, doc_id, text, CAST(length(text) AS BIGINT) AS n, coalesce(lead(text) OVER (ORDER BY r), first_value(text) OVER (ORDER BY r)) AS nxt, coalesce(lead(r) OVER (ORDER BY r), 1) AS nr FROM d),
e AS (SELECT *, left(text, n - n // 3) || left(nxt, n // 3) AS edited FROM n),
both_texts AS (SELECT r, 0 AS side, text AS t FROM e UNION ALL SELECT r, 1, edited FROM e),
c AS (SELECT r, side, least({k}, length(t)) AS kk, length(t) AS n, unnest(string_split(t, '')) AS ch, unnest(range(0, length(t))) AS pos FROM both_texts WHERE t <> ''),
h AS (SELECT r, side, kk, n, pos, (unicode(ch) + 1)::UHUGEINT * {int(_MIX)}::UHUGEINT % {mod} AS h, [{', '.join(f'{p}::UHUGEINT' for p in powers)}] AS pw FROM c),
g1 AS (SELECT r, side, kk, n, pos, ({term}) % {mod} AS g FROM h WINDOW g AS (PARTITION BY r, side ORDER BY pos)),
g2 AS (SELECT r, side, n - kk + 1 AS m, pos, CAST((xor(CAST(g AS UBIGINT), CAST(g // {1 << 29} AS UBIGINT))::UHUGEINT * {int(_MIX)}::UHUGEINT % {mod}) // {1 << 32} AS BIGINT) AS h FROM g1 WHERE pos <= n - kk),
m AS (SELECT r, side, m, pos, min(h::HUGEINT * {1 << 32} + ({(1 << 32) - 1} - pos)) OVER (PARTITION BY r, side ORDER BY pos ROWS BETWEEN CURRENT ROW AND {w - 1} FOLLOWING) AS low FROM g2),
f AS (SELECT DISTINCT r, side, CAST(low // {1 << 32} AS BIGINT) AS h, CAST({(1 << 32) - 1} - low % {1 << 32} AS BIGINT) AS pos FROM m WHERE pos <= greatest(0, m - {w})),
s AS (SELECT r, side, string_agg(format('{{:08x}}', h), '' ORDER BY pos) AS fp, string_agg(pos, ',' ORDER BY pos) AS places, list_distinct(list(h)) AS hs FROM f GROUP BY 1, 2),
x AS (SELECT e.*, coalesce(a.fp, '') AS f0, coalesce(b.fp, '') AS f1, coalesce(a.places, '') AS p0, coalesce(b.places, '') AS p1, coalesce(a.hs, []) AS h0, coalesce(b.hs, []) AS h1, coalesce(c.hs, []) AS h2
  FROM e LEFT JOIN s a ON a.r = e.r AND a.side = 0 LEFT JOIN s b ON b.r = e.r AND b.side = 1 LEFT JOIN s c ON c.r = e.nr AND c.side = 0),
y AS (SELECT *, len(list_intersect(h0, h1)) AS i1, len(list_intersect(h0, h2)) AS i2 FROM x)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, f0 AS fingerprint, f1 AS edited_fingerprint,
  CASE WHEN len(h0) + len(h1) = 0 THEN 1.0 ELSE i1::DOUBLE / (len(h0) + len(h1) - i1) END AS near_edited, CASE WHEN len(h0) + len(h2) = 0 THEN 1.0 ELSE i2::DOUBLE / (len(h0) + len(h2) - i2) END AS near_next, p0 AS positions, p1 AS edited_positions FROM y
"""


OP7_SQL = _op7_sql()
