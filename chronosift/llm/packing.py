"""Packing token sequences into fixed windows, planned on the histogram of lengths.

Documents are tokenised once. Full windows stand alone; what is left of each document is one piece, shorter than a
window. Shallow combinations of piece lengths that fill a window are enumerated, their repeat counts are the non-negative
least-squares solution against the histogram, rounded; what they leave is packed greedily, longest piece first,
still on the histogram. The plan's size depends on the window only. Pieces get their places by rank within their length.
"""

from __future__ import annotations

import functools
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronosift.llm.bpe import library, ranks_agree, word_encoder
from chronosift.llm.common import collector_off, give_back, id_text, text_slices, written

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

_WORD = re.compile(r"([a-zß-öø-ÿ]+)([.,;:!?%&*$#|]*)").fullmatch
_BEYOND = re.compile("[^\\x00-\\u024f]").search
_SPACE = str.maketrans("\n\t\r", "   ")


class WordIds:
    """Ids, as little-endian bytes, of texts for a file that drops white space; words are kept in a bounded table."""

    def __init__(self, path: str, fast: bool, most: int = 300_000) -> None:
        self.tok, self.most, self.known = library(path), most, {"": b""}
        self.word = word_encoder(path) if fast else None

    def encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def resolve(self, words: set[str]) -> dict[str, bytes]:
        known, out, later = self.known, {}, []
        for w in words:
            m = _WORD(w) if self.word else None
            if m:
                core, marks = m.groups()
                ids = known.get(core) or np.array(self.word(core.encode()), "<u4").tobytes()
                if marks:
                    if marks not in known:
                        known[marks] = self.encode([marks])[0]
                    ids += known[marks]
                out[w] = ids
            else:
                later.append(w)
        out.update(zip(later, self.encode(later), strict=True))
        if len(known) < self.most:
            known.update((w, x) for w, x in out.items() if len(w) <= 40)
        return out

    def ids(self, texts: list[str]) -> list[bytes]:
        """White space always parts words. Small letters come first only where that can't change the library's result:
        nothing beyond the Latin blocks and no special token's string."""
        known, cut = self.known, []
        for t in texts:
            if "<|" not in t and not _BEYOND(t):
                t = t.lower()
            if "\n" in t:
                t = t.replace("\n", " ")
            cut.append(t.split(" "))
        new = set().union(*cut).difference(known)
        extra = self.resolve(new) if new else {}
        if extra:
            return [b"".join([known[w] if w in known else extra[w] for w in words]) for words in cut]
        return [b"".join(map(known.__getitem__, words)) for words in cut]


@functools.cache
def _words(path: str, fast: bool) -> WordIds:
    return WordIds(path, fast)


def tokenise_pieces(docs: DataFrame, tokenizer: str, window: int, end_id: int) -> DataFrame:
    """One row for each full window of a document and one for its rest: doc_id, start, length, ids_crc32, doc_tokens."""
    fast, step, end = ranks_agree(tokenizer), 4 * window, int(end_id).to_bytes(4, "little")

    def run(batches):
        words = _words(tokenizer, fast)
        with collector_off():  # the tables hold no cycles
            for ids, texts in text_slices(batches):
                rows = []
                for doc_id, raw in zip(ids, words.ids(texts), strict=True):
                    raw += end
                    for at in range(0, len(raw), step):
                        part = raw[at : at + step]
                        rows.append((doc_id, at // 4, len(part) // 4, zlib.crc32(part), len(raw) // 4))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
                del rows
        give_back()

    return id_text(docs).mapInArrow(run, PIECES)


def combinations(counts: np.ndarray, window: int, depth: int, each: int) -> np.ndarray:
    """Combinations of present lengths, ``depth`` at most, that fill a window exactly or nearly.

    Rows hold lengths, 0 for none. Every length leads ``each`` combinations; the lengths between are taken where the histogram has
    most pieces, at evenly spaced quantiles, and the last is the longest present one that still fits.
    """
    present = np.flatnonzero(counts)
    present = present[(present > 0) & (present < window)]
    if not len(present):
        return np.zeros((0, depth), np.int64)
    fits = np.zeros(window + 1, np.int64)  # the longest present length up to each
    fits[present] = present
    fits = np.maximum.accumulate(fits)
    mass = np.cumsum(counts[present]) / counts[present].sum()
    found = []
    for k in range(each):
        for parts in range(2, depth + 1):
            left = window - present
            row = [present]
            for j in range(parts - 2):
                q = ((k + 0.5) / each + 0.381966 * (j + 1) + np.arange(len(present)) * 0.618034) % 1.0
                pick = present[np.minimum(np.searchsorted(mass, q), len(present) - 1)]
                pick = np.minimum(pick, fits[np.maximum(left, 0) // 2])
                row.append(pick)
                left = left - pick
            last = fits[np.maximum(left, 0)]
            row.append(last)
            whole = np.zeros((len(present), depth), np.int64)
            whole[:, :parts] = np.array(row).T
            found.append(whole[(left >= 0) & (last > 0)])
    for n in range(2, depth + 1):  # copies of one length
        same = present[present * n <= window]
        whole = np.zeros((len(same), depth), np.int64)
        whole[:, :n] = same[:, None]
        found.append(whole)
    rows = np.sort(np.concatenate(found), axis=1)[:, ::-1]
    rows = np.unique(rows, axis=0)
    total = rows.sum(axis=1)
    return rows[(total <= window) & (total >= window - window // 64)]


def repeat_counts(rows: np.ndarray, counts: np.ndarray, steps: int = 2000, close: float = 1e-4) -> np.ndarray:
    """x >= 0 least squares of sum_j x_j a_j = counts, a_j the lengths in combination j: projected gradient with momentum, preconditioned by length.

    It ends when a step moves no count by ``close`` of the largest, tried every 25 steps, or after ``steps``; what is not covered is packed greedily.
    """
    if not len(rows):
        return np.zeros(0)
    n = len(counts)
    weight = 1.0 / np.maximum(counts, 1.0)  # errors relative to the histogram
    weight[0] = 0.0
    x = np.zeros(len(rows))
    y, t = x.copy(), 1.0
    cover = np.bincount(rows.ravel(), minlength=n).astype(float)
    cover[0] = 0.0
    step = 1.0 / np.maximum((cover * weight)[rows].sum(axis=1), 1e-12)
    for i in range(steps):
        got = np.bincount(rows.ravel(), weights=np.repeat(y, rows.shape[1]), minlength=n)
        grad = ((got - counts) * weight)[rows].sum(axis=1)
        nxt = np.maximum(0.0, y - step * grad)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = nxt + (t - 1) / t2 * (nxt - x)
        still = i % 25 == 24 and np.abs(nxt - x).max() <= close * nxt.max(initial=1.0)
        x, t = nxt, t2
        if still:
            break
    return x


def plan_windows(counts: np.ndarray, window: int, depth: int = 4, each: int = 3) -> tuple[np.ndarray, int]:
    """Places for ``counts[l]`` pieces of each length l: rows (length, first rank, first sequence, offset), and the number of sequences.

    A place (l, r, s, o) holds from the piece of rank r on: rank r + i is in sequence s + i at offset o, until the next row
    of that length. The rows number a few for each length and combination, however many pieces there are.
    """
    left = counts.astype(np.int64).copy()
    left[0] = 0
    used = np.zeros_like(left)
    places: list[tuple[int, int, int, int]] = []
    sequences = 0

    def put(lengths: list[int], times: int) -> None:
        nonlocal sequences
        at = 0
        for n in lengths:
            places.append((n, int(used[n]), sequences, at))
            used[n] += times
            left[n] -= times
            at += n
        sequences += times

    if left[window]:
        put([window], int(left[window]))
    rows = combinations(left, window, depth, each)
    x = repeat_counts(rows, left.astype(float))
    for j in np.argsort(-x, kind="stable"):
        if x[j] < 0.5:
            break
        lengths = [int(v) for v in rows[j] if v]
        need = np.bincount(lengths, minlength=1)
        kinds = np.flatnonzero(need)
        times = min(int(x[j] + 0.5), int((left[kinds] // need[kinds]).min()))
        if times > 0:
            put(lengths, times)
    # what the rounding left: longest piece first, then always the longest that fits
    while left.any():
        lengths, room, spare = [], window, left.copy()
        while room > 0:
            fit = np.flatnonzero(spare[: room + 1])
            if not len(fit):
                break
            n = int(fit[-1])
            lengths.append(n)
            spare[n] -= 1
            room -= n
        need = np.bincount(lengths)
        kinds = np.flatnonzero(need)
        put(lengths, int((left[kinds] // need[kinds]).min()))
    return np.array(sorted(places), np.int64).reshape(-1, 4), sequences


def pack(docs: DataFrame, tokenizer: str, window: int = 4096, end_id: int = 2) -> DataFrame:
    """Pieces of all documents and their places: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are one end token. Repeated rows are packed each. Each id of a document lies in one piece; a
    sequence's pieces follow each other from offset 0. An empty table gives an empty table. Other columns are not read. A text of any length is
    tokenised whole in its task, at 4 bytes an id, and cut to windows.

    Only the histogram of lengths (``window`` numbers) reaches the driver. Ranks within a length are made in two
    steps, by salt and within it, so that many copies of one length are spread.
    """
    pieces = tokenise_pieces(docs, tokenizer, window, end_id)
    pieces = written(pieces.withColumn("h", F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id())), "pieces")
    counts = np.zeros(window + 1, np.int64)
    for n, c in pieces.groupBy("length").count().collect():
        counts[n] = c
    total = int(counts.sum())
    plan, _ = plan_windows(counts, window)
    salts = max(64, total // 50_000)
    salted = pieces.withColumn("salt", F.pmod("h", F.lit(salts)))
    before = salted.groupBy("length", "salt").count()
    before = before.withColumn("before", F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count")).drop("count")
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")) - 1
    ranked = salted.withColumn("within", within.cast("long")).join(before, ["length", "salt"])
    # a rank is below 2**44, so (length, rank) is one sortable number
    keys = (plan[:, 0] << 44) + plan[:, 1]
    first, offsets = plan[:, 2].copy(), plan[:, 3].copy()

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        key = (length.to_numpy() << 44) + rank.to_numpy()
        at = np.searchsorted(keys, key, side="right") - 1
        return pd.DataFrame({"sequence_id": first[at] + key - keys[at], "offset": offsets[at]})

    return ranked.withColumn("at", place("length", F.col("before") + F.col("within"))).select(*[c.split()[0] for c in PIECES.split(", ")], "at.sequence_id", "at.offset")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
