"""Token counts by batch encoding in Arrow functions that return lengths only.

Texts are split at safe boundaries: places between a non-space and a space followed by a non-space, where the
tokenizer's own pattern always begins a new piece; long runs without spaces also where letters and digits meet and behind full-width marks. The pieces of a slice of rows, slices being balanced by bytes, that the
worker has not met yet are encoded as one batch; a bounded table in the worker keeps the lengths.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronosift.llm.bpe import library, piece_encoder, ranks_agree
from chronosift.llm.common import collector_off, id_text, text_slices

#: White space other than the space and the line end; texts that have it are split by the slower rule.
_RARE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
_SAFE = re.compile(r"(?<=\S)(?= \S)")
#: Characters of a text that is split further, and places where one of the tokenizer's pieces ends: between words, letters and digits, and behind full-width marks.
LONG = 1 << 14
_INSIDE = re.compile(r"(?<=\S)(?= \S)|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f])(?=[\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5A-Za-z0-9])")
_WORD = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?%&*$#|]*)").fullmatch


class PieceLengths:
    """Lengths in tokens of pieces that stand behind a space; bounded by ``most`` entries."""

    def __init__(self, path: str, fast: bool, most: int = 600_000) -> None:
        self.tok, self.most, self.known, self.heads = library(path), most, {}, {}
        self.piece = piece_encoder(path) if fast else None

    def encode(self, texts: list[str]) -> list[int]:
        return [len(e) if len(t) <= LONG else self.long(t) for t, e in zip(texts, self.tok.encode_batch_fast([t if len(t) <= LONG else "" for t in texts], add_special_tokens=False), strict=True)]

    def long(self, text: str) -> int:
        """Tokens of a long text, over parts of bounded length that end where one of the tokenizer's pieces must."""
        if "<|" in text:  # a special token's string may go over such places
            return len(self.tok.encode(text, add_special_tokens=False))
        total, part, size = 0, [], 0
        for piece in _INSIDE.split(text):
            part.append(piece)
            size += len(piece)
            if size > LONG:
                total += len(self.tok.encode("".join(part), add_special_tokens=False))
                part, size = [], 0
        return total + len(self.tok.encode("".join(part), add_special_tokens=False))

    def resolve(self, pieces: set[str]) -> dict[str, int]:
        """Lengths of pieces that aren't known, each with a space before it.

        A single line end between two non-spaces is a piece of its own. Letters and then marks are two pieces, the
        marks without a space; letters of the Latin blocks only, as Unicode versions differ elsewhere.
        """
        known, out, later, lines = self.known, {}, [], []
        for p in pieces:
            m = _WORD(p) if self.piece else None
            if m:
                core, marks = m.groups()
                n = known.get(core) or len(self.piece((" " + core).encode()))
                out[p] = n + self.bare(marks) if marks else n
            elif "\n" in p and p.split() == (cut := p.split("\n")):
                lines.append((p, cut))
            else:
                later.append(p)
        for p, cut in lines:
            first = known.get(cut[0]) or self.encode([" " + cut[0]])[0]
            out[p] = first + sum([self.bare("\n") + self.bare(x) for x in cut[1:]])
        out.update(zip(later, self.encode([" " + p for p in later]), strict=True))
        if len(known) < self.most:
            known.update((p, n) for p, n in out.items() if len(p) <= 48)
        return out

    def bare(self, piece: str) -> int:
        """The same for a piece behind no space."""
        n = self.heads.get(piece)
        if n is None:
            n = self.encode([piece])[0]
            if len(self.heads) < self.most // 4 and len(piece) <= 48:
                self.heads[piece] = n
        return n

    def count(self, texts: list[str]) -> list[int]:
        known, cut, heads = self.known, [], []
        for t in texts:
            if "  " in t or " \n" in t or "\n " in t or _RARE(t):
                first, *rest = _SAFE.split(t)
                parts = [p[1:] for p in rest]
            else:
                first, *parts = t.split(" ")
            heads.append(first)
            cut.append(parts)
        new = set().union(*cut).difference(known)
        extra = self.resolve(new) if new else {}
        out = []
        for n, parts in zip(map(self.bare, heads), cut, strict=True):
            if extra:
                n += sum([known[p] if p in known else extra[p] for p in parts])
            else:
                n += sum(map(known.__getitem__, parts))
            out.append(n)
        return out


@functools.cache
def _lengths(path: str, fast: bool) -> PieceLengths:
    """One table for each worker process, kept from task to task."""
    return PieceLengths(path, fast)


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every whole text; other columns are not read.

    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers library, on every machine. Null and empty texts have 0
    bytes and tokens; repeated rows are counted each. Strings of special tokens are encoded as the library does by
    default. No begin, end or padding tokens.
    """

    fast = ranks_agree(tokenizer)

    def run(batches):
        lengths = _lengths(tokenizer, fast)
        with collector_off():  # the tables hold no cycles; walking them costs more than the work
            for ids, texts in text_slices(batches):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(lengths.count(texts), pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.withColumn("over_limit", F.col("n_tokens") > 512)
