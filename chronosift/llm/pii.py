"""Personal data by weak supervision.

Strict patterns give the base spans. Looser patterns give more candidates; on every candidate labelers vote: the strict pattern, a
checksum or range, a gazetteer of words nearby, the characters at its sides, its length. Expectation-maximisation over the
votes of the whole corpus estimates what each labeler is worth for each kind and how likely each candidate is personal
data. Those likelihoods train a logistic span classifier, which sees no votes but the span itself (length, digits, separators, whether
numbers check) and its surroundings (characters beside it, the word before it); it decides about the candidates. Base spans always stay.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronosift.llm.common import bounded_batches, id_text, text_slices, written

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++").match
_DIGIT = re.compile(r"[0-9]").search
# possessive forms of the contract's patterns: the same matches, without backtracking over long runs
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}").finditer
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++").finditer
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").finditer
_LOOSE_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])").finditer
_AT_SIGN = re.compile(r" ?[\[(] ?(?:at|AT) ?[\])] ?").finditer
_DOT_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?: ?(?:\.|[\[(] ?(?:dot|DOT) ?[\])]) ?[A-Za-z0-9-]++)++").match
#: Well-formed numbers inside matches of the base patterns that fail because a neighbour ran into them.
_CARD_GROUP = re.compile(r"(?<![0-9])(?:[0-9]{16,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9])").finditer
_WHOLE_PHONE = re.compile(r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])").finditer
_NOT_DIGIT = re.compile(r"[^0-9]")

#: Words that speak for a kind, and words that speak for some other number.
GAZETTEER = (
    ("mail", "e-mail", "contact", "write", "address", "correo", "courriel"),
    ("ip", "host", "server", "client", "login", "addr"),
    ("card", "visa", "credit", "payment", "mastercard", "carte", "karte", "tarjeta"),
    ("tel", "phone", "call", "fax", "mobile", "cell", "telefon", "appel"),
)
OTHER_NUMBERS = ("token", "version", "order", "invoice", "isbn", "key", "serial", "hash", "page", "year")
TOP_DOMAINS = frozenset("com org net edu gov io info biz de fr es uk eu us ca".split())


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i & 1:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _left(text: str, at: int, floor: int) -> int:
    while at > floor and text[at - 1] in _LOCAL:
        at -= 1
    return at


def candidates(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(kind, start, end) of the base spans and of the further candidates, code points, end exclusive."""
    base, more = [], []
    at, floor = text.find("@"), 0
    while at >= 0:
        start, m = _left(text, at, floor), _DOMAIN(text, at + 1)
        if m and start < at:
            base.append((EMAIL, start, m.end()))
            floor = m.end()
            at = text.find("@", floor)
        else:
            at = text.find("@", at + 1)
    if "(" in text or "[" in text:
        for m in _AT_SIGN(text):
            start, d = _left(text, m.start(), 0), _DOT_DOMAIN(text, m.end())
            if d and start < m.start():
                more.append((EMAIL, start, d.end()))
    if not _DIGIT(text):
        return base, more
    for m in _IP(text):
        (base if all(map(_small, m.group().split("."))) else more).append((IP, m.start(), m.end()))
    for m in _CARD(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            base.append((CARD, m.start(), m.end()))
        elif 13 <= len(digits) <= 19:
            more.append((CARD, m.start(), m.end()))
        elif len(digits) > 19:
            more += [(CARD, m.start() + g.start(), m.start() + g.end()) for g in _CARD_GROUP(m.group())]
    taken: list[tuple[int, int]] = []
    if "+" in text:
        for m in _PHONE(text):
            n = len(_NOT_DIGIT.sub("", m.group()))
            if 8 <= n <= 15:
                base.append((PHONE, m.start(), m.end()))
            else:
                more += [(PHONE, m.start() + g.start(), m.start() + g.end()) for g in _WHOLE_PHONE(m.group())]
            taken.append((m.start(), m.end()))
    more += clear([(PHONE, m.start(), m.end()) for m in _LOOSE_PHONE(text)], taken)
    return base, more


def clear(spans: list[tuple[int, int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """The spans that overlap none of ``taken``; two sorted lists are walked side by side."""
    out, at, end = [], 0, -1
    taken = sorted(taken)
    for span in sorted(spans, key=lambda x: x[2]):
        while at < len(taken) and taken[at][0] < span[2]:
            end = max(end, taken[at][1])
            at += 1
        if end <= span[1]:
            out.append(span)
    return sorted(out)


def votes(text: str, kind: int, start: int, end: int, strict: bool) -> tuple[int, ...]:
    """Votes 1, 0 (none), -1 of the labelers: strict pattern, checksum or range, words before, sides, length."""
    span = text[start:end]
    digits = _NOT_DIGIT.sub("", span)
    near = re.findall(r"[^\W\d_][\w-]*", text[max(0, start - 32) : start].lower())[-3:]
    if kind == EMAIL:
        sound = 1 if span.rpartition(".")[2].strip(" )]").lower() in TOP_DOMAINS else 0
        length = 1 if 6 <= len(span) <= 64 else -1
    elif kind == IP:
        sound = 1 if all(map(_small, span.split("."))) else -1
        length = 1 if len(span) <= 15 else -1
    elif kind == CARD:
        sound = 1 if luhn(digits) else -1
        length = 1 if len(digits) in (15, 16) else -1
    else:
        sound = 1 if 10 <= len(digits) <= 13 else 0
        length = 1 if 8 <= len(digits) <= 15 else -1
    context = 1 if any(w in GAZETTEER[kind] for w in near) else -1 if any(w in OTHER_NUMBERS for w in near) else 0
    before, after = text[start - 1 : start] if start else "", text[end : end + 1]
    sides = -1 if before.isalnum() or after.isalnum() or before in ('"', "=", "/") and before else 1
    strict = strict or kind == CARD and 16 <= len(digits) <= 19 and sound == 1 or kind == PHONE and span[0] == "+" and 8 <= len(digits) <= 15
    return (1 if strict else 0, sound, context, sides, length)


#: Prior votes (-1, 0, 1) of each labeler on other spans; on personal data the same turned round. Checksums and ranges are known to be good.
PRIOR = np.array([[2.0, 1.0, 1.0], [20.0, 1.0, 0.2], [2.0, 1.0, 1.0], [2.0, 1.0, 1.0], [2.0, 1.0, 1.0]])


def reliabilities(counts: dict[tuple[int, tuple[int, ...]], int], rounds: int = 50) -> dict[tuple[int, tuple[int, ...]], float]:
    """For each (kind, votes), the likelihood that it is personal data.

    Expectation-maximisation, each kind by itself: a labeler's reliability is how often it says yes, nothing or no about personal data and about
    the rest. It starts from the majority of votes and the labelers' prior.
    """
    out: dict[tuple[int, tuple[int, ...]], float] = {}
    for kind in sorted({k for k, _ in counts}):
        rows = sorted(v for k, v in counts if k == kind)
        v = np.array(rows) + 1
        n = np.array([counts[kind, r] for r in rows], float)
        prior = PRIOR[: v.shape[1]]
        first = np.array([[np.log(prior[j, 2 - x] / prior[j, x]) for j, x in enumerate(r)] for r in v]).sum(axis=1)
        p = np.clip(1 / (1 + np.exp(-first)), 0.05, 0.95)
        for _ in range(rounds):
            logs = np.zeros((len(rows), 2))
            for z, share in enumerate((1 - p, p)):
                weight = n * share
                logs[:, z] = np.log((weight.sum() + 1) / (n.sum() + 2))
                for j in range(v.shape[1]):
                    said = np.bincount(v[:, j], weights=weight, minlength=3) + (prior[j, ::-1] if z else prior[j])
                    logs[:, z] += np.log(said / said.sum())[v[:, j]]
            p = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))
        out.update({(kind, r): float(x) for r, x in zip(rows, p, strict=True)})
    return out


#: Features of a span, each with how many values it has: kind, length, digits, separators, numbers check, character before and after, word before.
FEATURES = (len(KINDS), 6, 6, 8, 2, 5, 5, 17)


def _side(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4


def features(text: str, kind: int, start: int, end: int) -> int:
    """The features of a span as one number, below the product of ``FEATURES``."""
    span = text[start:end]
    digits = _NOT_DIGIT.sub("", span)
    if kind == CARD:
        checks = 16 <= len(digits) <= 19 and luhn(digits)
    elif kind == IP:
        checks = all(map(_small, span.split(".")))
    elif kind == PHONE:
        checks = 8 <= len(digits) <= 15
    else:
        checks = span.rpartition(".")[2].strip(" )]").lower() in TOP_DOMAINS
    word = re.findall(r"[^\W\d_][\w-]*", text[max(0, start - 32) : start].lower())[-1:]
    before = 0 if not word else 1 if word[0] in GAZETTEER[kind] else 2 + zlib.crc32(word[0].encode()) % 15
    values = (
        kind,
        min(5, len(span) // 6),
        min(5, len(digits) // 4),
        ("." in span) + 2 * ("-" in span or " " in span) + 4 * ("+" in span or "(" in span or "[" in span),
        int(checks),
        _side(text[start - 1 : start] if start else ""),
        _side(text[end : end + 1]),
        before,
    )
    out = 0
    for x, n in zip(values, FEATURES, strict=True):
        out = out * n + x
    return out


def _one_hot(codes: np.ndarray) -> np.ndarray:
    """Columns that are 1: one for each feature's value, the features but the first for each kind by itself; column 0 is always 1."""
    values, left = [], codes.copy()
    for n in reversed(FEATURES):
        values.append(left % n)
        left //= n
    kind, *rest = reversed(values)
    at, cols = 1 + len(KINDS), [np.zeros_like(codes), 1 + kind]
    for x, n in zip(rest, FEATURES[1:], strict=True):
        cols.append(at + kind * n + x)
        at += n * len(KINDS)
    return np.array(cols).T


def classifier(seen: dict[int, tuple[float, float]], ridge: float = 0.1, rounds: int = 30):
    """Logistic regression on spans' features, by Newton's steps; ``seen`` has, for each features number, the spans and the sum of their likelihoods.

    Returns a function from features numbers to probabilities, also for features that were never seen together.
    """
    codes = np.array(sorted(seen), np.int64)
    n, y = np.array([seen[c] for c in codes.tolist()], float).reshape(-1, 2).T
    width = 1 + len(KINDS) * (1 + sum(FEATURES[1:]))
    w = np.zeros(width)
    cols = _one_hot(codes)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(w[cols].sum(axis=1), -30, 30)))
        slope, curve = -ridge * w, ridge * np.eye(width)
        for j in range(cols.shape[1]):
            slope += np.bincount(cols[:, j], weights=y - n * p, minlength=width)
            for k in range(cols.shape[1]):
                curve += np.bincount(cols[:, j] * width + cols[:, k], weights=n * p * (1 - p), minlength=width * width).reshape(width, width)
        move = np.linalg.solve(curve, slope)
        w = w + move
        if np.abs(move).max() < 1e-9:
            break
    return lambda asked: 1 / (1 + np.exp(-np.clip(w[_one_hot(np.asarray(asked, np.int64))].sum(axis=1), -30, 30)))


def _code(v: tuple[int, ...]) -> int:
    out = 0
    for y in v:
        out = 3 * out + y + 1
    return out


def _votes_of(code: int, n: int = 5) -> tuple[int, ...]:
    out = []
    for _ in range(n):
        out.append(code % 3 - 1)
        code //= 3
    return tuple(reversed(out))


SPAN = "array<struct<kind: int, start: int, stop: int, votes: int, features: int>>"


class Spans:
    """Lists of spans, one a text, kept as five columns of numbers: 20 bytes a span, however many a text has."""

    def __init__(self) -> None:
        self.ends = array("i", [0])
        self.columns = {x: array("i") for x in ("kind", "start", "stop", "votes", "features")}

    def add(self, text: str, spans: list[tuple[int, int, int]], strict: bool) -> None:
        columns = self.columns.values()
        for k, a, b in sorted(spans):
            for column, x in zip(columns, (k, a, b, _code(votes(text, k, a, b, strict)), features(text, k, a, b)), strict=True):
                column.append(x)
        self.ends.append(len(self.columns["kind"]))

    def lists(self) -> pa.ListArray:
        flat = pa.StructArray.from_arrays([pa.array(np.frombuffer(x, np.int32) if x else [], pa.int32()) for x in self.columns.values()], list(self.columns))
        return pa.ListArray.from_arrays(pa.array(np.frombuffer(self.ends, np.int32)), flat)


def chosen(lists: pa.ListArray, accepted: list[int]) -> pa.ListArray:
    """The spans of each list whose features number is accepted."""
    flat = lists.flatten()
    keep = np.isin(pc.struct_field(flat, "features").to_numpy(zero_copy_only=False), accepted)
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(keep)])[ends], pa.int32()), flat.filter(pa.array(keep)))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.9) -> DataFrame:
    """doc_id, base and added: arrays of (kind, start, stop, votes, features), ordered by kind and start.

    Null texts are empty. Repeated rows are searched each and count each as evidence. Added spans are candidates that the classifier gives ``threshold``
    or more and that overlap no base span. An empty table gives an empty table. A text of any length is searched in time in proportion to it. Other columns are not read.
    The driver gets a row for each kind and vote pattern, under a thousand, and one for each features number met, of 489,600, whatever the corpus.
    """
    bounded_batches(docs.sparkSession)

    def run(batches):
        for ids, texts in text_slices(batches):
            base, more = Spans(), Spans()
            for t in texts:
                strict, loose = candidates(t)
                base.add(t, strict, True)
                more.add(t, clear(loose, [(a, b) for _, a, b in strict]), False)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), base.lists(), more.lists()], names=["doc_id", "base", "more"])

    found = written(id_text(docs, id_col, text_col).mapInArrow(run, f"doc_id long, base {SPAN}, more {SPAN}"), "spans")
    every = found.select(F.explode(F.concat("base", "more")).alias("c")).select("c.kind", "c.votes", "c.features")
    voted = {(r["kind"], _votes_of(r["votes"])): r["count"] for r in every.groupBy("kind", "votes").count().collect()}
    accepted: list[int] = []
    if voted:
        likely = [(k, _code(v), p) for (k, v), p in reliabilities(voted).items()]
        table = F.broadcast(docs.sparkSession.createDataFrame(likely, "kind int, votes int, likely double"))
        seen = every.join(table, ["kind", "votes"]).groupBy("features").agg(F.count("*").alias("n"), F.sum(F.round("likely", 6).cast("decimal(20,6)")).cast("double").alias("y")).collect()
        sure = classifier({r["features"]: (r["n"], r["y"]) for r in seen})
        asked = sorted(r["features"] for r in seen)
        accepted = [c for c, p in zip(asked, sure(asked), strict=True) if p >= threshold]
    allowed = docs.sparkSession.sparkContext.broadcast(accepted)

    def decide(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), chosen(batch.column(2), allowed.value)], names=["doc_id", "base", "added"])

    return found.mapInArrow(decide, f"doc_id long, base {SPAN}, added {SPAN}")


def shown(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", names[c["kind"]], c["start"], c["stop"])), ",")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda c: c["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return out.select("doc_id", *map(number, range(len(KINDS))), F.sha2(shown(F.col("base")).cast("binary"), 256).alias("base_sha256"), shown(F.array_sort(F.concat("base", "added"))).alias("spans"))
