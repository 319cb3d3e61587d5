"""Language identification with string kernels.

The kernel of two texts is the number of n-grams (n = 1, 2, 3, blended) that both have, presence only, over the root of the
product of their own numbers of distinct n-grams. Landmark texts give a Nystroem map; one-versus-rest kernel ridge regression is
fitted on it. A text is scored over its whole length, many texts at a time, by matrix products with the landmarks.
"""

from __future__ import annotations

import dataclasses
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronosift.llm.common import crc_mod, give_back, id_text, text_slices

UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> np.ndarray | None:
    """Distinct n-grams of a text as sorted numbers, None for a text without letters.

    Letters of any script are themselves, in lower case; all else is one symbol that parts words. Each n-gram has a number of its own.
    """
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    known = _letters()[points]
    if not known.any():
        return None
    s = np.concatenate([[1], np.where(known, points.astype(np.int64) + 2, 1), [1]])
    two = (s[:-1] << 21) | s[1:]
    three = (two[:-1] << 21) | s[2:]
    return np.unique(np.concatenate([three, two, s]))


@dataclasses.dataclass
class Model:
    classes: list[str]
    vocabulary: np.ndarray  # the landmarks' n-grams, sorted
    landmarks: np.ndarray  # n-grams x landmarks: presence over the root of the landmark's number
    weights: np.ndarray  # landmarks x classes: Nystroem map and ridge weights in one

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        """Kernel values of texts, given as sets of n-grams, with the landmarks."""
        width = len(self.vocabulary)
        has = np.zeros((len(sets), width + 1), np.float32)
        for i, own in enumerate(sets):
            at = np.searchsorted(self.vocabulary, own)
            at[at == width] = width - 1 if width else 0
            has[i, at[self.vocabulary[at] == own] if width else at[:0]] = 1
        return (has[:, :width] @ self.landmarks) / np.sqrt([max(1, len(own)) for own in sets])[:, None]

    def score(self, texts: list[str]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for at in range(0, len(texts), 256):
            sets = [grams(t) for t in texts[at : at + 256]]
            margin = self.kernel([own if own is not None else np.zeros(0, np.int64) for own in sets]) @ self.weights
            best = margin.argmax(axis=1)
            top = np.clip((margin.max(axis=1) + 1) / 2, 0, 1)
            names += [UNKNOWN if own is None else self.classes[b] for own, b in zip(sets, best, strict=True)]
            scores += [0.0 if own is None else float(x) for own, x in zip(sets, top, strict=True)]
        return names, scores


def fit(sets: list[np.ndarray], langs: list[str], n_landmarks: int, ridge: float = 1e-2) -> Model:
    """One-versus-rest kernel ridge regression on ``n_landmarks`` Nystroem landmarks, spread evenly over the languages, one each at least.

    Texts come as sets of n-grams. Each language weighs the same, however many texts it has.
    """
    classes = sorted(set(langs))
    if not classes:
        return Model([UNKNOWN], np.zeros(0, np.int64), np.zeros((0, 1), np.float32), np.zeros((1, 1), np.float32))
    own = {c: [i for i, x in enumerate(langs) if x == c] for c in classes}
    picked = [i for c in classes for i in own[c][: max(1, n_landmarks // len(classes))]]
    vocabulary = np.unique(np.concatenate([sets[i] for i in picked]))
    marks = np.zeros((len(vocabulary), len(picked)), np.float32)
    for j, i in enumerate(picked):
        marks[np.searchsorted(vocabulary, sets[i]), j] = len(sets[i]) ** -0.5
    model = Model(classes, vocabulary, marks, np.zeros((len(picked), len(classes)), np.float32))
    kernel = np.concatenate([model.kernel(sets[i : i + 256]) for i in range(0, len(sets), 256)]).astype(float)
    among = kernel[picked]
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    z = kernel @ root
    y = np.where(np.array(langs)[:, None] == np.array(classes)[None, :], 1.0, -1.0)
    weight = np.array([len(langs) / len(own[x]) for x in langs])[:, None]
    beta = np.linalg.solve((z * weight).T @ z + ridge * len(langs) / len(classes) * np.eye(z.shape[1]), (z * weight).T @ y)
    model.weights = (root @ beta).astype(np.float32)
    return model


def _sets(rows: DataFrame) -> DataFrame:
    """Rows (l, t) as (l, size, grams); texts without letters go."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                own = grams(batch.column(1)[i].as_py())
                if own is not None:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([own], pa.list_(pa.int64()))], names=["l", "grams"])

    return rows.mapInArrow(run, "l string, grams array<long>")


def train(docs: DataFrame, rows: Column, each: int = 250, n_landmarks: int = 240, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on the ``each`` different texts of each language, among ``rows``, whose hashes are smallest.

    Every language that any labelled row has is learned. A text that is repeated under a language counts once, so copies crowd nothing out. Rows with a null text or
    language, and texts without letters, are not learned from. The bound: sets of n-grams of ``each`` whole texts a language reach the driver; a set holds what n-grams
    there are, however long the text. Without labelled rows every text is ``und``.
    """
    known = docs.where(rows & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(F.col(lang_col).cast("string").alias("l"), F.col(text_col).cast("string").alias("t")).withColumn("h", F.xxhash64("t"))
    # hashes are even over the longs: this share of them holds ``each`` texts and some more, so few rows are sorted
    # a row for each language: far less than the model, which is broadcast too
    sizes = known.groupBy("l").agg(F.approx_count_distinct("h", 0.03).alias("n")).withColumn("most", F.lit(-(2.0**63)) + F.least(F.lit(1.0), F.lit(1.2 * each + 8 * each**0.5) / F.col("n")) * 2.0**64)
    near = known.join(F.broadcast(sizes), "l").where(F.col("h") <= F.col("most"))
    texts = near.groupBy("l", "h").agg(F.min("t").alias("t"))
    first = texts.withColumn("r", F.row_number().over(Window.partitionBy("l").orderBy("h", "t"))).where(F.col("r") <= each)
    found = [(r.l, i, np.array(r.grams)) for i, r in enumerate(_sets(first.orderBy("l", "r").select("l", "t")).collect())]
    model = fit([g for _, _, g in found], [lang for lang, _, _ in found], n_landmarks)
    give_back()
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every whole text; ``und`` and 0 where it is null, empty or has no letter.

    The score is the winning one-versus-rest value, from -1..1 to 0..1: 0.5 or less means that no language claims the text. Repeated rows are
    scored each; an empty table gives an empty table. Only the text is read, the whole of it: time and memory of a very long one are in proportion.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # its size follows the landmarks' n-grams and the languages, not the corpus

    def run(batches):
        score = held.value.score
        for ids, texts in text_slices(batches):
            names, scores = score(texts)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])
        give_back()

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_claimed(docs: DataFrame, model: Model, least: float = 0.5, letters: int = 200, text_col: str = "text") -> DataFrame:
    """The rows in some language. All columns are kept, and nothing is shuffled.

    Repeated rows share their fate; an empty table stays empty. ``und`` goes (null, empty or letterless text), and so does a text of ``letters`` letters or more that no language claims, all one-versus-rest values
    being against it (a score under ``least``). Shorter texts are too little evidence against themselves and stay.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        score = held.value.score
        for batch in batches:
            keep = []
            for _, texts in text_slices([pa.RecordBatch.from_arrays([batch.column(at), batch.column(at)], names=["i", "t"])]):
                names, scores = score(texts)
                keep += [n != UNKNOWN and (s >= least or sum(map(str.isalpha, t)) < letters) for n, s, t in zip(names, scores, texts, strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))
        give_back()

    return docs.mapInArrow(run, docs.schema)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = predict(docs, train(docs, crc_mod("doc_id", 4) != 2))
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
