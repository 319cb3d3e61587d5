"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns documents again, the last one pieces.
What a stage returns is written as Parquet and read as the next one's docs. The stages keep no state between runs.

Rows with a null in any column, repeated rows and columns beyond those of documents (ignored) are taken by every stage; an empty table passes through as an
empty one. Very long texts are read whole. The stages bound the bytes of the session's Arrow batches, as executors hold several of whole texts at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronosift.llm import langid, line_dedup, mixing, packing, similar
from chronosift.llm.common import bounded_batches, fresh_path, remove, scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language. Null, empty and letterless texts go, and long ones that no language claims; repeated rows share their fate.

    It learns from the table's own labels; without any, no language claims a text, and all go.
    """
    bounded_batches(spark)
    model = langid.train(docs, F.lit(True))
    return langid.keep_claimed(docs.select(*COLUMNS), model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them have; n_chars follows the text. Null texts become empty; no row goes.

    A repeated row counts as a document of its own, a line repeated within a document counts once.
    """
    bounded_batches(spark)
    out = line_dedup.drop_frequent_lines(docs.select(*COLUMNS))
    return out.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.char_length("kept_text").cast("long").alias("n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked at a likeness of 0.8 or more of five-word shingles.

    Null ids come last; equal ids are told apart by their texts, and of equal rows one stays. Texts without words are one group.
    """
    bounded_batches(spark)
    return similar.keep_first(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled towards the production mix. Null sources and languages are values of their own; sampling hangs on the id alone, so rows of one id share
    their fate, and a document without words has its cell's probability."""
    bounded_batches(spark)
    return mixing.production_mix(docs.select(*COLUMNS)).where("sampled").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 4096 tokens. Null and empty texts are one end token; repeated rows are packed each."""
    import public_tokenizers

    bounded_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language ID", language_id),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SQL can't express string kernels, SimHash shards or the packing plan; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the last stage. What a stage keeps in the shared folder goes once its result is written, and that once the next one is."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (_, stage) in enumerate(STAGES[:-1]):
        path = fresh_path(spark, f"stage-{i + 1}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.option("compression", "snappy").parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
