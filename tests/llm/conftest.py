from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {
    "en": "the of and to in is that it for was on are with they this have from words some there".split(),
    "fr": "le la les des et que dans pour qui une est sur pas avec son école été même où très".split(),
    "de": "der die und den von zu das mit sich auf für nicht ein über schön größe wäre".split(),
}


def prose(rng: random.Random, lang: str, n: int) -> str:
    out = []
    for i in range(n):
        out.append(rng.choice(WORDS[lang]) + rng.choice(["", "", "", rng.choice("abcdefgh") * rng.randint(0, 2)]))
        if rng.random() < 0.05:
            out[-1] += rng.choice([".", ",", ".\n"])
    return " ".join(out).replace("\n ", "\n")


@pytest.fixture(scope="session")
def rows():
    """Documents with every odd case: null and empty texts, null columns, copies, repeated rows, a long one, shared lines."""
    rng = random.Random(11)
    out = []
    for i in range(60):
        lang = rng.choice(list(WORDS))
        text = prose(rng, lang, rng.randint(1, 120))
        if i % 5 == 0:
            text += "\nThis very line is shared.\n  THIS VERY LINE IS SHARED.\t"
        out.append((i, text, lang, f"src{i % 3}", len(text)))
    out += [(100, None, "en", "src0", None), (101, "", "fr", None, 0), (102, " \n\t\n", None, "src0", 4), (103, "12 34 %% --", "en", "src1", 11), (104, "x" * 3000 + " " + prose(rng, "en", 4000), "en", "src0", None)]
    out += [(200 + i, out[7][1], out[7][2], "src2", out[7][4]) for i in range(5)]  # copies
    out += [out[9], out[9]]  # repeated rows
    out += [(300, "Ünïcödé 中文 κόσμος 🙂 <|endoftext|> it's fine\r\n\x85 next  two", None, None, None)]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    """The documents with columns of names that the operators use inside."""
    from pyspark.sql import functions as F

    for c in ("fp", "rk", "_rk", "_drop", "key", "kept_text", "n_tokens", "prob", "sampled", "h", "salt", "part", "id", "shard", "component_id", "score", "topic", "_source"):
        docs = docs.withColumn(c, F.lit("x"))
    return docs
