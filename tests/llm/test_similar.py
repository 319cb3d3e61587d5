"""Near-duplicates by likeness against all pairs, and odd ids."""

from __future__ import annotations

import random

import numpy as np

from chronosift.llm import similar


def plain_sets(texts, k=5):
    words = [(t or "").lower().split() for t in texts]
    return [{tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set() for w in words]


def plain_groups(sets):
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if group[i] != group[j] and (not a and not sets[j] or 10 * len(a & sets[j]) >= 8 * len(a | sets[j]) > 0):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return group


def edited(rng, n_texts=60):
    """Texts with copies of which some words differ, chains of such copies, short and empty ones."""
    vocabulary = [f"w{i}" for i in range(500)]
    out = ["", " \n", None, "One two", "one  TWO"]
    for _ in range(n_texts):
        words = rng.choices(vocabulary, k=rng.randint(3, 150))
        for _ in range(rng.randint(1, 4)):
            out.append(" ".join(words))
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return out


def test_groups_equal_all_pairs():
    texts = edited(random.Random(5))
    want = plain_groups(plain_sets(texts))
    assert similar.groups_of([similar.shingles(t or "") for t in texts]).tolist() == want
    assert len(set(want)) < len(texts) - 20
    assert similar.groups_of([]).tolist() == [] and similar.groups_of([np.empty(0, np.uint64)]).tolist() == [0]


def test_pipeline_drops_edited_copies(spark):
    import corpus_pipeline as c

    texts = edited(random.Random(6))
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    want = sorted(set(plain_groups(plain_sets(texts))))
    assert sorted(r.doc_id for r in c.near_dedup(spark, docs, "").collect()) == want


def test_rows_of_one_id_and_without_id(spark):
    rows = [(1, "a b c d e f"), (1, "u v w x y z"), (1, "a b c d e f"), (None, "k l m n o p"), (None, "A b c d e f"), (None, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in similar.keep_first(docs).collect()), key=str)
    assert got == [(1, "a b c d e f"), (1, "u v w x y z"), (2, ""), (None, "k l m n o p")]
    assert similar.keep_first(docs.limit(0)).count() == 0


def test_large_groups_are_compared_in_blocks(spark):
    """One large group of near copies, in tiny blocks: the same rows stay."""
    texts = edited(random.Random(7), 25)
    base = [f"w{i}" for i in range(60)]
    rng = random.Random(8)
    for _ in range(60):
        words = base[:]
        words[rng.randrange(60)] = f"x{rng.randrange(9)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted(set(plain_groups(plain_sets(texts))))
    assert sorted(r.doc_id for r in similar.keep_first(docs, block_rows=10).collect()) == want
    assert sorted(r.doc_id for r in similar.keep_first(docs, block_bytes=3000).collect()) == want


def test_texts_that_are_joined_by_a_shuffle(spark, monkeypatch):
    """Beyond the bound of a broadcast the same rows stay."""
    texts = edited(random.Random(9), 20)
    docs = spark.createDataFrame([*enumerate(texts), (3, texts[3])], "doc_id long, text string")
    want = sorted(r.doc_id for r in similar.keep_first(docs).collect())
    monkeypatch.setattr(similar, "LIGHT", 0)
    assert sorted(r.doc_id for r in similar.keep_first(docs).collect()) == want == sorted(set(plain_groups(plain_sets(texts))))
