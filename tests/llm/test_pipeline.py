"""run() against a plain version of its decisions, stage by stage, and the queries' names."""

from __future__ import annotations

import collections

import pytest
from test_operators import check_packing, plain_lines, plain_near

P = pytest.importorskip("public_tokenizers")


def test_stages_follow_each_other(spark, docs):
    import corpus_pipeline as c
    from chronosift.llm.bpe import library

    kept = docs
    seen = []
    for name, stage in c.STAGES[:-1]:
        kept = stage(spark, kept, "").cache()
        assert kept.columns == c.COLUMNS, name
        seen.append(kept.collect())
    claimed, lines, near, mixed = seen
    assert not {r.doc_id for r in claimed} & {100, 101, 102, 103}
    assert {r.doc_id for r in claimed} >= set(range(60))
    texts = sorted((r.doc_id, r.text) for r in claimed)
    want = sorted((i, x[2]) for (i, _), x in zip(texts, plain_lines([t for _, t in texts], 10), strict=True))
    assert sorted((r.doc_id, r.text) for r in lines) == want
    assert all(r.n_chars == len(r.text) for r in lines)
    groups = plain_near([(r.doc_id, r.text) for r in lines])
    assert sorted(r.doc_id for r in near) == sorted(i for i, (_, g) in groups.items() if i == g)
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in near} and mixed
    path = P.path("word_bpe_49k.json")
    pieces = c.STAGES[-1][1](spark, kept, "").collect()
    check_packing(pieces, {r.doc_id: library(path).encode(r.text, add_special_tokens=False).ids for r in mixed})


def test_run_equals_its_stages(spark, docs, tmp_path):
    import corpus_pipeline as c

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    whole = collections.Counter(tuple(r) for r in c.run(spark, str(tmp_path)).select("doc_id", "start", "length", "ids_crc32").collect())
    kept = docs
    for _, stage in c.STAGES:
        kept = stage(spark, kept, str(tmp_path))
    assert whole == collections.Counter(tuple(r) for r in kept.select("doc_id", "start", "length", "ids_crc32").collect())


def test_names():
    from chronosift.llm import registry

    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES if n.startswith("op")) == list(range(1, 11))
    assert "pipeline" in registry.QUERIES


def test_run_on_an_empty_table(spark, none, tmp_path):
    import corpus_pipeline as c

    none.write.parquet(f"{tmp_path}/documents.parquet")
    out = c.run(spark, str(tmp_path))
    assert out.count() == 0 and {"doc_id", "sequence_id", "offset"} <= set(out.columns)


def test_extra_columns_are_ignored(spark, clashing):
    import corpus_pipeline as c

    for _, stage in c.STAGES[:-1]:
        assert stage(spark, clashing, "").columns == c.COLUMNS


def test_scratch_goes(spark, docs):
    import os

    from chronosift.llm import common

    kept = common.fresh_path(spark, "kept")
    with common.scratch(spark):
        inner = common.written(docs.select("doc_id"), "inner").inputFiles()[0]
        docs.select("doc_id").write.parquet(kept)
    path = inner.removeprefix("file://")
    assert not os.path.exists(path) and spark.read.parquet(kept).count() == docs.count()
    common.remove(spark, kept)


def test_stages_bound_batches_of_texts(spark):
    """Workers get long texts a few at a time, whatever stage comes first; a lower bound of the session's own stays."""
    import corpus_pipeline as c
    import pyarrow as pa

    key, sizes = "spark.sql.execution.arrow.maxBytesPerBatch", lambda it: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in it)
    before = spark.conf.get(key)
    docs = spark.range(0, 40, 1, 1).selectExpr("id AS doc_id", "repeat(concat('some words ', id, ' '), 70000) AS text", "'en' AS lang", "'s' AS source", "1L AS n_chars")
    try:
        for _, stage in c.STAGES:
            spark.conf.unset(key)
            stage(spark, docs.where("false"), "")
            assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) < 6 << 20
        spark.conf.set(key, "2m")
        c.pack(spark, docs.where("false"), "")
        assert spark.conf.get(key) == "2m"
    finally:
        spark.conf.set(key, before)
