"""Mixing sources to target weights by iterative proportional fitting.

Token weights, summed over the cells of source x language x topic, are raked until each marginal has its target shares; the ratio of
fitted to observed weight calibrates the probability by which a cell's documents are sampled, under a token budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronosift.llm.common import free_names, written

NONE = "(none)"
#: The production mix: shares by language and topic; languages and topics that aren't listed keep their own share, and sources are to weigh the
#: root of what they have, so that a hot source counts less.
LANGS = {"en": 0.40, "fr": 0.20, "de": 0.20, "es": 0.20}
TOPICS = {"prose": 0.70, "list": 0.15, "short": 0.05, "marked": 0.10}
BUDGET, ROUNDS, SEED = 0.5, 12, "mix-1"


def n_words(text: Column) -> Column:
    """Token weight: words between ASCII white space; null is 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def topic_of(text: Column, words: Column) -> Column:
    """A coarse topic by form: short texts, texts with many marks, lists, prose."""
    whole = F.coalesce(text, F.lit(""))
    marks = F.length(whole) - F.length(F.regexp_replace(whole, r"[%&*$#!]", ""))
    bars = F.length(whole) - F.length(F.replace(whole, F.lit("|"), F.lit("")))
    return F.when(words < 20, "short").when(bars * 4 > words, "list").when(marks * 2 > words, "marked").otherwise("prose")


def target_shares(observed: dict[str, float], targets: dict[str, float] | None) -> dict[str, float]:
    """Target shares of the values that occur. Without targets: the root of each one's share. Listed values share what the unlisted leave, which keep
    their own."""
    total = sum(observed.values())
    if targets is None:
        root = {k: v**0.5 for k, v in observed.items()}
        return {k: v / sum(root.values()) for k, v in root.items()}
    listed = {k: targets[k] for k in observed if k in targets}
    rest = {k: v / total for k, v in observed.items() if k not in targets}
    room = 1.0 - sum(rest.values())
    scale = sum(listed.values())
    return {**{k: v / scale * room for k, v in listed.items()}, **rest} if scale > 0 else {k: v / total for k, v in observed.items()}


def rake(cells: list[tuple], weights: list[float], targets: list[dict[str, float] | None], rounds: int = ROUNDS) -> np.ndarray:
    """Fitted weights of the cells, whose total is the observed total. ``cells`` holds a value for each dimension."""
    w = np.array(weights, float)
    total = w.sum()
    coded = []
    for d, target in enumerate(targets):
        values = sorted({c[d] for c in cells})
        code = {v: i for i, v in enumerate(values)}
        at = np.array([code[c[d]] for c in cells], int)
        seen = np.bincount(at, weights=w, minlength=len(values))
        want = target_shares(dict(zip(values, seen.tolist(), strict=True)), target)
        coded.append((at, np.array([want[v] for v in values])))
    for _ in range(rounds):
        for at, want in coded:
            have = np.bincount(at, weights=w, minlength=len(want))
            w = w * (want * total / np.where(have > 0, have, 1.0))[at]
    return w


def calibrate(observed: np.ndarray, fitted: np.ndarray, budget: float) -> np.ndarray:
    """Sampling probabilities min(1, k * fitted / observed) whose expected tokens are ``budget`` of all: k by cells, highest ratio first."""
    ratio = np.where(observed > 0, fitted / np.where(observed > 0, observed, 1.0), 0.0)
    order = np.argsort(-ratio, kind="stable")
    want = budget * observed.sum()
    whole = np.concatenate([[0.0], np.cumsum(observed[order])])  # tokens of the cells that are taken whole
    rest = np.concatenate([np.cumsum(fitted[order][::-1])[::-1], [0.0]])
    for j in range(len(order)):
        k = (want - whole[j]) / rest[j] if rest[j] > 0 else 0.0
        if k * ratio[order[j]] <= 1.0:
            return np.minimum(1.0, np.maximum(0.0, k) * ratio)
    return np.ones(len(order))


def chance(id_col: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(f":{seed}"))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def rake_distributed(cells: DataFrame, dims: list[str], targets: list[dict[str, float] | None], rounds: int) -> DataFrame:
    """``fitted`` for each cell, for more cells than the driver should hold. Marginals are summed and joined; each round is written."""
    spark = cells.sparkSession
    (total,) = cells.agg(F.sum("tokens")).first()
    wants = []
    for d, target in zip(dims, targets, strict=True):
        seen = cells.groupBy(d).agg(F.sum("tokens").alias("have"))
        if target is None:
            (roots,) = seen.agg(F.sum(F.sqrt("have"))).first()
            wants.append(written(seen.select(d, (F.sqrt("have") / F.lit(roots)).alias("want")), "want"))
        else:
            listed = spark.createDataFrame([(k, float(v)) for k, v in target.items()], f"{d} string, listed double")
            both = seen.join(listed, d, "left")
            rest, scale = both.agg(F.sum(F.when(F.col("listed").isNull(), F.col("have"))), F.sum("listed")).first()
            room = 1.0 - (rest or 0) / total
            wants.append(written(both.select(d, F.when(F.col("listed").isNull(), F.col("have") / F.lit(total)).otherwise(F.col("listed") * F.lit(room / (scale or 1.0))).alias("want")), "want"))
    out = cells.withColumn("fitted", F.col("tokens").cast("double"))
    for _ in range(rounds):
        for d, want in zip(dims, wants, strict=True):
            have = out.groupBy(d).agg(F.sum("fitted").alias("have")).join(want, d).select(d, F.when(F.col("have") > 0, F.col("want") * F.lit(float(total)) / F.col("have")).otherwise(1.0).alias("by"))
            out = out.join(have, d).withColumn("fitted", F.col("fitted") * F.col("by")).drop("by")
        out = written(out, "raked")
    return out


def mix(docs: DataFrame, targets: dict[str, dict[str, float] | None], weight: Column, budget: float = BUDGET, rounds: int = ROUNDS, seed: str = SEED, id_col: str = "doc_id", most_cells: int = 200_000) -> DataFrame:
    """All rows of ``docs`` with ``n_tokens``, ``prob`` and ``sampled`` (columns of those names are replaced).

    ``targets`` maps columns to target shares by value, or to None for root weights. Null values are a value of their own. Sampling
    depends on id and seed only, so repeated rows share their fate; documents without tokens have their cell's probability (0 in a cell without any).
    A cell whose ratio asks for more than it has is taken whole, and the others carry the rest of the budget. An empty table stays empty.

    Documents are read twice and never shuffled. Up to ``most_cells`` cells are raked on the driver and
    sent as a table of that bound; more are raked as a table and joined.
    """
    spark = docs.sparkSession
    dims = list(targets)
    keys = free_names(docs, *[f"_{d}" for d in dims])
    named = [F.coalesce(F.col(d).cast("string"), F.lit(NONE)).alias(k) for d, k in zip(dims, keys, strict=True)]
    own = docs.drop("n_tokens", "prob", "sampled").withColumn("n_tokens", weight)
    keyed = own.select("*", *named)
    cells = written(keyed.groupBy(*keys).agg(F.sum("n_tokens").alias("tokens")), "cells")
    count = cells.count()
    if count <= most_cells:
        rows = sorted(tuple(r) for r in cells.collect())
        seen = np.array([r[-1] for r in rows], float)
        fitted = rake([r[:-1] for r in rows], seen.tolist(), list(targets.values()), rounds) if rows else seen
        prob = calibrate(seen, fitted, budget) if rows else seen
        schema = ", ".join(f"{k} string" for k in keys) + ", prob double"
        table = F.broadcast(spark.createDataFrame([(*r[:-1], float(p)) for r, p in zip(rows, prob, strict=True)], schema))
    else:
        raked = rake_distributed(cells, keys, list(targets.values()), rounds)
        (total,) = raked.agg(F.sum("tokens")).first()
        k, before = budget, -1.0
        while k != before:  # the factor for which taken cells and the rest make the budget
            before = k
            ratio = F.lit(k) * F.col("fitted") >= F.col("tokens")
            whole, rest = raked.agg(F.sum(F.when(ratio, F.col("tokens")).otherwise(0)), F.sum(F.when(~ratio, F.col("fitted")).otherwise(0.0))).first()
            k = (budget * total - whole) / rest if rest else k
        table = raked.select(*keys, F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.lit(k) * F.col("fitted") / F.col("tokens"))).otherwise(0.0).alias("prob"))
    out = keyed.join(table, keys).drop(*keys)
    return out.withColumn("sampled", chance(F.col(id_col), seed) < F.col("prob"))


TARGETS = {"source": None, "lang": LANGS, "topic": TOPICS}


def production_mix(docs: DataFrame) -> DataFrame:
    """``docs`` with n_tokens, topic, prob and sampled, under the production targets."""
    words = n_words(F.col("text"))
    return mix(docs.withColumn("topic", topic_of(F.col("text"), words)), TARGETS, words)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    # texts are read once: what the mix needs of them is small and written
    own = docs.withColumn("words", n_words(F.col("text"))).withColumn("topic", topic_of(F.col("text"), F.col("words")))
    own = written(own.drop("text"), "weights")
    out = mix(own, TARGETS, F.col("words"))
    return out.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("prob", 6).alias("prob"), "sampled")


def _op2_sql() -> str:
    values = lambda x: ", ".join(f"('{k}', {v})" for k, v in x.items())
    steps = []
    last = "cells0"
    for i in range(ROUNDS):
        for d in ("source", "lang", "topic"):
            name = f"{d}{i}"
            steps.append(f"{name} AS MATERIALIZED (SELECT c.s, c.l, c.t, c.tokens, c.w * (t.want * g.total / sum(c.w) OVER (PARTITION BY c.{d[0]})) AS w FROM {last} c JOIN want_{d} t ON t.v = c.{d[0]} CROSS JOIN total g)")
            last = name
    want = lambda d, x: f"want_{d} AS MATERIALIZED (SELECT o.{d[0]} AS v, CASE WHEN x.k IS NULL THEN o.n / g.total ELSE x.share / sum(x.share) OVER () * (1 - coalesce(sum(CASE WHEN x.k IS NULL THEN o.n / g.total END) OVER (), 0)) END AS want FROM (SELECT {d[0]}, sum(tokens) AS n FROM cells0 GROUP BY 1) o LEFT JOIN (VALUES {values(x)}) x(k, share) ON x.k = o.{d[0]} CROSS JOIN total g)"
    return f"""
WITH d0 AS (SELECT doc_id, coalesce(text, '') AS text, source, lang, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n FROM documents),
d AS MATERIALIZED (SELECT doc_id, source, lang, n AS n_tokens, coalesce(source, '{NONE}') AS s, coalesce(lang, '{NONE}') AS l,
  CASE WHEN n < 20 THEN 'short' WHEN (length(text) - length(replace(text, '|', ''))) * 4 > n THEN 'list'
       WHEN (length(text) - length(regexp_replace(text, '[%&*$#!]', '', 'g'))) * 2 > n THEN 'marked' ELSE 'prose' END AS t FROM d0),
cells0 AS MATERIALIZED (SELECT s, l, t, sum(n_tokens)::DOUBLE AS tokens, sum(n_tokens)::DOUBLE AS w FROM d GROUP BY ALL),
total AS MATERIALIZED (SELECT sum(tokens) AS total FROM cells0),
want_source AS MATERIALIZED (SELECT s AS v, sqrt(n) / sum(sqrt(n)) OVER () AS want FROM (SELECT s, sum(tokens) AS n FROM cells0 GROUP BY s)),
{want('lang', LANGS)},
{want('topic', TOPICS)},
{', '.join(steps)},
ratios AS (SELECT s, l, t, tokens, w, CASE WHEN tokens > 0 THEN w / tokens ELSE 0 END AS ratio FROM {last}),
sums AS (SELECT *, coalesce(sum(tokens) OVER (ORDER BY ratio DESC, s, l, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS whole,
  sum(w) OVER (ORDER BY ratio DESC, s, l, t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM ratios),
ks AS (SELECT ({BUDGET} * g.total - whole) / nullif(rest, 0) AS k, ratio, whole FROM sums CROSS JOIN total g),
pick AS (SELECT max_by(k, ratio) AS k FROM (SELECT k, ratio FROM ks WHERE k * ratio <= 1)),
p AS (SELECT s, l, t, least(1.0, greatest(0, k) * ratio) AS prob FROM ratios CROSS JOIN pick)
SELECT doc_id, source, lang, d.t AS topic, n_tokens, round(prob, 6) AS prob,
       ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{SEED}'), 1, 8))::BIGINT / 4294967296.0 < prob AS sampled
FROM d JOIN p ON p.s = d.s AND p.l = d.l AND p.t = d.t
"""


OP2_SQL = _op2_sql()
