"""Streams of many keys: their states are kept in buckets, and results are those of a plain loop over each key."""

from __future__ import annotations

import time

import numpy as np
import pandas as pd
import pytest

from chronosift.operators import regime, threshold
from chronosift.plans import queries_flow
from chronosift.streaming import engine

KEYS = 1200


def recorded(spark, folder, frames, schema):
    for i, pdf in enumerate(frames):
        spark.createDataFrame(pdf, schema).coalesce(1).write.parquet(f"{folder}/{i}")
        time.sleep(1.1)  # files are replayed in the order of their times
    return engine.replay(spark, str(folder), schema)


def followed(stream, tmp_path):
    """Rows of all batches, and the most states that were kept at once."""
    out = []
    query = engine.run_stream(stream, lambda df, i: out.extend((i, *r) for r in df.collect()), str(tmp_path / "progress"), "append")
    query.awaitTermination()
    return out, max(p.stateOperators[0].numRowsTotal for p in query.recentProgress)


def halves(rows):
    """Two batches that part each key's rows somewhere else, each in no order."""
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rows)
    first = pdf[2] < 3 + pdf[0].str[1:].astype(int) % 4
    return [pdf[first].sample(frac=1, random_state=rng), pdf[~first].sample(frac=1, random_state=rng)]


def test_regimes_of_many_keys(spark, tmp_path):
    rng = np.random.default_rng(0)
    rows = [(f"e{k}", None if k % 7 == 0 else f"m{k % 2}", i, str(rng.choice(["critical", "normal"])), str(rng.choice(["normal", "warning"]))) for k in range(KEYS) for i in range(9)]
    stream = recorded(spark, tmp_path / "in", halves(rows), "entity_uid string, metric_name string, seq long, forecast_severity string, recon_severity string")
    out, states = followed(engine.streaming_regime(stream, 2, 3), tmp_path)
    want, now = {}, {}
    for e, m, i, forecast, recon in rows:
        mode, _, *now[e, m] = regime.advance(*now.get((e, m), ("normal", 0)), forecast, recon, 2, 3)
        want[e, m, i] = mode, now[e, m][0]
    assert {(e, m, i): (mode, after) for _, e, m, i, mode, after in out} == want and len(out) == len(rows)
    assert states <= engine.BUCKETS < KEYS


def judged(spark, tmp_path, policy, cuts):
    rng = np.random.default_rng(0)
    rows = [(f"e{k}", "m", i, float(rng.choice([1.0, 1.5, 2.5, rng.exponential()]))) for k in range(KEYS) for i in range(11)]
    stream = recorded(spark, tmp_path / "in", halves(rows), "entity_uid string, metric_name string, seq long, score double")
    out, states = followed(policy(stream, 5, 3), tmp_path)
    want, past = {}, {}
    for e, _, i, score in rows:
        own = past.setdefault(e, [])
        warn, crit = cuts(own[-5:]) if len(own) >= 3 else (1.8, 3.0)
        want[e, i] = score, "critical" if score > crit else "warning" if score > warn else "normal"
        own.append(score)
    assert {(e, i): (score, severity) for _, e, _, i, score, severity in out} == want and len(out) == len(rows)
    assert states <= engine.BUCKETS < KEYS


def test_deviations_of_many_keys(spark, tmp_path):
    def cuts(past):
        spread = 1.4826 * float(np.median(np.abs(np.asarray(past) - np.median(past)))) or 1e-8
        return np.median(past) + 3 * spread, np.median(past) + 5 * spread

    judged(spark, tmp_path, engine.streaming_mad, cuts)


def test_quantiles_of_many_keys(spark, tmp_path):
    judged(spark, tmp_path, engine.streaming_quantile, lambda past: (np.quantile(past, 0.95), np.quantile(past, 0.99)))


@pytest.mark.parametrize("aligned", [True, False])
def test_replayed_rows_are_dealt_to_all_cores(spark, tmp_path, monkeypatch, aligned):
    """A part is several files and a micro-batch; keys keep their order, also where a micro-batch ends within a part, and all cores have states."""
    monkeypatch.setattr(queries_flow, "_cores", lambda _: 6)
    if not aligned:
        replay = engine.replay
        monkeypatch.setattr(engine, "replay", lambda spark, folder, schema, files: replay(spark, folder, schema, files - 2))
    rng = np.random.default_rng(0)
    rows = [(f"e{k}", None if k % 7 == 0 else "m", i, float(rng.exponential())) for k in range(KEYS) for i in range(9)]
    df = spark.createDataFrame(pd.DataFrame(rows).sample(frac=1, random_state=rng), "entity_uid string, metric_name string, seq long, score double")
    stream, buckets = queries_flow._replayed(df, "seq", ["entity_uid", "metric_name"], str(tmp_path / "in"))
    for part in range(3):
        files = [pd.read_parquet(f) for f in (tmp_path / "in" / f"{part:05d}").glob("*.parquet")]
        assert len(files) == 6 and sum(f["entity_uid"].nunique() for f in files) == KEYS and all(set(f["seq"]) == {3 * part, 3 * part + 1, 3 * part + 2} for f in files)
    out = []
    query = engine.run_stream(engine.streaming_quantile(stream, 5, 3, buckets=buckets), lambda df, i: out.extend((i, *r) for r in df.collect()), str(tmp_path / "progress"), "append")
    query.awaitTermination()
    assert {p.stateOperators[0].numShufflePartitions for p in query.recentProgress} == {6} and buckets == 24
    assert len({r[0] for r in out}) == (3 if aligned else 5)
    past = {}
    for e, m, i, score in rows:
        past.setdefault((e, m), []).append((i, score))
    want = set()
    for (e, m), own in past.items():
        for j, (i, score) in enumerate(own):
            warn, crit = np.quantile([x for _, x in own[max(0, j - 5) : j]], (0.95, 0.99)) if j >= 3 else (1.8, 3.0)
            want.add((e, m, i, score, "critical" if score > crit else "warning" if score > warn else "normal"))
    assert {r[1:] for r in out} == want and len(out) == len(rows)


def test_scores_that_equal_their_quantile(spark, tmp_path):
    """The registered query over two series whose score of one day is its cut to the last decimal; interpolated in doubles the cut is below it."""
    series = {
        (1, "error"): [(0, 34.81), (2, 2.27), (3, 11.78), (4, 41.51), (6, 12.74), (7, 4.17), (9, 43.3), (9, 47.52), (11, 30.23), (12, 17.29), (16, 54.22), (18, 5.49), (20, 17.1), (21, 26.57), (21, 47.22), (22, 7.27), (22, 9.07), (22, 56.18), (22, 73.22), (23, 24.65), (24, 187.59)],
        (2, "signup"): [(0, 2.69), (0, 42.07), (2, 45.78), (3, 19.65), (6, 8.97), (6, 12.37), (6, 58.09), (15, 48.66), (16, 3.67), (20, 41.67), (22, 3.85), (26, 44.5)],
    }
    rows = [(pd.Timestamp("2024-01-03") + pd.Timedelta(days=d), user, kind, value) for (user, kind), own in series.items() for d, value in own]
    spark.createDataFrame(pd.DataFrame(rows, columns=["ts", "user_id", "event_type", "value"]), "ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(str(tmp_path / "events.parquet"))
    got = {(r.group_id, (r.day - 1_704_240_000_000) // 86_400_000): r.severity for r in queries_flow.Q.queries["str16_stream_quantile"](spark, str(tmp_path)).collect()}
    assert len(got) == 16 + 9
    assert got["1", 7] == "normal" and got["2", 22] == "warning"


def test_missing_scores_have_no_part_in_quantiles(spark, tmp_path):
    """They take a place of the window; what is left gives the cuts if there is enough of it, else the fixed ones hold. As the batch form has it."""
    rng = np.random.default_rng(0)
    rows = [(f"e{k}", "m", i, None if rng.random() < 0.3 else float(rng.exponential(2))) for k in range(60) for i in range(15)]
    schema = "entity_uid string, metric_name string, seq long, score double"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    out, _ = followed(engine.streaming_quantile(engine.replay(spark, str(tmp_path / "in"), schema), 5, 3), tmp_path)
    want = threshold.rolling_quantile(spark.createDataFrame(rows, schema), ["entity_uid", "metric_name"], ["seq"], window=5, min_history=3)
    assert {(e, i): severity for _, e, _, i, _, severity in out} == {(r.entity_uid, r.seq): r.severity for r in want.collect()} and len(out) == len(rows)


def test_panes_of_many_keys(spark, tmp_path):
    """Early panes over two batches; windows that the watermark has left fire once more in their time, whether their bucket has new rows or not."""
    rng = np.random.default_rng(0)
    rows = [(f"g{k}", "c", int(t), float(k)) for k in range(KEYS) for t in rng.integers(0, 60_000, 1 + k % 5)]
    more = [(f"g{k}", "c", int(t), float(k)) for k in range(0, KEYS, 2) for t in rng.integers(0, 60_000, 2)]
    later, last = [("g0", "c", 200_000, 1.0)], [(f"g{k}", "c", 230_000, 1.0) for k in range(0, KEYS, 3)]
    stream = recorded(spark, tmp_path / "in", [pd.DataFrame(x) for x in (rows, more, later, last)], engine.POINTS)
    out, states = followed(engine.counted_panes(stream, engine.WindowSpec(60, 60, lateness_s=60, early_every=2)), tmp_path)
    counts = pd.Series([r[0] for r in rows + more]).value_counts()
    early = sorted((g, n) for _, g, _, start, _, kind, n, _ in out if start == 0 and kind == "early")
    assert early == sorted((g, n) for g, c in counts.items() for n in range(2, c + 1, 2))
    timed = sorted((g, n, total) for _, g, _, start, _, kind, n, total in out if start == 0 and kind == "on_time")
    assert timed == sorted((g, c, float(c * int(g[1:]))) for g, c in counts.items() if c % 2)
    assert all(pane == (n - 1) // 2 for _, _, _, start, pane, _, n, _ in out if start == 0)
    assert states <= engine.BUCKETS < KEYS


def test_buckets_are_one_at_least(spark, tmp_path):
    with pytest.raises(ValueError, match="buckets"):
        engine.streaming_mad(engine.replay(spark, str(tmp_path), "entity_uid string, metric_name string, seq long, score double"), buckets=0)
