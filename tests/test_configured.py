"""Configured pipelines: models from checkpoints, policies, windows over streams, regimes between runs; operators behind the queries."""

from __future__ import annotations

import json
import math
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from chronosift import schema
from chronosift.functions import calendar
from chronosift.functions import series as S
from chronosift.operators import datasets, detect, forecast, graph, regime, windows
from chronosift.plans import pipeline
from chronosift.sinks import rows, store
from chronosift.streaming import engine

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import tests

SPEC = {"n_channels": 1, "context_length": 16, "horizon": 4, "patch_length": 4, "stride": 4, "d_model": 8, "n_heads": 2, "n_layers": 1, "d_ff": 8, "unknown": 1}


def series_points(spark, n=120, bad=None):
    rows_ = [("e1", c, i * 1000, math.sin(i / 5) + (50.0 if bad and i >= bad and c == "a" else 0.0)) for i in range(n) for c in ("a", "b")]
    rows_ += [("e2", "a", i * 1000, float(i)) for i in range(6)]
    return spark.createDataFrame(rows_, engine.POINTS)


class Repeats:
    """A model that repeats the last value, and rebuilds with the error of a flat line."""

    spec = forecast.ModelSpec.from_dict(SPEC)

    def forecast(self, x):
        return np.repeat(x[:, -1:], self.spec.horizon, axis=1)

    def reconstruct(self, x):
        return x, ((x - x.mean(axis=1, keepdims=True)) ** 2).mean(axis=1)


class Fails(Repeats):
    def forecast(self, x):
        raise RuntimeError("no such weight")


# ---- models


def test_injected_model_scores_like_plain_loops(spark):
    pts = series_points(spark, bad=116)
    got = {(r.entity_uid, r.metric_name): r for r in pipeline.build_detector({"type": "patch-forecast-infer"}, Repeats())(pts).collect()}
    v = np.array([math.sin(i / 5) + (50 if i >= 116 else 0) for i in range(120)])
    error = lambda s: math.sqrt(((v[s + 16 : s + 20] - v[s + 15]) ** 2).mean())
    history = [error(s) for s in range(0, int(120 * 0.8) - 20 + 1, 4)]
    assert abs(got["e1", "a"].score - round(error(100) / np.mean(history[-5:]), 4)) < 1e-3
    assert (got["e1", "a"].severity, got["e1", "a"].method) == ("critical", "forecast-model")
    assert got["e1", "b"].severity == "normal"
    assert got["e2", "a"].method == "zscore" and got["e2", "a"].labels == {}  # too short
    back = {(r.entity_uid, r.metric_name): r for r in pipeline.build_detector({"type": "reconstruction-infer"}, Repeats())(pts).collect()}
    assert back["e1", "a"].severity == "critical" and back["e1", "b"].method == "reconstruct-model"


def test_failing_model_falls_back_and_says_so(spark):
    got = {(r.entity_uid, r.metric_name): r for r in pipeline.build_detector({"type": "patch-forecast-infer"}, Fails())(series_points(spark)).collect()}
    assert got["e1", "a"].method == "zscore" and got["e1", "a"].labels == {"fallback": "RuntimeError: no such weight"}


def test_checkpoints_are_loaded_once_and_must_fit(spark, tmp_path, monkeypatch):
    spec = forecast.ModelSpec.from_dict(SPEC)
    forecast.save_model(str(tmp_path / "f.npz"), forecast.random_weights(spec, 1))
    rows.write_weights(spark, forecast.random_weights(spec, 2), str(tmp_path / "r"))
    config = {"type": "patch-forecast-infer", "params": {"forecast_ckpt": str(tmp_path / "f.npz"), "reconstruct_ckpt": str(tmp_path / "r"), "spec": SPEC, "threshold": {"type": "fixed", "warning": 0.0, "critical": 1e9}}}
    loads = []
    real = pipeline.load_pair
    monkeypatch.setattr(pipeline, "load_pair", lambda *a: loads.append(1) or real(*a))
    judge = pipeline.build_detector(config)
    for _ in range(2):
        got = {(r.entity_uid, r.metric_name): r for r in judge(series_points(spark)).collect()}
    assert len(loads) == 1 and got["e1", "a"].method == "forecast-model"
    assert got["e1", "a"].severity == "warning"  # the policy's cuts, not the default ones
    with pytest.raises(ValueError, match="needs a model"):
        pipeline.build_detector({"type": "reconstruction-infer"})
    with pytest.raises(ValueError, match="doesn't fit"):
        real(spark, str(tmp_path / "f.npz"), str(tmp_path / "r"), {**SPEC, "d_model": 12})
    with pytest.raises(Exception, match="missing"):
        real(spark, str(tmp_path / "missing.npz"), str(tmp_path / "r"), SPEC)


def test_weights_survive_both_formats(spark, tmp_path):
    weights = forecast.random_weights(forecast.ModelSpec.from_dict(SPEC), 3)
    rows.write_weights(spark, weights, str(tmp_path / "w"))
    forecast.save_model(str(tmp_path / "w.npz"), weights)
    for path in ("w", "w.npz"):
        got = rows.read_weights(spark, str(tmp_path / path))
        assert got.keys() == weights.keys() and all(np.allclose(got[k], v) for k, v in weights.items())


def test_policy_goes_by_windows(spark):
    """With windows as ticks an adaptive policy has a history; a first window has the fixed cuts."""
    rows_ = [("e", "m", w, i * 1000, float(i % 3) + (30.0 if w == 9 and i > 27 else 0)) for w in range(10) for i in range(30)]
    pts = spark.createDataFrame(rows_, "group_id string, channel string, win_start long, ts_ms long, value double")
    judge = pipeline.build_detector({"type": "patch-forecast-infer", "threshold": {"type": "mad", "min_history": 4}}, Repeats(), ("win_start",))
    got = {r.win_start: r.severity for r in judge(pts).collect()}
    assert got[9] == "critical" and all(got[w] == "normal" for w in range(9))


# ---- pipelines


def test_pipeline_counts_and_seeds_from_the_store(spark, tmp_path):
    root = str(tmp_path / "kb")
    source = {"type": "points", "path": str(tmp_path / "in")}
    series_points(spark, bad=116).write.parquet(source["path"])
    ahead = {"type": "patch-forecast-infer"}
    config = {"source": source, "detector": {"type": "regime-switch", "forecast": ahead, "detective": {"type": "reconstruction-infer"}, "seed": root}, "sinks": [{"type": "signal-store", "root": root}]}
    first = pipeline.run_pipeline(config, spark, 1000, Repeats())
    assert first["records_out"] == 3 and first["rows_in"] >= 246
    read = store.SignalStore(spark, root)
    assert {r.metric_name: r.labels["regime"] for r in read.query("e1").collect()} == {"a": "incident", "b": "normal"}
    assert read.query("e1", "a").first().labels["mode"] == "anticipation"
    pipeline.run_pipeline(config, spark, 2000, Repeats())
    second = {r.metric_name: r for r in read.query("e1", since=2000).collect()}
    assert second["a"].labels["mode"] == "detective" and second["b"].labels["mode"] == "anticipation"


def test_streaming_from_the_configuration(spark, tmp_path):
    """A file of settings runs windows over a replayed stream; the result is that of the batch form, and a retried batch doubles nothing."""
    root = str(tmp_path / "kb")
    config = {
        "source": {"type": "synthetic", "group_ids": ["g"], "channels": ["cpu", "mem"], "n_points": 120, "slope": 0.01, "anomaly_at": 118},
        "engine": {"streaming": True, "window": {"size_s": 300, "period_s": 300, "lateness_s": 60, "early_every": 5}, "folder": str(tmp_path / "work"), "panes": str(tmp_path / "panes")},
        "entity_rollup": True,
        "sinks": [{"type": "signal-store", "root": root}],
    }
    path = tmp_path / "c.json"
    path.write_text(json.dumps(config))
    out = pipeline.run_pipeline(pipeline.load_config(str(path)), spark)
    assert out["rows_in"] == 240 and out["batches"] >= 2
    read = store.SignalStore(spark, root).read()
    pts = pipeline.SyntheticSource(["g"], ["cpu", "mem"], 120, slope=0.01, anomaly_at=118).read(spark)
    want = {(r.metric_name, r.ts): (r.score, r.severity) for r in engine.windowed_zscore(pts, engine.WindowSpec(300, 300), streaming=False).collect()}
    newest = {}
    for r in read.where("metric_name <> '__entity__'").collect():
        old = newest.get((r.metric_name, r.ts))
        newest[r.metric_name, r.ts] = r if old is None or r.n_points >= old.n_points else old
    assert {k: (r.score, r.severity) for k, r in newest.items()} == want
    assert read.where("metric_name = '__entity__'").count() >= 6 and any(r.severity != "normal" for r in newest.values())
    assert spark.read.parquet(str(tmp_path / "panes") + "/*").where("kind = 'early'").count() > 0
    before = read.count()
    rows_ = read.limit(3)
    sink = pipeline.StoreSink(root)
    for _ in range(2):
        sink.write_batch(rows_.withColumn("text", F.lit("again")), "stream-77")
    assert store.SignalStore(spark, root).read().count() == before + 3


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], engine.POINTS).write.parquet(str(tmp_path / "in"))
    source = {"type": "points", "path": str(tmp_path / "in")}
    for detector in ({"type": "zscore"}, {"type": "regime-switch"}):
        config = {"source": source, "detector": detector, "entity_rollup": True, "sinks": [{"type": "signal-store", "root": str(tmp_path / "kb")}]}
        assert pipeline.run_pipeline(config, spark, 1) == {"rows_in": 0, "records_out": 0}


def test_late_element_comes_last(spark, tmp_path):
    source = pipeline.SyntheticSource(["g"], ["c"], 20, late_at=3)
    stream = source.read_stream(spark, str(tmp_path / "f"), parts=3)
    seen = []
    pipeline.engine.run_stream(stream, lambda df, i: seen.append(sorted(r.ts_ms for r in df.collect())), str(tmp_path / "c"), "append").awaitTermination()
    assert len(seen) == 4 and seen[-1] == [45_000] and sum(map(len, seen)) == 20


def test_sinks_take_streams(spark, tmp_path):
    series_points(spark, 20).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = pipeline.PointsSource(str(tmp_path / "in")).read_stream(spark)
    pivot = stream.select("group_id", "ts_ms", F.array("channel").alias("channels"), F.array("value").alias("values"), F.create_map().cast("map<string,string>").alias("labels"))
    pipeline.RowSink(str(tmp_path / "out")).write_stream(pivot, str(tmp_path / "c"))
    assert spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "out")).count() == 46


def test_streaming_deviation_policy(spark, tmp_path):
    scores = [1.0, 1.1, 0.9, 1.0, 1.05, 9.0, 1.0]
    spark.createDataFrame([("e", "m", i, s) for i, s in enumerate(scores)], "entity_uid string, metric_name string, seq long, score double").coalesce(1).write.parquet(str(tmp_path / "s"))
    out = engine.streaming_mad(engine.replay(spark, str(tmp_path / "s"), "entity_uid string, metric_name string, seq long, score double"), 8, 4)
    got = {}
    engine.run_stream(out, lambda df, i: got.update({r.seq: r.severity for r in df.collect()}), str(tmp_path / "c"), "append").awaitTermination()
    batch = spark.createDataFrame([("e", i, s) for i, s in enumerate(scores)], "k string, seq long, score double")
    from chronosift.operators import threshold

    assert got == {r.seq: r.severity for r in threshold.mad(batch, ["k"], ["seq"], 8, 4).collect()} and got[5] == "critical"


# ---- operators


def test_regime_by_plain_loop(spark):
    rng = np.random.default_rng(0)
    data = [(k, i, str(rng.choice(["critical", "warning", "normal"])), str(rng.choice(["normal", "warning"])), "incident" if k == "b" else None) for k in "abc" for i in range(200)]
    ticks = spark.createDataFrame(data, "k string, seq long, forecast_severity string, recon_severity string, s string")
    got = {(r.k, r.seq): (r.mode, r.regime, r.severity) for r in regime.switch(ticks, ["k"], enter_after=2, exit_after=2, seed="s").collect()}
    for key in "abc":
        now, streak = ("incident" if key == "b" else "normal"), 0
        for k, i, f, r, _ in data:
            if k != key:
                continue
            mode, hit, severity = ("detective", r == "normal", r) if now == "incident" else ("anticipation", f == "critical", f)
            streak = streak + 1 if hit else 0
            if streak == 2:
                now, streak = ("normal" if now == "incident" else "incident"), 0
            assert got[k, i] == (mode, now, severity)


def test_thousandths_are_those_of_printing(spark):
    rng = np.random.default_rng(1)
    xs = [round(float(x), 4) for x in rng.uniform(0, 50, 3000)] + [0.0005, 0.0015, 0.0025, 0.125, 2.5, 1e6 + 0.0005, -0.0004, -1.2345, 0.9995, 1.0, 0.0]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i long, x double").select("i", schema.thousandths(F.col("x")).alias("t")).collect()
    for r in got:
        assert r.t.replace("-0.000", "0.000") == f"{xs[r.i]:.3f}".replace("-0.000", "0.000"), xs[r.i]


def test_patterns_with_percent_signs(spark):
    one = spark.createDataFrame([("05/03/2024 07:08:09",)], "c string")
    assert one.select(calendar.parse_ts(F.col("c"), "%d/%m/%Y %H:%M:%S")).first()[0] == 1_709_622_489_000
    assert calendar.pattern("%Y-%m-%dT%H") == "yyyy-MM-dd'T'HH"
    with pytest.raises(ValueError):
        calendar.pattern("%Q")


def test_random_orders_are_repeatable(spark):
    df = spark.range(1000).select(F.col("id").alias("k"))
    a = windows.shuffled_rank(df, ["k"], 3)
    assert sorted(r["rank"] for r in a.collect()) == list(range(1000))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, windows.shuffled_rank(df.repartition(7), ["k"], 3).collect()))
    n = windows.ordinals(df.repartition(5), ["k"], 6)
    assert all(r.rn == r.k + 1 for r in n.collect())


def test_draws_by_weight_are_a_plain_lookup(spark):
    import hashlib

    weights = {f"k{i}": float(i % 7) for i in range(200)}
    df = spark.createDataFrame(list(weights.items()), "key string, w double")
    got = {r.draw: r.key for r in windows.sample_with_replacement(df, 500, F.col("w"), 9, "key").collect()}
    order = sorted((k for k in weights if weights[k]), key=lambda k: hashlib.md5(k.encode()).hexdigest())
    upto = np.cumsum([weights[k] for k in order])
    for draw in range(500):
        x = int(hashlib.md5(f"{draw}/9".encode()).hexdigest()[:8], 16) / 2**32 * upto[-1]
        assert got[draw] == order[int(np.searchsorted(upto, x, "right"))]


def test_pyramid_and_activations(spark):
    assert graph.level_sizes(96, [4, 4]) == [96, 24, 6]
    edges = {tuple(r) for r in graph.pyramid_edges(spark, 10, [4], 1).collect()}
    assert (9, 11) in edges and (0, 10) in edges and (10, 11) in edges and (0, 0) not in edges and (3, 4) in edges
    one = spark.createDataFrame([(-1.5,)], "x double").select(S.activation("relu", F.col("x")), S.activation("gelu", F.col("x")), S.sigmoid_range(F.col("x"), 0.0, 4.0)).first()
    assert one[0] == 0 and abs(one[1] + 0.1003) < 1e-3 and abs(one[2] - 4 / (1 + math.exp(1.5))) < 1e-9
    with pytest.raises(ValueError):
        S.activation("magic", F.col("x"))


def test_long_range_and_single_step_sets(spark):
    df = spark.range(60).select(F.lit("s").alias("k"), F.col("id").alias("o"), (F.col("id") % 5).cast("double").alias("value"))
    out = datasets.long_range_set(df, ["k"], ["o"], 8, 4, stride=4)
    train_end = 12 + int(0.9 * (60 - 12) / 4) * 4
    want = {"train": (train_end - 12) // 4, "test": max(0, (60 - (train_end - 7) - 12) // 4)}
    assert {r.part: r.n for r in out.groupBy("part").agg(F.count_distinct("win").alias("n")).collect()} == {k: v for k, v in want.items() if v}
    r = out.where("part = 'train' AND win = 2 AND pos = 9").first()
    mean = np.mean([i % 5 for i in range(8, 16)])
    assert abs(r["mean"] - mean) < 1e-9 and abs(r.scaled - (17 % 5) / (mean + 1)) < 1e-9
    w = windows.window_points(windows.with_length(windows.indexed(df, ["k"], ["o"]), ["k"]), 6, 3).withColumn("v", F.lit(2.0))
    step = {r.h: r for r in datasets.single_step_test(w, "elect", 6, 2).where("win = 1 AND at = 4").collect()}
    assert step[0].value == -1 and step[0].target == (3 + 4) % 5 and step[1].target == (3 + 5) % 5
    with pytest.raises(ValueError):
        datasets.single_step_test(w, "magic", 6, 2)


def test_metrics_lines(spark, tmp_path):
    rows.write_metrics(spark.createDataFrame([(0.5, 0.25, "x")], "mse double, mae double, name string"), str(tmp_path / "m"), "run-1")
    assert [r.value for r in spark.read.text(str(tmp_path / "m")).collect()] == ["run-1  mse:0.5, mae:0.25"]


def test_ett_and_noise(spark, tmp_path):
    from chronosift.sources import files

    with open(tmp_path / "ett.csv", "w") as f:
        f.write("date,HUFL,OT\n2016-07-01 00:00:00,5.8,30.5\n2016-07-01 01:00:00,5.6,27.7\n")
    got = files.ett(spark, str(tmp_path / "ett.csv")).orderBy("row").collect()
    assert [(r.HUFL, r.OT) for r in got] == [(5.8, 30.5), (5.6, 27.7)]
    plain = {(r.series_id, r.idx): r.value for r in files.sinusoids(spark, 2, 50, noise=0.0).collect()}
    noisy = {(r.series_id, r.idx): r.value for r in files.sinusoids(spark, 2, 50, noise=0.1).collect()}
    assert plain.keys() == noisy.keys() and 0 < np.std([noisy[k] - plain[k] for k in plain]) < 1


def test_recent_tail_and_labels(spark):
    pts = series_points(spark, 20)
    assert detect.recent_tail(pts, ["group_id", "channel"]).where("group_id = 'e1' AND channel = 'a'").count() == 5
