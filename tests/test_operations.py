"""Alignment, detection, roll-up, thresholds, regimes and validation on small literal cases."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronosift import schema
from chronosift.operators import align, detect, regime, threshold

POINTS = "group_id string, channel string, ts_ms long, value double"


def aligned(spark, rows, step, fill):
    df = spark.createDataFrame([("e", *r) for r in rows], POINTS)
    out = align.to_rows(align.align_long(df, step, fill)).orderBy("ts_ms").collect()
    return [(r.ts_ms, *r["values"]) for r in out]


@pytest.mark.parametrize(
    ("rows", "step", "fill", "want"),
    [
        ([("cpu", 0, 1.0), ("cpu", 15000, 1.1), ("cpu", 30000, 1.2), ("mem", 0, 5.0), ("mem", 30000, 5.5)], 15000, "ffill", [(0, 1.0, 5.0), (15000, 1.1, 5.0), (30000, 1.2, 5.5)]),
        ([("cpu", 0, 1.0), ("cpu", 15000, 1.1), ("mem", 15000, 5.0)], 15000, "drop", [(15000, 1.1, 5.0)]),
        ([("a", 0, 1.0), ("b", 1000, 2.0)], 1000, "zero", [(0, 1.0, 0.0), (1000, 1.0, 2.0)]),
        ([("a", 0, 1.0), ("a", 1000, 1.1), ("a", 2000, 1.2), ("b", 2000, 9.0)], 1000, "ffill", [(2000, 1.2, 9.0)]),
        ([("cpu", 0, 1.0), ("cpu", 1000, 2.0)], 1000, "ffill", [(0, 1.0), (1000, 2.0)]),
        ([("a", 0, 1.0), ("b", 0, 2.0), ("a", 1000, 3.0)], 1000, "drop_strict", [(0, 1.0, 2.0)]),
        ([("a", -1, 7.0)], 1000, "ffill", [(-1000, 7.0)]),
        ([("a", 5, 1.0), ("a", 5, 3.0), ("a", 4, 9.0)], 10, "ffill", [(0, 3.0)]),
    ],
)
def test_alignment(spark, rows, step, fill, want):
    assert aligned(spark, rows, step, fill) == want


def test_alignment_of_nothing_and_bad_fill(spark):
    none = spark.createDataFrame([], POINTS)
    assert align.align_long(none, 1000).count() == 0
    with pytest.raises(ValueError, match="unknown fill"):
        align.align_long(none, 1000, "spline")


def test_rows_and_points_round_trip(spark):
    df = spark.createDataFrame([("e", "b", 0, 1.0), ("e", "a", 0, 2.0), ("f", "a", 5, 3.0)], POINTS)
    back = align.to_points(align.to_rows(align.align_long(df, 5)))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def z(spark, values, **kw):
    df = spark.createDataFrame([("e", "m", i, float(v)) for i, v in enumerate(values)], POINTS)
    return detect.zscore(df, ["group_id", "channel"], **kw).first()


def test_zscore(spark):
    spike = z(spark, [10.0] * 50 + [200.0])
    assert spike.severity == "critical" and spike.score > 4.5 and spike.n_points == 51
    assert z(spark, [10.0] * 50 + [200.0], warning=2, critical=100).severity == "warning"
    assert tuple(z(spark, [3.0] * 20))[2:] == (20, 0.0, "normal")
    assert tuple(z(spark, [1.0, 99.0]))[2:] == (2, 0.0, "normal")
    rng = np.random.default_rng(0)
    x = rng.normal(size=40)
    want = np.abs((x - x.mean()) / x.std())[-10:].max()
    assert abs(z(spark, x).score - round(want, 4)) < 1e-9


def test_nan_is_normal(spark):
    assert z(spark, [1.0] * 20 + [float("nan")]).severity == "normal"


SIG = "entity_uid string, metric_name string, severity string, score double, n_points long"


def test_roll_up(spark):
    df = spark.createDataFrame([("e", "cpu", "critical", 5.0, 10), ("e", "mem", "warning", 2.0, 30), ("e", "net", "normal", 0.1, 20)], SIG)
    r = detect.roll_up(df).first()
    assert (r.severity, r.score, r.metric_name, r.method, r.n_points) == ("critical", 5.0, "__entity__", "aggregate", 30)
    assert r.labels == {"n_channels": "3", "n_anomalous": "2", "top_channel": "cpu", "rollup_policy": "max"}
    two = spark.createDataFrame([("e", "a", "warning", 3.0, 1), ("e", "b", "critical", 4.0, 1)], SIG)
    assert [detect.roll_up(two, p).first().score for p in ("max", "mean", "l2")] == [4.0, 3.5, 5.0]
    again = detect.roll_up(two.unionByName(detect.roll_up(two).select(*two.columns)))
    assert again.count() == 1 and again.first().labels["n_channels"] == "2"
    with pytest.raises(ValueError, match="unknown policy"):
        detect.roll_up(two, "median")


def test_roll_up_ties_go_to_the_first_name(spark):
    df = spark.createDataFrame([("e", "b", "warning", 2.0, 1), ("e", "a", "warning", 2.0, 1)], SIG)
    assert detect.roll_up(df).first().labels["top_channel"] == "a"


def judged(spark, policy, scores, **kw):
    df = spark.createDataFrame([("e", "m", i, float(s)) for i, s in enumerate(scores)], "entity string, metric string, seq long, score double")
    return [r.severity for r in policy(df, ["entity", "metric"], ["seq"], **kw).orderBy("seq").collect()]


def test_thresholds(spark):
    fixed = threshold.fixed(spark.createDataFrame([(1.0,), (1.8,), (3.0,)], "score double"))
    assert [r.severity for r in fixed.collect()] == ["normal", "warning", "critical"]
    calm = [1.0, 1.1, 0.9, 1.05, 0.95] * 4
    assert judged(spark, threshold.rolling_quantile, [*calm, 1.0, 10.0])[-2:] == ["normal", "critical"]
    assert judged(spark, threshold.rolling_quantile, [1.8, 1.9, 3.0, 3.1]) == ["normal", "warning", "warning", "critical"]
    assert judged(spark, threshold.mad, [*([1.0] * 19), 50.0, 1.0, 100.0])[-2:] == ["normal", "critical"]
    assert judged(spark, threshold.mad, [*([2.0] * 16), 2.0, 9.0])[-2:] == ["normal", "critical"]


def test_thresholds_against_numpy(spark):
    x = np.random.default_rng(1).gamma(2, 1, 120).round(3)
    got_q, got_m = judged(spark, threshold.rolling_quantile, x, window=20, min_history=5), judged(spark, threshold.mad, x, window=20, min_history=5)
    for i, s in enumerate(x):
        past = x[max(0, i - 20) : i]
        if len(past) < 5:
            continue
        w, c = np.quantile(past, 0.95), np.quantile(past, 0.99)
        assert got_q[i] == ("critical" if s > c else "warning" if s > w else "normal") or min(abs(s - w), abs(s - c)) < 1e-9
        mid = np.median(past)
        spread = 1.4826 * np.median(np.abs(past - mid)) or 1e-8
        assert got_m[i] == ("critical" if s > mid + 5 * spread else "warning" if s > mid + 3 * spread else "normal")


def regimes(spark, forecast, recon, enter=1, leave=1, seed=None):
    rows = [("e", "m", i, f, r, seed) for i, (f, r) in enumerate(zip(forecast, recon, strict=True))]
    df = spark.createDataFrame(rows, "entity string, metric string, seq long, forecast_severity string, recon_severity string, start string")
    out = regime.switch(df, ["entity", "metric"], enter_after=enter, exit_after=leave, seed="start").orderBy("seq").collect()
    if enter == leave == 1:
        plain = regime.switch_by_window(df, ["entity", "metric"], seed="start").orderBy("seq").collect()
        assert [(r.mode, r.regime, r.severity) for r in out] == [(r.mode, r.regime, r.severity) for r in plain]
    return [r.regime[0] for r in out], [r["mode"][0] for r in out]


def test_regimes(spark):
    assert regimes(spark, ["normal", "critical", "x", "x"], ["x", "x", "critical", "normal"])[0] == list("niin")
    assert regimes(spark, ["critical", "critical"], ["x", "x"], 2)[0] == list("ni")
    assert regimes(spark, ["critical", "normal", "critical"], ["x"] * 3, 2)[0] == list("nnn")
    assert regimes(spark, ["critical", "x", "x"], ["x", "normal", "normal"], 1, 2)[0] == list("iin")
    assert regimes(spark, ["critical", "x", "x", "x"], ["x", "normal", "warning", "normal"], 1, 2)[0] == list("iiii")
    assert regimes(spark, ["normal"], ["warning"], seed="incident") == (["i"], ["d"])
    assert regimes(spark, ["normal"], ["warning"], seed="never heard of") == (["n"], ["a"])
    with pytest.raises(ValueError, match="1 or more"):
        regime.switch(spark.range(1), ["id"], enter_after=0)


def test_random_regimes_agree_in_both_forms(spark):
    rng = np.random.default_rng(2)
    f, r = rng.choice(["normal", "critical"], 200), rng.choice(["normal", "warning"], 200)
    state, want = "n", []
    for a, b in zip(f, r, strict=True):
        state = ("n" if b == "normal" else "i") if state == "i" else ("i" if a == "critical" else "n")
        want.append(state)
    assert regimes(spark, f.tolist(), r.tolist())[0] == want


def test_validation(spark):
    rows = [("g", 1, ["a", "b"], [1.0, 2.0]), ("", 1, ["a"], [1.0]), ("g", None, ["a"], [1.0]), ("g", 1, ["a"], [1.0, 2.0]), ("g", 1, ["a", "a"], [1.0, 2.0])]
    df = spark.createDataFrame(rows, "group_id string, ts_ms long, channels array<string>, values array<double>")
    good, bad = schema.quarantine(df, schema.pivot_problem())
    assert good.count() == 1 and {r.problem for r in bad.collect()} == {"empty group_id", "no timestamp", "values do not match channels", "channels repeat"}
    assert schema.checked(good, schema.pivot_problem()).count() == 1
    with pytest.raises(Exception, match="empty group_id|no timestamp|values do not|channels repeat"):
        schema.checked(df, schema.pivot_problem()).collect()
    sig = spark.createDataFrame([("e", 1, "normal", ""), ("", 1, "normal", ""), ("e", 1, "odd", ""), ("e", 1, "normal", "far")], "entity_uid string, ts long, severity string, horizon string")
    assert schema.quarantine(sig, schema.signal_problem())[0].count() == 1


def test_signal_text_and_labels(spark):
    df = spark.createDataFrame([("e", "m", "critical", 4.56789, "zscore", 9)], "entity_uid string, metric_name string, severity string, score double, method string, n_points long")
    assert schema.as_signals(df, 5).first().text == "signal metric=m entity=e severity=critical score=4.568 method=zscore n=9"
    merged = df.select(schema.merge_labels(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), F.create_map(F.lit("b"), F.lit("3"))).alias("m")).first().m
    assert merged == {"a": "1", "b": "3"}


def test_ratio_detector(spark):
    rows = [("e", i, False, 1.0) for i in range(8)] + [("e", 8, True, 3.5), ("f", 0, True, 2.0)]
    out = {r.k: r for r in detect.error_ratio(spark.createDataFrame(rows, "k string, win int, is_eval boolean, error double"), ["k"]).collect()}
    assert (out["e"].score, out["e"].severity, out["f"].score, out["f"].severity) == (3.5, "critical", 1.0, "normal")
