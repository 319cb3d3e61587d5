"""Parts of research forecasters against plain loops, forward passes, autoregression, trees, and two-stage training."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronosift.operators import forecast, graph, neural

RNG = np.random.default_rng(0)


def test_masks():
    assert neural.causal(4).tolist() == [[j > i for j in range(4)] for i in range(4)]
    closed = neural.pyramid(8, [4], 1)
    assert closed.shape == (10, 10) and not closed[3, 4] and closed[3, 5] and not closed[3, 8] and not closed[8, 3] and not closed[8, 9] and closed[0, 9]
    assert (closed == closed.T).all()


def test_pyramid_mask_is_the_graphs(spark):
    closed = neural.pyramid(64, [4, 4], 2)
    open_pairs = {(int(a), int(b)) for a, b in np.argwhere(~closed) if a != b}
    edges = {tuple(r) for r in graph.pyramid_edges(spark, 64, [4, 4], 2).collect()}
    assert open_pairs == edges | {(b, a) for a, b in edges}


def test_full_attention_by_loops():
    q, k, v = RNG.normal(size=(3, 2, 2, 5, 3))
    out = neural.attend(q, k, v, neural.causal(5))
    for b in range(2):
        for h in range(2):
            for i in range(5):
                w = [math.exp(q[b, h, i] @ k[b, h, j] / math.sqrt(3)) for j in range(i + 1)]
                assert np.allclose(out[b, h, i], sum(x * v[b, h, j] for j, x in enumerate(w)) / sum(w))


def test_sparse_attention_of_all_queries_is_full():
    q, k, v = RNG.normal(size=(3, 1, 2, 6, 4))
    assert np.allclose(neural.attend_sparse(q, k, v, factor=50), neural.attend(q, k, v))
    assert np.allclose(neural.attend_sparse(q, k, v, factor=50, masked=True), neural.attend(q, k, v, neural.causal(6)))
    few = neural.attend_sparse(q, k, v, factor=0.5)
    mean = v.mean(axis=2, keepdims=True)
    assert 0 < np.isclose(few, mean).all(axis=-1).sum() < 12


def test_delays_find_the_period():
    t = np.arange(48)
    x = np.sin(2 * np.pi * t / 12)[None, None, :, None]
    c = neural.correlation(x, x)[0, 0, :, 0]
    assert np.allclose(c[5], sum(x[0, 0, (i + 5) % 48, 0] * x[0, 0, i, 0] for i in range(48)))
    assert set(np.flatnonzero(np.isclose(c, c.max()))) == {0, 12, 24, 36}
    assert np.allclose(neural.attend_delays(x, x, x), x, atol=1e-9)
    short = neural.attend_delays(x, x[:, :, :30], x[:, :, :30])
    assert short.shape == x.shape


def test_all_frequencies_are_the_series():
    x = RNG.normal(size=(2, 2, 16, 3))
    eye = np.broadcast_to(np.eye(3, dtype=complex), (2, 9, 3, 3))
    assert np.allclose(neural.attend_frequencies(x, list(range(9)), eye), x)
    low = neural.attend_frequencies(x, [0], eye)
    assert np.allclose(low, x.mean(axis=2, keepdims=True))
    cross = neural.attend_frequencies(x, list(range(4)), eye, k=RNG.normal(size=(2, 2, 10, 3)))
    assert cross.shape == x.shape


@pytest.mark.parametrize("n", [16, 13, 2])
def test_wavelets_put_together_again(n):
    x = RNG.normal(size=(2, 1, n, 3))
    assert np.allclose(neural.attend_wavelets(x, [np.eye(3)] * 3, np.eye(3)), x)
    smooth, detail = neural.haar(x)
    assert np.allclose(smooth[0, 0, 0] ** 2 + detail[0, 0, 0] ** 2, x[0, 0, 0] ** 2 + x[0, 0, 1] ** 2)


def test_pooling():
    x = np.arange(10.0).reshape(1, 10, 1)
    assert neural.pooled(x, [4, 2], "max")[0, 10:, 0].tolist() == [3, 7, 7]
    assert neural.pooled(x, [4])[0, 10:, 0].tolist() == [1.5, 5.5]


@pytest.mark.parametrize("kind", neural.KINDS)
def test_forward_passes(kind):
    s = neural.Shape(kind, n_channels=3, seq_len=32, label_len=16, pred_len=8, kernel=5, modes=4)
    model = neural.Forecaster(s, neural.random_weights(s, 1))
    x, marks, ahead = RNG.normal(size=(4, 32, 3)), RNG.normal(size=(4, 32, 4)), RNG.normal(size=(4, 24, 4))
    out = model.forecast(x, marks, ahead)
    assert out.shape == (4, 8, 3) and np.isfinite(out).all()
    alone = model.forecast(x[1:2], marks[1:2], ahead[1:2])
    assert np.allclose(alone[0], out[1])  # a window doesn't hang on the others
    again = neural.Forecaster(s, neural.random_weights(s, 1)).forecast(x, marks, ahead)
    assert np.array_equal(again, out)
    wide = neural.Shape(kind, n_channels=3, seq_len=32, label_len=16, pred_len=8, kernel=5, modes=4, gaussian=True)
    mean, sd = neural.Forecaster(wide, neural.random_weights(wide, 2)).forecast(x, marks, ahead)
    assert mean.shape == sd.shape == (4, 8, 3) and (sd > 0).all()
    with pytest.raises(ValueError, match="expected"):
        model.forecast(x[:, :5], marks, ahead)
    with pytest.raises(ValueError, match="don't fit"):
        neural.Forecaster(wide, neural.random_weights(s, 1))
    with pytest.raises(ValueError, match="unknown kind"):
        neural.Shape("magic")


def test_decomposing_models_carry_the_level():
    """With weights of 0 the forecast of a decomposing model is the mean of the past, of the others 0."""
    for kind, want in (("delay", 5.0), ("frequency", 5.0), ("full", 0.0)):
        s = neural.Shape(kind, n_channels=1, seq_len=16, label_len=8, pred_len=4, kernel=5)
        model = neural.Forecaster(s, {k: np.zeros_like(v) for k, v in neural.random_weights(s).items()})
        assert np.allclose(model.forecast(np.full((1, 16, 1), 5.0), np.zeros((1, 16, 4)), np.zeros((1, 12, 4))), want)


def test_trees_follow_steps():
    x = np.repeat([[1.0, 5.0, 2.0, 8.0]], 10, axis=0).repeat(6, axis=1)
    out = forecast._boosted(x, 3, rounds=200, depth=2)
    assert np.allclose(out, 8, atol=0.05)
    tree = forecast._tree(x[:1], 3)
    assert np.allclose(tree, x[:1])
    assert np.allclose(forecast._tree(np.array([[3.0]]), 3), 3)


def test_autoregression():
    t = np.arange(120)
    assert np.allclose(forecast.arima(2.0 * t + 3, 4), 2.0 * np.arange(120, 124) + 3, atol=1e-6)
    wave = np.sin(2 * np.pi * t / 12)
    assert np.allclose(forecast.arima(wave, 6), np.sin(2 * np.pi * np.arange(120, 126) / 12), atol=1e-6)
    season = np.tile([1.0, 9, 4, 2], 20) + np.repeat(np.arange(20.0), 4)
    assert np.allclose(forecast.arima(season, 4, season=4), [21, 29, 24, 22], atol=1e-6)
    g = np.random.default_rng(3)
    x = [0.0]
    for _ in range(600):
        x.append(0.8 * x[-1] + g.normal())
    x = np.array(x)
    ahead = np.array([forecast.arima(x[: i + 1], 1)[0] for i in range(500, 600)])
    assert ((ahead - x[501:601]) ** 2).mean() < ((x[500:600] - x[501:601]) ** 2).mean()
    assert len(forecast.arima(np.array([1.0, 2.0]), 3)) == 3


def test_batches_are_single_fits():
    train, future, last = RNG.normal(size=(3, 9, 6)), RNG.normal(size=(3, 9, 2)), RNG.normal(size=(3, 4, 6))
    for kind in ("naive", "linear", "nlinear", "dlinear", "trees", "arima"):
        whole = forecast.linear_forecast(train, future, last, kind, kernel=3)
        for i in range(3):
            assert np.allclose(whole[i], forecast.linear_forecast(train[i], future[i], last[i], kind, kernel=3)), kind


SPEC = forecast.ModelSpec(n_channels=1, context_length=24, horizon=6, patch_length=6, stride=6, d_model=16, n_heads=2, n_layers=1, d_ff=16)


def test_heads_and_decomposition():
    w = forecast.random_weights(SPEC, 1)
    model = forecast.PatchTransformer(SPEC, w)
    x = RNG.normal(size=(5, 24, 1))
    h = forecast.encoded(model, x)
    assert h.shape == (5, 1, 4, 16)
    p = forecast.classification_head(h, RNG.normal(size=(16, 3)), np.zeros(3))
    assert np.allclose(p.sum(axis=1), 1)
    y = forecast.regression_head(h, RNG.normal(size=(16, 1)) * 9, np.zeros(1), -1, 1)
    assert (np.abs(y) <= 1).all() and forecast.regression_head(h, np.zeros((16, 1)), np.full(1, 7.0))[0, 0] == 7
    both = forecast.DecomposedTransformer(SPEC, w, w, kernel=1)
    # with a kernel of 1 the trend is the series and the rest 0
    assert np.allclose(both.forecast(x), model.forecast(x) + model.forecast(np.zeros_like(x)))


def test_two_stage_training(spark):
    """The trained pair forecasts better than the last value, rebuilds real windows better than shuffled ones, and hangs on no partition."""
    t = np.arange(900)
    series = np.sin(2 * np.pi * t / 16) + 0.3 * np.sin(2 * np.pi * t / 5)
    rows = [(i, [float(x) for x in series[i : i + 30]]) for i in range(0, 700)]
    df = spark.createDataFrame(rows, "i long, window array<double>")
    ahead, back = forecast.train_pair(df, SPEC, ridge=1e-3)
    again, _ = forecast.train_pair(df.repartition(5), SPEC, ridge=1e-3)
    assert np.allclose(ahead["forecast.w"], again["forecast.w"], atol=1e-4)
    assert np.array_equal(ahead["embed.w"], back["embed.w"])  # the encoder is transferred
    test = np.stack([series[i : i + 30] for i in range(720, 860, 7)])[:, :, None]
    model = forecast.PatchTransformer(SPEC, ahead)
    rmse = lambda p: math.sqrt(((p - test[:, 24:]) ** 2).mean())
    assert rmse(model.forecast(test[:, :24])) < 0.5 * rmse(np.repeat(test[:, 23:24], 6, axis=1))
    rebuild = forecast.PatchTransformer(SPEC, back)
    g = np.random.default_rng(5)
    mixed = np.stack([g.permutation(x) for x in test[:, :24]])
    assert rebuild.reconstruct(mixed)[1].mean() > 1.3 * rebuild.reconstruct(test[:, :24])[1].mean()
    with pytest.raises(ValueError, match="no windows"):
        forecast.train_pair(df.where(F.lit(False)), SPEC)


def test_experiment_by_plain_fits(spark, tmp_path, capsys):
    from chronosift.__main__ import main
    from chronosift.operators.datasets import DatasetSpec
    from chronosift.plans import experiment

    t = np.arange(200)
    x = np.sin(t / 3) + 0.01 * t
    df = spark.createDataFrame([("s", int(i), float(v)) for i, v in zip(t, x, strict=True)], "k string, o long, value double")
    what = experiment.Experiment(DatasetSpec(seq_len=12, label_len=4, pred_len=3), "nlinear")
    got = {r.part: r for r in experiment.run(df, ["k"], ["o"], what).collect()}
    a, b = int(200 * 0.7), 200 - int(200 * 0.2)
    z = (x - x[:a].mean()) / x[:a].std()
    cut = lambda lo, hi: np.stack([z[i : i + 15] for i in range(lo, hi - 14)])
    for part, lo, hi in (("val", a - 12, b), ("test", b - 12, 200)):
        own, train = cut(lo, hi), cut(0, a)
        pred = forecast.linear_forecast(train[:, :12], train[:, 12:], own[:, :12], "nlinear")
        assert abs(got[part].mse - ((pred - own[:, 12:]) ** 2).mean()) < 1e-9 and got[part].setting == "nlinear_ftM_sl12_ll4_pl3"
    with pytest.raises(ValueError, match="unknown forecaster"):
        experiment.Experiment(model="magic")
    with open(tmp_path / "x.csv", "w") as f:
        f.write("ts,OT\n" + "".join(f"{i * 3600},{v}\n" for i, v in enumerate(x)))
    assert main(["experiment", "--csv", str(tmp_path / "x.csv"), "--seq-len", "12", "--pred-len", "3", "--model", "naive", "--out", str(tmp_path / "m")]) == 0
    assert "'part': 'test'" in capsys.readouterr().out and spark.read.text(str(tmp_path / "m")).count() == 2


def test_fetch_skips_what_is_there(tmp_path):
    import io

    from chronosift.sources import files

    asked = []

    def answer(url):
        asked.append(url)
        return io.BytesIO(b"a,b\n")

    path = str(tmp_path / "x.csv")
    for _ in range(2):
        assert files.fetch("http://host/x.csv", path, answer) == path
    assert asked == ["http://host/x.csv"] and open(path).read() == "a,b\n"


def test_errors_along_series_by_loops(spark):
    """Windows, fits and errors of every closed-form model, series by series."""
    g = np.random.default_rng(6)
    data = [(f"s{i}", [float(x) for x in np.cumsum(g.normal(size=n))]) for i, n in enumerate((30, 30, 41, 9, 7, 3))]
    df = spark.createDataFrame(data, "k string, series array<double>")
    for kind in ("linear", "dlinear", "trees"):
        got = {(r.k, r.win): (r.is_eval, r.error) for r in forecast.window_errors(df, ["k"], 6, 2, kind).collect()}
        want = {}
        for k, x in data:
            x = np.array(x)
            if len(x) < 8:
                continue
            starts = [*range(0, int(len(x) * 0.8) - 8 + 1, 1)]
            train, future = np.array([x[s : s + 6] for s in starts]).reshape(-1, 6), np.array([x[s + 6 : s + 8] for s in starts]).reshape(-1, 2)
            for i, s in enumerate([*starts, len(x) - 8]):
                pred = forecast.linear_forecast(train, future, x[None, s : s + 6], kind)
                want[k, i] = (i == len(starts), math.sqrt(((pred[0] - x[s + 6 : s + 8]) ** 2).mean()))
        assert got.keys() == want.keys()
        assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-8 for k in want), kind
    got = {(r.k, r.win): r.error for r in forecast.reconstruction_errors(df, ["k"], 8, 4, rank=1).collect()}
    x = np.array(data[2][1])
    starts = [*range(0, int(41 * 0.8) - 8 + 1, 2)]
    patches = np.concatenate([x[s : s + 8].reshape(2, 4) for s in starts])
    mid = patches.mean(axis=0)
    way = np.linalg.svd(patches - mid)[2][0]
    for i, s in enumerate([*starts, 41 - 8]):
        off = x[s : s + 8].reshape(2, 4) - mid
        assert abs(got["s2", i] - math.sqrt(((off - np.outer(off @ way, way)) ** 2).mean())) < 1e-8
