"""Forecasters over windows of series, and detectors from their errors.

The repeat forecaster is pure expressions. The linear family is fitted in closed form with numpy, one group at a time.
The patch transformer is a numpy forward pass with weights from a file; weights are loaded once in each worker.
"""

from __future__ import annotations

import dataclasses
import functools
import zlib

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronosift.operators import detect


def repeat_last(series: Column, horizon: int) -> Column:
    """The last value, ``horizon`` times."""
    return F.array_repeat(F.element_at(series, -1), horizon)


def rmse_arrays(p: Column, t: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(p, t, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x) / F.size(t))


def _trend(x: np.ndarray, kernel: int) -> np.ndarray:
    front = (kernel - 1) // 2
    full = np.concatenate([np.repeat(x[:, :1], front, axis=1), x, np.repeat(x[:, -1:], kernel - 1 - front, axis=1)], axis=1)
    total = np.cumsum(np.concatenate([np.zeros((len(x), 1)), full], axis=1), axis=1)
    return (total[:, kernel:] - total[:, :-kernel]) / kernel


def _ridge(x: np.ndarray, y: np.ndarray, alpha: float) -> np.ndarray:
    x = _with_one(x)
    xt = x.swapaxes(-1, -2)
    return np.linalg.solve(xt @ x + alpha * np.eye(x.shape[-1]), xt @ y)


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((*x.shape[:-1], 1))], axis=-1)


def _apply(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return _with_one(x) @ w


def linear_forecast(train: np.ndarray, future: np.ndarray, last: np.ndarray, kind: str = "linear", alpha: float = 1e-3, kernel: int = 25) -> np.ndarray:
    """Forecasts for the windows ``last`` by ridge regression from windows ``train`` to ``future``; with a leading axis, one fit for each series.

    ``nlinear`` works on values less the last one; ``dlinear`` has trend and rest as two inputs; ``naive`` repeats.
    """
    horizon = future.shape[-1]
    if kind == "naive" or not train.shape[-2]:
        return np.repeat(last[..., -1:], horizon, axis=-1)
    if kind == "nlinear":
        base = train[..., -1:]
        return _apply(last - last[..., -1:], _ridge(train - base, future - base, alpha)) + last[..., -1:]
    if kind == "dlinear":

        def both(x: np.ndarray) -> np.ndarray:
            trend = _trend(x.reshape(-1, x.shape[-1]), kernel).reshape(x.shape)
            return np.concatenate([trend, x - trend], axis=-1)

        return _apply(both(last), _ridge(both(train), future, alpha))
    if kind == "linear":
        return _apply(last, _ridge(train, future, alpha))
    flat = last.reshape(-1, last.shape[-1])
    if kind == "trees":
        return _boosted(flat, horizon).reshape(*last.shape[:-1], horizon)
    if kind == "arima":
        return np.stack([arima(x, horizon) for x in flat]).reshape(*last.shape[:-1], horizon)
    raise ValueError(f"unknown forecaster {kind!r}")


def _boosted(last: np.ndarray, horizon: int, rounds: int = 50, rate: float = 0.1, depth: int = 3) -> np.ndarray:
    """Gradient-boosted trees of ``depth`` levels on the time index of each window, extrapolated past its end."""
    fit = np.repeat(last.mean(axis=1, keepdims=True), last.shape[1], axis=1)
    out = np.repeat(last.mean(axis=1, keepdims=True), horizon, axis=1)
    for _ in range(rounds):
        step = _tree(last - fit, depth)
        fit = fit + rate * step
        out = out + rate * step[:, -1:]
    return out


def _tree(rest: np.ndarray, depth: int) -> np.ndarray:
    """Regression trees on the time index, one for each row: pieces of constant value, each cut where the squared error falls most."""
    rows, length = rest.shape
    total = np.concatenate([np.zeros((rows, 1)), np.cumsum(rest, axis=1)], axis=1)
    at = np.arange(rows)
    pieces = [(np.zeros(rows, int), np.full(rows, length))]
    t = np.arange(length)[None, :]
    for _ in range(depth):
        new = []
        for low, high in pieces:
            n_left, n_right = t - low[:, None] + 1, high[:, None] - t - 1
            inside = (n_left > 0) & (n_right > 0)
            left = total[:, 1:] - total[at, low][:, None]
            right = total[at, high][:, None] - total[:, 1:]
            gain = np.where(inside, left**2 / np.maximum(n_left, 1) + right**2 / np.maximum(n_right, 1), -np.inf)
            cut = gain.argmax(axis=1) + 1
            cut = np.where(inside.any(axis=1), cut, high)  # a single step stays whole
            new += [(low, cut), (cut, high)]
        pieces = new
    out = np.zeros_like(rest)
    for low, high in pieces:
        mean = (total[at, high] - total[at, low]) / np.maximum(high - low, 1)
        out += np.where((t >= low[:, None]) & (t < high[:, None]), mean[:, None], 0.0)
    return out


def arima(x: np.ndarray, horizon: int, most: int = 4, season: int = 0) -> np.ndarray:
    """Forecasts of one series by autoregression on differences, fitted by least squares; differencing (0 to 2) and order (0 to ``most``) have the least AIC.

    With ``season`` the series is differenced by it first. Errors are innovations only: there is no moving-average part.
    """
    x = np.asarray(x, float)
    base = x[season:] - x[:-season] if season and len(x) > 2 * season else x
    used = season if len(base) < len(x) else 0
    best, plan = np.inf, (0, 0, np.array([base.mean()]))
    for d in range(3):
        z = np.diff(base, d)
        for p in range(most + 1):
            n = len(z) - most
            if n < p + 3:
                continue
            lags = np.stack([np.ones(n), *[z[most - i - 1 : len(z) - i - 1] for i in range(p)]], axis=1)
            coef = np.linalg.lstsq(lags, z[most:], rcond=None)[0]
            error = max(float(((z[most:] - lags @ coef) ** 2).mean()), 1e-12)
            aic = n * np.log(error) + 2 * (p + 1) + 0.01 * d
            if aic < best:
                best, plan = aic, (d, p, coef)
    d, p, coef = plan
    levels = [np.diff(base, i) for i in range(d + 1)]
    z = list(levels[-1])
    ahead = []
    for _ in range(horizon):
        z.append(float(coef[0] + sum(c * z[-i - 1] for i, c in enumerate(coef[1 : p + 1]))))
        ahead.append(z[-1])
    for level in reversed(levels[:-1]):
        ahead = list(level[-1] + np.cumsum(ahead))
    if used:
        whole = list(x)
        for y in ahead:
            whole.append(y + whole[-used])
        ahead = whole[len(x) :]
    return np.array(ahead)


def window_errors(series: DataFrame, keys: list[str], context: int, horizon: int, kind: str = "naive", step: int | None = None) -> DataFrame:
    """Errors of forecasts along each series (column ``series``, an ordered array): win, is_eval, error (RMSE).

    History windows lie in the first 80 % of the series, a quarter of a context apart; the evaluated window is the last.
    """
    step = step or max(1, context // 4)
    span = context + horizon
    if kind == "naive":
        n = F.size("series")
        limit = F.floor(n * 0.8).cast("int")
        starts = F.when(limit >= span, F.sequence(F.lit(0), limit - span, F.lit(step))).otherwise(F.array().cast("array<int>"))
        rows = series.where(n >= span).select(*keys, "series", F.posexplode(F.concat(starts, F.array(n - span))).alias("win", "start"), F.size(starts).alias("m"))
        x, y = F.slice("series", F.col("start") + 1, context), F.slice("series", F.col("start") + 1 + context, horizon)
        return rows.select(*keys, "win", (F.col("win") == F.col("m")).alias("is_eval"), rmse_arrays(repeat_last(x, horizon), y).alias("error"))

    def errors(x: np.ndarray) -> np.ndarray:
        limit = int(x.shape[1] * 0.8)
        starts = [*range(0, limit - span + 1, step)]
        cut = lambda a, b: np.stack([x[:, s + a : s + b] for s in starts], axis=1) if starts else np.zeros((len(x), 0, b - a))
        train, future = cut(0, context), cut(context, span)
        end = x.shape[1] - span
        both = np.concatenate([train, x[:, None, end : end + context]], axis=1)
        truth = np.concatenate([future, x[:, None, end + context :]], axis=1)
        return np.sqrt(((linear_forecast(train, future, both, kind) - truth) ** 2).mean(axis=-1))

    return _by_length(series, keys, span, errors)


def _by_length(series: DataFrame, keys: list[str], least: int, errors) -> DataFrame:
    """win, is_eval and error of the series that have ``least`` points: those of one length are computed together, as [series, points] -> [series, windows],
    the evaluated window last."""

    def run(batches):
        for pdf in batches:
            sizes = pdf["series"].map(len).to_numpy()
            parts = []
            for n in np.unique(sizes[sizes >= least]):
                rows = np.flatnonzero(sizes == n)
                for at in range(0, len(rows), max(1, 1_000_000 // int(n))):
                    own = rows[at : at + max(1, 1_000_000 // int(n))]
                    e = errors(np.stack([np.asarray(x, float) for x in pdf["series"].iloc[own]]))
                    part = pdf.iloc[np.repeat(own, e.shape[1])][keys].reset_index(drop=True)
                    win = np.tile(np.arange(e.shape[1], dtype=np.int32), len(own))
                    parts.append(part.assign(win=win, is_eval=win == e.shape[1] - 1, error=e.ravel()))
            if parts:
                yield pd.concat(parts, ignore_index=True)

    kinds = dict(series.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", win int, is_eval boolean, error double"
    return series.select(*keys, "series").mapInPandas(run, schema)


def reconstruction_errors(series: DataFrame, keys: list[str], context: int, patch: int, rank: int = 2) -> DataFrame:
    """The same with the error of rebuilding the patches of a window from the ``rank`` main directions of the history's patches."""
    step = max(1, context // 4)

    def errors(x: np.ndarray) -> np.ndarray:
        n = x.shape[1]
        starts = [*range(0, int(n * 0.8) - context + 1, step)]
        wins = np.stack([x[:, s : s + context] for s in [*starts, n - context]], axis=1)
        cut = wins[:, :, context % patch :].reshape(len(x), wins.shape[1], -1, patch)
        train = (cut[:, :-1] if starts else cut).reshape(len(x), -1, patch)
        mid = train.mean(axis=1, keepdims=True)
        basis = np.linalg.svd(train - mid, full_matrices=False)[2][:, :rank]
        off = cut - mid[:, None]
        rest = off - off @ basis.swapaxes(-1, -2)[:, None] @ basis[:, None]
        return np.sqrt((rest**2).mean(axis=(2, 3)))

    return _by_length(series, keys, context, errors)


def model_errors(series: DataFrame, keys: list[str], spec: ModelSpec, engine, face: str) -> DataFrame:
    """win, is_eval, error and failure for windows of each series, from a model: the RMSE of its forecasts, or its mean rebuilding error.

    ``engine`` has forecast(x) -> [batch, horizon, channels] and reconstruct(x) -> (patches, errors); it is broadcast, and a worker makes it once. History windows lie in the first
    80 %, a quarter of a context apart, one at least; the evaluated window is the last. Series shorter than a window give no row. A failing model gives one row with what it said.
    """
    c = spec.context_length
    span = c + spec.horizon if face == "forecast" else c
    step = max(1, c // 4)
    held = series.sparkSession.sparkContext.broadcast(cloudpickle.dumps(engine))  # by value, wherever its class was made

    def run(batches):
        model = cloudpickle.loads(held.value)
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                x = np.asarray(row.series, float)
                if len(x) < span:
                    continue
                own = row[: len(keys)]
                starts = [*range(0, max(span, int(len(x) * 0.8)) - span + 1, step), len(x) - span]
                wins = np.stack([x[s : s + span] for s in starts])[:, :, None]
                try:
                    if face == "forecast":
                        errors = np.sqrt(((model.forecast(wins[:, :c]) - wins[:, c:]) ** 2).mean(axis=(1, 2)))
                    else:
                        errors = np.asarray(model.reconstruct(wins)[1]).reshape(len(wins), -1).mean(axis=1)
                    out += [(*own, i, i + 1 == len(starts), float(e), None) for i, e in enumerate(errors)]
                except Exception as failed:  # the z-score answers instead, and says so
                    out.append((*own, 0, True, None, f"{type(failed).__name__}: {failed}"))
            yield pd.DataFrame(out, columns=[*keys, "win", "is_eval", "error", "failure"])

    kinds = dict(series.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", win int, is_eval boolean, error double, failure string"
    return series.select(*keys, "series").mapInPandas(run, schema)


def detect_by_error(points: DataFrame, errors: DataFrame, keys: list[str], method: str, policy=None) -> DataFrame:
    """Signals from error ratios; series too short for a window, or whose model failed, fall back to the z-score, and ``method`` says which ran.

    ``policy`` (scores, keys, order) -> scores with severity judges instead of the fixed cuts; ``failure`` tells why a model gave no score.
    """
    known = errors.where(F.col("error").isNotNull()) if "failure" in errors.columns else errors
    ratio = detect.error_ratio(known, keys)
    if policy is not None:
        order = [k for k in keys if k == "win_start"] or [F.lit(0)]
        ratio = policy(ratio.drop("severity").withColumn("score", F.col("raw")), [k for k in keys if k != "win_start"] if "win_start" in keys else keys, order)
    scored = ratio.select(*keys, F.round("score", 4).alias("score"), "severity", F.lit(method).alias("method"))
    if "failure" in errors.columns:
        failed = errors.where(F.col("failure").isNotNull()).select(*keys, "failure")
        return _with_fallback(points, scored, keys).join(failed, keys, "left")
    return _with_fallback(points, scored, keys)


def _with_fallback(points: DataFrame, scored: DataFrame, keys: list[str]) -> DataFrame:
    plain = detect.zscore(points, keys, ["ts_ms", "value"])
    out = plain.alias("z").join(scored.alias("r"), keys, "left")
    has = F.col("r.method").isNotNull()
    return out.select(*keys, F.when(has, F.col("r.score")).otherwise(F.col("z.score")).alias("score"), F.when(has, F.col("r.severity")).otherwise(F.col("z.severity")).alias("severity"), F.when(has, F.col("r.method")).otherwise("zscore").alias("method"), "z.n_points")


@dataclasses.dataclass(frozen=True)
class ModelSpec:
    """Shape of a patch transformer."""

    n_channels: int = 7
    context_length: int = 336
    horizon: int = 96
    patch_length: int = 16
    stride: int = 8
    d_model: int = 64
    n_heads: int = 4
    n_layers: int = 3
    d_ff: int = 128

    @classmethod
    def from_dict(cls, values: dict) -> ModelSpec:
        known = {f.name for f in dataclasses.fields(cls)}
        return cls(**{k: v for k, v in values.items() if k in known})

    @property
    def num_patch(self) -> int:
        return (max(self.context_length, self.patch_length) - self.patch_length) // self.stride + 1


def random_weights(spec: ModelSpec, seed: int = 0) -> dict[str, np.ndarray]:
    """Weights of the right shapes for tests, and a template for exported ones."""
    g = np.random.default_rng(seed)
    d, f = spec.d_model, spec.d_ff
    w = {"embed.w": (spec.patch_length, d), "embed.b": (d,), "pos": (spec.num_patch, d)}
    for i in range(spec.n_layers):
        w |= {f"{i}.{n}.w": (d, d) for n in ("q", "k", "v", "o")} | {f"{i}.{n}.b": (d,) for n in ("q", "k", "v", "o")}
        w |= {f"{i}.ff1.w": (d, f), f"{i}.ff1.b": (f,), f"{i}.ff2.w": (f, d), f"{i}.ff2.b": (d,)}
        w |= {f"{i}.norm{n}.{p}": (d,) for n in (1, 2) for p in ("w", "b", "mean", "var")}
    w |= {"forecast.w": (spec.num_patch * d, spec.horizon), "forecast.b": (spec.horizon,), "rebuild.w": (d, spec.patch_length), "rebuild.b": (spec.patch_length,)}
    out = {k: g.normal(0, 0.05, s) for k, s in w.items()}
    return {k: np.abs(v) + 1 if k.endswith((".var",)) or (".norm" in k and k.endswith(".w")) else v for k, v in out.items()}


def transfer(source: dict[str, np.ndarray], target: dict[str, np.ndarray], heads: tuple[str, ...] = ("forecast", "rebuild")) -> dict[str, np.ndarray]:
    """``target`` with the weights of ``source`` that match by name and shape, heads left out."""
    return {k: source[k] if k in source and source[k].shape == v.shape and not k.startswith(heads) else v for k, v in target.items()}


class PatchTransformer:
    """Channel-independent forward pass in evaluation mode: normalise, patch, encode, head, restore."""

    def __init__(self, spec: ModelSpec, weights: dict[str, np.ndarray]) -> None:
        self.spec, self.w = spec, weights

    def _check(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, float)
        if x.ndim == 2:
            x = x[None]
        if x.ndim != 3 or x.shape[1] != self.spec.context_length or x.shape[2] != self.spec.n_channels:
            raise ValueError(f"expected [batch, {self.spec.context_length}, {self.spec.n_channels}] or one window, got {x.shape}")
        return x

    def _encode(self, patches: np.ndarray) -> np.ndarray:
        s, w = self.spec, self.w
        h = patches @ w["embed.w"] + w["embed.b"] + w["pos"]
        n, p, d = h.shape
        for i in range(s.n_layers):
            q, k, v = ((h @ w[f"{i}.{m}.w"] + w[f"{i}.{m}.b"]).reshape(n, p, s.n_heads, d // s.n_heads).transpose(0, 2, 1, 3) for m in "qkv")
            a = q @ k.transpose(0, 1, 3, 2) / np.sqrt(d // s.n_heads)
            a = np.exp(a - a.max(axis=-1, keepdims=True))
            a /= a.sum(axis=-1, keepdims=True)
            h = self._norm(h + (a @ v).transpose(0, 2, 1, 3).reshape(n, p, d) @ w[f"{i}.o.w"] + w[f"{i}.o.b"], f"{i}.norm1")
            f = h @ w[f"{i}.ff1.w"] + w[f"{i}.ff1.b"]
            f = 0.5 * f * (1 + np.tanh(np.sqrt(2 / np.pi) * (f + 0.044715 * f**3)))
            h = self._norm(h + f @ w[f"{i}.ff2.w"] + w[f"{i}.ff2.b"], f"{i}.norm2")
        return h

    def _norm(self, x: np.ndarray, at: str) -> np.ndarray:
        w = self.w
        return (x - w[f"{at}.mean"]) / np.sqrt(w[f"{at}.var"] + 1e-5) * w[f"{at}.w"] + w[f"{at}.b"]

    def _patches(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        s = self.spec
        flat = x.transpose(0, 2, 1).reshape(-1, s.context_length)
        mean, sd = flat.mean(axis=1, keepdims=True), np.sqrt(flat.var(axis=1, keepdims=True) + 1e-5)
        flat = (flat - mean) / sd
        first = s.context_length - (s.patch_length + s.stride * (s.num_patch - 1))
        return np.stack([flat[:, first + i * s.stride : first + i * s.stride + s.patch_length] for i in range(s.num_patch)], axis=1), mean, sd

    def forecast(self, x: np.ndarray) -> np.ndarray:
        """[batch, horizon, channels]."""
        x = self._check(x)
        patches, mean, sd = self._patches(x)
        h = self._encode(patches).reshape(len(patches), -1)
        y = (h @ self.w["forecast.w"] + self.w["forecast.b"]) * sd + mean
        return y.reshape(len(x), self.spec.n_channels, self.spec.horizon).transpose(0, 2, 1)

    def reconstruct(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rebuilt patches [batch, patches, channels, length], normalised, and the mean square error of each channel."""
        x = self._check(x)
        patches, _, _ = self._patches(x)
        y = self._encode(patches) @ self.w["rebuild.w"] + self.w["rebuild.b"]
        error = ((y - patches) ** 2).mean(axis=(1, 2)).reshape(len(x), self.spec.n_channels)
        return y.reshape(len(x), self.spec.n_channels, self.spec.num_patch, -1).transpose(0, 2, 1, 3), error


class Baseline:
    """A model without weights: it forecasts the last value, and rebuilds a window as its mean. For any detector that takes a model."""

    def __init__(self, spec: ModelSpec) -> None:
        self.spec = spec

    def forecast(self, x: np.ndarray) -> np.ndarray:
        return np.repeat(x[:, -1:], self.spec.horizon, axis=1)

    def reconstruct(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        flat = np.broadcast_to(x.mean(axis=1, keepdims=True), x.shape)
        return flat, ((x - flat) ** 2).mean(axis=1)


class DecomposedTransformer:
    """Two patch transformers, one for the trend and one for the rest; their forecasts are added."""

    def __init__(self, spec: ModelSpec, trend: dict[str, np.ndarray], rest: dict[str, np.ndarray], kernel: int = 25) -> None:
        self.spec, self.kernel, self.of_trend, self.of_rest = spec, kernel, PatchTransformer(spec, trend), PatchTransformer(spec, rest)

    def forecast(self, x: np.ndarray) -> np.ndarray:
        x = self.of_trend._check(x)
        flat = x.transpose(0, 2, 1).reshape(-1, x.shape[1])
        trend = _trend(flat, self.kernel).reshape(len(x), x.shape[2], -1).transpose(0, 2, 1)
        return self.of_trend.forecast(trend) + self.of_rest.forecast(x - trend)


def regression_head(h: np.ndarray, w: np.ndarray, b: np.ndarray, low: float | None = None, high: float | None = None) -> np.ndarray:
    """Values from the last patch of encoded windows [batch, channels, patches, width], within a range if one is given."""
    out = h[:, :, -1].reshape(len(h), -1) @ w + b
    return out if low is None else low + (high - low) / (1 + np.exp(-out))


def classification_head(h: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Class probabilities from the last patch."""
    logits = h[:, :, -1].reshape(len(h), -1) @ w + b
    logits = np.exp(logits - logits.max(axis=1, keepdims=True))
    return logits / logits.sum(axis=1, keepdims=True)


def encoded(model: PatchTransformer, x: np.ndarray) -> np.ndarray:
    """[batch, channels, patches, width]: what the heads see."""
    x = model._check(x)
    h = model._encode(model._patches(x)[0])
    return h.reshape(len(x), model.spec.n_channels, model.spec.num_patch, -1)


def train_pair(windows: DataFrame, spec: ModelSpec, mask: float = 0.4, ridge: float = 1.0, seed: int = 0, window_col: str = "window") -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Weights (for forecasts, for rebuilding) in two stages, over windows of context_length + horizon steps, flat by step then channel.

    The encoder keeps seeded random weights; heads are ridge regressions, whose normal equations are summed over the table, so that no task and not the driver
    sees all windows. First the rebuilding head is fitted to all patches of windows some of whose patches are hidden by chance; its encoder is transferred, and the forecasting head is fitted on it.
    """
    start = random_weights(spec, seed)
    back = _fitted(windows, spec, start, "rebuild", mask, ridge, seed, window_col)
    ahead = _fitted(windows, spec, transfer(back, random_weights(spec, seed + 1)), "forecast", mask, ridge, seed, window_col)
    return ahead, back


def _fitted(windows: DataFrame, spec: ModelSpec, weights: dict[str, np.ndarray], head: str, mask: float, ridge: float, seed: int, window_col: str) -> dict[str, np.ndarray]:
    held = windows.sparkSession.sparkContext.broadcast(weights)
    c, span = spec.context_length, spec.context_length + spec.horizon
    n_in, n_out = weights[f"{head}.w"].shape

    def sums(batches):
        model = PatchTransformer(spec, held.value)
        a, b, n = np.zeros((n_in + 1, n_in + 1)), np.zeros((n_in + 1, n_out)), 0
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack([np.asarray(v, float) for v in pdf[window_col]]).reshape(-1, span, spec.n_channels)
            patches, mean, sd = model._patches(x[:, :c])
            if head == "rebuild":
                # hidden by the windows' own digest, whatever batch they come in
                rng = [np.random.default_rng([seed, zlib.crc32(row.tobytes())]) for row in patches]
                hidden = np.stack([g.random(spec.num_patch) < mask for g in rng])
                h = model._encode(np.where(hidden[:, :, None], 0.0, patches))
                given, target = h.reshape(-1, h.shape[-1]), patches.reshape(-1, patches.shape[-1])
            else:
                given = model._encode(patches).reshape(len(patches), -1)
                target = (x[:, c:].transpose(0, 2, 1).reshape(-1, spec.horizon) - mean) / sd
            given = np.concatenate([given, np.ones((len(given), 1))], axis=1)
            a, b, n = a + given.T @ given, b + given.T @ target, n + len(given)
        if n:
            yield pd.DataFrame({"i": range(n_in + 1), "a": list(a), "b": list(b)})

    rows = windows.select(window_col).mapInPandas(sums, "i int, a array<double>, b array<double>")
    total = lambda name, n: F.array(*[F.sum(F.col(name)[j]) for j in range(n)]).alias(name)
    found = sorted(rows.groupBy("i").agg(total("a", n_in + 1), total("b", n_out)).collect(), key=lambda r: r.i)
    if not found:
        raise ValueError("no windows to train on")
    a, b = np.array([r.a for r in found]), np.array([r.b for r in found])
    solved = np.linalg.solve(a + ridge * np.eye(n_in + 1), b)
    return {**weights, f"{head}.w": solved[:-1], f"{head}.b": solved[-1]}


@functools.cache
def load_model(path: str, spec: ModelSpec) -> PatchTransformer:
    """Once in each worker process and file (.npz)."""
    with np.load(path) as f:
        return PatchTransformer(spec, {k: f[k] for k in f.files})


def save_model(path: str, weights: dict[str, np.ndarray]) -> None:
    np.savez(path, **weights)


def infer(windows: DataFrame, spec: ModelSpec, weights: dict[str, np.ndarray] | str, window_col: str = "window") -> DataFrame:
    """Adds ``forecast`` (flat, by step then channel) and ``rebuild_error`` (mean over channels) to rows whose window is flat in the same way. A path must be one that
    all executors can open; weights given as arrays are broadcast."""
    sc = windows.sparkSession.sparkContext
    held = None if isinstance(weights, str) else sc.broadcast(weights)

    def run(batches):
        model = load_model(weights, spec) if held is None else PatchTransformer(spec, held.value)
        for pdf in batches:
            if len(pdf):
                x = np.stack([np.asarray(v, float) for v in pdf[window_col]]).reshape(-1, spec.context_length, spec.n_channels)
                pdf = pdf.assign(forecast=[y.ravel() for y in model.forecast(x)], rebuild_error=model.reconstruct(x)[1].mean(axis=1))
            else:
                pdf = pdf.assign(forecast=None, rebuild_error=0.0)
            yield pdf

    schema = T.StructType([*windows.schema.fields, T.StructField("forecast", T.ArrayType(T.DoubleType())), T.StructField("rebuild_error", T.DoubleType())])
    return windows.mapInPandas(run, schema)
