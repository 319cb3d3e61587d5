"""Functions of whole series held as arrays: windows, patches, averages, normalisation, spectra."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def num_patches(length: Column | int, patch: int, stride: int) -> Column:
    length = F.lit(length) if isinstance(length, int) else length
    return (F.floor((F.greatest(length, F.lit(patch)) - patch) / stride) + 1).cast("int")


def patches(series: Column, patch: int, stride: int) -> Column:
    """Patches up to the newest value; what doesn't fit is dropped from the oldest end."""
    n = F.size(series)
    count = F.floor((n - patch) / stride) + 1
    start = n - (patch + stride * (count - 1))
    return F.when(n >= patch, F.transform(F.sequence(F.lit(0).cast("bigint"), count - 1), lambda p: F.slice(series, (start + p * stride + 1).cast("int"), patch))).otherwise(F.array())


def padded_patches(series: Column, patch: int, stride: int) -> Column:
    """The newest value repeated ``stride`` times at the end first, so that nothing newest is lost."""
    return patches(F.concat(series, F.array_repeat(F.element_at(series, -1), stride)), patch, stride)


def windows(series: Column, length: int, step: int = 1) -> Column:
    """All windows of a length, ``step`` apart, from the oldest on."""
    n = F.size(series)
    return F.when(n >= length, F.transform(F.sequence(F.lit(0).cast("bigint"), F.floor((n - length) / step)), lambda k: F.slice(series, (k * step + 1).cast("int"), length))).otherwise(F.array())


def moving_average(series: Column, kernel: int) -> Column:
    """Moving average with the end values repeated, (kernel - 1) // 2 before and the rest after."""
    front = (kernel - 1) // 2
    full = F.concat(F.array_repeat(F.element_at(series, 1), front), series, F.array_repeat(F.element_at(series, -1), kernel - 1 - front))
    return F.transform(F.sequence(F.lit(1), F.size(series)), lambda i: F.aggregate(F.slice(full, i, kernel), F.lit(0.0), lambda a, x: a + x) / kernel)


def _let(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once: an expression inside a lambda would be computed for every element."""
    return F.transform(F.array(value), fn)[0]


def mean_var(series: Column) -> tuple[Column, Column]:
    """Mean and population variance of an array."""
    n = F.size(series)
    mean = F.aggregate(series, F.lit(0.0), lambda a, x: a + x) / n
    return mean, _let(mean, lambda m: F.aggregate(series, F.lit(0.0), lambda a, x: a + (x - m) * (x - m)) / n)


def rev_in(series: Column, eps: float = 1e-5, subtract_last: bool = False) -> Column:
    """Instance normalisation: less the mean (or the last value), over the root of variance + eps."""
    mean, var = mean_var(series)
    centre = F.element_at(series, -1) if subtract_last else mean
    return _let(F.struct(centre.alias("c"), F.sqrt(var + eps).alias("d")), lambda s: F.transform(series, lambda x: (x - s["c"]) / s["d"]))


def rev_in_inverse(normed: Column, centre: Column, var: Column, eps: float = 1e-5) -> Column:
    return F.transform(normed, lambda x: x * F.sqrt(var + eps) + centre)


def softmax(series: Column) -> Column:
    def over(top: Column) -> Column:
        return _let(F.aggregate(series, F.lit(0.0), lambda a, x: a + F.exp(x - top)), lambda total: F.transform(series, lambda x: F.exp(x - top) / total))

    return _let(F.array_max(series), over)


def roll(series: Column, shift: int) -> Column:
    """Values moved ``shift`` places towards the start, around the end."""
    n = F.size(series)
    k = F.pmod(F.lit(shift), n).cast("int")
    return F.concat(F.slice(series, k + 1, n), F.slice(series, F.lit(1), k))


def sin_cos_encoding(position: Column, dims: int) -> Column:
    """Sine and cosine position encoding, in turn."""
    return F.array(*[(F.sin if i % 2 == 0 else F.cos)(position * float(np.exp(-(i - i % 2) * np.log(10000.0) / dims))) for i in range(dims)])


def coordinate_encoding(position: Column, length: int, exponential: bool = False) -> Column:
    """Position scaled to [-1, 1], by its root for the exponential form."""
    power = 0.5 if exponential else 1.0
    return 2 * F.pow(position / F.lit(float(max(1, length - 1))), F.lit(power)) - 1


def _circular(x) -> np.ndarray:
    x = np.asarray(x, float)
    spectrum = np.fft.rfft(x)
    return np.fft.irfft(spectrum * np.conj(spectrum), n=len(x)) / max(1, len(x))


def _per_series(fn, series: str | Column) -> Column:
    """A numpy function of each series; there is no built-in FFT."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(x: pd.Series) -> pd.Series:
        return x.map(fn)

    return run(series)


def autocorrelation(series: str | Column) -> Column:
    """Circular autocorrelation by FFT, over the length."""
    return _per_series(_circular, series)


def amplitudes(series: str | Column) -> Column:
    """Amplitudes of the real FFT."""
    return _per_series(lambda x: np.abs(np.fft.rfft(np.asarray(x, float))), series)


def top_delays(correlation: Column, factor: float = 1.0) -> Column:
    """Delays (from 0) of the largest autocorrelations, int(factor * ln L) of them, the largest first, equal ones by smaller delay."""
    pairs = F.transform(correlation, lambda x, i: F.struct((-x).alias("v"), i.alias("i")))
    k = F.greatest(F.lit(1), F.floor(F.lit(factor) * F.ln(F.size(correlation)))).cast("int")
    return F.transform(F.slice(F.array_sort(pairs), F.lit(1), k), lambda p: p["i"])


def last_steps(v: Column, n: int, features: str = "M") -> Column:
    """The last n steps of a prediction; of steps that are arrays of channels, with ``MS`` the last channel only."""
    tail = F.slice(v, -n, n)
    return F.transform(tail, lambda x: F.element_at(x, -1)) if features == "MS" else tail


def sigmoid_range(x: Column, low: float, high: float) -> Column:
    """A logistic curve from low to high."""
    return F.lit(high - low) / (1 + F.exp(-x)) + F.lit(low)


def activation(name: str, x: Column) -> Column:
    """relu, gelu (by its tanh form), sigmoid or tanh of a column."""
    cube = F.lit(0.7978845608028654) * (x + F.lit(0.044715) * x * x * x)
    known = {"relu": F.greatest(F.lit(0.0), x), "gelu": F.lit(0.5) * x * (1 + F.tanh(cube)), "sigmoid": 1 / (1 + F.exp(-x)), "tanh": F.tanh(x)}
    if name.lower() not in known:
        raise ValueError(f"unknown activation {name!r}, one of {', '.join(known)}")
    return known[name.lower()]


def _rows_of(x: pd.Series, steps: int) -> np.ndarray:
    return np.stack([np.asarray(v, float) for v in x]).reshape(len(x), 1, steps, -1)


def self_attention(v: Column, steps: int) -> Column:
    """Each series as ``steps`` tokens that attend to one another; the result flat, by token then width."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(x: pd.Series) -> pd.Series:
        from chronosift.operators import neural

        if not len(x):
            return x
        t = _rows_of(x, steps)
        return pd.Series(list(neural.attend(t, t, t).reshape(len(x), -1)))

    return run(v)


def sparse_queries(v: Column, steps: int, u: int) -> Column:
    """Numbers of the u tokens whose scores are furthest above their mean, the furthest first."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def run(x: pd.Series) -> pd.Series:
        from chronosift.operators import neural

        if not len(x):
            return x
        t = _rows_of(x, steps)
        return pd.Series(list(np.argsort(-neural.sparsity(t, t)[:, 0], axis=-1, kind="stable")[:, :u]))

    return run(v)


def low_pass(v: Column, modes: int) -> Column:
    """The series from its lowest frequencies alone."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(x: pd.Series) -> pd.Series:
        from chronosift.operators import neural

        if not len(x):
            return x
        t = np.stack([np.asarray(one, float) for one in x])[:, None, :, None]
        return pd.Series(list(neural.attend_frequencies(t, list(range(modes)), np.ones((1, modes, 1, 1))).reshape(len(x), -1)))

    return run(v)


def haar(v: Column) -> tuple[Column, Column]:
    """Smooth and detail of neighbouring values."""
    pairs = F.sequence(F.lit(0), F.floor(F.size(v) / 2).cast("int") - 1)
    at = lambda i: F.get(v, i)
    return F.transform(pairs, lambda i: (at(2 * i) + at(2 * i + 1)) / F.sqrt(F.lit(2.0))), F.transform(pairs, lambda i: (at(2 * i) - at(2 * i + 1)) / F.sqrt(F.lit(2.0)))


def ordered_series(points: DataFrame, keys: list[str], value: str = "value", ts: str = "ts_ms") -> DataFrame:
    """Each key's values as one array, ordered by time and value."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(ts).alias("t"), F.col(value).alias("v"))))
    return points.groupBy(*keys).agg(pairs.alias("_p")).select(*keys, F.col("_p.v").alias("series"))


def frequency_modes(length: int, modes: int, how: str = "lowest", seed: int = 0) -> list[int]:
    """Frequencies to keep: the lowest, or a seeded choice; ascending."""
    modes = min(modes, length // 2)
    if how == "lowest":
        return list(range(modes))
    return sorted(np.random.default_rng(seed).permutation(length // 2)[:modes].tolist())
