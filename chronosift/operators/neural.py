"""Parts of research forecasters and their forward passes, in numpy, evaluation mode, with weights from outside.

Arrays are [batch, steps, width]; attention works on [batch, heads, steps, width of a head]. The parts run inside Arrow functions over many windows at once; a
model is a dictionary of named weights and a ``Shape``.
"""

from __future__ import annotations

import dataclasses

import numpy as np

from chronosift.operators import graph
from chronosift.operators.forecast import _trend

KINDS = ("full", "sparse", "delay", "frequency", "wavelet", "pyramid")


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def gelu(x: np.ndarray) -> np.ndarray:
    return 0.5 * x * (1 + np.tanh(np.sqrt(2 / np.pi) * (x + 0.044715 * x**3)))


def normed(x: np.ndarray, eps: float = 1e-5) -> np.ndarray:
    """Each step with mean 0 and deviation 1."""
    return (x - x.mean(axis=-1, keepdims=True)) / np.sqrt(x.var(axis=-1, keepdims=True) + eps)


# ---- masks


def causal(length: int) -> np.ndarray:
    """True where a step (row) may not look at another (column): those behind it in time."""
    return np.triu(np.ones((length, length), bool), 1)


def pyramid(length: int, sizes: list[int], neighbours: int) -> np.ndarray:
    """True where nodes of the pyramid may not look at each other: all but neighbours on a level, parents and children, and themselves."""
    levels = graph.level_sizes(length, sizes)
    starts = np.cumsum([0, *levels])
    closed = np.ones((starts[-1], starts[-1]), bool)
    np.fill_diagonal(closed, False)
    for i, n in enumerate(levels):
        at = np.arange(n)
        near = np.abs(at[:, None] - at[None, :]) <= neighbours
        closed[starts[i] : starts[i + 1], starts[i] : starts[i + 1]] &= ~near
        if i + 1 < len(levels):
            up = starts[i + 1] + np.minimum(at // sizes[i], levels[i + 1] - 1)
            closed[starts[i] + at, up] = closed[up, starts[i] + at] = False
    return closed


# ---- attention


def attend(q: np.ndarray, k: np.ndarray, v: np.ndarray, closed: np.ndarray | None = None) -> np.ndarray:
    """Every query over all keys that aren't closed to it."""
    scores = q @ k.swapaxes(-1, -2) / np.sqrt(q.shape[-1])
    return softmax(np.where(closed, -1e30, scores) if closed is not None else scores) @ v


def sparsity(q: np.ndarray, k: np.ndarray, keys: np.ndarray | None = None) -> np.ndarray:
    """How far each query's largest score is above its mean score, over the keys ``keys`` (all)."""
    some = k if keys is None else k[..., keys, :]
    scores = q @ some.swapaxes(-1, -2)
    return scores.max(axis=-1) - scores.sum(axis=-1) / k.shape[-2]


def attend_sparse(q: np.ndarray, k: np.ndarray, v: np.ndarray, factor: float = 5.0, masked: bool = False, seed: int = 0) -> np.ndarray:
    """The int(factor ln L) queries of largest sparsity attend; the others get the mean of the values, or their running sum if masked."""
    steps, room = q.shape[-2], k.shape[-2]
    u = min(steps, max(1, int(factor * np.ceil(np.log(max(2, steps))))))
    sampled = np.random.default_rng(seed).choice(room, min(room, max(1, int(factor * np.ceil(np.log(max(2, room)))))), replace=False)
    top = np.sort(np.argsort(-sparsity(q, k, np.sort(sampled)), axis=-1, kind="stable")[..., :u], axis=-1)
    out = np.cumsum(v, axis=-2) if masked else np.repeat(v.mean(axis=-2, keepdims=True), steps, axis=-2)
    scores = np.take_along_axis(q, top[..., None], axis=-2) @ k.swapaxes(-1, -2) / np.sqrt(q.shape[-1])
    if masked:
        scores = np.where(np.arange(room) > top[..., None], -1e30, scores)
    np.put_along_axis(out, np.broadcast_to(top[..., None], (*top.shape, v.shape[-1])), softmax(scores) @ v, axis=-2)
    return out


def correlation(q: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Circular cross-correlation along the steps, by FFT."""
    n = q.shape[-2]
    return np.fft.irfft(np.fft.rfft(q, axis=-2) * np.conj(np.fft.rfft(k, axis=-2)), n, axis=-2)


def attend_delays(q: np.ndarray, k: np.ndarray, v: np.ndarray, factor: float = 1.0) -> np.ndarray:
    """Values rolled by the int(factor ln L) delays of largest mean correlation, weighed by its softmax; keys and values are cut or padded to the queries' length."""
    n = q.shape[-2]
    fit = lambda x: x[..., :n, :] if x.shape[-2] >= n else np.concatenate([x, np.zeros((*x.shape[:-2], n - x.shape[-2], x.shape[-1]))], axis=-2)
    k, v = fit(k), fit(v)
    mean = correlation(q, k).mean(axis=(1, 3))  # over heads and their widths
    top = np.argsort(-mean, axis=-1, kind="stable")[:, : max(1, int(factor * np.log(n)))]
    weight = softmax(np.take_along_axis(mean, top, axis=-1))
    at = (np.arange(n)[None, None, :] + top[:, :, None]) % n  # [batch, delays, steps]
    rolled = np.take_along_axis(v[:, None], at[:, :, None, :, None], axis=3)
    return (weight[:, :, None, None, None] * rolled).sum(axis=1)


def attend_frequencies(q: np.ndarray, modes: list[int], weight: np.ndarray, k: np.ndarray | None = None) -> np.ndarray:
    """Chosen frequencies of the queries, each mixed over a head's widths by its own complex matrix ``weight`` [heads, modes, width, width]; the others are 0.

    With keys the queries' frequencies first attend to the keys' by tanh of their products.
    """
    n = q.shape[-2]
    have = [m for m in modes if m < n // 2 + 1]
    fq = np.fft.rfft(q, axis=-2)[..., have, :]
    if k is not None:
        fk = np.fft.rfft(k, axis=-2)[..., [m for m in modes if m < k.shape[-2] // 2 + 1], :]
        both = fq @ fk.swapaxes(-1, -2)
        fq = (np.tanh(both.real) + 1j * np.tanh(both.imag)) @ fk
    out = np.zeros((*q.shape[:-2], n // 2 + 1, q.shape[-1]), complex)
    out[..., have, :] = np.einsum("bhmi,hmio->bhmo", fq, weight[:, : len(have)])
    return np.fft.irfft(out, n, axis=-2)


def haar(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smooth and detail of neighbouring steps, half as many; an odd last step is repeated."""
    if x.shape[-2] % 2:
        x = np.concatenate([x, x[..., -1:, :]], axis=-2)
    even, odd = x[..., ::2, :], x[..., 1::2, :]
    return (even + odd) / np.sqrt(2), (even - odd) / np.sqrt(2)


def unhaar(smooth: np.ndarray, detail: np.ndarray, length: int) -> np.ndarray:
    out = np.empty((*smooth.shape[:-2], 2 * smooth.shape[-2], smooth.shape[-1]))
    out[..., ::2, :], out[..., 1::2, :] = (smooth + detail) / np.sqrt(2), (smooth - detail) / np.sqrt(2)
    return out[..., :length, :]


def attend_wavelets(x: np.ndarray, details: list[np.ndarray], coarse: np.ndarray) -> np.ndarray:
    """Details of each level mixed by that level's matrix, the coarsest smooth part by ``coarse``; put together again."""
    parts, sizes = [], []
    for weight in details:
        sizes.append(x.shape[-2])
        x, detail = haar(x)
        parts.append(detail @ weight)
    x = x @ coarse
    for detail, n in zip(reversed(parts), reversed(sizes), strict=True):
        x = unhaar(x, detail, n)
    return x


def pooled(x: np.ndarray, sizes: list[int], how: str = "mean") -> np.ndarray:
    """All levels of a pyramid one after the other, each the mean or maximum of groups of the level below."""
    out = [x]
    for n in sizes:
        last = out[-1][:, : out[-1].shape[1] // n * n]
        groups = last.reshape(len(x), -1, n, x.shape[-1])
        out.append(groups.mean(axis=2) if how == "mean" else groups.max(axis=2))
    return np.concatenate(out, axis=1)


# ---- models


@dataclasses.dataclass(frozen=True)
class Shape:
    """A forecaster. ``kind`` says how it attends; ``delay``, ``frequency`` and ``wavelet`` take trends out after each step; ``pyramid`` has an encoder only.
    ``gaussian`` gives a mean and a deviation for each value."""

    kind: str = "full"
    n_channels: int = 7
    n_marks: int = 4
    seq_len: int = 96
    label_len: int = 48
    pred_len: int = 24
    d_model: int = 16
    n_heads: int = 2
    d_ff: int = 32
    encoder_layers: int = 2
    decoder_layers: int = 1
    kernel: int = 25
    modes: int = 8
    sizes: tuple[int, ...] = (4, 4)
    neighbours: int = 1
    gaussian: bool = False

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind {self.kind!r}, one of {', '.join(KINDS)}")

    @property
    def decomposes(self) -> bool:
        return self.kind in ("delay", "frequency", "wavelet")


def random_weights(s: Shape, seed: int = 0) -> dict[str, np.ndarray]:
    """Weights of the right shapes for tests, and a template for exported ones."""
    g = np.random.default_rng(seed)
    d, head = s.d_model, s.d_model // s.n_heads
    shapes: dict[str, tuple[int, ...]] = {}
    for side in ("enc", "dec"):
        shapes |= {f"{side}.value": (3 * s.n_channels, d), f"{side}.mark": (s.n_marks, d)}

    def block(name: str) -> None:
        for n in "qkvo":
            shapes[f"{name}.{n}"] = (d, d)
        if s.kind == "frequency":
            shapes[f"{name}.re"] = shapes[f"{name}.im"] = (s.n_heads, s.modes, head, head)
        if s.kind == "wavelet":
            shapes.update({f"{name}.detail{i}": (head, head) for i in range(3)} | {f"{name}.coarse": (head, head)})

    for i in range(s.encoder_layers):
        block(f"enc{i}.self")
        shapes |= {f"enc{i}.ff1": (d, s.d_ff), f"enc{i}.ff2": (s.d_ff, d)}
    if s.kind == "pyramid":
        levels = len(s.sizes) + 1
        shapes["out"] = (levels * d, s.pred_len * s.n_channels * (2 if s.gaussian else 1))
    else:
        for i in range(s.decoder_layers):
            block(f"dec{i}.self")
            block(f"dec{i}.cross")
            shapes |= {f"dec{i}.ff1": (d, s.d_ff), f"dec{i}.ff2": (s.d_ff, d), f"dec{i}.trend": (d, s.n_channels)}
        shapes["out"] = (d, s.n_channels * (2 if s.gaussian else 1))
    return {k: g.normal(0, 0.3 / np.sqrt(v[-2]), v) for k, v in shapes.items()}


class Forecaster:
    """A forward pass over windows: past values and calendar marks of past and future in, forecasts out."""

    def __init__(self, shape: Shape, weights: dict[str, np.ndarray]) -> None:
        missing = [k for k, v in random_weights(shape).items() if k not in weights or weights[k].shape != v.shape]
        if missing:
            raise ValueError(f"weights don't fit the shape: {', '.join(missing[:5])}")
        self.s, self.w = shape, weights

    def _embed(self, side: str, x: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """Each step with its neighbours (circular) through one matrix, its place, and its marks."""
        around = np.concatenate([np.roll(x, 1, axis=1), x, np.roll(x, -1, axis=1)], axis=-1)
        out = around @ self.w[f"{side}.value"] + marks @ self.w[f"{side}.mark"]
        if self.s.decomposes:
            return out
        rate = np.exp(np.arange(0, self.s.d_model, 2) * -(np.log(10_000.0) / self.s.d_model))
        angle = np.arange(x.shape[1])[:, None] * rate
        place = np.empty((x.shape[1], self.s.d_model))
        place[:, ::2], place[:, 1::2] = np.sin(angle), np.cos(angle)[:, : self.s.d_model // 2]
        return out + place

    def _split(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rest and trend."""
        b, n, c = x.shape
        trend = _trend(x.transpose(0, 2, 1).reshape(b * c, n), self.s.kernel).reshape(b, c, n).transpose(0, 2, 1)
        return x - trend, trend

    def _attention(self, name: str, x: np.ndarray, y: np.ndarray, masked: bool = False, closed: np.ndarray | None = None) -> np.ndarray:
        s, w = self.s, self.w
        cut = lambda z: z.reshape(len(z), z.shape[1], s.n_heads, -1).swapaxes(1, 2)
        q, k, v = cut(x @ w[f"{name}.q"]), cut(y @ w[f"{name}.k"]), cut(y @ w[f"{name}.v"])
        if s.kind == "sparse":
            out = attend_sparse(q, k, v, masked=masked)
        elif s.kind == "delay":
            out = attend_delays(q, k, v)
        elif s.kind == "frequency":
            out = attend_frequencies(q, list(range(s.modes)), w[f"{name}.re"] + 1j * w[f"{name}.im"], None if x is y else k)
        elif s.kind == "wavelet" and x is y:
            out = attend_wavelets(q, [w[f"{name}.detail{i}"] for i in range(3)], w[f"{name}.coarse"])
        else:
            out = attend(q, k, v, causal(q.shape[-2]) if masked else closed)
        return out.swapaxes(1, 2).reshape(x.shape) @ w[f"{name}.o"]

    def _feed(self, name: str, x: np.ndarray) -> np.ndarray:
        return gelu(x @ self.w[f"{name}.ff1"]) @ self.w[f"{name}.ff2"]

    def _encode(self, x: np.ndarray, closed: np.ndarray | None = None) -> np.ndarray:
        settle = (lambda z: self._split(z)[0]) if self.s.decomposes else normed
        for i in range(self.s.encoder_layers):
            x = settle(x + self._attention(f"enc{i}.self", x, x, closed=closed))
            x = settle(x + self._feed(f"enc{i}", x))
            if self.s.kind == "sparse" and i + 1 < self.s.encoder_layers and x.shape[1] > 3:
                x = np.maximum(x[:, : x.shape[1] // 2 * 2 : 2], x[:, 1 : x.shape[1] // 2 * 2 : 2])  # the halving between layers
        return normed(x)

    def forecast(self, x: np.ndarray, marks: np.ndarray, future_marks: np.ndarray) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
        """[batch, pred_len, channels], or mean and deviation of that shape. ``future_marks`` are those of the last label_len steps and of the future."""
        s, w = self.s, self.w
        if x.shape[1:] != (s.seq_len, s.n_channels):
            raise ValueError(f"expected [batch, {s.seq_len}, {s.n_channels}], got {x.shape}")
        if s.kind == "pyramid":
            h = pooled(self._embed("enc", x, marks), list(s.sizes))
            h = self._encode(h, pyramid(s.seq_len, list(s.sizes), s.neighbours))
            ends = np.cumsum(graph.level_sizes(s.seq_len, list(s.sizes))) - 1
            return self._shaped((h[:, ends].reshape(len(x), -1) @ w["out"]).reshape(len(x), s.pred_len, -1))
        seen = self._encode(self._embed("enc", x, marks))
        if s.decomposes:
            rest, trend = self._split(x)
            mean = np.repeat(x.mean(axis=1, keepdims=True), s.pred_len, axis=1)
            trend = np.concatenate([trend[:, s.seq_len - s.label_len :], mean], axis=1)
            start = np.concatenate([rest[:, s.seq_len - s.label_len :], np.zeros_like(mean)], axis=1)
        else:
            trend = 0.0
            start = np.concatenate([x[:, s.seq_len - s.label_len :], np.zeros((len(x), s.pred_len, s.n_channels))], axis=1)
        h = self._embed("dec", start, future_marks)
        for i in range(s.decoder_layers):
            for step in (lambda z: self._attention(f"dec{i}.self", z, z, masked=not s.decomposes), lambda z: self._attention(f"dec{i}.cross", z, seen), lambda z: self._feed(f"dec{i}", z)):  # noqa: B023
                h = h + step(h)
                if s.decomposes:
                    h, own = self._split(h)
                    trend = trend + own @ w[f"dec{i}.trend"]
                else:
                    h = normed(h)
        out = normed(h) @ w["out"]
        if s.decomposes:
            out = out + (np.concatenate([trend, np.zeros_like(trend)], axis=-1) if s.gaussian else trend)
        return self._shaped(out[:, -s.pred_len :])

    def _shaped(self, out: np.ndarray):
        """Mean and deviation (by softplus) if the head is Gaussian."""
        if not self.s.gaussian:
            return out
        mean, wide = np.split(out, 2, axis=-1)
        return mean, np.log1p(np.exp(-np.abs(wide))) + np.maximum(wide, 0) + 1e-6
