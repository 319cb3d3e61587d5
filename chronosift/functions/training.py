"""Small helpers of model training: learning-rate schedules and the steepest stretch of a range test."""

from __future__ import annotations

import math


def learning_rate(epoch: int, base: float, kind: str = "halving", total: int = 100, patience: int = 3) -> float:
    """The rate for an epoch counted from 1.

    ``halving`` halves it each epoch, ``step`` drops it at fixed epochs, ``hold-decay`` keeps it ``patience`` epochs and then takes a tenth off each, ``constant``
    keeps it, ``cut-at-N`` divides it by 10 from epoch N on, ``one-cycle`` rises for 30 % of ``total`` and falls along a cosine.
    """
    if kind == "halving":
        return base * 0.5 ** (epoch - 1)
    if kind == "step":
        # fixed values: epochs and rates
        rates = {2: 5e-5, 4: 1e-5, 6: 5e-6, 8: 1e-6, 10: 5e-7, 15: 1e-7, 20: 5e-8}
        return next((rates[e] for e in sorted(rates, reverse=True) if e <= epoch), base)
    if kind == "hold-decay":
        return base if epoch <= patience else base * 0.9 ** (epoch - patience)
    if kind == "constant":
        return base
    if kind.startswith("cut-at-"):
        return base if epoch < int(kind[7:]) else base * 0.1
    if kind == "one-cycle":
        peak = 0.3 * total
        if epoch <= peak:
            return base * (1 - math.cos(math.pi * epoch / peak)) / 2
        return base * (1 + math.cos(math.pi * (epoch - peak) / (total - peak))) / 2
    raise ValueError(f"unknown schedule {kind!r}")


def steepest_descent(rates: list[float], losses: list[float]) -> float:
    """The rate two thirds into the longest run of falling losses (a subsequence, as the curve is noisy)."""
    n = len(losses)
    if not n:
        raise ValueError("no losses")
    length, came = [1] * n, [-1] * n
    for i in range(n):
        for j in range(i):
            if losses[j] > losses[i] and length[j] + 1 > length[i]:
                length[i], came[i] = length[j] + 1, j
    end = max(range(n), key=length.__getitem__)
    first = end
    while came[first] >= 0:
        first = came[first]
    return rates[first + (end - first) * 2 // 3]
