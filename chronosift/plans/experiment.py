"""Forecast experiments: a long table split, scaled and cut to windows, a forecaster fitted on the training part, errors on validation and test."""

from __future__ import annotations

import argparse
import dataclasses

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronosift.operators import datasets, forecast, metrics

MODELS = ("naive", "linear", "nlinear", "dlinear", "trees", "arima")


@dataclasses.dataclass(frozen=True)
class Experiment:
    """What to run: the data set's settings, a forecaster, and its ridge weight and trend kernel."""

    data: datasets.DatasetSpec = datasets.DatasetSpec()
    model: str = "dlinear"
    alpha: float = 1e-3
    kernel: int = 25
    parts: tuple[str, ...] = ("val", "test")

    def __post_init__(self) -> None:
        if self.model not in MODELS:
            raise ValueError(f"unknown forecaster {self.model!r}, one of {', '.join(MODELS)}")

    @property
    def setting(self) -> str:
        d = self.data
        return f"{self.model}_ft{d.features}_sl{d.seq_len}_ll{d.label_len}_pl{d.pred_len}"


def parser() -> argparse.ArgumentParser:
    """Flags for every setting; the data set's are those of its dataclass."""
    out = argparse.ArgumentParser(prog="chronosift experiment", add_help=False)
    for f in dataclasses.fields(datasets.DatasetSpec):
        flag = f"--{f.name.replace('_', '-')}"
        if isinstance(f.default, bool):
            out.add_argument(flag, action=argparse.BooleanOptionalAction, default=f.default)
        else:
            out.add_argument(flag, type=type(f.default), default=f.default)
    out.add_argument("--model", choices=MODELS, default="dlinear")
    out.add_argument("--alpha", type=float, default=1e-3)
    out.add_argument("--kernel", type=int, default=25)
    return out


def from_args(args: argparse.Namespace) -> Experiment:
    names = [f.name for f in dataclasses.fields(datasets.DatasetSpec)]
    return Experiment(datasets.DatasetSpec(**{n: getattr(args, n) for n in names}), args.model, args.alpha, args.kernel)


def predictions(long: DataFrame, keys: list[str], order: list[str], what: Experiment) -> DataFrame:
    """(part, keys, win, step, true, pred) in scaled units, for every window of the parts. One fit for each series, on its training windows; a
    series is one group, and those without a training window are left out."""
    spec = what.data
    span, kinds = spec.seq_len + spec.pred_len, dict(long.dtypes)
    rows = datasets.prepare(long, dataclasses.replace(spec, freq=""), keys, order)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        cut = {}
        for part, own in pdf.groupby("part"):
            x = own.sort_values("idx")["scaled"].to_numpy(float)
            if len(x) >= span:
                cut[part] = np.lib.stride_tricks.sliding_window_view(x, span)
        out = []
        if "train" in cut:
            train = cut["train"]
            for part in what.parts:
                if part in cut:
                    given, true = cut[part][:, : spec.seq_len], cut[part][:, spec.seq_len :]
                    pred = forecast.linear_forecast(train[:, : spec.seq_len], train[:, spec.seq_len :], given, what.model, what.alpha, what.kernel)
                    n, h = true.shape
                    out.append(pd.DataFrame({"part": part, **{k: pdf[k].iloc[0] for k in keys}, "win": np.repeat(np.arange(n), h), "step": np.tile(np.arange(h), n), "true": true.ravel(), "pred": pred.ravel()}))
        return pd.concat(out) if out else pd.DataFrame(columns=["part", *keys, "win", "step", "true", "pred"])

    schema = "part string, " + ", ".join(f"{k} {kinds[k]}" for k in keys) + ", win long, step long, true double, pred double"
    return rows.select("part", *keys, "idx", "scaled").groupBy(*keys).applyInPandas(fit, schema)


def run(long: DataFrame, keys: list[str], order: list[str], what: Experiment) -> DataFrame:
    """A row of errors for each part."""
    return metrics.bundle(predictions(long, keys, order, what), ["part"]).withColumn("setting", F.lit(what.setting))
