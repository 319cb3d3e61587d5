"""Data-set preparation: splits with look-back, scaling from the training rows, marks, windows."""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronosift.functions import calendar
from chronosift.operators import scaling, windows


@dataclasses.dataclass(frozen=True)
class DatasetSpec:
    """How a wide table becomes samples. ``features``: M all channels, MS all to one target, S the target only."""

    seq_len: int = 336
    label_len: int = 48
    pred_len: int = 96
    features: str = "M"
    target: str = "OT"
    freq: str = "h"
    scale: bool = True
    split: str = "share"  # or months, with per_hour rows an hour
    per_hour: int = 1
    train: float = 0.7
    test: float = 0.2


#: Splits of the known data sets.
KNOWN = {
    "ett-hourly": DatasetSpec(split="months"),
    "ett-minutely": DatasetSpec(split="months", per_hour=4, freq="15min"),
    "custom": DatasetSpec(),
    "sinusoid": DatasetSpec(seq_len=384, label_len=96, pred_len=96, features="S", target="y", freq=""),
}


def channels_of(columns: list[str], spec: DatasetSpec, ts_col: str = "date") -> list[str]:
    """Feature columns in order, the target last."""
    rest = [c for c in columns if c not in (ts_col, spec.target)]
    return [spec.target] if spec.features == "S" else [*rest, spec.target]


def reordered(df: DataFrame, spec: DatasetSpec, ts_col: str = "date") -> DataFrame:
    return df.select(ts_col, *channels_of(df.columns, spec, ts_col))


def borders(spec: DatasetSpec, n: Column) -> dict[str, tuple[Column, Column]]:
    if spec.split == "months":
        return {k: (F.lit(a).cast("long"), F.lit(b).cast("long")) for k, (a, b) in windows.borders_by_months(spec.seq_len, spec.per_hour).items()}
    return windows.borders_by_share(n, spec.seq_len, spec.train, spec.test)


def prepare(long: DataFrame, spec: DatasetSpec, keys: list[str], order: list[str], ts_col: str | None = None) -> DataFrame:
    """Rows of each part (part, keys, idx, value, scaled[, marks]): a row lies in a part for each split whose borders hold it; ``scaled`` uses the training
    rows' statistics."""
    n = windows.with_length(windows.indexed(long, keys, order), keys)
    parts = borders(spec, F.col("n"))
    a, b = parts["train"]
    if spec.scale:
        n = scaling.standardise(n, keys, where=(F.col("idx") >= a) & (F.col("idx") < b))
    else:
        n = n.withColumn("scaled", F.col("value"))
    held = F.array_compact(F.array(*[F.when((F.col("idx") >= lo) & (F.col("idx") < hi), F.lit(name)) for name, (lo, hi) in parts.items()]))
    out = n.withColumn("part", F.explode(held))
    if ts_col and spec.freq:
        out = out.withColumns(calendar.encoded(F.col(ts_col), spec.freq))
    return out


def sample_counts(prepared: DataFrame, spec: DatasetSpec, keys: list[str], batch: int | None = None) -> DataFrame:
    """Samples of each part, whole batches only if a batch size is given."""
    rows = prepared.groupBy("part", *keys).agg(F.count("*").alias("rows"))
    n = windows.n_samples(F.col("rows"), spec.seq_len, spec.pred_len)
    return rows.withColumn("samples", n if batch is None else F.floor(n / batch) * batch)


def prediction_set(long: DataFrame, spec: DatasetSpec, keys: list[str], order: list[str]) -> DataFrame:
    """The last seq_len rows of each series, scaled with the statistics of all its rows."""
    n = windows.with_length(windows.indexed(long, keys, order), keys)
    return scaling.standardise(n, keys).where(F.col("idx") >= F.col("n") - spec.seq_len)


def hourly_load(df: DataFrame, keys: list[str], seq: int, step: int, start: int | None = None, end: int | None = None) -> DataFrame:
    """Electricity preparation: hourly right-closed sums, an inclusive range of hours, and windows scaled by their non-zero mean."""
    hours = windows.resample_sum(df, keys)
    if start is not None:
        hours = hours.where(F.col("bucket").between(start, end))
    n = windows.with_length(windows.indexed(hours, keys, ["bucket"]), keys)
    starts = windows.first_nonzero(n, keys)
    n = n.join(starts, keys).where(F.col("idx") >= F.col("first_idx")).drop("idx", "n", "first_idx")
    n = windows.with_length(windows.indexed(n, keys, ["bucket"]), keys)
    return windows.window_points(n, seq, step)


def flow(df: DataFrame, keys: list[str], order: str, seq: int, step: int) -> DataFrame:
    """App-flow preparation: mostly zero series go, the rest are right-aligned and cut to windows."""
    good = windows.right_aligned(windows.drop_mostly_zero(df, keys), keys, order)
    n = windows.with_length(windows.indexed(good, keys, [order]), keys)
    return windows.window_points(n, seq, step)


def sinusoid_set(long: DataFrame, spec: DatasetSpec, keys: list[str], order: list[str]) -> DataFrame:
    """Parts of a series without calendar: its marks are 0."""
    return prepare(long, dataclasses.replace(spec, split="share", freq=""), keys, order).withColumn("mark", F.lit(0.0))


def long_range_set(long: DataFrame, keys: list[str], order: list[str], seq_len: int, pred_len: int, stride: int = 24, share: float = 0.9) -> DataFrame:
    """Training and test windows of long synthetic series: part, win, pos, value, scaled (over the mean of the inputs + 1, if that mean is above 0), mean and sd.

    Training windows end where ``share`` of all windows end; test windows begin a look-back before.
    """
    span = seq_len + pred_len
    n = windows.with_length(windows.indexed(long, keys, order), keys)
    train_end = F.lit(span) + F.floor(F.lit(share) * ((F.col("n") - span) / F.lit(float(stride)))) * stride
    test_start = train_end - seq_len + 1
    found = []
    for part, at, room in (("train", F.lit(0), train_end - span), ("test", test_start, F.col("n") - test_start - span)):
        many = F.floor(room / stride)
        idx = F.col("idx") - at
        low, high = F.greatest(F.lit(0), F.ceil((idx - (span - 1)) / stride)).cast("long"), F.least(many - 1, F.floor(idx / stride)).cast("long")
        wins = F.when((high >= low) & (idx >= 0), F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
        found.append(n.withColumn("part", F.lit(part)).withColumn("win", F.explode(wins)).withColumn("pos", idx - F.col("win") * stride))
    rows = found[0].unionByName(found[1])
    given = F.when(F.col("pos") < seq_len, F.col("value"))
    stats = rows.groupBy("part", *keys, "win").agg(F.avg(given).alias("mean"), F.stddev_samp(given).alias("sd"))
    return rows.join(stats, ["part", *keys, "win"]).withColumn("scaled", F.when(F.col("mean") > 0, F.col("value") / (F.col("mean") + 1)).otherwise(F.col("value")))


def single_step_test(points: DataFrame, kind: str, length: int, pred_len: int) -> DataFrame:
    """Windows of ``length`` points with their scale ``v`` as one sample for each of the ``pred_len`` last steps; the last value of a sample is masked.

    Inputs of ``elect`` are raw values over the scale; ``flow`` and ``wind`` hold scaled ones, whose targets get the scale again.
    """
    if kind not in ("elect", "flow", "wind"):
        raise ValueError(f"unknown set {kind!r}")
    v = F.col("v")
    target = F.col("value") if kind == "elect" else F.col("value") * v
    given = F.when(v > 0, F.col("value") / v).otherwise(F.col("value")) if kind == "elect" else F.col("value")
    steps = windows.horizon_steps(points.withColumn("_t", target).withColumn("value", given), length - pred_len + 1, pred_len)
    return steps.withColumn("target", F.when(F.col("target").isNotNull(), F.col("_t"))).drop("_t")


def single_step_train(points: DataFrame, scales: DataFrame, keys: list[str], length: int, pred_len: int, seed: int) -> DataFrame:
    """As many windows as there are, drawn with replacement by |v|, each cut to single-step samples; ``draw`` numbers the drawn."""
    named = scales.withColumn("_k", F.concat_ws("/", *keys))
    drawn = windows.sample_with_replacement(named, scales.count(), F.col("v"), seed, "_k").drop("_k", "v")
    return windows.horizon_steps(points.join(drawn, keys), length - pred_len + 1, pred_len)


def wind(df: DataFrame, keys: list[str], order: str, seq: int, base: int, step: int) -> DataFrame:
    """Wind preparation: windows whose first ``base`` values hold a positive one, over the mean of the positive."""
    w = windows.window_points(windows.with_length(windows.indexed(df, keys, [order]), keys), seq, step)
    scale = w.where(F.col("pos") < base).groupBy(*keys, "win").agg(F.avg(F.when(F.col("value") > 0, F.col("value"))).alias("scale")).where("scale IS NOT NULL")
    return w.join(scale, [*keys, "win"]).withColumn("scaled", F.col("value") / F.col("scale"))


def with_covariates(values: DataFrame, covariates: DataFrame, on: str = "h") -> DataFrame:
    """Values beside the covariates of their time or position; those without covariates go."""
    return values.join(covariates, on)


def with_age(df: DataFrame, keys: list[str]) -> DataFrame:
    """``age``: the index since the first non-zero value, z-scored over all rows of the series."""
    from pyspark.sql import Window

    first = windows.first_nonzero(df, keys)
    w = Window.partitionBy(*keys)
    kept = df.join(first, keys).where(F.col("idx") >= F.col("first_idx")).withColumn("since", F.col("idx") - F.col("first_idx"))
    return kept.withColumn("age", F.try_divide(F.col("since") - F.avg("since").over(w), F.stddev_pop("since").over(w)))
