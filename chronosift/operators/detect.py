"""Detectors over series of points, and the roll-up of their signals to entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronosift.schema import ENTITY_METRIC, SEVERITIES, severity_rank

#: Fixed values of the z-score detector.
Z_WARNING, Z_CRITICAL, Z_MIN_POINTS, Z_RECENT, Z_FLAT = 3.0, 4.5, 8, 0.25, 1e-8
#: Fixed values of the ratio detectors.
R_WARNING, R_CRITICAL, R_FLOOR, R_BASELINE = 1.8, 3.0, 1e-8, 5


def cut_at_least(score: Column, warning: float | Column, critical: float | Column) -> Column:
    """Severity by inclusive cuts; NaN is normal."""
    return F.when(F.isnan(score) | score.isNull(), SEVERITIES[0]).when(score >= critical, SEVERITIES[2]).when(score >= warning, SEVERITIES[1]).otherwise(SEVERITIES[0])


def anomalies(signals: DataFrame) -> DataFrame:
    """Signals that aren't normal."""
    return signals.where(F.col("severity") != SEVERITIES[0])


def with_group_labels(signals: DataFrame, labels: DataFrame, key: str = "entity_uid") -> DataFrame:
    """The signals with their entity's labels; entities without any keep their signals."""
    return signals.join(labels, key, "left")


def cut_above(score: Column, warning: Column | float, critical: Column | float) -> Column:
    """Severity by exclusive cuts; NaN is normal."""
    return F.when(F.isnan(score) | score.isNull(), SEVERITIES[0]).when(score > critical, SEVERITIES[2]).when(score > warning, SEVERITIES[1]).otherwise(SEVERITIES[0])


def recent_tail(points: DataFrame, keys: list[str], recent: float = Z_RECENT, order: list[str] | None = None) -> DataFrame:
    """The last ``recent`` share of each key's points by time and value, one at least."""
    order = order or ["ts_ms", "value"]
    part = Window.partitionBy(*keys)
    ranked = points.withColumn("_rn", F.row_number().over(part.orderBy(*[F.desc(c) for c in order]))).withColumn("_n", F.count(F.lit(1)).over(part))
    return ranked.where(F.col("_rn") <= F.greatest(F.lit(1), F.floor(F.col("_n") * recent))).drop("_rn", "_n")


def without_rollups(signals: DataFrame) -> DataFrame:
    """Signals of channels: those of entities go."""
    return signals.where(F.col("metric_name") != ENTITY_METRIC)


def zscore(points: DataFrame, keys: list[str], order: list[str] | None = None, value: str = "value", warning: float = Z_WARNING, critical: float = Z_CRITICAL, min_points: int = Z_MIN_POINTS, recent: float = Z_RECENT) -> DataFrame:
    """One row for each key: n_points, score (rounded to 4) and severity.

    The score is the largest |z| among the last quarter of the points by time and value, mean and deviation (population)
    over all of them. Short and flat series score 0. All points of a key share one window partition.
    """
    order = order or ["ts_ms", value]
    part = Window.partitionBy(*keys)
    ranked = points.select(
        *keys, F.col(value).alias("v"), F.row_number().over(part.orderBy(*[F.desc(c) for c in order])).alias("rn"),
        F.count(F.lit(1)).over(part).alias("n"), F.avg(value).over(part).alias("mu"), F.stddev_pop(value).over(part).alias("sd"),
    )
    tail = F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(recent)))
    z = F.when((F.col("n") >= max(3, min_points)) & (F.col("sd") >= Z_FLAT), F.abs(F.col("v") - F.col("mu")) / F.col("sd")).otherwise(0.0)
    scored = ranked.where(F.col("rn") <= tail).groupBy(*keys).agg(F.max("n").cast("long").alias("n_points"), F.max(z).alias("raw"))
    return scored.select(*keys, "n_points", F.round("raw", 4).alias("score"), cut_at_least(F.col("raw"), warning, critical).alias("severity"))


def channel_signals(points: DataFrame, now_ms: int | None = None) -> DataFrame:
    """Rows of ``as_signals`` input for (group_id, channel, ts_ms, value) by the z-score detector."""
    out = zscore(points, ["group_id", "channel"])
    return out.select(F.col("group_id").alias("entity_uid"), F.col("channel").alias("metric_name"), "severity", "score", F.lit("zscore").alias("method"), "n_points")


def error_ratio(windows: DataFrame, keys: list[str], error: str = "error", order: str = "win", eval_flag: str = "is_eval", warning: float = R_WARNING, critical: float = R_CRITICAL) -> DataFrame:
    """Error of the evaluated window over the mean of the last five errors before it; without any the ratio is 1."""
    part = Window.partitionBy(*keys).orderBy(F.desc(order))
    history = windows.where(~F.col(eval_flag)).withColumn("rn", F.row_number().over(part)).where(F.col("rn") <= R_BASELINE).groupBy(*keys).agg(F.avg(error).alias("baseline"))
    scored = windows.where(F.col(eval_flag)).select(*keys, F.col(error).alias("eval_error")).join(history, keys, "left")
    baseline = F.coalesce(F.col("baseline"), F.col("eval_error"))
    raw = F.when(F.col("baseline").isNull(), F.lit(1.0)).otherwise(F.col("eval_error") / F.greatest(baseline, F.lit(R_FLOOR)))
    return scored.select(*keys, "eval_error", baseline.alias("baseline"), raw.alias("raw"), F.round(raw, 4).alias("score"), cut_at_least(raw, warning, critical).alias("severity"))


POLICIES = ("max", "mean", "l2")


def roll_up(signals: DataFrame, policy: str = "max") -> DataFrame:
    """One signal for each entity from its channels' signals; earlier roll-ups are left out, so it can be repeated.

    The worst channel by severity, then score, then name gives severity and horizon; the policy gives the score.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}, one of {', '.join(POLICIES)}")
    channels = signals.where(F.col("metric_name") != ENTITY_METRIC)
    if "horizon" not in signals.columns:
        channels = channels.withColumn("horizon", F.lit(""))
    score = {"max": F.max("score"), "mean": F.avg("score"), "l2": F.sqrt(F.sum(F.col("score") * F.col("score")))}[policy]
    # the smallest of (-rank, -score, name) is the worst channel, by name among equals
    worst = F.min(F.struct((-severity_rank(F.col("severity"))).alias("r"), (-F.col("score")).alias("s"), "metric_name", "severity", "horizon"))
    out = channels.groupBy("entity_uid").agg(worst.alias("w"), F.round(score, 4).alias("score"), F.max("n_points").alias("n_points"), F.count("*").alias("n"), F.count_if(F.col("severity") != SEVERITIES[0]).alias("bad"))
    labels = F.create_map(F.lit("n_channels"), F.col("n").cast("string"), F.lit("n_anomalous"), F.col("bad").cast("string"), F.lit("top_channel"), F.col("w.metric_name"), F.lit("rollup_policy"), F.lit(policy))
    return out.select("entity_uid", F.lit(ENTITY_METRIC).alias("metric_name"), F.col("w.severity").alias("severity"), "score", F.lit("aggregate").alias("method"), F.col("w.horizon").alias("horizon"), "n_points", labels.alias("labels"))
