"""Scalers whose statistics come from a slice of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def standard_stats(df: DataFrame, keys: list[str], value: str = "value", where: Column | None = None) -> DataFrame:
    """mean and sd (population; 1 for a constant series) of each key over the rows of ``where``."""
    rows = df if where is None else df.where(where)
    sd = F.stddev_pop(value)
    return rows.groupBy(*keys).agg(F.avg(value).alias("mean"), F.when(sd == 0, 1.0).otherwise(sd).alias("sd"))


def standardise(df: DataFrame, keys: list[str], value: str = "value", where: Column | None = None) -> DataFrame:
    return df.join(standard_stats(df, keys, value, where), keys).withColumn("scaled", (F.col(value) - F.col("mean")) / F.col("sd"))


def unstandardise(df: DataFrame, scaled: str = "scaled") -> DataFrame:
    return df.withColumn("restored", F.col(scaled) * F.col("sd") + F.col("mean"))


def gaussian(df: DataFrame, keys: list[str], value: str = "value", eps: float = 1e-5) -> DataFrame:
    """Less the mean, over the sample deviation plus eps; global if there are no keys, pointwise with the position as key."""
    stats = df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
    both = df.join(stats, keys) if keys else df.crossJoin(F.broadcast(stats))  # one row
    return both.withColumn("scaled", (F.col(value) - F.col("mean")) / (F.col("sd") + eps))


def to_range(df: DataFrame, keys: list[str], value: str = "value", low: float = 0.0, high: float = 1.0) -> DataFrame:
    stats = df.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    both = df.join(stats, keys) if keys else df.crossJoin(F.broadcast(stats))  # one row
    return both.withColumn("scaled", (F.col(value) - F.col("lo")) * F.try_divide(F.lit(high - low), F.col("hi") - F.col("lo")) + low)


def mean_scale(value: Column, mean: Column) -> Column:
    return value / (mean + 1)


def mean_unscale(value: Column, mean: Column) -> Column:
    return value * (mean + 1)
