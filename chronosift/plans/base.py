"""What registered queries share: tables, the metric stream, and the registering itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronosift.schema import ts_ms

DAY = 86_400_000


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None):
        def add(fn):
            self.queries[name] = fn
            if sql is not None:
                self.oracles[name] = sql
            return fn

        return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric stream: entity = user, channel = event type."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").cast("string").alias("group_id"), F.col("event_type").alias("channel"), ts_ms(F.col("ts")).alias("ts_ms"), "value")


POINTS = "p AS (SELECT CAST(user_id AS VARCHAR) AS group_id, event_type AS channel, CAST(epoch_us(ts) // 1000 AS BIGINT) AS ts_ms, value FROM events)"


def r6(c: Column | str) -> Column:
    return F.round(c, 6)


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for each (entity, metric, day): how far the day's mean is from the series' mean, in deviations."""
    from pyspark.sql import Window

    w = Window.partitionBy("group_id", "channel")
    p = points(spark, sf_dir).select("group_id", "channel", (F.col("ts_ms") - F.pmod("ts_ms", F.lit(DAY))).alias("day"), "value", F.avg("value").over(w).alias("mu"), F.stddev_pop("value").over(w).alias("sd"))
    d = p.groupBy("group_id", "channel", "day").agg(F.avg("value").alias("m"), F.first("mu").alias("mu"), F.first("sd").alias("sd"), F.count("*").alias("n_points"))
    score = F.round(F.when(F.col("sd") >= 1e-8, F.abs(F.col("m") - F.col("mu")) / F.col("sd")).otherwise(0.0), 4)
    return d.select("group_id", "channel", "day", score.alias("score"), "n_points")


TICKS = POINTS + f""", k AS (SELECT group_id, channel, avg(value) AS mu, stddev_pop(value) AS sd FROM p GROUP BY ALL),
ticks AS (SELECT p.group_id, p.channel, ts_ms - ts_ms % {DAY} AS day,
  round(CASE WHEN any_value(sd) >= 1e-8 THEN abs(avg(value) - any_value(mu)) / any_value(sd) ELSE 0 END, 4) AS score, count(*) AS n_points
  FROM p JOIN k USING (group_id, channel) GROUP BY p.group_id, p.channel, day)"""


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals from the ticks, with cuts 1.0 and 2.0."""
    from chronosift.operators.detect import cut_at_least

    t = ticks(spark, sf_dir)
    return t.select(F.col("group_id").alias("entity_uid"), F.col("channel").alias("metric_name"), F.col("day").alias("ts"), cut_at_least(F.col("score"), 1.0, 2.0).alias("severity"), "score", F.lit("tick").alias("method"), F.lit("").alias("horizon"), "n_points")


SIGNALS = TICKS + """, signals AS (SELECT group_id AS entity_uid, channel AS metric_name, day AS ts,
  CASE WHEN score >= 2.0 THEN 'critical' WHEN score >= 1.0 THEN 'warning' ELSE 'normal' END AS severity, score, 'tick' AS method, '' AS horizon, n_points FROM ticks)"""
