"""Temporal alignment of channels with different cadences, on the long form (group_id, channel, ts_ms, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILLS = ("ffill", "zero", "drop", "drop_strict")


def snap(ts: Column, step_ms: int) -> Column:
    """The grid point at or before a timestamp, also for negative ones."""
    return ts - F.pmod(ts, F.lit(step_ms))


def last_in_bucket(points: DataFrame, step_ms: int) -> DataFrame:
    """The latest value of each (group, channel, bucket); at one timestamp the largest value."""
    bucketed = points.withColumn("bucket", snap(F.col("ts_ms"), step_ms))
    return bucketed.groupBy("group_id", "channel", "bucket").agg(F.max(F.struct("ts_ms", "value")).alias("last")).select("group_id", "channel", "bucket", F.col("last.value").alias("value"))


def grid(bucketed: DataFrame) -> DataFrame:
    """All (group, bucket) pairs that occur, with every channel of the group."""
    return bucketed.select("group_id", "bucket").distinct().join(bucketed.select("group_id", "channel").distinct(), "group_id")


def align_long(points: DataFrame, step_ms: int, fill: str = "ffill") -> DataFrame:
    """(group_id, channel, bucket, value): each channel's value as of every grid point of its group.

    ``ffill`` and ``drop`` carry values forward and leave out grid points before every channel has one; ``zero`` has 0 there;
    ``drop_strict`` keeps only grid points at which every channel was observed.
    """
    if fill not in FILLS:
        raise ValueError(f"unknown fill {fill!r}, one of {', '.join(FILLS)}")
    bucketed = last_in_bucket(points, step_ms)
    full = grid(bucketed).join(bucketed, ["group_id", "channel", "bucket"], "left")
    if fill != "drop_strict":
        order = Window.partitionBy("group_id", "channel").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        full = full.withColumn("value", F.last("value", ignorenulls=True).over(order))
    if fill == "zero":
        return full.withColumn("value", F.coalesce("value", F.lit(0.0)))
    missing = F.count_if(F.col("value").isNull()).over(Window.partitionBy("group_id", "bucket"))
    return full.withColumn("missing", missing).where("missing = 0").drop("missing")


def to_rows(aligned: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Pivot rows: channels sorted by name, values beside them; labels by group if given."""
    pairs = F.array_sort(F.collect_list(F.struct("channel", "value")))
    rows = aligned.groupBy("group_id", "bucket").agg(pairs.alias("p")).select("group_id", F.col("bucket").alias("ts_ms"), F.col("p.channel").alias("channels"), F.col("p.value").alias("values"))
    if labels is None:
        return rows.withColumn("labels", F.create_map().cast("map<string,string>"))
    return rows.join(labels, "group_id", "left").withColumn("labels", F.coalesce("labels", F.create_map().cast("map<string,string>")))


def to_points(rows: DataFrame) -> DataFrame:
    """The long form of pivot rows."""
    return rows.select("group_id", "ts_ms", F.explode(F.arrays_zip("channels", "values")).alias("p")).select("group_id", F.col("p.channels").alias("channel"), "ts_ms", F.col("p.values").alias("value"))


def first_labels(series: DataFrame) -> DataFrame:
    """Each group's labels, those of the series listed first (column ``ord``)."""
    return series.groupBy("group_id").agg(F.min_by("labels", "ord").alias("labels"))


def as_of(points: DataFrame, probes: DataFrame) -> DataFrame:
    """Backward as-of join: for each probe (group_id, channel, ts_ms) the last value at or before it.

    One shuffle for both sides and one ordered pass, no range join.
    """
    both = points.select("group_id", "channel", "ts_ms", "value", F.lit(0).alias("probe")).unionByName(probes.select("group_id", "channel", "ts_ms", F.lit(None).cast("double").alias("value"), F.lit(1).alias("probe")))
    order = Window.partitionBy("group_id", "channel").orderBy("ts_ms", "probe", "value").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("value", F.last("value", ignorenulls=True).over(order)).where("probe = 1").drop("probe")
