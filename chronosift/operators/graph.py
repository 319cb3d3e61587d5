"""Graphs over the time steps of a window: a pyramid of coarser levels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def level_sizes(length: int, sizes: list[int]) -> list[int]:
    """Nodes of each level: every node of a level stands for ``sizes`` nodes of the one below; what doesn't fill one is left out."""
    out = [length]
    for n in sizes:
        out.append(out[-1] // n)
    return out


def pyramid_edges(spark: SparkSession, length: int, sizes: list[int], neighbours: int) -> DataFrame:
    """(a, b): nodes within ``neighbours`` of each other on their level, both ways, and each node with its parent. Levels are numbered one after the other."""
    levels = level_sizes(length, sizes)
    starts = [sum(levels[:i]) for i in range(len(levels))]
    parts = []
    for i, (n, at) in enumerate(zip(levels, starts, strict=True)):
        node = spark.range(at, at + n).select(F.col("id").alias("a"))
        low, high = F.greatest(F.lit(at).cast("long"), F.col("a") - neighbours), F.least(F.lit(at + n - 1).cast("long"), F.col("a") + neighbours)
        parts.append(node.select("a", F.explode(F.sequence(low, high)).alias("b")).where("a <> b"))
        if i + 1 < len(levels):
            # the last parent takes what doesn't fill one
            up = F.least(F.floor((F.col("a") - at) / sizes[i]), F.lit(levels[i + 1] - 1)) + starts[i + 1]
            parts.append(node.select("a", up.cast("long").alias("b")))
    return reduce(DataFrame.union, parts)


def causal_pairs(spark: SparkSession, length: int) -> DataFrame:
    """(i, j): the steps j that step i may look at, itself and those before."""
    return spark.range(length).select(F.col("id").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("id"))).alias("j"))


def parents(df: DataFrame, idx: str, n: str, size: int) -> DataFrame:
    """``parent``: the coarser node that a step of its series belongs to, null for steps behind the last whole one."""
    up: Column = F.floor(F.col(idx) / size)
    return df.withColumn("parent", F.when(up < F.floor(F.col(n) / size), up))
