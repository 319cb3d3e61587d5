"""Sinks for pivot rows and predictions, and writing to several at once."""

from __future__ import annotations

import io
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronosift.schema import labels_json


def as_record(rows: DataFrame) -> DataFrame:
    """Pivot rows as they are stored: labels as JSON text with sorted keys."""
    return rows.select(F.col("group_id").cast("string").alias("group_id"), F.col("ts_ms").cast("long").alias("ts"), F.col("channels").cast("array<string>").alias("channels"), F.col("values").cast("array<double>").alias("values"), labels_json(F.col("labels")).alias("labels"))


def write_rows(rows: DataFrame, path: str, shards: int = 1) -> None:
    """Replace ``path`` by the rows in ``shards`` files."""
    out = as_record(rows)
    out = out.coalesce(1) if shards == 1 else out.repartition(shards) if shards else out
    out.write.mode("overwrite").parquet(path)


def write_predictions(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("overwrite").option("header", True).format(fmt).save(path)


def write_metrics(df: DataFrame, path: str, setting: str, columns: list[str] | None = None) -> None:
    """Append a line for each row to a folder of text: the setting, then name:value pairs."""
    columns = columns or [c for c, kind in df.dtypes if kind in ("double", "float")]
    pairs = F.concat_ws(", ", *[F.concat(F.lit(f"{c}:"), F.col(c).cast("string")) for c in columns])
    df.select(F.concat(F.lit(f"{setting}  "), pairs).alias("value")).coalesce(1).write.mode("append").text(path)


def write_weights(spark: SparkSession, weights: dict[str, np.ndarray], path: str) -> None:
    """A model's weights as a table (name, shape, values) that any executor can read."""
    rows = [(k, [int(n) for n in v.shape], [float(x) for x in np.asarray(v, float).ravel()]) for k, v in sorted(weights.items())]
    spark.createDataFrame(rows, "name string, shape array<int>, `values` array<double>").coalesce(1).write.mode("overwrite").parquet(path)


def read_weights(spark: SparkSession, path: str) -> dict[str, np.ndarray]:
    """Weights from such a table, or from a saved .npz file; in any store that Spark reads."""
    if path.endswith(".npz"):
        content = spark.read.format("binaryFile").load(path).select("content").first()[0]
        with np.load(io.BytesIO(bytes(content)), allow_pickle=False) as f:
            return {k: f[k] for k in f.files}
    return {r["name"]: np.array(r["values"]).reshape(r["shape"]) for r in spark.read.parquet(path).collect()}


def fan_out(df: DataFrame, sinks: list[Callable[[DataFrame], None]]) -> None:
    """Compute once, write to each."""
    held = df.persist()
    try:
        for sink in sinks:
            sink(held)
    finally:
        held.unpersist()
