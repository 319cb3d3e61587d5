"""Bounded sources: wide and delimited CSV, range-query matrices, Parquet, and synthetic series."""

from __future__ import annotations

import json
import math
import os
import shutil
import urllib.parse
import urllib.request

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from chronosift.functions.calendar import parse_ts

MATRIX = "metric map<string,string>, values array<struct<ts_s: double, val: string>>"


def wide_to_long(df: DataFrame, ts_col: str, prefix: str = "", channels: list[str] | None = None) -> DataFrame:
    """One row for each cell that isn't blank: (ts_cell, channel, value)."""
    channels = channels or [c for c in df.columns if c != ts_col]
    text = df.select(F.col(ts_col).cast("string").alias("ts_cell"), *[F.col(c).cast("string").alias(c) for c in channels])
    long = text.unpivot(["ts_cell"], channels, "channel", "cell")
    return long.where((F.trim("cell") != "") & (F.trim("ts_cell") != "")).select("ts_cell", F.concat(F.lit(prefix), F.col("channel")).alias("channel"), F.col("cell").cast("double").alias("value"))


def csv_points(spark: SparkSession, path: str, instance: str, ts_col: str | None = None, prefix: str = "", fmt: str = "yyyy-MM-dd HH:mm:ss", now_ms: int | None = None, labels: dict[str, str] | None = None) -> DataFrame:
    """A wide CSV as long points (group_id, channel, ts_ms, value, labels); with ``now_ms`` moved so that the last one is then."""
    raw = spark.read.csv(path, header=True)
    long = wide_to_long(raw, ts_col or raw.columns[0], prefix).withColumn("ts_ms", parse_ts(F.col("ts_cell"), fmt))
    if now_ms is not None:
        last = long.agg(F.max("ts_ms").alias("last"))
        long = long.crossJoin(F.broadcast(last)).withColumn("ts_ms", F.col("ts_ms") + (F.lit(now_ms) - F.col("last"))).drop("last")  # last is one row
    more = [x for kv in (labels or {}).items() for x in map(F.lit, kv)]
    return long.select(F.lit(instance).alias("group_id"), "channel", "ts_ms", "value", F.create_map(F.lit("__name__"), F.col("channel"), F.lit("instance"), F.lit(instance), *more).alias("labels"))


def decimal_comma(cell: Column) -> Column:
    """A number written with a decimal comma."""
    return F.regexp_replace(cell.cast("string"), ",", ".").cast("double")


def delimited(spark: SparkSession, path: str, sep: str = ";", header: bool = True, schema: str | None = None, comma: bool = True) -> DataFrame:
    """A delimited file; all but the first column are numbers, with a decimal comma if so."""
    reader = spark.read.option("header", header).option("sep", sep)
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.select(df.columns[0], *[(decimal_comma(F.col(c)) if comma else F.col(c).cast("double")).alias(c) for c in df.columns[1:]])


def headerless(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=False)


def group_id(metric: Column, group_by: list[str]) -> Column:
    """Label values joined by /; ``default`` only if the joined text is empty."""
    joined = F.concat_ws("/", *[F.coalesce(metric[k], F.lit("")) for k in group_by])
    return F.when(joined == "", "default").otherwise(joined)


def channel_name(metric: Column, label: str = "__name__") -> Column:
    return F.coalesce(metric[label], metric["__name__"], F.lit("value"))


def flatten_matrix(matrix: DataFrame, group_by: list[str] | None = None, channel_label: str = "__name__") -> DataFrame:
    """Rows of MATRIX as long points; seconds become whole milliseconds, cut off."""
    group_by = group_by or ["instance"]
    rows = matrix.select(group_id(F.col("metric"), group_by).alias("group_id"), channel_name(F.col("metric"), channel_label).alias("channel"), F.map_filter("metric", lambda k, _: k.isin(group_by)).alias("labels"), F.explode("values").alias("p"))
    return rows.select("group_id", "channel", (F.col("p.ts_s") * 1000).cast("long").alias("ts_ms"), F.col("p.val").cast("double").alias("value"), "labels")


def matrix_from_json(df: DataFrame, col: str = "body") -> DataFrame:
    """Rows of MATRIX from response bodies; a body whose status isn't success fails the job."""
    shape = "status string, data struct<result: array<struct<metric: map<string,string>, `values`: array<array<string>>>>>"
    parsed = df.select(F.from_json(col, shape).alias("r")).where(F.when(F.coalesce(F.col("r.status"), F.lit("")) != "success", F.raise_error(F.concat(F.lit("range query failed: "), F.coalesce("r.status", F.lit("no status"))))).otherwise(F.lit(True)))
    series = parsed.select(F.explode("r.data.result").alias("s"))
    return series.select(F.col("s.metric").alias("metric"), F.transform(F.col("s")["values"], lambda p: F.struct(p[0].cast("double").alias("ts_s"), p[1].alias("val"))).alias("values"))


def query_range(endpoint: str, query: str, start: float, end: float, step_s: int, tenant: str | None = None, timeout: float = 30.0, open_url=urllib.request.urlopen) -> list[dict]:
    """The series of one range query; an answer other than success is an error."""
    args = urllib.parse.urlencode({"query": query, "start": start, "end": end, "step": step_s})
    request = urllib.request.Request(f"{endpoint.rstrip('/')}/prometheus/api/v1/query_range?{args}", headers={"X-Scope-OrgID": tenant} if tenant else {})
    with open_url(request, timeout=timeout) as answer:
        body = json.loads(answer.read())
    if body.get("status") != "success":
        raise RuntimeError(f"range query failed: {body.get('error', body.get('status'))}")
    return body["data"]["result"]


class _Span(InputPartition):
    def __init__(self, start: float, end: float) -> None:
        self.start, self.end = start, end


class RangeReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.o = options

    def partitions(self) -> list[InputPartition]:
        start, end, step, n = float(self.o["start"]), float(self.o["end"]), int(self.o.get("step", 15)), int(self.o.get("partitions", 1))
        points = int((end - start) // step) + 1
        each = -(-points // n)
        return [_Span(start + i * step, min(end, start + (min(points, i + each) - 1) * step)) for i in range(0, points, each)]

    def read(self, partition: _Span):
        if "file" in self.o:
            with open(self.o["file"], encoding="utf-8") as f:
                series = json.load(f)["data"]["result"]
        else:
            series = query_range(self.o["endpoint"], self.o["query"], partition.start, partition.end, int(self.o.get("step", 15)), self.o.get("tenant"))
        for s in series:
            values = [(float(t), str(v)) for t, v in s["values"] if partition.start <= float(t) <= partition.end]
            if values:
                yield s["metric"], values


class RangeSource(DataSource):
    """``spark.read.format("promrange")``: options endpoint, query, start, end, step, tenant, partitions; ``file`` reads a saved answer instead."""

    @classmethod
    def name(cls) -> str:
        return "promrange"

    def schema(self) -> str:
        return MATRIX

    def reader(self, schema) -> RangeReader:
        return RangeReader(self.options)


def synthetic(spark: SparkSession, groups: list[str], channels: list[str], n_points: int, start_ms: int = 0, step_s: int = 15, base: float = 1.0, slope: float = 0.0, anomaly_at: int | None = None, anomaly_value: float | None = None) -> DataFrame:
    """Long points with value base + slope * i, and one anomaly (ten times base unless given)."""
    value = F.lit(float(base)) + F.lit(float(slope)) * F.col("id")
    if anomaly_at is not None:
        value = F.when(F.col("id") == anomaly_at, F.lit(float(base * 10 if anomaly_value is None else anomaly_value))).otherwise(value)
    rows = spark.range(n_points).withColumn("group_id", F.explode(F.array(*map(F.lit, groups)))).withColumn("channel", F.explode(F.array(*map(F.lit, channels))))
    return rows.select("group_id", "channel", (F.col("id") * (step_s * 1000) + start_ms).alias("ts_ms"), value.alias("value"))


def sinusoids(spark: SparkSession, n_series: int, n_points: int, periods: tuple[int, ...] = (24, 168, 720), noise: float = 0.1, seed: int = 0) -> DataFrame:
    """Sums of sinusoids whose amplitudes (5 to 10) and phases hang on series, period and seed, and noise whose covariance decays with distance (first-order)."""

    def even(series: Column, period: int, what: str) -> Column:
        digest = F.md5(F.concat_ws("/", series, F.lit(str(period)), F.lit(what), F.lit(str(seed))))
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)

    s, i = F.col("series_id"), F.col("idx")
    grid = spark.range(n_series).select(F.col("id").alias("series_id"), *[(5 + 5 * even(F.col("id"), p, "a")).alias(f"a{p}") for p in periods], *[(2 * math.pi * even(F.col("id"), p, "f")).alias(f"f{p}") for p in periods])
    grid = grid.withColumn("idx", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_points - 1).cast("long"))))
    value = sum((F.col(f"a{p}") * F.sin(F.lit(2 * math.pi) * i / p + F.col(f"f{p}")) for p in periods), F.lit(0.0))
    waves = grid.select(s, i, value.alias("value"))
    if not noise:
        return waves

    def make(batches):
        for pdf in batches:
            for one in pdf["id"].tolist():
                w = np.random.default_rng([seed, one]).normal(0, noise, n_points)
                e = np.zeros(n_points)
                for t in range(n_points):
                    e[t] = (0.9 * e[t - 1] if t else 0.0) + w[t]
                yield pd.DataFrame({"series_id": one, "idx": range(n_points), "noise": e})

    added = spark.range(n_series).mapInPandas(make, "series_id long, idx long, noise double")
    return waves.join(added, ["series_id", "idx"]).select("series_id", "idx", (F.col("value") + F.col("noise")).alias("value"))


def fetch(url: str, path: str, open_url=urllib.request.urlopen) -> str:
    """The file behind a URL at ``path``; nothing is asked for if it is there already. A broken transfer leaves no file."""
    if not os.path.exists(path):
        with open_url(url) as answer, open(f"{path}.part", "wb") as f:
            shutil.copyfileobj(answer, f)
        os.replace(f"{path}.part", path)
    return path


def ett(spark: SparkSession, path: str, ts_col: str = "date") -> DataFrame:
    """The channels of a transformer-temperature CSV as numbers, without its date; row order is kept in ``row``."""
    df = spark.read.csv(path, header=True)
    channels = [c for c in df.columns if c != ts_col]
    order = F.monotonically_increasing_id()
    return df.select(order.alias("row"), *[F.col(c).cast("double").alias(c) for c in channels])


def fractional_noise(n: int, hurst: float, step: float = 1.0, seed: int = 0) -> np.ndarray:
    """Increments of fractional Brownian motion, exactly, by the covariance's Cholesky factor."""
    k = np.arange(n)
    cov = 0.5 * step ** (2 * hurst) * (np.abs(k + 1.0) ** (2 * hurst) - 2 * np.abs(k) ** (2 * hurst) + np.abs(k - 1.0) ** (2 * hurst))
    full = cov[np.abs(k[:, None] - k[None, :])]
    return np.linalg.cholesky(full + 1e-12 * np.eye(n)) @ np.random.default_rng(seed).standard_normal(n)


def zipped_lines(spark: SparkSession, path: str, suffix: str = ".csv") -> DataFrame:
    """(archive, member, line_no, line) of the text files in zip archives, one task an archive."""

    def run(batches):
        import io
        import zipfile

        for pdf in batches:
            for archive, content in zip(pdf["path"], pdf["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for member in sorted(n for n in z.namelist() if n.endswith(suffix)):
                        with z.open(member) as f:
                            lines = [x.rstrip("\r\n") for x in io.TextIOWrapper(f, "utf-8")]
                        yield pd.DataFrame({"archive": archive, "member": member, "line_no": range(len(lines)), "line": lines})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "archive string, member string, line_no long, line string")


def npy_rows(spark: SparkSession, path: str) -> DataFrame:
    """(file, row, values): the rows of saved arrays, inner dimensions flattened."""

    def run(batches):
        import io

        for pdf in batches:
            for file, content in zip(pdf["path"], pdf["content"], strict=True):
                x = np.load(io.BytesIO(content), allow_pickle=False)
                yield pd.DataFrame({"file": file, "row": range(len(x)), "values": list(x.reshape(len(x), -1).astype(float))})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "file string, row long, `values` array<double>")


def seed_csv(path: str, n: int = 60, seed: int = 0) -> None:
    """A small metrics CSV: cpu with a spike at rows 50 to 54, mem with a slope, a minute apart."""
    g = np.random.default_rng(seed)
    with open(path, "w", encoding="utf-8") as f:
        f.write("ts,cpu,mem\n")
        for i in range(n):
            cpu = 0.95 if 50 <= i <= 54 else 0.2 + g.normal(0, 0.01)
            f.write(f"{i * 60},{cpu:.4f},{0.4 + 0.004 * i + g.normal(0, 0.005):.4f}\n")
