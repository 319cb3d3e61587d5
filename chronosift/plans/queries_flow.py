"""Queries that go the whole way: through sinks and back, through streams, through configured pipelines."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronosift.functions import series, training
from chronosift.operators import align, forecast
from chronosift.plans import pipeline
from chronosift.plans import queries_signals as signals_sql
from chronosift.plans.base import DAY, POINTS, SIGNALS, TICKS, Registry, points, r6, signals, table, ticks
from chronosift.schema import as_signals
from chronosift.sinks import remote_write, rows, store
from chronosift.sources import files
from chronosift.storage import laid_down, shared_folder
from chronosift.streaming import engine

Q = Registry()
_TEN = 10 * 86_400


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/flow-{uuid.uuid4().hex}"


def _small(spark: SparkSession, partitions: int = 4) -> SparkSession:
    """A session of its own for a stream: every shuffle partition is a state store that each batch writes, few for few rows."""
    child = spark.newSession()
    child.conf.set("spark.sql.shuffle.partitions", str(partitions))
    child.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return child


def _kept(spark: SparkSession, stream: DataFrame, folder: str, mode: str) -> DataFrame:
    """All that a stream gives, with the number of the batch that gave it."""

    def keep(df: DataFrame, i: int) -> None:
        df.withColumn("batch", F.lit(i)).write.mode("overwrite").parquet(f"{folder}/out/{i}")

    engine.run_stream(stream, keep, f"{folder}/progress", mode).awaitTermination()
    return spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in stream.schema)}, batch int").option("recursiveFileLookup", "true").parquet(f"{folder}/out")


def _cores(spark: SparkSession) -> int:
    """How many tasks advance a stream's keys at once: one a core, as far as there are buckets."""
    return min(engine.BUCKETS, max(4, spark.sparkContext.defaultParallelism))


def _replayed(df: DataFrame, by: str, keys: list[str], folder: str, parts: int = 3) -> tuple[DataFrame, int]:
    """The rows as a stream of so many micro-batches in order of ``by``, and in how many buckets to advance its keys: one for 20,000 rows, as each call of Python costs some
    milliseconds, but some for each core and no more than the engine's own number.

    Each part is one job, as the files' times give their order, and several files, written and read side by side. A key's rows of a part are in one file, so that its
    rows stay in order wherever a micro-batch ends.
    """
    spark, files = df.sparkSession, 1
    with laid_down(df) as rows_:
        low, high, n = rows_.agg(F.min(by), F.max(by), F.count("*")).first()
        step = ((high or 0) - (low or 0)) // parts + 1
        for i in range(parts):
            part = rows_.where((F.col(by) >= (low or 0) + i * step) & (F.col(by) < (low or 0) + (i + 1) * step))
            part.repartition(_cores(spark), *keys).write.parquet(f"{folder}/{i:05d}")
            files = max(files, len(spark.read.schema(rows_.schema).parquet(f"{folder}/{i:05d}").inputFiles()))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    buckets = min(engine.BUCKETS, max(4 * _cores(spark), n // 20_000))
    return engine.replay(_small(spark, _cores(spark)), folder, schema, files), buckets


# ---- sinks and back


@Q("snk1_rows_and_back", f"WITH {POINTS}{signals_sql._aligned('ffill')} SELECT group_id, bucket AS ts, string_agg(channel, ',' ORDER BY channel) AS channels, round(sum(value), 6) AS total, '{{}}' AS labels FROM a GROUP BY 1, 2")
def _(spark, sf):
    path = _folder(spark)
    rows.write_rows(align.to_rows(align.align_long(points(spark, sf), DAY)), path, 3)
    back = spark.read.parquet(path)
    return back.select("group_id", "ts", F.concat_ws(",", "channels").alias("channels"), r6(F.aggregate("values", F.lit(0.0), lambda a, x: a + x)).alias("total"), "labels")


@Q("snk4_store_and_back", f"WITH {SIGNALS} SELECT entity_uid, metric_name, max(ts) AS ts, arg_max(score, ts) AS score, arg_max(severity, ts) AS severity, arg_max(n_points, ts) AS n_points FROM signals GROUP BY ALL")
def _(spark, sf):
    path = _folder(spark)
    kept = store.SignalStore(spark, path)
    s = as_signals(signals(spark, sf), F.col("ts"))
    kept.write(s.where("ts % 2 = 0"))
    for _ in range(2):  # a batch that is tried again replaces itself
        kept.write(s.where("ts % 2 <> 0 OR severity <> 'normal'"), batch="7")
    return kept.latest().select("entity_uid", "metric_name", "ts", "score", "severity", "n_points")


@Q("snk12_fan_out", f"WITH {SIGNALS} SELECT sink, severity, count(*) AS n FROM signals, (VALUES ('a'), ('b')) v(sink) GROUP BY 1, 2")
def _(spark, sf):
    path = _folder(spark)
    rows.fan_out(signals(spark, sf), [lambda df, k=k: rows.write_predictions(df, f"{path}/{k}") for k in "ab"])
    both = [spark.read.parquet(f"{path}/{k}").withColumn("sink", F.lit(k)) for k in "ab"]
    return both[0].unionByName(both[1]).groupBy("sink", "severity").agg(F.count("*").alias("n"))


@Q("src10_headerless_csv", "SELECT CAST(p_partkey AS VARCHAR) AS label, p_size, round(p_retailprice, 2) AS price FROM part")
def _(spark, sf):
    path = _folder(spark)
    table(spark, sf, "part").select("p_partkey", "p_size", F.round("p_retailprice", 2)).write.csv(path)
    return files.headerless(spark, path, "label string, p_size long, price double")


@Q("src7_channels_without_date", "SELECT round(s_acctbal, 2) AS s_acctbal, CAST(s_nationkey AS DOUBLE) AS s_nationkey FROM supplier")
def _(spark, sf):
    path = _folder(spark)
    table(spark, sf, "supplier").select(F.lit("2016-07-01 00:00:00").alias("date"), F.round("s_acctbal", 2).alias("s_acctbal"), "s_nationkey").write.option("header", True).csv(path)
    return files.ett(spark, path).select("s_acctbal", "s_nationkey")


@Q("src5_csv_points", "SELECT 'node' AS group_id, 'm_' || channel AS channel, CAST(o_orderkey * 1000 AS BIGINT) AS ts_ms, value FROM (SELECT o_orderkey, round(o_totalprice, 2) AS total, CAST(o_custkey AS DOUBLE) AS cust FROM orders) UNPIVOT (value FOR channel IN (total, cust))")
def _(spark, sf):
    path = _folder(spark)
    table(spark, sf, "orders").select(F.col("o_orderkey").alias("ts"), F.round("o_totalprice", 2).alias("total"), F.col("o_custkey").alias("cust")).write.option("header", True).csv(path)
    return files.csv_points(spark, path, "node", prefix="m_").select("group_id", "channel", "ts_ms", "value")


# ---- configured pipelines


@Q("api10_pipeline_run", signals_sql.Q.oracles["ag7_detect_with_rollup"])
def _(spark, sf):
    path = _folder(spark)
    points(spark, sf).write.parquet(f"{path}/in")
    config = {"source": {"type": "points", "path": f"{path}/in"}, "detector": {"type": "zscore"}, "entity_rollup": True, "sinks": [{"type": "signal-store", "root": f"{path}/kb"}]}
    pipeline.run_pipeline(config, spark, 1000)
    return store.SignalStore(spark, f"{path}/kb").read().select("entity_uid", "metric_name", "severity", "score", "method", "n_points")


_WINDOWS = signals_sql._sliding_sql(_TEN, _TEN)


@Q("api8_streaming_run", f"SELECT group_id AS entity_uid, channel AS metric_name, (win_start + {_TEN}) * 1000 AS ts, n_points, score, severity FROM ({_WINDOWS})")
def _(spark, sf):
    path = _folder(spark)
    child = _small(spark)
    engine.record(points(child, sf), f"{path}/in", 3)
    window = {"size_s": _TEN, "period_s": _TEN}
    config = {"source": {"type": "points", "path": f"{path}/in"}, "engine": {"streaming": True, "window": window, "folder": path}, "sinks": [{"type": "signal-store", "root": f"{path}/kb"}]}
    pipeline.run_pipeline(config, child)
    best = Window.partitionBy("entity_uid", "metric_name", "ts").orderBy(F.desc("n_points"))
    found = store.SignalStore(spark, f"{path}/kb").read().withColumn("rn", F.row_number().over(best)).where("rn = 1")
    return found.select("entity_uid", "metric_name", "ts", "n_points", "score", "severity")


# ---- streams


@Q("str5_stream_windows", _WINDOWS)
def _(spark, sf):
    path = _folder(spark)
    child = _small(spark)
    engine.record(points(child, sf), f"{path}/in", 3)
    got = _kept(spark, engine.windowed_zscore(engine.replay(child, f"{path}/in"), engine.WindowSpec(_TEN, _TEN)), path, "update")
    last = Window.partitionBy("entity_uid", "metric_name", "win_start").orderBy(F.desc("batch"))
    got = got.withColumn("rn", F.row_number().over(last)).where("rn = 1")
    return got.select(F.col("metric_name").alias("channel"), F.col("entity_uid").alias("group_id"), (F.col("win_start") / 1000).cast("long").alias("win_start"), "n_points", "score", "severity")


@Q("str8_stream_panes", f"WITH {POINTS}, w AS (SELECT group_id, channel, ts_ms // {_TEN * 1000} * {_TEN * 1000} AS win_start, count(*) AS n FROM p GROUP BY ALL) SELECT group_id, channel, win_start, CAST(unnest(range(1, n // 2 + 1)) * 2 AS INTEGER) AS n FROM w")
def _(spark, sf):
    path = _folder(spark)
    child = _small(spark)
    engine.record(points(child, sf), f"{path}/in", 3)
    got = _kept(spark, engine.counted_panes(engine.replay(child, f"{path}/in"), engine.WindowSpec(_TEN, _TEN, lateness_s=_TEN, early_every=2)), path, "append")
    return got.where("kind = 'early'").select("group_id", "channel", "win_start", "n")


def _by_day(df: DataFrame) -> DataFrame:
    return df.select(F.col("group_id").alias("entity_uid"), F.col("channel").alias("metric_name"), F.col("day").alias("seq"), "score")


_KEYS = ["entity_uid", "metric_name"]


@Q("str10_stream_regime", signals_sql._DEBOUNCED)
def _(spark, sf):
    path = _folder(spark)
    t = signals_sql._faces(spark, sf).withColumnsRenamed({"group_id": "entity_uid", "channel": "metric_name"})
    stream, buckets = _replayed(t, "seq", _KEYS, f"{path}/in")
    got = _kept(spark, engine.streaming_regime(stream, 2, 3, buckets), path, "append")
    return got.select(F.col("entity_uid").alias("group_id"), F.col("metric_name").alias("channel"), "seq", "regime")


_PAST = "WINDOW w AS (PARTITION BY group_id, channel ORDER BY day ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)"


@Q("str16_stream_quantile", f"WITH {TICKS}, c AS (SELECT group_id, channel, day, score, count(score) OVER w AS h, quantile_cont(score, 0.95) OVER w AS qw, quantile_cont(score, 0.99) OVER w AS qc FROM ticks {_PAST}) SELECT group_id, channel, day, CASE WHEN score > CASE WHEN h >= 4 THEN qc + 1e-9 ELSE 3.0 END THEN 'critical' WHEN score > CASE WHEN h >= 4 THEN qw + 1e-9 ELSE 1.8 END THEN 'warning' ELSE 'normal' END AS severity FROM c")
def _(spark, sf):
    path = _folder(spark)
    stream, buckets = _replayed(_by_day(ticks(spark, sf)), "seq", _KEYS, f"{path}/in")
    # scores are rounded, so quantiles can equal them: the margin is the SQL's
    got = _kept(spark, engine.streaming_quantile(stream, 8, 4, buckets=buckets, margin=1e-9), path, "append")
    return got.select(F.col("entity_uid").alias("group_id"), F.col("metric_name").alias("channel"), F.col("seq").alias("day"), "severity")


@Q("str16_stream_mad", f"WITH {TICKS}, c AS (SELECT group_id, channel, day, score, list(score) OVER w AS past FROM ticks {_PAST}), m AS (SELECT *, coalesce(len(past), 0) AS h, list_median(past) AS mid FROM c), s AS (SELECT *, 1.4826 * list_median(list_transform(past, lambda x: abs(x - mid))) AS sp FROM m), t AS (SELECT *, CASE WHEN sp > 0 THEN sp ELSE 1e-8 END AS spread FROM s) SELECT group_id, channel, day, CASE WHEN score > CASE WHEN h >= 4 THEN mid + 5 * spread ELSE 3.0 END THEN 'critical' WHEN score > CASE WHEN h >= 4 THEN mid + 3 * spread ELSE 1.8 END THEN 'warning' ELSE 'normal' END AS severity FROM t")
def _(spark, sf):
    path = _folder(spark)
    stream, buckets = _replayed(_by_day(ticks(spark, sf)), "seq", _KEYS, f"{path}/in")
    got = _kept(spark, engine.streaming_mad(stream, 8, 4, buckets=buckets), path, "append")
    return got.select(F.col("entity_uid").alias("group_id"), F.col("metric_name").alias("channel"), F.col("seq").alias("day"), "severity")


# ---- the rest of the surface


@Q("api13_ingest_csv", "SELECT 'x' AS job, 'node' AS instance, 'm_' || channel AS name, CAST(epoch_ms(ts) AS BIGINT) AS ts_ms, value FROM (SELECT TIMESTAMP '2024-01-01' + to_seconds(o_orderkey) AS ts, round(o_totalprice, 2) AS total, CAST(o_custkey AS DOUBLE) AS cust FROM orders) UNPIVOT (value FOR channel IN (total, cust))")
def _(spark, sf):
    """What the ingest command sends: labels, prefix and times with % signs, encoded and read back."""
    path = _folder(spark)
    when = F.date_format(F.timestamp_seconds(F.lit(1_704_067_200) + F.col("o_orderkey")), "dd.MM.yyyy HH:mm:ss")
    table(spark, sf, "orders").select(when.alias("ts"), F.round("o_totalprice", 2).alias("total"), F.col("o_custkey").alias("cust")).write.option("header", True).csv(path)
    sent = files.csv_points(spark, path, "node", prefix="m_", fmt="%d.%m.%Y %H:%M:%S", labels={"job": "x"})
    got = remote_write.received(remote_write.requests(remote_write.to_pieces(sent), partitions=None))
    at = F.col("labels")
    return got.select(at["job"].alias("job"), at["instance"].alias("instance"), at["__name__"].alias("name"), "ts_ms", "value")


@Q("api15_history_endpoint", f"WITH {SIGNALS} SELECT entity_uid, metric_name, ts, severity, score FROM signals WHERE entity_uid = '7' AND ts >= 1704500000000 ORDER BY ts, metric_name LIMIT 12")
def _(spark, sf):
    """The answer of the HTTP endpoint, asked over a socket."""
    import json
    import threading
    import urllib.request

    path = _folder(spark)
    store.SignalStore(spark, path).write(as_signals(signals(spark, sf).where("entity_uid = '7'"), F.col("ts")))
    server = store.serve(spark, path, port=0)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://127.0.0.1:{server.server_address[1]}/api/v1/signals/history?entity=7&since=1704500000000&limit=12"
        with urllib.request.urlopen(url, timeout=300) as answer:
            body = json.loads(answer.read())
    finally:
        server.shutdown()
    kept = [(s["entity_uid"], s["metric_name"], s["ts"], s["severity"], s["score"]) for s in body["signals"]]
    return spark.createDataFrame(kept, "entity_uid string, metric_name string, ts long, severity string, score double")


@Q("api16_counters", f"WITH {POINTS} SELECT count(*) AS rows_in, count(DISTINCT (group_id, channel)) AS records_out FROM p")
def _(spark, sf):
    path = _folder(spark)
    points(spark, sf).write.parquet(f"{path}/in")
    out = pipeline.run_pipeline({"source": {"type": "points", "path": f"{path}/in"}}, spark, 1000)
    return spark.createDataFrame([(out["rows_in"], out["records_out"])], "rows_in long, records_out long")


_FLAT = forecast.ModelSpec(n_channels=1, context_length=64, horizon=4, patch_length=8, stride=8, d_model=4, n_heads=1, n_layers=1, d_ff=4)


@Q("dt8_model_of_zeros", "WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings) SELECT vec_id, 4 AS steps, round(list_avg(v), 6) AS first, round(list_var_pop(v) / (list_var_pop(v) + 1e-5), 6) AS rebuild_error FROM e")
def _(spark, sf):
    """The forward pass with weights from a table, all 0: the forecast is each window's mean, the rebuilding error its normalised variance."""
    path = _folder(spark)
    rows.write_weights(spark, {k: np.zeros_like(v) for k, v in forecast.random_weights(_FLAT).items()}, path)
    wins = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("window"))
    out = forecast.infer(wins, _FLAT, rows.read_weights(spark, path))
    return out.select("vec_id", F.size("forecast").alias("steps"), r6(F.element_at("forecast", 1)).alias("first"), r6("rebuild_error").alias("rebuild_error"))


def _one_step(kind: str, coefficients: str, pred: str):
    sql = f"""WITH {POINTS}, s AS (SELECT group_id, channel, list(value ORDER BY ts_ms, value) AS v FROM p GROUP BY ALL), n AS (SELECT *, len(v) AS n, CAST(floor(len(v) * 0.8) AS BIGINT) AS lim FROM s WHERE len(v) >= 2),
 t AS (SELECT group_id, channel, v, unnest(range(0, greatest(0, lim - 1))) AS o FROM n), k AS (SELECT group_id, channel, count(*)::DOUBLE AS m, sum(v[o + 1]) AS sx, sum(v[o + 2]) AS sy, sum(v[o + 1] * v[o + 1]) AS sxx, sum(v[o + 1] * v[o + 2]) AS sxy FROM t GROUP BY ALL),
 c AS (SELECT *, {coefficients} FROM k), w AS (SELECT group_id, channel, o AS win, FALSE AS is_eval, v[o + 1] AS x, v[o + 2] AS y FROM t UNION ALL SELECT group_id, channel, greatest(0, lim - 1), TRUE, v[n - 1], v[n] FROM n)
 SELECT w.group_id, w.channel, win, is_eval, round(abs(coalesce({pred}, x) - y), 4) AS error FROM w LEFT JOIN c USING (group_id, channel)"""

    @Q(f"fm2_{kind}_one_step", sql)
    def _(spark, sf):
        s = series.ordered_series(points(spark, sf), ["group_id", "channel"])
        out = forecast.window_errors(s, ["group_id", "channel"], 1, 1, kind)
        return out.select("group_id", "channel", F.col("win").cast("long").alias("win"), "is_eval", F.round("error", 4).alias("error"))


_LINE = "((m + 1e-3) * sxy - sx * sy) / ((sxx + 1e-3) * (m + 1e-3) - sx * sx) AS w, ((sxx + 1e-3) * sy - sx * sxy) / ((sxx + 1e-3) * (m + 1e-3) - sx * sx) AS b"
_one_step("linear", _LINE, "x * w + b")
_one_step("dlinear", _LINE, "x * w + b")
_one_step("nlinear", "(sy - sx) / (m + 1e-3) AS b", "x + b")


def _schedule(kind: str, name: str, sql: str):
    @Q(f"f28_rate_{name}", f"SELECT CAST(e AS BIGINT) AS epoch, round({sql}, 12) AS rate FROM range(1, 41) t(e)")
    def _(spark, sf):
        rate = F.udf(lambda e: training.learning_rate(e, 1e-2, kind, 40), "double")  # forty epochs
        return spark.range(1, 41).select(F.col("id").alias("epoch"), F.round(rate("id"), 12).alias("rate"))


_schedule("halving", "halving", "1e-2 * pow(0.5, e - 1)")
_schedule("hold-decay", "hold_decay", "CASE WHEN e <= 3 THEN 1e-2 ELSE 1e-2 * pow(0.9, e - 3) END")
_schedule("cut-at-10", "cut", "CASE WHEN e < 10 THEN 1e-2 ELSE 1e-3 END")
_schedule("step", "step", "CASE WHEN e >= 20 THEN 5e-8 WHEN e >= 15 THEN 1e-7 WHEN e >= 10 THEN 5e-7 WHEN e >= 8 THEN 1e-6 WHEN e >= 6 THEN 5e-6 WHEN e >= 4 THEN 1e-5 WHEN e >= 2 THEN 5e-5 ELSE 1e-2 END")
_schedule("one-cycle", "one_cycle", "CASE WHEN e <= 12 THEN 1e-2 * (1 - cos(pi() * e / 12)) / 2 ELSE 1e-2 * (1 + cos(pi() * (e - 12) / 28)) / 2 END")
