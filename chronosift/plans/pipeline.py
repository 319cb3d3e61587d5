"""From a configuration to a plan: source -> align -> detect -> roll up -> sinks, as a batch or a stream."""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chronosift.functions.series import ordered_series
from chronosift.operators import align, detect, forecast, regime, threshold
from chronosift.registry import build, connector
from chronosift.schema import as_signals
from chronosift.sinks import rows, store
from chronosift.sources import files
from chronosift.storage import durable, shared_folder
from chronosift.streaming import engine


class ReplayedSource:
    """A bounded source that can also be replayed as a stream, from files written in order of time."""

    def read_stream(self, spark: SparkSession, folder: str, parts: int = 4) -> DataFrame:
        engine.record(self.read(spark), folder, parts)
        return engine.replay(spark, folder)


class BatchedSink:
    """A sink that a stream writes to batch by batch; a batch that is tried again replaces what it had written."""

    def write_batch(self, df: DataFrame, batch: str) -> None:
        self.write(df)

    def write_stream(self, df: DataFrame, checkpoint: str, mode: str = "append", once: bool = True) -> None:
        engine.run_stream(df, lambda rows_, i: self.write_batch(rows_, f"stream-{i}"), checkpoint, mode, once).awaitTermination()


@connector("synthetic")
class SyntheticSource(ReplayedSource):
    def __init__(self, group_ids: list[str], channels: list[str], n_points: int, late_at: int | None = None, **more) -> None:
        self.args, self.late_at = {"groups": group_ids, "channels": channels, "n_points": n_points, **more}, late_at

    def read(self, spark: SparkSession) -> DataFrame:
        return files.synthetic(spark, **self.args)

    def read_stream(self, spark: SparkSession, folder: str, parts: int = 4) -> DataFrame:
        """The elements of number ``late_at`` are held back and come last."""
        at = None if self.late_at is None else self.args.get("start_ms", 0) + self.late_at * 1000 * self.args.get("step_s", 15)
        engine.record(self.read(spark), folder, parts, None if at is None else F.col("ts_ms") == at)
        return engine.replay(spark, folder)

    def describe(self) -> dict:
        return {"kind": "synthetic", **self.args}


@connector("promrange")
class RangeQuerySource(ReplayedSource):
    def __init__(self, start: float, end: float, endpoint: str = "", query: str = "", step_s: int = 15, group_by: list[str] | None = None, channel_label: str = "__name__", fill: str = "ffill", tenant: str | None = None, file: str | None = None) -> None:
        self.options = {k: str(v) for k, v in {"endpoint": endpoint, "query": query, "start": start, "end": end, "step": step_s, "tenant": tenant, "file": file}.items() if v not in (None, "")}
        self.step_s, self.group_by, self.channel_label, self.fill = step_s, group_by or ["instance"], channel_label, fill

    def read(self, spark: SparkSession) -> DataFrame:
        spark.dataSource.register(files.RangeSource)
        matrix = spark.read.format("promrange").options(**self.options).load()
        points = files.flatten_matrix(matrix, self.group_by, self.channel_label)
        return align.align_long(points, self.step_s * 1000, self.fill).withColumnRenamed("bucket", "ts_ms")

    def describe(self) -> dict:
        return {"kind": "promrange", **self.options}


@connector("csv")
class CsvSource(ReplayedSource):
    def __init__(self, path: str, instance: str, **more) -> None:
        self.path, self.instance, self.more = path, instance, more

    def read(self, spark: SparkSession) -> DataFrame:
        return files.csv_points(spark, self.path, self.instance, **self.more)

    def describe(self) -> dict:
        return {"kind": "csv", "path": self.path}


@connector("points")
class PointsSource:
    """A folder of Parquet files with long points, as a table or file by file as a stream."""

    def __init__(self, path: str) -> None:
        self.path = path

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(engine.POINTS).option("recursiveFileLookup", "true").parquet(self.path)

    def read_stream(self, spark: SparkSession, folder: str | None = None) -> DataFrame:
        return engine.replay(spark, folder or self.path)

    def describe(self) -> dict:
        return {"kind": "points", "path": self.path}


@connector("parquet")
class RowSink(BatchedSink):
    def __init__(self, path: str, shards: int = 1) -> None:
        self.path, self.shards = path, shards

    def write(self, df: DataFrame) -> None:
        rows.write_rows(df, self.path, self.shards)

    def write_batch(self, df: DataFrame, batch: str) -> None:
        rows.write_rows(df, f"{self.path}/batch-{batch}", self.shards)

    def describe(self) -> dict:
        return {"kind": "parquet", "path": self.path}


@connector("signal-store")
class StoreSink(BatchedSink):
    def __init__(self, root: str) -> None:
        self.root = root

    def write(self, df: DataFrame) -> None:
        store.SignalStore(df.sparkSession, self.root).write(df)

    def write_batch(self, df: DataFrame, batch: str) -> None:
        store.SignalStore(df.sparkSession, self.root).write(df, batch=batch)

    def describe(self) -> dict:
        return {"kind": "signal-store", "root": self.root}


def load_config(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        if path.endswith((".yaml", ".yml")):
            import yaml  # not needed for JSON

            return yaml.safe_load(f)
        return json.load(f)


def build_threshold(config: dict | None):
    """A function (scores, keys, order) -> scores with severity."""
    config = dict(config or {"type": "fixed"})
    kind = config.pop("type", "fixed")
    if kind not in threshold.POLICIES:
        raise ValueError(f"unknown threshold {kind!r}, one of {', '.join(threshold.POLICIES)}")
    if kind == "fixed":
        return lambda scores, keys, order: threshold.fixed(scores, **config)
    return lambda scores, keys, order: threshold.POLICIES[kind](scores, keys, order, **config)


DETECTORS = ("zscore", "patch-forecast", "reconstruction", "patch-forecast-infer", "reconstruction-infer", "regime-switch")


class ModelPair:
    """A forecasting and a rebuilding model of one shape, as one engine."""

    def __init__(self, spec: forecast.ModelSpec, ahead: dict, back: dict) -> None:
        self.spec, self._ahead, self._back = spec, forecast.PatchTransformer(spec, ahead), forecast.PatchTransformer(spec, back)

    def forecast(self, x):
        return self._ahead.forecast(x)

    def reconstruct(self, x):
        return self._back.reconstruct(x)


def load_pair(spark: SparkSession, forecast_ckpt: str, reconstruct_ckpt: str, spec: dict | forecast.ModelSpec) -> ModelPair:
    """Both models from their weights; a missing file or a weight of another shape is an error."""
    spec = spec if isinstance(spec, forecast.ModelSpec) else forecast.ModelSpec.from_dict(spec)
    want = forecast.random_weights(spec)
    found = []
    for path in (forecast_ckpt, reconstruct_ckpt):
        weights = rows.read_weights(spark, path)
        wrong = [k for k, v in want.items() if k not in weights or weights[k].shape != v.shape]
        if wrong:
            raise ValueError(f"{path} doesn't fit the shape of the model: {', '.join(wrong[:5])}")
        found.append(weights)
    return ModelPair(spec, *found)


def build_detector(config: dict | None, engine_model=None, extra: tuple[str, ...] = ()):
    """A function from long points to (entity_uid, metric_name, severity, score, method, n_points[, labels][, extra]).

    The settings stand beside ``type`` or in ``params``. ``patch-forecast`` and ``reconstruction`` fit closed-form forecasters, and ``method`` says which one. The
    ``-infer`` names run a model: ``engine_model`` if it is given, or the weights of forecast_ckpt and reconstruct_ckpt with a spec, which are loaded before
    anything runs; without either they are an error. Where a series is too short or the model fails, the z-score answers, ``method`` says so, and the label ``fallback``
    has the failure. ``threshold`` is a policy for ratios. ``extra`` names further keys, as the start of a window (win_start); policies and regimes then go by it.
    """
    config = dict(config or {"type": "zscore"})
    config |= config.pop("params", None) or {}
    kind = config.pop("type", "zscore")
    if kind not in DETECTORS:
        raise ValueError(f"unknown detector {kind!r}, one of {', '.join(DETECTORS)}")
    keys, ids = ["group_id", "channel", *extra], ["entity_uid", "metric_name", *extra]
    named = lambda df: df.withColumnsRenamed({"group_id": "entity_uid", "channel": "metric_name"})
    series = lambda pts: ordered_series(pts, keys)
    context, horizon = config.get("context_length", 64), config.get("prediction_length", 8)
    if kind == "zscore":
        return lambda pts: named(detect.zscore(pts, keys, **config)).withColumn("method", F.lit("zscore"))
    if kind == "regime-switch":
        ahead = build_detector(config.get("forecast", {"type": "patch-forecast"}), engine_model, extra)
        back = build_detector(config.get("detective", {"type": "reconstruction"}), engine_model, extra)

        def both(pts: DataFrame) -> DataFrame:
            r = back(pts).select(*ids, F.col("severity").alias("recon_severity"), F.col("score").alias("recon_score"), F.col("method").alias("recon_method"))
            seq = F.col("win_start") if "win_start" in extra else F.lit(0).cast("long")
            ticks = ahead(pts).drop("labels").withColumnRenamed("severity", "forecast_severity").join(r, ids).withColumn("seq", seq)
            state = config.get("seed")
            if isinstance(state, str):  # the root of a signal history
                state = store.SignalStore(pts.sparkSession, state).latest()
            ticks = regime.seeded(ticks, state) if state is not None else ticks.withColumn("start_regime", F.lit("normal"))
            told = regime.switch(ticks, ["entity_uid", "metric_name"], enter_after=config.get("enter_after", 1), exit_after=config.get("exit_after", 1), seed="start_regime")
            out = told.join(ticks, ["entity_uid", "metric_name", "seq"])
            judged = F.col("mode") == "detective"
            labels = F.create_map(F.lit("mode"), F.col("mode"), F.lit("regime"), F.col("regime"))
            return out.select(*ids, "severity", F.when(judged, F.col("recon_score")).otherwise(F.col("score")).alias("score"), F.when(judged, F.col("recon_method")).otherwise(F.col("method")).alias("method"), "n_points", labels.alias("labels"))

        return both
    policy = build_threshold(config["threshold"]) if config.get("threshold") else None
    if policy is None and ("warning" in config or "critical" in config):
        policy = build_threshold({"type": "fixed", **{k: config[k] for k in ("warning", "critical") if k in config}})
    if kind.endswith("-infer"):
        if engine_model is None and not (config.get("forecast_ckpt") and config.get("reconstruct_ckpt") and config.get("spec")):
            raise ValueError(f"{kind} needs a model, or forecast_ckpt, reconstruct_ckpt and spec")
        face = "forecast" if kind.startswith("patch-forecast") else "reconstruct"
        made = [engine_model] if engine_model is not None else []

        def inferred(pts: DataFrame) -> DataFrame:
            if not made:  # once, whatever number of batches follows
                made.append(load_pair(pts.sparkSession, config["forecast_ckpt"], config["reconstruct_ckpt"], config["spec"]))
            errors = forecast.model_errors(series(pts), keys, made[0].spec, made[0], face)
            out = named(forecast.detect_by_error(pts, errors, keys, f"{face}-model", policy))
            none = F.create_map().cast("map<string,string>")
            return out.withColumn("labels", F.when(F.col("failure").isNotNull(), F.create_map(F.lit("fallback"), F.col("failure"))).otherwise(none)).drop("failure")

        return inferred
    if kind == "reconstruction":
        return lambda pts: named(forecast.detect_by_error(pts, forecast.reconstruction_errors(series(pts), keys, context, config.get("patch_length", 8)), keys, "reconstruction-ratio", policy))
    model = config.get("model", "nlinear")
    return lambda pts: named(forecast.detect_by_error(pts, forecast.window_errors(series(pts), keys, context, horizon, model), keys, f"forecast-ratio-{model}", policy))


def detection(points: DataFrame, detector=None, now_ms: int | None = None, entity_rollup: bool = False, rollup_policy: str = "max") -> DataFrame:
    """Signals of all series, and of their entities if asked."""
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    found = (detector or build_detector(None))(points)
    signals = as_signals(found, now_ms)
    if not entity_rollup:
        return signals
    return signals.unionByName(as_signals(detect.roll_up(signals, rollup_policy), now_ms))


def session(conf: dict | None = None, master: str | None = None) -> SparkSession:
    """A session with what the engine relies on; lists repeat as comma-separated values."""
    aliases = {"local": "local[*]", "direct": "local[*]", "yarn": "yarn", "k8s": "k8s"}
    builder = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        known = aliases.get(master, master)
        if known == master and ":" not in master and "[" not in master and master not in aliases:
            raise KeyError(f"unknown master {master!r}; known: {', '.join(aliases)}")
        builder = builder.master(known)
    return reduce(lambda b, kv: b.config(kv[0], ",".join(map(str, kv[1])) if isinstance(kv[1], list) else kv[1]), (conf or {}).items(), builder).getOrCreate()


def run_pipeline(config: dict, spark: SparkSession | None = None, now_ms: int | None = None, engine_model=None) -> dict:
    """Run a configuration: counts of rows in and records out. With ``engine.streaming`` it runs as a stream of windows (``run_streaming``)."""
    settings = config.get("engine") or {}
    spark = spark or session(settings.get("options"), settings.get("master"))
    if settings.get("streaming"):
        return run_streaming(config, spark, engine_model)
    source = dict(config["source"])
    seen, read = Observation(), build(source.pop("type"), **source).read(spark)
    points = read.observe(seen, F.count(F.lit(1)).alias("n"))
    sinks = _sinks(config)
    found = detection(points, build_detector(config.get("detector"), engine_model), now_ms, config.get("entity_rollup", False), config.get("rollup_policy", "max"))
    found = durable(found)
    rows.fan_out(found, [sink.write for sink in sinks])
    try:
        n_in = seen.get["n"]
    except Py4JJavaError:  # a plan that was seen to be empty has run without its source
        n_in = read.count()
    return {"rows_in": n_in, "records_out": found.count()}


def _sinks(config: dict) -> list:
    return [build((s := dict(x)).pop("type"), **s) for x in config.get("sinks", [])]


def run_streaming(config: dict, spark: SparkSession, engine_model=None) -> dict:
    """Sliding windows of a stream of points through the detector into the sinks; ends when all that is there has been read.

    ``engine.window`` holds the settings of a WindowSpec; ``engine.folder`` and ``engine.checkpoint`` are folders for replayed files and progress (in the
    shared folder unless given). A window that gets more points is judged again, and a batch that is tried again replaces what it had written. With early_every or late_every the panes that these
    counts fire go to ``engine.panes`` as well.
    """
    settings = config.get("engine") or {}
    spec = engine.WindowSpec(**(settings.get("window") or {}))
    base = settings.get("folder") or f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    source = dict(config["source"])
    points = build(source.pop("type"), **source).read_stream(spark, *([] if config["source"]["type"] == "points" else [f"{base}/points"]))
    sinks, out = _sinks(config), {"rows_in": 0, "records_out": 0, "batches": 0}
    judge = build_detector(config.get("detector"), engine_model, ("win_start",))

    def write(df: DataFrame, batch_id: int) -> None:
        windows = durable(df)
        points_of = windows.select("group_id", "channel", "win_start", F.explode("pts").alias("p")).select("group_id", "channel", "win_start", "p.ts_ms", "p.value")
        found = judge(points_of).withColumn("ts", F.col("win_start") + spec.size_s * 1000)
        signals = as_signals(found, F.col("ts"))
        if config.get("entity_rollup"):
            for_each = detect.roll_up(signals.withColumn("entity_uid", F.concat_ws("\x1f", "entity_uid", F.col("ts").cast("string"))), config.get("rollup_policy", "max"))
            parts = F.split("entity_uid", "\x1f")
            up = for_each.withColumn("ts", parts[1].cast("long")).withColumn("entity_uid", parts[0])
            signals = signals.unionByName(as_signals(up, F.col("ts")))
        signals = durable(signals)
        for sink in sinks:
            sink.write_batch(signals, f"stream-{batch_id}")
        out["records_out"] += signals.count()
        out["batches"] += 1

    query = engine.run_stream(engine.windowed_points(points, spec), write, f"{settings.get('checkpoint') or base + '/progress'}", "update")
    query.awaitTermination()
    out["rows_in"] = sum(p.numInputRows for p in query.recentProgress)
    if (spec.early_every or spec.late_every) and settings.get("panes"):
        panes = engine.counted_panes(engine.replay(spark, config["source"]["path"] if config["source"]["type"] == "points" else f"{base}/points"), spec)

        def keep(df: DataFrame, batch_id: int) -> None:
            df.write.mode("overwrite").parquet(f"{settings['panes']}/batch-{batch_id}")

        engine.run_stream(panes, keep, f"{settings.get('checkpoint') or base}/panes", "append").awaitTermination()
    return out
