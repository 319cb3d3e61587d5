"""Sources, sinks, history, configuration, streaming and the model pass."""

from __future__ import annotations

import json
import struct
import threading
import time
import urllib.request

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronosift import registry
from chronosift.functions import calendar
from chronosift.functions import series as S
from chronosift.operators import forecast, metrics, windows
from chronosift.plans import pipeline
from chronosift.sinks import remote_write, rows, store
from chronosift.sources import files
from chronosift.streaming import engine

POINTS = "group_id string, channel string, ts_ms long, value double"
SIG = "entity_uid string, metric_name string, ts long, severity string, score double, method string, horizon string, n_points long, labels map<string,string>, text string"


def csv(spark, tmp_path, text, **kw):
    path = tmp_path / "x.csv"
    path.write_text(text)
    return sorted((r.channel, r.ts_ms, r.value) for r in files.csv_points(spark, str(path), "node", **kw).collect())


def test_wide_csv(spark, tmp_path):
    basic = csv(spark, tmp_path, "date,a,b\n2016-07-01 00:00:00,1.0,2.0\n2016-07-01 01:00:00,3.0,4.0\n", prefix="ett_")
    assert [x[0] for x in basic] == ["ett_a", "ett_a", "ett_b", "ett_b"] and basic[0][1] == 1467331200000
    assert [x[1] for x in csv(spark, tmp_path, "ts,v\n1467331200,5.0\n1467331200000,6.0\n")] == [1467331200000] * 2
    assert csv(spark, tmp_path, "ts,v\n1000,\n2000,7.0\n") == [("v", 2000000, 7.0)]
    assert csv(spark, tmp_path, "v,when\n1.0,1000\n", ts_col="when") == [("v", 1000000, 1.0)]
    assert [x[1] for x in csv(spark, tmp_path, "ts,v\n1000,1.0\n2000,2.0\n", now_ms=10**12)] == [10**12 - 10**6, 10**12]


def test_delimited(spark, tmp_path):
    path = tmp_path / "e.csv"
    path.write_text("t;a;b\n2011-01-01;1,5;2\n")
    assert tuple(files.delimited(spark, str(path)).first())[1:] == (1.5, 2.0)
    flat = tmp_path / "f.csv"
    flat.write_text("app,z1,5,2.5\n")
    assert tuple(files.headerless(spark, str(flat), "app_name string, zone string, time long, value double").first()) == ("app", "z1", 5, 2.5)


MATRIX = {"status": "success", "data": {"result": [{"metric": {"__name__": "cpu", "instance": "pod-a"}, "values": [[0, "1.0"], [15, "1.1"]]}, {"metric": {"__name__": "mem", "instance": "pod-a"}, "values": [[0, "5.0"], [15, "5.5"]]}]}}


def test_range_source(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(json.dumps(MATRIX))
    source = pipeline.RangeQuerySource(0, 15, file=str(path))
    registry.check_source(source, spark)
    got = sorted((r.channel, r.ts_ms, r.value) for r in source.read(spark).collect())
    assert got == [("cpu", 0, 1.0), ("cpu", 15000, 1.1), ("mem", 0, 5.0), ("mem", 15000, 5.5)]
    spans = files.RangeReader({"start": "0", "end": "100", "step": "15", "partitions": "3"}).partitions()
    assert [(s.start, s.end) for s in spans] == [(0, 30), (45, 75), (90, 90)]


def test_range_query_over_http():
    seen = {}

    class Answer:
        def __init__(self, body):
            self.body = body

        def read(self):
            return json.dumps(self.body).encode()

        def __enter__(self):
            return self

        def __exit__(self, *a):
            return False

    def get(request, timeout):
        seen.update(url=request.full_url, tenant=request.get_header("X-scope-orgid"))
        return Answer(MATRIX)

    assert len(files.query_range("http://x/", "up", 0, 15, 15, "t1", open_url=get)) == 2
    assert "query_range?query=up&start=0" in seen["url"] and seen["tenant"] == "t1"
    with pytest.raises(RuntimeError, match="failed"):
        files.query_range("http://x", "up", 0, 1, 1, open_url=lambda *a, **k: Answer({"status": "error"}))


def test_missing_labels(spark):
    df = spark.createDataFrame([({"job": "x"}, [(1.5, "2")])], files.MATRIX)
    assert files.flatten_matrix(df).select("group_id", "channel", "ts_ms", "value").first()[:] == ("default", "value", 1500, 2.0)
    assert files.flatten_matrix(df, ["a", "b"]).first().group_id == "/"


# ---- remote write: an independent decoder


def unvarint(b, at):
    n = s = 0
    while True:
        n |= (b[at] & 0x7F) << s
        s, at = s + 7, at + 1
        if not b[at - 1] & 0x80:
            return n, at


def fields(b):
    at = 0
    while at < len(b):
        tag, at = unvarint(b, at)
        if tag & 7 == 2:
            n, at = unvarint(b, at)
            yield tag >> 3, b[at : at + n]
            at += n
        elif tag & 7 == 1:
            yield tag >> 3, struct.unpack("<d", b[at : at + 8])[0]
            at += 8
        else:
            n, at = unvarint(b, at)
            yield tag >> 3, n - (1 << 64) if n >> 63 else n


def decode(b):
    out = []
    for _, s in fields(b):
        labels = [tuple(v.decode() for _, v in fields(x)) for n, x in fields(s) if n == 1]
        out.append((labels, [tuple(v for _, v in fields(x))[::-1] for n, x in fields(s) if n == 2]))
    return out


def test_remote_write_round_trip():
    got = decode(remote_write.encode_request([({"zzz": "1", "__name__": "cpu", "aaa": "2"}, [(1000, 1.5), (-5, 2.5)]), ({"__name__": "no"}, [])]))
    assert got == [([("__name__", "cpu"), ("aaa", "2"), ("zzz", "1")], [(1000, 1.5), (-5, 2.5)])]
    assert remote_write.encode_request([]) == b""
    with pytest.raises(ValueError, match="__name__"):
        remote_write.encode_series({"a": "b"}, [(1, 1.0)])


def test_chunks():
    sizes = lambda c: [sum(len(s) for _, s in x) for x in c]
    assert sizes(remote_write.chunks([({"n": "a"}, [0] * 10)], 4)) == [4, 4, 2]
    assert sizes(remote_write.chunks([({}, [0] * 3), ({}, [0] * 3), ({}, [0] * 1)], 4)) == [3, 4]
    assert remote_write.chunks([({}, [])], 4) == []


def test_push(spark):
    df = spark.createDataFrame([({"__name__": f"m{i}"}, [(t, 1.0) for t in range(7)]) for i in range(3)], "labels map<string,string>, samples array<struct<ts_ms long, value double>>")
    assert remote_write.push(df, "http://nowhere", dry_run=True) == 21
    got = remote_write.requests(df, 5, 1).collect()
    assert sum(r.n_samples for r in got) == 21 and max(r.n_samples for r in got) <= 5
    raw = pa.Codec("snappy")
    n, _ = unvarint(bytes(got[0].body), 0)
    assert decode(raw.decompress(bytes(got[0].body), n, asbytes=True))
    assert sum(len(r.samples) for r in remote_write.pieces(df, 3).collect()) == 21


def test_long_series_in_pieces(spark):
    """A series of any length goes in pieces of bounded size, in order of time; all samples come back."""
    shape = "group_id string, channel string, ts_ms long, value double, labels map<string,string>"
    data = [("g", c, (i * 37) % 1003, float(i), {"__name__": c, "instance": "g"}) for c, n in (("a", 1003), ("b", 12), ("c", 1)) for i in range(n)]
    points = spark.createDataFrame(data, shape).repartition(4)
    found = [(r.labels["__name__"], [(s.ts_ms, s.value) for s in r.samples]) for r in remote_write.to_pieces(points, 50).collect()]
    assert max(len(x) for _, x in found) <= 50
    for c in "abc":
        own = sorted(x for name, x in found if name == c)
        assert [s for x in own for s in x] == sorted((t, v) for _, name, t, v, _ in data if name == c)
    sent = remote_write.requests(remote_write.to_pieces(points, 50), 50, partitions=None)
    assert max(r.n_samples for r in sent.collect()) <= 50
    back = [(r.labels, r.ts_ms, r.value) for r in remote_write.received(sent).collect()]
    assert sorted((x["__name__"], x["instance"], t, v) for x, t, v in back) == sorted((c, "g", t, v) for _, c, t, v, _ in data)
    one = spark.createDataFrame([({"__name__": "a"}, [(t, 1.0)]) for t in (5, 1, 9, 3)], "labels map<string,string>, samples array<struct<ts_ms long, value double>>").repartition(3)
    assert [r.ts_ms for r in remote_write.received(remote_write.requests(one, 1, 2, in_order=True)).collect()] == [1, 3, 5, 9]
    assert remote_write.received(remote_write.requests(remote_write.to_pieces(points.where("false")), partitions=None)).count() == 0


# ---- store


def signal(ts, metric="cpu", entity="e", **labels):
    return (entity, metric, ts, "normal", 1.0, "zscore", "", 1, labels, "")


def test_store(spark, tmp_path):
    s = store.SignalStore(spark, str(tmp_path / "kb"))
    assert s.read().count() == 0 and not s.write(spark.createDataFrame([], SIG))
    s.write(spark.createDataFrame([signal(9000), signal(1000), signal(5000, k="v"), signal(5000, "mem")], SIG))
    s.write(spark.createDataFrame([signal(7000, entity="other")], SIG))
    assert [r.ts for r in s.query("e", "cpu", 2000, 8000).collect()] == [5000]
    assert [r.ts for r in s.query("e", limit=2).collect()] == [1000, 5000]
    assert s.query("e", "cpu", 5000, 5000).first().labels == {"k": "v"}
    assert s.latest("e", "cpu").first().ts == 9000
    plan = s.query("e", "cpu", 2000)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(entity_uid)" in plan and "EqualTo(entity_uid,e)" in plan
    s.compact(str(tmp_path / "kb2"), 1)
    assert store.SignalStore(spark, str(tmp_path / "kb2")).read().count() == 5
    with pytest.raises(ValueError, match="limit"):
        store.signal_history(spark, s.root, "e", limit=0)


def test_history_over_http(spark, tmp_path):
    s = store.SignalStore(spark, str(tmp_path / "kb"))
    s.write(spark.createDataFrame([signal(1000), signal(2000)], SIG))
    server = store.serve(spark, s.root, port=0)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        base = f"http://127.0.0.1:{server.server_port}"
        with urllib.request.urlopen(f"{base}/health") as a:
            assert json.load(a) == {"status": "ok"}
        with urllib.request.urlopen(f"{base}/api/v1/signals/history?entity=e&since=1500") as a:
            body = json.load(a)
        assert body["count"] == 1 and body["signals"][0]["ts"] == 2000
        with pytest.raises(urllib.error.HTTPError):
            urllib.request.urlopen(f"{base}/api/v1/signals/history?limit=1")
    finally:
        server.shutdown()


# ---- registry, configuration, end to end


def test_registry():
    assert registry.available()["signal-store"] == "sink" and registry.available()["synthetic"] == "source"
    with pytest.raises(KeyError, match="available"):
        registry.build("nope")
    with pytest.raises(ValueError, match="taken"):
        registry.connector("synthetic")(pipeline.SyntheticSource)
    with pytest.raises(TypeError):
        registry.connector("x")(int)


def test_pipeline_end_to_end(spark, tmp_path):
    config = {"source": {"type": "synthetic", "group_ids": ["a", "b"], "channels": ["cpu", "mem"], "n_points": 60, "base": 1.0, "slope": 0.001, "anomaly_at": 59}, "detector": {"type": "zscore"}, "entity_rollup": True, "sinks": [{"type": "signal-store", "root": str(tmp_path / "kb")}]}
    path = tmp_path / "c.json"
    path.write_text(json.dumps(config))
    assert pipeline.run_pipeline(pipeline.load_config(str(path)), spark, 123) == {"rows_in": 240, "records_out": 6}
    got = store.SignalStore(spark, str(tmp_path / "kb")).query("a").collect()
    assert {r.metric_name for r in got} == {"cpu", "mem", "__entity__"} and {r.severity for r in got} == {"critical"} and {r.ts for r in got} == {123}


@pytest.mark.parametrize("kind", ["patch-forecast", "reconstruction", "regime-switch"])
def test_model_detectors(spark, kind):
    pts = files.synthetic(spark, ["a"], ["cpu"], 120, anomaly_at=119).unionByName(files.synthetic(spark, ["short"], ["cpu"], 10))
    config = {"type": kind, "context_length": 16, "prediction_length": 4, "patch_length": 4, "model": "naive"}
    if kind == "regime-switch":
        config = {"type": kind, "forecast": {**config, "type": "patch-forecast"}, "detective": {**config, "type": "reconstruction"}}
    got = {r.entity_uid: r for r in pipeline.build_detector(config)(pts).collect()}
    assert got["a"].severity == "critical" and got["a"].method != "zscore" and got["short"].method == "zscore"


def test_bad_configurations():
    with pytest.raises(ValueError, match="unknown detector"):
        pipeline.build_detector({"type": "magic"})
    with pytest.raises(ValueError, match="unknown threshold"):
        pipeline.build_threshold({"type": "magic"})
    with pytest.raises(KeyError, match="unknown master"):
        pipeline.session(master="spark")


def test_row_sink_and_fan_out(spark, tmp_path):
    df = spark.createDataFrame([("g", 1, ["a"], [1.0], {"b": "2", "a": "1"})], "group_id string, ts_ms long, channels array<string>, values array<double>, labels map<string,string>")
    rows.fan_out(df, [lambda d: rows.write_rows(d, str(tmp_path / "x")), lambda d: rows.write_rows(d, str(tmp_path / "y"), 2)])
    assert spark.read.parquet(str(tmp_path / "x")).first().labels == '{"a":"1","b":"2"}'


# ---- streaming


def write_points(spark, tmp_path, batches):
    for i, b in enumerate(batches):
        spark.createDataFrame(b, POINTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        if i + 1 < len(batches):
            time.sleep(1.1)  # files are replayed in the order of their times


def emitted(spark, tmp_path, spec, mode="update"):
    out = []
    df = engine.windowed_zscore(engine.replay(spark, str(tmp_path / "in")), spec)
    engine.run_stream(df, lambda d, i: out.extend((i, *r) for r in d.select("win_start", "n_points").collect()), str(tmp_path / "cp"), mode).awaitTermination()
    return out


def test_streaming_windows_and_late_data(spark, tmp_path):
    base = [("g", "c", i * 15_000, float(i)) for i in range(8)]
    late = [("g", "c", 30_000, 2.0)]
    write_points(spark, tmp_path, [[p for p in base if p not in [("g", "c", 30_000, 2.0)]], [("g", "c", 600_000, 1.0)], late])
    gated = emitted(spark, tmp_path, engine.WindowSpec(60, 30))
    assert len({w for _, w, _ in gated}) == 7 and not [x for x in gated if x[0] == 2 and x[1] < 60_000]
    (tmp_path / "cp").rename(tmp_path / "cp-old")
    admitted = emitted(spark, tmp_path, engine.WindowSpec(60, 30, lateness_s=3600))
    assert len(admitted) > len(gated) and (2, 0, 4) in admitted


def test_batch_windows_equal_streaming_windows(spark):
    pts = files.synthetic(spark, ["g"], ["c"], 40, slope=0.5, anomaly_at=20)
    got = engine.windowed_zscore(pts, engine.WindowSpec(300, 60), streaming=False).select(F.col("win_start"), "n_points", "score").collect()
    plain = windows.sliding(pts.withColumn("ts_s", F.floor(F.col("ts_ms") / 1000)), ["group_id"], "ts_s", 300, 60)
    from chronosift.operators.detect import zscore

    want = zscore(plain, ["win_start"]).collect()
    assert sorted((r.win_start, r.n_points, r.score) for r in got) == sorted((r.win_start * 1000, r.n_points, r.score) for r in want)


def collect_stream(df, tmp_path, name):
    out = []
    engine.run_stream(df, lambda d, i: out.extend(d.collect()), str(tmp_path / name), "append").awaitTermination()
    return out


def test_counted_panes(spark, tmp_path):
    write_points(spark, tmp_path, [[("g", "c", 60_000 + i * 10_000, 1.0) for i in range(6)], [("g", "c", 500_000, 1.0)]])
    keep = collect_stream(engine.counted_panes(engine.replay(spark, str(tmp_path / "in")), engine.WindowSpec(60, 60, early_every=2)), tmp_path, "a")
    assert [r.n for r in sorted(keep, key=lambda r: r.pane) if r.win_start == 60_000 and r.kind == "early"] == [2, 4, 6]
    shed = collect_stream(engine.counted_panes(engine.replay(spark, str(tmp_path / "in")), engine.WindowSpec(60, 60, early_every=2, accumulating=False)), tmp_path, "b")
    assert [r.n for r in shed if r.win_start == 60_000] == [2, 2, 2]


def test_streaming_state_machines(spark, tmp_path):
    ticks = [("e", "m", i, f, r) for i, (f, r) in enumerate(zip(["critical", "critical", "x", "x"], ["x", "x", "normal", "normal"], strict=True))]
    schema = "entity_uid string, metric_name string, seq long, forecast_severity string, recon_severity string"
    for part in (ticks[:2], ticks[2:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
        time.sleep(1.1)
    got = collect_stream(engine.streaming_regime(engine.replay(spark, str(tmp_path / "t"), schema), 2, 2), tmp_path, "r")
    assert [r.regime for r in sorted(got, key=lambda r: r.seq)] == ["normal", "incident", "incident", "normal"]
    scores = "entity_uid string, metric_name string, seq long, score double"
    spark.createDataFrame([("e", "m", i, 1.0 + i % 3 / 10) for i in range(20)] + [("e", "m", 20, 9.0)], scores).coalesce(1).write.parquet(str(tmp_path / "s"))
    got = collect_stream(engine.streaming_quantile(engine.replay(spark, str(tmp_path / "s"), scores)), tmp_path, "q")
    assert sorted(got, key=lambda r: r.seq)[-1].severity == "critical"


def test_window_spec():
    assert engine.WindowSpec(60, 60).tumbling
    for bad in ({"size_s": 0}, {"period_s": 1.5}, {"lateness_s": -1}, {"early_every": 0}):
        with pytest.raises(ValueError):
            engine.WindowSpec(**bad)


# ---- functions and models


def test_array_functions(spark):
    df = spark.createDataFrame([([1.0, 2.0, 6.0, 3.0, 5.0],)], "v array<double>")
    one = lambda c: df.select(c.alias("x")).first().x
    assert one(S.patches(F.col("v"), 2, 2)) == [[2.0, 6.0], [3.0, 5.0]]
    assert one(S.padded_patches(F.col("v"), 3, 2))[-1] == [5.0, 5.0, 5.0]
    assert np.allclose(one(S.moving_average(F.col("v"), 3)), [4 / 3, 3, 11 / 3, 14 / 3, 13 / 3])
    assert one(S.windows(F.col("v"), 3, 2)) == [[1.0, 2.0, 6.0], [6.0, 3.0, 5.0]]
    assert one(S.windows(F.col("v"), 9)) == []
    assert one(S.roll(F.col("v"), 2)) == [6.0, 3.0, 5.0, 1.0, 2.0]
    x = np.array([1.0, 2, 6, 3, 5])
    assert np.allclose(one(S.autocorrelation("v")), [np.dot(x, np.roll(x, k)) / 5 for k in range(5)])
    assert np.allclose(one(S.amplitudes("v")), np.abs(np.fft.rfft(x)))
    assert one(S.top_delays(S.autocorrelation("v")))[0] == 0
    assert S.frequency_modes(10, 3) == [0, 1, 2] and len(S.frequency_modes(10, 3, "random", 1)) == 3


def test_resample_is_right_closed(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 2.0), ("a", 3600, 4.0), ("a", 10801, 8.0)], "k string, ts_s long, value double")
    got = sorted((r.bucket, r.value) for r in windows.resample_sum(df, ["k"]).collect())
    assert got == [(-3600, 1.0), (0, 6.0), (3600, 0.0), (7200, 0.0), (10800, 8.0)]


def test_corr_is_not_pearson(spark):
    rng = np.random.default_rng(0)
    t, p = rng.normal(size=(6, 4)), rng.normal(size=(6, 4))
    u = ((t - t.mean(0)) * (p - p.mean(0))).sum(0)
    d = np.sqrt(((t - t.mean(0)) ** 2 * (p - p.mean(0)) ** 2).sum(0)) + 1e-12
    rows_ = [("k", j, float(p[i, j]), float(t[i, j])) for i in range(6) for j in range(4)]
    got = metrics.corr(spark.createDataFrame(rows_, "k string, cell int, pred double, true double"), ["k"], "cell").first()["corr"]
    assert abs(got - 0.01 * (u / d).mean()) < 1e-9


def test_unknown_frequency(spark):
    with pytest.raises(RuntimeError, match="unsupported"):
        calendar.encoded(F.col("ts"), "fortnight")
    assert list(calendar.encoded(F.col("ts"), "15min")) == calendar.FREQUENCIES["t"]


def test_linear_forecasters():
    t = np.arange(200.0)
    train = np.array([t[i : i + 12] for i in range(100)])
    future = np.array([t[i + 12 : i + 15] for i in range(100)])
    last = t[None, 150:162]
    for kind in ("linear", "nlinear", "dlinear"):
        assert np.allclose(forecast.linear_forecast(train, future, last, kind, alpha=1e-6), [[162, 163, 164]], atol=0.05), kind
    assert (forecast.linear_forecast(train, future, last, "naive") == 161).all()
    assert forecast.linear_forecast(train, future, last, "trees").shape == (1, 3)
    with pytest.raises(ValueError, match="unknown forecaster"):
        forecast.linear_forecast(train, future, last, "oracle")


def test_patch_transformer(spark, tmp_path):
    spec = forecast.ModelSpec.from_dict({"n_channels": 3, "context_length": 16, "horizon": 4, "patch_length": 4, "stride": 4, "d_model": 8, "n_heads": 2, "n_layers": 1, "d_ff": 16, "surplus": 1})
    weights = forecast.random_weights(spec)
    model = forecast.PatchTransformer(spec, weights)
    x = np.random.default_rng(0).normal(size=(5, 16, 3))
    assert model.forecast(x).shape == (5, 4, 3) and model.forecast(x[0]).shape == (1, 4, 3)
    rebuilt, error = model.reconstruct(x)
    assert rebuilt.shape == (5, 4, 3, 4) and error.shape == (5, 3)
    assert np.allclose(model.forecast(x * 3 + 7), model.forecast(x) * 3 + 7, atol=1e-3)
    for bad in (x[:, :10], x[:, :, :2], x[0, 0]):
        with pytest.raises(ValueError, match="expected"):
            model.forecast(bad)
    path = str(tmp_path / "w.npz")
    forecast.save_model(path, weights)
    df = spark.createDataFrame([(i, [float(v) for v in w.ravel()]) for i, w in enumerate(x)], "id long, window array<double>")
    a = {r.id: r.forecast for r in forecast.infer(df, spec, path).collect()}
    b = {r.id: r.forecast for r in forecast.infer(df, spec, weights).collect()}
    assert all(np.allclose(a[i], model.forecast(x[i]).ravel()) and a[i] == b[i] for i in a)
    other = forecast.transfer(weights, forecast.random_weights(spec, 9))
    assert (other["pos"] == weights["pos"]).all() and not (other["forecast.w"] == weights["forecast.w"]).all()


def test_fractional_noise_has_its_variance():
    x = files.fractional_noise(400, 0.7)
    assert 0.5 < x.std() < 1.6


def test_weighted_sample(spark):
    df = spark.createDataFrame([(f"k{i:03d}", float(i % 10)) for i in range(200)], "key string, w double")
    got = windows.sample_with_replacement(df, 4000, F.col("w"), 5, "key")
    counts = {r.w: r["count"] for r in got.groupBy("w").count().collect()}
    assert got.count() == 4000 and 0.0 not in counts
    assert all(abs(counts[float(d)] / 4000 - d / 45) < 0.03 for d in range(1, 10))


def test_training_helpers():
    from chronosift.functions import training

    assert training.learning_rate(3, 0.1) == 0.025 and training.learning_rate(5, 0.1, "constant") == 0.1
    assert training.learning_rate(10, 1.0, "cut-at-10") == 0.1 and training.learning_rate(9, 1.0, "cut-at-10") == 1.0
    assert training.learning_rate(30, 1.0, "one-cycle") == 1.0 and training.learning_rate(100, 1.0, "one-cycle") < 1e-9
    assert training.learning_rate(2, 1.0, "hold-decay") == 1.0 and training.learning_rate(9, 1.0, "step") == 1e-6
    with pytest.raises(ValueError, match="unknown schedule"):
        training.learning_rate(1, 1.0, "magic")
    assert training.steepest_descent([1, 2, 3, 4, 5, 6], [9, 8, 8.5, 6, 4, 7]) == 3


def test_archives_arrays_and_seed(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.csv", "a,1\nb,2\n")
        z.writestr("note.txt", "no")
    got = [(r.member, r.line_no, r.line) for r in files.zipped_lines(spark, str(tmp_path / "a.zip")).collect()]
    assert got == [("x.csv", 0, "a,1"), ("x.csv", 1, "b,2")]
    np.save(tmp_path / "x.npy", np.arange(12.0).reshape(3, 2, 2))
    rows_ = sorted((r.row, list(r["values"])) for r in files.npy_rows(spark, str(tmp_path / "x.npy")).collect())
    assert rows_[2] == (2, [8.0, 9.0, 10.0, 11.0])
    files.seed_csv(str(tmp_path / "seed.csv"))
    points = files.csv_points(spark, str(tmp_path / "seed.csv"), "n1")
    found = {r.metric_name: r.severity for r in pipeline.build_detector(None)(points).collect()}
    assert points.count() == 120 and set(found) == {"cpu", "mem"}
