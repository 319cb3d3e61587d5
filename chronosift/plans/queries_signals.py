"""Queries of the operational layer: alignment, detection, thresholds, regimes, roll-up, history, windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronosift.functions import series
from chronosift.operators import align, detect, forecast, regime, threshold, windows
from chronosift.plans.base import DAY, POINTS, SIGNALS, TICKS, Registry, points, r6, signals, table, ticks
from chronosift.schema import as_signals, labels_json, merge_labels, pivot_problem, quarantine, severity_rank, signal_problem
from chronosift.sinks import remote_write, rows, store

Q = Registry()

_Z = """, r AS (SELECT *, row_number() OVER (PARTITION BY group_id, channel ORDER BY ts_ms DESC, value DESC) AS rn, count(*) OVER w AS n,
  avg(value) OVER w AS mu, stddev_pop(value) OVER w AS sd FROM p WINDOW w AS (PARTITION BY group_id, channel)),
z AS (SELECT group_id, channel, max(n) AS n_points, max(CASE WHEN n >= 8 AND sd >= 1e-8 THEN abs(value - mu) / sd ELSE 0 END) AS raw
  FROM r WHERE rn <= greatest(1, floor(n * 0.25)) GROUP BY ALL),
zs AS (SELECT group_id, channel, n_points, round(raw, 4) AS score, CASE WHEN raw >= 4.5 THEN 'critical' WHEN raw >= 3.0 THEN 'warning' ELSE 'normal' END AS severity FROM z)"""


@Q("ag2_zscore", f"WITH {POINTS}{_Z} SELECT * FROM zs")
def _(spark, sf):
    return detect.zscore(points(spark, sf), ["group_id", "channel"])


@Q("ag3_severity", f"WITH {TICKS} SELECT severity, count(*) AS n FROM (SELECT CASE WHEN score >= 2 THEN 'critical' WHEN score >= 1 THEN 'warning' ELSE 'normal' END AS severity FROM ticks) GROUP BY 1")
def _(spark, sf):
    return threshold.fixed(ticks(spark, sf), 1.0, 2.0).groupBy("severity").agg(F.count("*").alias("n"))


@Q("ag7_detect_with_rollup", f"""WITH {POINTS}{_Z}, up AS (SELECT group_id, max(n_points) AS n_points, round(max(score), 4) AS score,
 arg_min(severity, (CASE severity WHEN 'critical' THEN -2 WHEN 'warning' THEN -1 ELSE 0 END, -score, channel)) AS severity FROM zs GROUP BY 1)
 SELECT group_id AS entity_uid, channel AS metric_name, severity, score, 'zscore' AS method, n_points FROM zs
 UNION ALL SELECT group_id, '__entity__', severity, score, 'aggregate', n_points FROM up""")
def _(spark, sf):
    found = as_signals(detect.channel_signals(points(spark, sf)), 0)
    both = found.unionByName(as_signals(detect.roll_up(found), 0))
    return both.select("entity_uid", "metric_name", "severity", "score", "method", "n_points")


def _rollup(policy: str, sql: str):
    @Q(f"ag4_rollup_{policy}", f"""WITH {SIGNALS} SELECT entity_uid, round({sql}, 4) AS score, max(n_points) AS n_points, CAST(count(*) AS VARCHAR) AS n_channels,
 CAST(count(*) FILTER (severity <> 'normal') AS VARCHAR) AS n_anomalous,
 arg_min(metric_name, (CASE severity WHEN 'critical' THEN -2 WHEN 'warning' THEN -1 ELSE 0 END, -score, metric_name)) AS top_channel,
 arg_min(severity, (CASE severity WHEN 'critical' THEN -2 WHEN 'warning' THEN -1 ELSE 0 END, -score, metric_name)) AS severity FROM signals GROUP BY 1""")
    def _(spark, sf):
        up = detect.roll_up(signals(spark, sf), policy)
        return up.select("entity_uid", "score", "n_points", *[F.col("labels")[k].alias(k) for k in ("n_channels", "n_anomalous", "top_channel")], "severity")


_rollup("max", "max(score)")
_rollup("mean", "avg(score)")
_rollup("l2", "sqrt(sum(score * score))")


@Q("ag6_rollup_again", f"WITH {SIGNALS} SELECT entity_uid, round(max(score), 4) AS score FROM signals GROUP BY 1")
def _(spark, sf):
    s = signals(spark, sf)
    first = detect.roll_up(s).select(*s.columns[:2], F.lit(0).cast("long").alias("ts"), "severity", "score", "method", "horizon", "n_points")
    return detect.roll_up(s.unionByName(first)).select("entity_uid", "score")


def _aligned(fill: str) -> str:
    value = {"zero": "coalesce(f, 0)"}.get(fill, "f")
    filled = "value" if fill == "drop_strict" else "last_value(value IGNORE NULLS) OVER (PARTITION BY group_id, channel ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    keep = "" if fill == "zero" else " WHERE missing = 0"
    return f""", b AS (SELECT group_id, channel, ts_ms - ts_ms % {DAY} AS bucket, arg_max(value, (ts_ms, value)) AS value FROM p GROUP BY ALL),
g AS (SELECT * FROM (SELECT DISTINCT group_id, bucket FROM b) JOIN (SELECT DISTINCT group_id, channel FROM b) USING (group_id)),
f AS (SELECT group_id, channel, bucket, {filled} AS f FROM g LEFT JOIN b USING (group_id, channel, bucket)),
m AS (SELECT *, count(*) FILTER (f IS NULL) OVER (PARTITION BY group_id, bucket) AS missing FROM f),
a AS (SELECT group_id, channel, bucket, {value} AS value FROM m{keep})"""


def _align(fill: str):
    @Q(f"al1_align_{fill}", f"WITH {POINTS}{_aligned(fill)} SELECT * FROM a")
    def _(spark, sf):
        return align.align_long(points(spark, sf), DAY, fill).select("group_id", "channel", "bucket", "value")


for _fill in align.FILLS:
    _align(_fill)


@Q("al2_snap_negative", "SELECT event_id, CAST(floor((event_id * 997 - 5000000) / 900.0) * 900 AS BIGINT) AS bucket FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", align.snap(F.col("event_id") * 997 - 5_000_000, 900).alias("bucket"))


@Q("al3_last_in_bucket", f"WITH {POINTS} SELECT group_id, channel, ts_ms - ts_ms % {DAY} AS bucket, arg_max(value, (ts_ms, value)) AS value FROM p GROUP BY ALL")
def _(spark, sf):
    return align.last_in_bucket(points(spark, sf), DAY)


@Q("al4_grid", f"WITH {POINTS}, b AS (SELECT DISTINCT group_id, channel, ts_ms - ts_ms % {DAY} AS bucket FROM p) SELECT group_id, count(DISTINCT bucket) * count(DISTINCT channel) AS cells FROM b GROUP BY 1")
def _(spark, sf):
    return align.grid(align.last_in_bucket(points(spark, sf), DAY)).groupBy("group_id").agg(F.count("*").alias("cells"))


@Q("al7_rows", f"WITH {POINTS}{_aligned('ffill')} SELECT group_id, bucket AS ts_ms, string_agg(channel, ',' ORDER BY channel) AS channels, count(*) AS width, round(sum(value), 6) AS total, round(arg_min(value, channel), 6) AS first_value FROM a GROUP BY 1, 2")
def _(spark, sf):
    rows_ = align.to_rows(align.align_long(points(spark, sf), DAY))
    total = F.aggregate("values", F.lit(0.0), lambda a, x: a + x)
    return rows_.select("group_id", "ts_ms", F.concat_ws(",", "channels").alias("channels"), F.size("channels").cast("long").alias("width"), r6(total).alias("total"), r6(F.get("values", F.lit(0))).alias("first_value"))


@Q("al8_first_labels", "SELECT CAST(user_id AS VARCHAR) AS group_id, arg_min(event_type, event_id) AS kind FROM events GROUP BY 1")
def _(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("group_id"), F.col("event_id").alias("ord"), F.create_map(F.lit("kind"), "event_type").alias("labels"))
    return align.first_labels(e).select("group_id", F.col("labels")["kind"].alias("kind"))


@Q("al9_points_of_rows", f"WITH {POINTS}{_aligned('zero')} SELECT group_id, channel, bucket AS ts_ms, value FROM a")
def _(spark, sf):
    return align.to_points(align.to_rows(align.align_long(points(spark, sf), DAY, "zero"))).select("group_id", "channel", "ts_ms", "value")


@Q("j2_as_of", f"""WITH {POINTS}, b AS (SELECT DISTINCT group_id, channel, ts_ms - ts_ms % {DAY} + {DAY // 2} AS at FROM p), d AS (SELECT group_id, channel, ts_ms, max(value) AS value FROM p GROUP BY ALL)
 SELECT b.group_id, b.channel, b.at AS ts_ms, d.value FROM b ASOF LEFT JOIN d ON b.group_id = d.group_id AND b.channel = d.channel AND b.at >= d.ts_ms""")
def _(spark, sf):
    p = points(spark, sf)
    probes = p.select("group_id", "channel", (align.snap(F.col("ts_ms"), DAY) + DAY // 2).alias("ts_ms")).distinct()
    return align.as_of(p, probes).select("group_id", "channel", "ts_ms", "value")


@Q("j3_labels_on_signals", f"WITH {SIGNALS}, c AS (SELECT CAST(c_custkey AS VARCHAR) AS entity_uid, c_mktsegment AS segment FROM customer) SELECT entity_uid, metric_name, ts, segment FROM signals LEFT JOIN c USING (entity_uid)")
def _(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("entity_uid"), F.col("c_mktsegment").alias("segment"))
    return detect.with_group_labels(signals(spark, sf), c).select("entity_uid", "metric_name", "ts", "segment")


@Q("w1_recent_tail", f"WITH {POINTS}, r AS (SELECT *, row_number() OVER (PARTITION BY group_id, channel ORDER BY ts_ms DESC, value DESC) AS rn, count(*) OVER (PARTITION BY group_id, channel) AS n FROM p) SELECT group_id, channel, count(*) AS n_tail, round(max(value), 6) AS top FROM r WHERE rn <= greatest(1, floor(n * 0.25)) GROUP BY 1, 2")
def _(spark, sf):
    return detect.recent_tail(points(spark, sf), ["group_id", "channel"]).groupBy("group_id", "channel").agg(F.count("*").alias("n_tail"), r6(F.max("value")).alias("top"))


@Q("w3_rolling_quantile", f"""WITH {TICKS}, c AS (SELECT group_id, channel, day, score, count(score) OVER w AS h, quantile_cont(score, 0.95) OVER w AS qw, quantile_cont(score, 0.99) OVER w AS qc FROM ticks
 WINDOW w AS (PARTITION BY group_id, channel ORDER BY day ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)), t AS (SELECT *, CASE WHEN h >= 4 THEN round(qw, 6) ELSE 1.8 END AS warn_cut, CASE WHEN h >= 4 THEN round(qc, 6) ELSE 3.0 END AS crit_cut FROM c)
 SELECT group_id, channel, day, warn_cut, crit_cut, CASE WHEN score > crit_cut + 1e-7 THEN 'critical' WHEN score > warn_cut + 1e-7 THEN 'warning' ELSE 'normal' END AS severity FROM t""")
def _(spark, sf):
    t = threshold.rolling_quantile(ticks(spark, sf), ["group_id", "channel"], ["day"], window=8, min_history=4)
    # scores are rounded, so quantiles can equal them: the compared result keeps away from last bits
    return t.select("group_id", "channel", "day", r6("warn_cut").alias("warn_cut"), r6("crit_cut").alias("crit_cut"), detect.cut_above(F.col("score"), r6("warn_cut") + 1e-7, r6("crit_cut") + 1e-7).alias("severity"))


@Q("w4_mad", f"""WITH {TICKS}, c AS (SELECT group_id, channel, day, score, list(score) OVER w AS past FROM ticks WINDOW w AS (PARTITION BY group_id, channel ORDER BY day ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)),
 m AS (SELECT *, coalesce(len(past), 0) AS h, list_median(past) AS mid FROM c), s AS (SELECT *, 1.4826 * list_median(list_transform(past, lambda x: abs(x - mid))) AS sp FROM m),
 t AS (SELECT *, CASE WHEN h >= 4 THEN round(mid + 3 * CASE WHEN sp > 0 THEN sp ELSE 1e-8 END, 10) ELSE 1.8 END AS warn_cut, CASE WHEN h >= 4 THEN round(mid + 5 * CASE WHEN sp > 0 THEN sp ELSE 1e-8 END, 10) ELSE 3.0 END AS crit_cut FROM s)
 SELECT group_id, channel, day, warn_cut, crit_cut, CASE WHEN score > crit_cut + 1e-7 THEN 'critical' WHEN score > warn_cut + 1e-7 THEN 'warning' ELSE 'normal' END AS severity FROM t""")
def _(spark, sf):
    t = threshold.mad(ticks(spark, sf), ["group_id", "channel"], ["day"], window=8, min_history=4)
    return t.select("group_id", "channel", "day", F.round("warn_cut", 10).alias("warn_cut"), F.round("crit_cut", 10).alias("crit_cut"), detect.cut_above(F.col("score"), F.round("warn_cut", 10) + 1e-7, F.round("crit_cut", 10) + 1e-7).alias("severity"))


@Q("w6_fixed_threshold", f"WITH {TICKS} SELECT group_id, channel, day, CASE WHEN score >= 3.0 THEN 'critical' WHEN score >= 1.8 THEN 'warning' ELSE 'normal' END AS severity FROM ticks")
def _(spark, sf):
    return threshold.fixed(ticks(spark, sf)).select("group_id", "channel", "day", "severity")


def _faces(spark, sf):
    s = F.col("score")
    return ticks(spark, sf).select("group_id", "channel", F.col("day").alias("seq"), F.when(s >= 1.2, "critical").when(s >= 0.9, "warning").otherwise("normal").alias("forecast_severity"), F.when(s < 0.6, "normal").otherwise("warning").alias("recon_severity"))


_REGIME = f"""WITH {TICKS}, t AS (SELECT group_id, channel, day AS seq, CASE WHEN score >= 1.2 THEN 'critical' WHEN score >= 0.9 THEN 'warning' ELSE 'normal' END AS fs, CASE WHEN score < 0.6 THEN 'normal' ELSE 'warning' END AS rs FROM ticks),
 b AS (SELECT *, CASE WHEN fs = 'critical' AND rs <> 'normal' THEN 1 WHEN fs <> 'critical' AND rs = 'normal' THEN 0 END AS st, sum(CASE WHEN fs = 'critical' AND rs = 'normal' THEN 1 ELSE 0 END) OVER w AS sw FROM t WINDOW w AS (PARTITION BY group_id, channel ORDER BY seq)),
 l AS (SELECT *, last_value(st IGNORE NULLS) OVER w AS s0, last_value(CASE WHEN st IS NOT NULL THEN sw END IGNORE NULLS) OVER w AS k0 FROM b WINDOW w AS (PARTITION BY group_id, channel ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
 f AS (SELECT *, (coalesce(s0, 0) + sw - coalesce(k0, 0)) % 2 AS state FROM l), pr AS (SELECT *, coalesce(lag(state) OVER (PARTITION BY group_id, channel ORDER BY seq), 0) AS prior FROM f)
 SELECT group_id, channel, seq, CASE WHEN prior = 1 THEN 'detective' ELSE 'anticipation' END AS mode, CASE WHEN state = 1 THEN 'incident' ELSE 'normal' END AS regime, CASE WHEN prior = 1 THEN rs ELSE fs END AS severity FROM pr"""


@Q("w7_regime_fold", _REGIME)
def _(spark, sf):
    return regime.switch(_faces(spark, sf), ["group_id", "channel"])


@Q("w7_regime_window", _REGIME)
def _(spark, sf):
    return regime.switch_by_window(_faces(spark, sf), ["group_id", "channel"])


_DEBOUNCED = f"""WITH RECURSIVE {TICKS}, t AS (SELECT group_id, channel, day AS seq, row_number() OVER (PARTITION BY group_id, channel ORDER BY day) AS i,
   CASE WHEN score >= 1.2 THEN 'critical' ELSE 'other' END AS fs, CASE WHEN score < 0.6 THEN 'normal' ELSE 'warning' END AS rs FROM ticks),
 h AS (SELECT group_id, channel, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS seq, 0 AS inc, 0 AS streak FROM t GROUP BY ALL
  UNION ALL SELECT t.group_id, t.channel, t.i, t.seq,
   CASE WHEN (CASE WHEN inc = 1 THEN rs = 'normal' ELSE fs = 'critical' END) AND streak + 1 >= (CASE WHEN inc = 1 THEN 3 ELSE 2 END) THEN 1 - inc ELSE inc END,
   CASE WHEN NOT (CASE WHEN inc = 1 THEN rs = 'normal' ELSE fs = 'critical' END) THEN 0 WHEN streak + 1 >= (CASE WHEN inc = 1 THEN 3 ELSE 2 END) THEN 0 ELSE streak + 1 END
  FROM h JOIN t ON t.group_id = h.group_id AND t.channel = h.channel AND t.i = h.i + 1)
 SELECT group_id, channel, seq, CASE WHEN inc = 1 THEN 'incident' ELSE 'normal' END AS regime FROM h WHERE i > 0"""


@Q("w7_regime_debounced", _DEBOUNCED)
def _(spark, sf):
    return regime.switch(_faces(spark, sf), ["group_id", "channel"], enter_after=2, exit_after=3).select("group_id", "channel", "seq", "regime")


@Q("w9_seeded_regime", f"WITH {SIGNALS}, l AS (SELECT entity_uid, metric_name, arg_max(severity, ts) AS sev FROM signals GROUP BY ALL) SELECT entity_uid, metric_name, CASE WHEN sev = 'critical' THEN 'incident' ELSE 'normal' END AS start_regime FROM l")
def _(spark, sf):
    s = signals(spark, sf)
    last = store.newest(s).withColumn("labels", F.create_map(F.lit("regime"), F.when(F.col("severity") == "critical", "incident").when(F.col("severity") == "warning", "unheard-of")))
    return regime.seeded(s.select("entity_uid", "metric_name").distinct(), last).select("entity_uid", "metric_name", "start_regime")


_SINCE, _UNTIL = 1_704_500_000_000, 1_705_900_000_000


@Q("pf2_history", f"WITH {SIGNALS} SELECT entity_uid, metric_name, ts, severity, score, n_points FROM signals WHERE entity_uid = '7' AND ts >= {_SINCE} AND ts <= {_UNTIL}")
def _(spark, sf):
    return store.history(signals(spark, sf), "7", None, _SINCE, _UNTIL).select("entity_uid", "metric_name", "ts", "severity", "score", "n_points")


@Q("st2_history_limit", f"WITH {SIGNALS} SELECT entity_uid, metric_name, ts, severity, score FROM signals WHERE entity_uid = '7' ORDER BY ts, metric_name LIMIT 10")
def _(spark, sf):
    return store.history(signals(spark, sf), "7", limit=10).select("entity_uid", "metric_name", "ts", "severity", "score")


@Q("w10_latest", f"WITH {SIGNALS} SELECT entity_uid, metric_name, max(ts) AS ts, arg_max(score, ts) AS score FROM signals GROUP BY ALL")
def _(spark, sf):
    return store.newest(signals(spark, sf)).select("entity_uid", "metric_name", "ts", "score")


@Q("pf7_without_rollups", f"WITH {SIGNALS} SELECT entity_uid, metric_name, ts, score FROM signals")
def _(spark, sf):
    s = signals(spark, sf)
    both = s.unionByName(detect.roll_up(s).select(*s.columns[:2], F.lit(0).cast("long").alias("ts"), "severity", "score", "method", "horizon", "n_points"))
    return detect.without_rollups(both).select("entity_uid", "metric_name", "ts", "score")


@Q("pf13_row_validation", "SELECT CASE WHEN user_id % 7 = 0 THEN 'empty group_id' WHEN user_id % 11 = 0 THEN 'values do not match channels' WHEN user_id % 13 = 0 THEN 'channels repeat' ELSE 'good' END AS problem, count(*) AS n FROM events GROUP BY 1")
def _(spark, sf):
    e = table(spark, sf, "events")
    u = F.col("user_id")
    r = e.select(F.when(u % 7 == 0, "").otherwise("g").alias("group_id"), F.lit(1).cast("long").alias("ts_ms"), F.when((u % 13 == 0) & (u % 11 != 0), F.array(F.lit("a"), F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b"))).alias("channels"), F.when(u % 11 == 0, F.array(F.lit(1.0))).otherwise(F.array(F.lit(1.0), F.lit(2.0))).alias("values"))
    good, bad = quarantine(r, pivot_problem())
    return good.select(F.lit("good").alias("problem")).unionByName(bad.select("problem")).groupBy("problem").agg(F.count("*").alias("n"))


@Q("pf13_signal_validation", f"WITH {SIGNALS} SELECT CASE WHEN n_points % 5 = 0 THEN 'empty entity_uid' WHEN n_points % 3 = 0 THEN 'unknown severity' WHEN score > 1.5 THEN 'unknown horizon' ELSE 'good' END AS problem, count(*) AS n FROM signals GROUP BY 1")
def _(spark, sf):
    n = F.col("n_points")
    s = signals(spark, sf).withColumns({"entity_uid": F.when(n % 5 == 0, "").otherwise(F.col("entity_uid")), "severity": F.when(n % 3 == 0, "odd").otherwise(F.col("severity")), "horizon": F.when(F.col("score") > 1.5, "never").otherwise("")})
    good, bad = quarantine(s, signal_problem())
    return good.select(F.lit("good").alias("problem")).unionByName(bad.select("problem")).groupBy("problem").agg(F.count("*").alias("n"))


@Q("pf14_anomalies", f"WITH {SIGNALS} SELECT entity_uid, metric_name, ts FROM signals WHERE severity <> 'normal'")
def _(spark, sf):
    return detect.anomalies(signals(spark, sf)).select("entity_uid", "metric_name", "ts")


@Q("pf15_short_series", f"WITH {POINTS}{_Z} SELECT group_id, channel, n_points, score FROM zs WHERE n_points < 8")
def _(spark, sf):
    return detect.zscore(points(spark, sf), ["group_id", "channel"]).where("n_points < 8").select("group_id", "channel", "n_points", "score")


@Q("f14_severity_rank", f"WITH {SIGNALS} SELECT CASE severity WHEN 'critical' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END AS rank, count(*) AS n FROM signals GROUP BY 1")
def _(spark, sf):
    return signals(spark, sf).groupBy(severity_rank(F.col("severity")).alias("rank")).agg(F.count("*").alias("n"))


@Q("f8_narrative", f"WITH {SIGNALS} SELECT 'signal metric=' || metric_name || ' entity=' || entity_uid || ' severity=' || severity || ' score=' || format('{{:.3f}}', score) || ' method=tick n=' || n_points AS text FROM signals")
def _(spark, sf):
    return as_signals(signals(spark, sf), 0).select("text")


@Q("f6_labels_json", "SELECT event_id, '{\"a\":\"' || event_type || '\",\"z\":\"' || user_id || '\"}' AS labels FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", labels_json(F.create_map(F.lit("z"), F.col("user_id").cast("string"), F.lit("a"), "event_type")).alias("labels"))


@Q("f7_label_merge", "SELECT event_id, 'new' AS mode, event_type AS kept FROM events")
def _(spark, sf):
    old, new = F.create_map(F.lit("mode"), F.lit("old"), F.lit("kept"), "event_type"), F.create_map(F.lit("mode"), F.lit("new"))
    m = table(spark, sf, "events").select("event_id", merge_labels(old, new).alias("m"))
    return m.select("event_id", F.col("m")["mode"].alias("mode"), F.col("m")["kept"].alias("kept"))


@Q("snk3_as_record", f"WITH {POINTS}{_aligned('ffill')} SELECT group_id, bucket AS ts, string_agg(channel, ',' ORDER BY channel) AS channels, '{{}}' AS labels FROM a GROUP BY 1, 2")
def _(spark, sf):
    return rows.as_record(align.to_rows(align.align_long(points(spark, sf), DAY))).select("group_id", "ts", F.concat_ws(",", "channels").alias("channels"), "labels")


def _series(spark, sf):
    p = points(spark, sf).withColumn("labels", F.create_map(F.lit("__name__"), "channel", F.lit("instance"), "group_id"))
    return remote_write.to_series(p)


@Q("snk6_samples", f"WITH {POINTS} SELECT group_id, channel, count(*) AS n_samples FROM p GROUP BY ALL")
def _(spark, sf):
    s = _series(spark, sf)
    return s.select(F.col("labels")["instance"].alias("group_id"), F.col("labels")["__name__"].alias("channel"), F.size("samples").cast("long").alias("n_samples"))


@Q("snk8_pieces", f"WITH {POINTS}, r AS (SELECT group_id, channel, (row_number() OVER (PARTITION BY group_id, channel ORDER BY ts_ms, value) - 1) // 5 AS piece FROM p) SELECT group_id, channel, CAST(piece AS INTEGER) AS piece, count(*) AS n FROM r GROUP BY ALL")
def _(spark, sf):
    p = remote_write.pieces(_series(spark, sf), 5)
    return p.select(F.col("labels")["instance"].alias("group_id"), F.col("labels")["__name__"].alias("channel"), "piece", F.size("samples").cast("long").alias("n"))


@Q("snk7_requests", f"WITH {POINTS} SELECT group_id, channel, ts_ms, value FROM p")
def _(spark, sf):
    got = remote_write.received(remote_write.requests(_series(spark, sf)))
    return got.select(F.col("labels")["instance"].alias("group_id"), F.col("labels")["__name__"].alias("channel"), "ts_ms", "value")


def _sliding_sql(size: int, slide: int) -> str:
    return f"""WITH {POINTS}, w AS (SELECT group_id, channel, value, ts_ms, unnest(range(CAST((ts_ms // 1000) - (ts_ms // 1000) % {slide} - {size} + {slide} AS BIGINT), CAST(ts_ms // 1000 - (ts_ms // 1000) % {slide} + 1 AS BIGINT), {slide})) AS win_start FROM p),
 p2 AS (SELECT group_id, channel || '@' || win_start AS channel, ts_ms, value FROM w)""" + _Z.replace("FROM p ", "FROM p2 ") + " SELECT split_part(channel, '@', 1) AS channel, group_id, CAST(split_part(channel, '@', 2) AS BIGINT) AS win_start, n_points, score, severity FROM zs"


def _sliding(name: str, size: int, slide: int):
    @Q(name, _sliding_sql(size, slide))
    def _(spark, sf):
        p = points(spark, sf).withColumn("ts_s", F.floor(F.col("ts_ms") / 1000))
        w = windows.sliding(p, ["group_id", "channel"], "ts_s", size, slide)
        return detect.zscore(w, ["channel", "group_id", "win_start"])


_sliding("str2_sliding_windows", 10 * 86400, 5 * 86400)
_sliding("str3_tumbling_windows", 10 * 86400, 10 * 86400)


@Q("ag19_error_ratio", f"""WITH {POINTS}, s AS (SELECT group_id, channel, list(value ORDER BY ts_ms, value) AS v FROM p GROUP BY ALL), n AS (SELECT *, len(v) AS n, CAST(floor(len(v) * 0.8) AS BIGINT) AS lim FROM s WHERE len(v) >= 6),
 st AS (SELECT group_id, channel, v, unnest(range(0, lim - 6 + 1)) AS off, FALSE AS ev FROM n UNION ALL SELECT group_id, channel, v, n - 6, TRUE FROM n),
 e AS (SELECT *, sqrt((pow(v[off + 4] - v[off + 5], 2) + pow(v[off + 4] - v[off + 6], 2)) / 2) AS err FROM st),
 b AS (SELECT group_id, channel, avg(err) AS baseline FROM (SELECT *, row_number() OVER (PARTITION BY group_id, channel ORDER BY off DESC) AS rn FROM e WHERE NOT ev) WHERE rn <= 5 GROUP BY ALL)
 SELECT e.group_id, e.channel, round(err, 6) AS eval_error, round(coalesce(baseline, err), 6) AS baseline, round(CASE WHEN baseline IS NULL THEN 1.0 ELSE err / greatest(baseline, 1e-8) END, 4) AS score FROM e LEFT JOIN b USING (group_id, channel) WHERE ev""")
def _(spark, sf):
    s = series.ordered_series(points(spark, sf), ["group_id", "channel"])
    out = detect.error_ratio(forecast.window_errors(s, ["group_id", "channel"], 4, 2), ["group_id", "channel"])
    return out.select("group_id", "channel", r6("eval_error").alias("eval_error"), r6("baseline").alias("baseline"), "score")


def _model(kind: str):
    @Q(f"dt4_ratio_{kind}")
    def _(spark, sf):
        p = points(spark, sf)
        keys = ["group_id", "channel"]
        s = series.ordered_series(p, keys)
        errors = forecast.reconstruction_errors(s, keys, 6, 2) if kind == "reconstruction" else forecast.window_errors(s, keys, 6, 2, kind)
        return forecast.detect_by_error(p, errors, keys, kind)


for _kind in ("linear", "nlinear", "dlinear", "trees", "reconstruction"):
    _model(_kind)


def _by_model(name: str, kind: str, span: int, error: str, method: str):
    """A detector with a model without weights, over every series; too short ones have the z-score."""

    @Q(name, f"""WITH {POINTS}{_Z}, sv AS (SELECT group_id, channel, list(value ORDER BY ts_ms, value) AS v FROM p GROUP BY ALL), nv AS (SELECT *, len(v) AS n, greatest({span}, CAST(floor(len(v) * 0.8) AS BIGINT)) AS lim FROM sv WHERE len(v) >= {span}),
 st AS (SELECT group_id, channel, v, unnest(range(0, lim - {span} + 1)) AS o, FALSE AS ev FROM nv UNION ALL SELECT group_id, channel, v, n - {span}, TRUE FROM nv),
 e AS (SELECT *, {error} AS err FROM st),
 b AS (SELECT group_id, channel, avg(err) AS baseline FROM (SELECT *, row_number() OVER (PARTITION BY group_id, channel ORDER BY o DESC) AS rn FROM e WHERE NOT ev) WHERE rn <= 5 GROUP BY ALL),
 q AS (SELECT e.group_id, e.channel, err / greatest(baseline, 1e-8) AS raw FROM e JOIN b USING (group_id, channel) WHERE ev)
 SELECT zs.group_id AS entity_uid, zs.channel AS metric_name, round(coalesce(raw, zs.score), 4) AS score, CASE WHEN raw IS NULL THEN severity WHEN raw >= 2.5 THEN 'critical' WHEN raw >= 1.5 THEN 'warning' ELSE 'normal' END AS severity, CASE WHEN raw IS NULL THEN 'zscore' ELSE '{method}' END AS method, n_points FROM zs LEFT JOIN q USING (group_id, channel)""")
    def _(spark, sf):
        from chronosift.plans.pipeline import build_detector

        model = forecast.Baseline(forecast.ModelSpec(n_channels=1, context_length=4, horizon=2))
        judge = build_detector({"type": kind, "threshold": {"type": "fixed", "warning": 1.5, "critical": 2.5}}, model)
        return judge(points(spark, sf)).select("entity_uid", "metric_name", "score", "severity", "method", "n_points")


_by_model("dt4_model_forecast", "patch-forecast-infer", 6, "sqrt((pow(v[o + 4] - v[o + 5], 2) + pow(v[o + 4] - v[o + 6], 2)) / 2)", "forecast-model")
_by_model("dt5_model_rebuild", "reconstruction-infer", 4, "list_avg(list_transform(v[o + 1 : o + 4], lambda x: pow(x - list_avg(v[o + 1 : o + 4]), 2)))", "reconstruct-model")
