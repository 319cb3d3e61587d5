"""Queries over series: windows, patches, averages, normalisation, scalers, metrics, spectra."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronosift.functions import series as S
from chronosift.operators import datasets, graph, metrics, scaling, windows
from chronosift.plans import experiment
from chronosift.plans.base import POINTS, Registry, points, r6, table

Q = Registry()
KEYS = ["group_id", "channel"]

_SER = POINTS + ", s AS (SELECT group_id, channel, list(value ORDER BY ts_ms, value) AS v FROM p GROUP BY ALL)"
_IDX = POINTS + ", i AS (SELECT *, row_number() OVER (PARTITION BY group_id, channel ORDER BY ts_ms, value) - 1 AS idx, count(*) OVER (PARTITION BY group_id, channel) AS n FROM p)"


def _series(spark, sf):
    return S.ordered_series(points(spark, sf), KEYS).withColumnRenamed("series", "v")


def _indexed(spark, sf):
    return windows.with_length(windows.indexed(points(spark, sf), KEYS, ["ts_ms", "value"]), KEYS)


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))


@Q("ag1_ordered_series", f"WITH {_SER} SELECT group_id, channel, len(v) AS n, round(v[1], 6) AS head, round(v[-1], 6) AS last FROM s")
def _(spark, sf):
    return _series(spark, sf).select(*KEYS, F.size("v").cast("long").alias("n"), r6(F.element_at("v", 1)).alias("head"), r6(F.element_at("v", -1)).alias("last"))


@Q("w11_moving_average", f"""WITH {_IDX} SELECT a.group_id, a.channel, a.idx, round(avg(b.value), 6) AS trend, round(any_value(a.value) - avg(b.value), 6) AS residual
 FROM (SELECT *, unnest(range(-2, 3)) AS o FROM i) a JOIN i b ON b.group_id = a.group_id AND b.channel = a.channel AND b.idx = greatest(0, least(a.n - 1, a.idx + a.o)) GROUP BY 1, 2, 3""")
def _(spark, sf):
    out = windows.moving_average(_indexed(spark, sf), KEYS, "idx", 5)
    return out.select(*KEYS, "idx", r6("trend").alias("trend"), r6("residual").alias("residual"))


@Q("w12_decompose_even_kernel", f"""WITH {_IDX} SELECT a.group_id, a.channel, a.idx, round(any_value(a.value) - avg(b.value), 6) AS residual
 FROM (SELECT *, unnest(range(-1, 3)) AS o FROM i) a JOIN i b ON b.group_id = a.group_id AND b.channel = a.channel AND b.idx = greatest(0, least(a.n - 1, a.idx + a.o)) GROUP BY 1, 2, 3""")
def _(spark, sf):
    return windows.moving_average(_indexed(spark, sf), KEYS, "idx", 4).select(*KEYS, "idx", r6("residual").alias("residual"))


@Q("w13_multi_decompose", f"""WITH {_IDX}, m AS (SELECT a.group_id, a.channel, a.idx, any_value(a.value) AS value, avg(b.value) FILTER (a.o BETWEEN -1 AND 1) AS t3, avg(b.value) AS t5
 FROM (SELECT *, unnest(range(-2, 3)) AS o FROM i) a JOIN i b ON b.group_id = a.group_id AND b.channel = a.channel AND b.idx = greatest(0, least(a.n - 1, a.idx + a.o)) GROUP BY 1, 2, 3)
 SELECT group_id, channel, idx, round(0.25 * t3 + 0.75 * t5, 6) AS trend, round(value - (0.25 * t3 + 0.75 * t5), 6) AS residual FROM m""")
def _(spark, sf):
    return windows.multi_trend(_indexed(spark, sf), KEYS, "idx", [3, 5], [0.25, 0.75]).select(*KEYS, "idx", r6("trend").alias("trend"), r6("residual").alias("residual"))


@Q("w14_sliding_windows", f"WITH {_IDX}, w AS (SELECT *, unnest(range(0, n)) AS win FROM i) SELECT group_id, channel, win, count(*) AS n_points, round(sum(value), 6) AS total FROM w WHERE win * 2 + 6 <= n AND idx BETWEEN win * 2 AND win * 2 + 5 GROUP BY ALL")
def _(spark, sf):
    return windows.window_points(_indexed(spark, sf), 6, 2).groupBy(*KEYS, "win").agg(F.count("*").alias("n_points"), r6(F.sum("value")).alias("total"))


@Q("w15_split_windows", f"""WITH {_IDX}, w AS (SELECT DISTINCT group_id, channel, unnest(range(0, greatest(0, n - 5))) AS win FROM i), r AS (SELECT *, count(*) OVER () AS total, row_number() OVER (ORDER BY group_id, channel, win) AS rn FROM w)
 SELECT CASE WHEN rn <= floor(total * 0.97) THEN 'train' ELSE 'test' END AS part, count(*) AS n FROM r GROUP BY 1""")
def _(spark, sf):
    w = windows.window_points(_indexed(spark, sf), 6).where("pos = 0").select(*KEYS, "win")
    total = w.count()
    rn = windows.ordinals(w, [*KEYS, "win"])
    return rn.groupBy(F.when(F.col("rn") <= int(total * 0.97), "train").otherwise("test").alias("part")).agg(F.count("*").alias("n"))


@Q("w16_horizon_steps", f"WITH {_IDX}, w AS (SELECT *, unnest(range(0, greatest(0, n - 6))) AS win FROM i), q AS (SELECT *, idx - win AS pos FROM w WHERE idx BETWEEN win AND win + 6), h AS (SELECT *, unnest(range(0, 3)) AS h FROM q) SELECT h, count(*) AS n, count(*) FILTER (pos - h = 4) AS masked, round(sum(CASE WHEN pos - h = 4 THEN -1 ELSE value END), 4) AS total, round(sum(value) FILTER (pos - h = 4), 4) AS target FROM h WHERE pos - h BETWEEN 0 AND 4 GROUP BY 1")
def _(spark, sf):
    w = windows.window_points(_indexed(spark, sf), 7)
    out = windows.horizon_steps(w, 5, 3)
    return out.groupBy(F.col("h").cast("long").alias("h")).agg(F.count("*").alias("n"), F.count("target").alias("masked"), F.round(F.sum("value"), 4).alias("total"), F.round(F.sum("target"), 4).alias("target"))


@Q("w17_scaled_windows", f"WITH {_IDX}, w AS (SELECT *, unnest(range(0, n)) AS win FROM i), q AS (SELECT group_id, channel, win, avg(value) AS m FROM w WHERE win * 3 + 6 <= n AND idx BETWEEN win * 3 AND win * 3 + 5 GROUP BY ALL) SELECT group_id, channel, win, round(CASE WHEN m + 1 = 0 THEN 1 ELSE m + 1 END, 6) AS scale FROM q")
def _(spark, sf):
    w = windows.window_points(_indexed(spark, sf), 6, 3)
    return windows.window_scale(w, [*KEYS, "win"], "mean").withColumn("scale", r6("scale"))


@Q("w18_patches", "WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), q AS (SELECT vec_id, v, unnest(range(0, (len(v) - 10) // 8 + 1)) AS p FROM e) SELECT vec_id, p, round(list_sum(v[(len(v) - (10 + 8 * ((len(v) - 10) // 8))) + p * 8 + 1 : (len(v) - (10 + 8 * ((len(v) - 10) // 8))) + p * 8 + 10]), 5) AS total FROM q")
def _(spark, sf):
    p = _vectors(spark, sf).select("vec_id", F.posexplode(S.patches(F.col("v"), 10, 8)).alias("p", "x"))
    return p.select("vec_id", F.col("p").cast("long").alias("p"), F.round(F.aggregate("x", F.lit(0.0), lambda a, y: a + y), 5).alias("total"))


@Q("w19_padded_patches", "WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), f AS (SELECT vec_id, list_concat(v, list_transform(range(0, 8), lambda x: v[-1])) AS v FROM e), q AS (SELECT vec_id, v, unnest(range(0, (len(v) - 16) // 8 + 1)) AS p FROM f) SELECT vec_id, p, round(list_sum(v[(len(v) - 16) % 8 + p * 8 + 1 : (len(v) - 16) % 8 + p * 8 + 16]), 5) AS total FROM q")
def _(spark, sf):
    p = _vectors(spark, sf).select("vec_id", F.posexplode(S.padded_patches(F.col("v"), 16, 8)).alias("p", "x"))
    return p.select("vec_id", F.col("p").cast("long").alias("p"), F.round(F.aggregate("x", F.lit(0.0), lambda a, y: a + y), 5).alias("total"))


@Q("w20_running_sum", f"WITH {_IDX} SELECT group_id, channel, idx, round(sum(value) OVER (PARTITION BY group_id, channel ORDER BY idx), 5) AS total FROM i")
def _(spark, sf):
    return windows.running_sum(_indexed(spark, sf), KEYS, "idx").select(*KEYS, "idx", F.round("total", 5).alias("total"))


@Q("w21_roll", "SELECT vec_id, round(CAST(embedding[6] AS DOUBLE), 6) AS first, round(CAST(embedding[5] AS DOUBLE), 6) AS last FROM embeddings")
def _(spark, sf):
    v = _vectors(spark, sf).select("vec_id", S.roll(F.col("v"), 5).alias("v"))
    return v.select("vec_id", r6(F.element_at("v", 1)).alias("first"), r6(F.element_at("v", -1)).alias("last"))


@Q("j7_window_parts", f"WITH {_IDX}, w AS (SELECT *, unnest(range(0, greatest(0, n - 7))) AS win FROM i), q AS (SELECT *, idx - win AS pos FROM w WHERE idx BETWEEN win AND win + 7) SELECT part, step, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT 'x' AS part, pos AS step, value FROM q WHERE pos < 5 UNION ALL SELECT 'y', pos - 3, value FROM q WHERE pos >= 3) GROUP BY 1, 2")
def _(spark, sf):
    w = windows.sample_parts(windows.window_points(_indexed(spark, sf), 8), 5, 2, 3)
    return w.groupBy("part", "step").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@Q("j8_rescaled_windows", f"WITH {_IDX}, w AS (SELECT *, unnest(range(0, n)) AS win FROM i), q AS (SELECT * FROM w WHERE win * 3 + 6 <= n AND idx BETWEEN win * 3 AND win * 3 + 5), m AS (SELECT *, avg(value) OVER (PARTITION BY group_id, channel, win) + 1 AS sc FROM q) SELECT group_id, channel, win, round(sum(value / CASE WHEN sc = 0 THEN 1 ELSE sc END), 5) AS total FROM m GROUP BY ALL")
def _(spark, sf):
    w = windows.window_points(_indexed(spark, sf), 6, 3)
    both = w.join(windows.window_scale(w, [*KEYS, "win"], "mean"), [*KEYS, "win"])
    return both.groupBy(*KEYS, "win").agg(F.round(F.sum(F.col("value") / F.col("scale")), 5).alias("total"))


@Q("j10_pyramid_edges", "WITH n AS (SELECT unnest(range(0, 64)) AS a), l AS (SELECT unnest(range(0, 16)) AS a) SELECT a, b FROM n, LATERAL (SELECT unnest(range(greatest(0, a - 1), least(63, a + 1) + 1)) AS b) WHERE a <> b UNION ALL SELECT 64 + a, 64 + b FROM l, LATERAL (SELECT unnest(range(greatest(0, a - 1), least(15, a + 1) + 1)) AS b) WHERE a <> b UNION ALL SELECT a, 64 + a // 4 FROM n")
def _(spark, sf):
    return graph.pyramid_edges(spark, 64, [4], 1)


@Q("j10_pyramid_of_series", f"WITH {_IDX}, s AS (SELECT group_id, channel, max(n) AS n FROM i GROUP BY ALL) SELECT group_id, channel, count(*) AS n_nodes, sum(CASE WHEN idx // 4 < n // 4 THEN 1 ELSE 0 END) AS n_parents FROM i GROUP BY 1, 2")
def _(spark, sf):
    i = _indexed(spark, sf)
    up = graph.parents(i, "idx", "n", 4)
    return up.groupBy(*KEYS).agg(F.count("*").alias("n_nodes"), F.sum(F.col("parent").isNotNull().cast("long")).alias("n_parents"))


_REV = "WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), m AS (SELECT *, list_avg(v) AS mu, list_var_pop(v) AS var FROM e)"


@Q("f22_rev_in", _REV + " SELECT vec_id, round((v[1] - mu) / sqrt(var + 1e-5), 5) AS first, round((v[-1] - mu) / sqrt(var + 1e-5), 5) AS last FROM m")
def _(spark, sf):
    v = _vectors(spark, sf).select("vec_id", S.rev_in(F.col("v")).alias("v"))
    return v.select("vec_id", F.round(F.element_at("v", 1), 5).alias("first"), F.round(F.element_at("v", -1), 5).alias("last"))


@Q("f22_rev_in_inverse", "SELECT vec_id, round(CAST(embedding[3] AS DOUBLE), 5) AS third FROM embeddings")
def _(spark, sf):
    mean, var = S.mean_var(F.col("v"))
    v = _vectors(spark, sf).select("vec_id", S.rev_in(F.col("v")).alias("z"), mean.alias("mean"), var.alias("var"))
    return v.select("vec_id", F.round(F.element_at(S.rev_in_inverse(F.col("z"), F.col("mean"), F.col("var")), 3), 5).alias("third"))


@Q("f26_softmax", "WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), x AS (SELECT vec_id, v, list_max(v) AS m FROM e), t AS (SELECT *, list_sum(list_transform(v, lambda y: exp(y - m))) AS s FROM x) SELECT vec_id, round(exp(v[1] - m) / s, 8) AS first FROM t")
def _(spark, sf):
    return _vectors(spark, sf).select("vec_id", F.round(F.element_at(S.softmax(F.col("v")), 1), 8).alias("first"))


@Q("f26_positions", "SELECT CAST(i AS BIGINT) AS pos, round(sin(i), 6) AS s0, round(cos(i), 6) AS c0, round(sin(i * exp(-2 * ln(10000.0) / 4)), 6) AS s1, round(2 * i / 63.0 - 1, 6) AS coord FROM range(0, 64) t(i)")
def _(spark, sf):
    enc = S.sin_cos_encoding(F.col("id"), 4)
    return spark.range(64).select(F.col("id").alias("pos"), r6(enc[0]).alias("s0"), r6(enc[1]).alias("c0"), r6(enc[2]).alias("s1"), r6(S.coordinate_encoding(F.col("id"), 64)).alias("coord"))


_CIRCULAR = """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), t AS (SELECT vec_id, v, unnest(range(0, len(v) // 2 + 1)) AS lag FROM e),
 a AS (SELECT vec_id, lag, list_sum(list_transform(range(0, len(v)), lambda i: v[i + 1] * v[(i + lag) % len(v) + 1])) / len(v) AS ac FROM t)"""


@Q("f27_autocorrelation", _CIRCULAR + " SELECT vec_id, lag, round(ac, 6) AS ac FROM a")
def _(spark, sf):
    v = _vectors(spark, sf).select("vec_id", F.posexplode(S.autocorrelation("v")).alias("lag", "ac"), F.size("v").alias("n"))
    return v.where(F.col("lag") <= F.floor(F.col("n") / 2)).select("vec_id", F.col("lag").cast("long").alias("lag"), r6("ac").alias("ac"))


@Q("f27_top_delays", _CIRCULAR + ", r AS (SELECT vec_id, lag, row_number() OVER (PARTITION BY vec_id ORDER BY round(ac, 6) DESC, lag) AS rn FROM a) SELECT vec_id, lag FROM r WHERE rn <= 3")
def _(spark, sf):
    v = _vectors(spark, sf).select("vec_id", S.autocorrelation("v").alias("ac"))
    half = F.transform(F.slice("ac", F.lit(1), F.floor(F.size("ac") / 2).cast("int") + 1), lambda x: F.round(x, 6))  # the other half mirrors it
    return v.select("vec_id", F.explode(S.top_delays(half, 1.0)).alias("lag")).select("vec_id", F.col("lag").cast("long").alias("lag"))


@Q("f31_sigmoid_range", "SELECT vec_id, round(3.0 / (1 + exp(-CAST(embedding[1] AS DOUBLE))) - 1, 6) AS ranged, round(greatest(0, CAST(embedding[2] AS DOUBLE)), 6) AS relu, round(1 / (1 + exp(-CAST(embedding[3] AS DOUBLE))), 6) AS sigmoid FROM embeddings")
def _(spark, sf):
    v = _vectors(spark, sf)
    at = lambda i: F.element_at("v", i)
    return v.select("vec_id", r6(S.sigmoid_range(at(1), -1.0, 2.0)).alias("ranged"), r6(S.activation("relu", at(2))).alias("relu"), r6(S.activation("sigmoid", at(3))).alias("sigmoid"))


@Q("m15_patch_error", "WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), q AS (SELECT vec_id, unnest(list_transform(range(0, len(v) // 8), lambda k: v[k * 8 + 1 : k * 8 + 8])) AS p FROM e) SELECT vec_id, round(avg(list_avg(list_transform(p, lambda x: pow(x - list_avg(p), 2)))), 8) AS error FROM q GROUP BY 1")
def _(spark, sf):
    p = _vectors(spark, sf).select("vec_id", F.explode(S.patches(F.col("v"), 8, 8)).alias("patch"))
    mean = F.aggregate("patch", F.lit(0.0), lambda a, x: a + x) / F.size("patch")
    out = metrics.patch_error(p.withColumn("rebuilt", F.array_repeat(mean, F.size("patch"))), ["vec_id"])
    return out.select("vec_id", F.round("error", 8).alias("error"))


@Q("f30_num_patches", "SELECT n, CAST((greatest(n, 16) - 16) // 8 + 1 AS INTEGER) AS patches FROM range(1, 400) t(n)")
def _(spark, sf):
    return spark.range(1, 400).select(F.col("id").alias("n"), S.num_patches(F.col("id"), 16, 8).alias("patches"))


@Q("ag12_standard_stats", f"WITH {_IDX} SELECT channel, round(avg(value), 6) AS mean, round(CASE WHEN stddev_pop(value) = 0 THEN 1 ELSE stddev_pop(value) END, 6) AS sd FROM i WHERE idx < floor(n * 0.7) GROUP BY 1")
def _(spark, sf):
    st = scaling.standard_stats(_indexed(spark, sf), ["channel"], where=F.col("idx") < F.floor(F.col("n") * 0.7))
    return st.select("channel", r6("mean").alias("mean"), r6("sd").alias("sd"))


@Q("f23_standardise", f"WITH {_IDX}, st AS (SELECT channel, avg(value) AS m, CASE WHEN stddev_pop(value) = 0 THEN 1 ELSE stddev_pop(value) END AS sd FROM i WHERE idx < floor(n * 0.7) GROUP BY 1) SELECT group_id, channel, idx, round((value - m) / sd, 5) AS scaled, round(value, 5) AS restored FROM i JOIN st USING (channel)")
def _(spark, sf):
    s = scaling.unstandardise(scaling.standardise(_indexed(spark, sf), ["channel"], where=F.col("idx") < F.floor(F.col("n") * 0.7)))
    return s.select(*KEYS, "idx", F.round("scaled", 5).alias("scaled"), F.round("restored", 5).alias("restored"))


@Q("f24_gaussian_pointwise", f"WITH {_IDX} SELECT group_id, channel, idx, round((value - avg(value) OVER w) / (stddev_samp(value) OVER w + 1e-5), 5) AS scaled FROM i WINDOW w AS (PARTITION BY idx)")
def _(spark, sf):
    return scaling.gaussian(_indexed(spark, sf), ["idx"]).select(*KEYS, "idx", F.round("scaled", 5).alias("scaled"))


@Q("f24_gaussian_global", "SELECT event_id, round((value - avg(value) OVER ()) / (stddev_samp(value) OVER () + 1e-5), 5) AS scaled FROM events")
def _(spark, sf):
    return scaling.gaussian(table(spark, sf, "events").select("event_id", "value"), []).select("event_id", F.round("scaled", 5).alias("scaled"))


@Q("f24_range", "SELECT event_id, round((value - min(value) OVER w) * 2 / nullif(max(value) OVER w - min(value) OVER w, 0) - 1, 5) AS scaled FROM events WINDOW w AS (PARTITION BY event_type)")
def _(spark, sf):
    return scaling.to_range(table(spark, sf, "events").select("event_id", "event_type", "value"), ["event_type"], low=-1.0, high=1.0).select("event_id", F.round("scaled", 5).alias("scaled"))


@Q("f25_mean_scale", "SELECT event_id, round(value / (avg(value) OVER w + 1), 5) AS scaled FROM events WINDOW w AS (PARTITION BY event_type)")
def _(spark, sf):
    m = F.avg("value").over(Window.partitionBy("event_type"))
    return table(spark, sf, "events").select("event_id", F.round(scaling.mean_scale(F.col("value"), m), 5).alias("scaled"))


# ---- metrics: truth is each value, the forecast repeats the one before it

_PT = _IDX + ", f AS (SELECT group_id, channel, idx, value AS t, lag(value) OVER (PARTITION BY group_id, channel ORDER BY idx) AS q FROM i), e AS (SELECT * FROM f WHERE q IS NOT NULL)"


def _pairs(spark, sf):
    w = Window.partitionBy(*KEYS).orderBy("idx")
    return _indexed(spark, sf).select(*KEYS, "idx", F.col("value").alias("true"), F.lag("value").over(w).alias("pred")).where("pred IS NOT NULL")


@Q("m8_bundle", f"WITH {_PT} SELECT channel, round(avg(abs(q - t)), 5) AS mae, round(avg((q - t) * (q - t)), 4) AS mse, round(sqrt(avg((q - t) * (q - t))), 5) AS rmse, round(sqrt(sum((q - t) * (q - t))) / sqrt(count(t) * var_pop(t)), 5) AS rse FROM e GROUP BY 1")
def _(spark, sf):
    b = metrics.bundle(_pairs(spark, sf), ["channel"])
    return b.select("channel", F.round("mae", 5).alias("mae"), F.round("mse", 4).alias("mse"), F.round("rmse", 5).alias("rmse"), F.round("rse", 5).alias("rse"))


@Q("m4_relative", f"WITH {_PT} SELECT channel, round(ln(avg(abs((q - t) / nullif(t, 0)))), 5) AS log_mape, round(ln(avg(pow((q - t) / nullif(t, 0), 2))), 5) AS log_mspe FROM e GROUP BY 1")
def _(spark, sf):
    out = _pairs(spark, sf).groupBy("channel").agg(metrics.mape().alias("mape"), metrics.mspe().alias("mspe"))
    return out.select("channel", F.round(F.ln("mape"), 5).alias("log_mape"), F.round(F.ln("mspe"), 5).alias("log_mspe"))


@Q("m7_corr", f"WITH {_PT}, d AS (SELECT channel, idx, t - avg(t) OVER w AS dt, q - avg(q) OVER w AS dq FROM e WINDOW w AS (PARTITION BY channel, idx)), c AS (SELECT channel, idx, sum(dt * dq) AS u, sqrt(sum(dt * dt * dq * dq)) + 1e-12 AS d FROM d GROUP BY 1, 2) SELECT channel, round(0.01 * avg(u / d), 6) AS corr FROM c GROUP BY 1")
def _(spark, sf):
    return metrics.corr(_pairs(spark, sf), ["channel"], "idx").select("channel", r6("corr").alias("corr"))


@Q("m9_r2", f"WITH {_PT} SELECT channel, round(1 - sum((q - t) * (q - t)) / (count(*) * var_pop(t)), 5) AS r2 FROM e GROUP BY 1")
def _(spark, sf):
    return _pairs(spark, sf).groupBy("channel").agg(F.round(metrics.r2(), 5).alias("r2"))


@Q("m10_top_k_loss", f"WITH {_PT}, r AS (SELECT channel, (q - t) * (q - t) AS loss, row_number() OVER (PARTITION BY channel ORDER BY (q - t) * (q - t) DESC, group_id, idx) AS rn FROM e) SELECT channel, round(avg(loss), 4) AS top_k_loss FROM r WHERE rn <= 25 GROUP BY 1")
def _(spark, sf):
    d = _pairs(spark, sf).withColumn("loss", (F.col("pred") - F.col("true")) * (F.col("pred") - F.col("true"))).withColumn("id", F.struct("group_id", "idx"))
    return metrics.top_k_loss(d, ["channel"], 25).select("channel", F.round("top_k_loss", 4).alias("top_k_loss"))


@Q("m11_gaussian_nll", f"WITH {_PT} SELECT channel, round(avg(0.5 * ln(2 * pi()) + ln(2.0 + idx % 3) + pow(t - q, 2) / (2 * pow(2.0 + idx % 3, 2))), 4) AS nll FROM e GROUP BY 1")
def _(spark, sf):
    d = _pairs(spark, sf)
    return d.groupBy("channel").agg(F.round(F.avg(metrics.gaussian_nll(F.col("true"), F.col("pred"), F.lit(2.0) + F.col("idx") % 3)), 4).alias("nll"))


@Q("m12_nd_nrmse", f"WITH {_PT} SELECT channel, round(sum(abs(q - t)) / sum(t), 5) AS nd, round(sqrt(avg((q - t) * (q - t))) / avg(t), 5) AS nrmse FROM e GROUP BY 1")
def _(spark, sf):
    return _pairs(spark, sf).groupBy("channel").agg(F.round(metrics.nd(), 5).alias("nd"), F.round(metrics.nrmse(), 5).alias("nrmse"))


@Q("m13_lp_loss", f"WITH {_PT} SELECT group_id, channel, round(pow(sum(pow(abs(q - t), 3)), 1 / 3.0), 4) AS lp, round(pow(sum(pow(abs(q - t), 3)), 1 / 3.0) / nullif(pow(sum(pow(abs(t), 3)), 1 / 3.0), 0), 5) AS lp_rel FROM e GROUP BY 1, 2")
def _(spark, sf):
    return metrics.lp_loss(_pairs(spark, sf), KEYS, 3.0).select(*KEYS, F.round("lp", 4).alias("lp"), F.round("lp_rel", 5).alias("lp_rel"))


@Q("m14_masked_mse", f"WITH {_PT} SELECT channel, round(sum((q - t) * (q - t)) FILTER (idx % 3 = 0) / nullif(count(*) FILTER (idx % 3 = 0), 0), 4) AS masked FROM e GROUP BY 1")
def _(spark, sf):
    d = _pairs(spark, sf).withColumn("mask", (F.col("idx") % 3 == 0).cast("double"))
    return d.groupBy("channel").agg(F.round(metrics.masked_mse(), 4).alias("masked"))


@Q("ag20_covariance", f"WITH {_IDX}, d AS (SELECT channel, idx, avg(value) AS v FROM i GROUP BY 1, 2) SELECT x.channel AS a, y.channel AS b, round(covar_pop(x.v, y.v), 4) AS cov FROM d x JOIN d y USING (idx) GROUP BY 1, 2")
def _(spark, sf):
    d = _indexed(spark, sf).groupBy("channel", "idx").agg(F.avg("value").alias("v"))
    return metrics.covariance(d, "channel", "idx", "v").select("a", "b", F.round("cov", 4).alias("cov"))


@Q("ag21_epoch_loss", "SELECT event_type, round(sum(value * user_id) / nullif(sum(user_id), 0), 5) AS loss FROM events GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.round(metrics.weighted_mean("value", "user_id"), 5).alias("loss"))


@Q("fm1_repeat_last", f"WITH {_SER} SELECT group_id, channel, round(sqrt(list_avg(list_transform(v[-3:], lambda x: pow(x - v[-4], 2)))), 5) AS rmse FROM s WHERE len(v) >= 4")
def _(spark, sf):
    from chronosift.operators.forecast import repeat_last, rmse_arrays

    s = _series(spark, sf).where(F.size("v") >= 4)
    past, truth = F.slice("v", F.lit(1), F.size("v") - 3), F.slice("v", -3, 3)
    return s.select(*KEYS, F.round(rmse_arrays(repeat_last(past, 3), truth), 5).alias("rmse"))


@Q("st12_lowest_modes", "SELECT CAST(i AS BIGINT) AS mode FROM range(0, 8) t(i)")
def _(spark, sf):
    return spark.createDataFrame([(m,) for m in S.frequency_modes(64, 8)], "mode long")


@Q("st11_random_mask", "WITH p AS (SELECT vec_id, unnest(range(0, len(embedding) // 8)) AS p FROM embeddings), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY substr(md5(vec_id || '/' || p || '/7'), 1, 8), p) AS rn, count(*) OVER (PARTITION BY vec_id) AS l FROM p) SELECT vec_id, p, rn > floor(l * 0.6 + 1e-9) AS masked FROM r")
def _(spark, sf):
    p = _vectors(spark, sf).select("vec_id", F.posexplode(S.patches(F.col("v"), 8, 8)).alias("p", "x")).select("vec_id", F.col("p").cast("long").alias("p"))
    return windows.random_mask(p, ["vec_id"], "p", 0.4, 7)


_DRAWS = f"""WITH {_IDX}, w AS (SELECT *, unnest(range(0, n)) AS win FROM i), v AS (SELECT group_id || '/' || channel || '/' || win AS key, channel, sum(value) AS v FROM w WHERE win * 3 + 6 <= n AND idx BETWEEN win * 3 AND win * 3 + 5 GROUP BY group_id, channel, win),
 c AS (SELECT *, sum(abs(v)) OVER (ORDER BY md5(key)) AS hi, sum(abs(v)) OVER () AS total FROM v WHERE v <> 0),
 d AS (SELECT draw, ('0x' || substr(md5(draw || '/3'), 1, 8))::BIGINT / 4294967296.0 * (SELECT any_value(total) FROM c) AS x FROM (SELECT CAST(unnest(range(0, 200)) AS BIGINT) AS draw))"""


@Q("st9_weighted_sample", _DRAWS + " SELECT draw, arg_min(key, hi) AS key FROM d JOIN c ON c.hi > d.x GROUP BY 1")
def _(spark, sf):
    w = windows.window_points(_indexed(spark, sf), 6, 3).groupBy(*KEYS, "win").agg(F.sum("value").alias("v"))
    w = w.withColumn("key", F.concat_ws("/", *KEYS, "win"))
    return windows.sample_with_replacement(w, 200, F.col("v"), 3, "key").select("draw", "key")


@Q("st10_batches", "WITH r AS (SELECT p_partkey, row_number() OVER (ORDER BY md5(p_partkey || '/5'), p_partkey) - 1 AS rn FROM part) SELECT p_partkey, rn // 32 AS batch, rn % 32 AS place FROM r")
def _(spark, sf):
    return windows.random_batches(table(spark, sf, "part").select("p_partkey"), ["p_partkey"], 32, 5)


@Q("st5_text_order", "SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY CAST(event_id AS VARCHAR)) - 1 AS idx FROM events")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", F.col("event_id").cast("string").alias("as_text"))
    return windows.indexed(e, ["user_id"], ["as_text"]).select("event_id", "idx")


# ---- parts of models

_TOK = "WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), t AS (SELECT vec_id, i, v[i * 8 + 1 : i * 8 + 8] AS x FROM (SELECT vec_id, v, CAST(unnest(range(0, 8)) AS BIGINT) AS i FROM e)), s AS (SELECT a.vec_id, a.i, b.i AS j, list_sum(list_transform(range(1, 9), lambda k: a.x[k] * b.x[k])) AS s, b.x AS vx FROM t a JOIN t b USING (vec_id))"


@Q("attention_full", _TOK + ", m AS (SELECT *, exp(s / sqrt(8.0) - max(s / sqrt(8.0)) OVER (PARTITION BY vec_id, i)) AS w FROM s) SELECT vec_id, i, round(sum(w * vx[1]) / sum(w), 6) AS first, round(sum(w * vx[8]) / sum(w), 6) AS last FROM m GROUP BY 1, 2")
def _(spark, sf):
    out = _vectors(spark, sf).select("vec_id", S.self_attention(F.col("v"), 8).alias("y"))
    token = out.select("vec_id", "y", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))).alias("i"))
    at = lambda k: F.get("y", (F.col("i") * 8 + k).cast("int"))
    return token.select("vec_id", "i", r6(at(0)).alias("first"), r6(at(7)).alias("last"))


@Q("st7_sparse_queries", _TOK + ", m AS (SELECT vec_id, i, max(s) - avg(s) AS m FROM s GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY m DESC, i) AS rn FROM m) SELECT vec_id, i FROM r WHERE rn <= 3")
def _(spark, sf):
    out = _vectors(spark, sf).select("vec_id", F.explode(S.sparse_queries(F.col("v"), 8, 3)).alias("i"))
    return out.select("vec_id", F.col("i").cast("long").alias("i"))


@Q("spectral_low_pass", "WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), c AS (SELECT vec_id, len(v) AS n, list_sum(v) AS c0, list_sum(list_transform(range(0, len(v)), lambda i: v[i + 1] * cos(2 * pi() * i / len(v)))) AS re, list_sum(list_transform(range(0, len(v)), lambda i: -v[i + 1] * sin(2 * pi() * i / len(v)))) AS im FROM e) SELECT vec_id, round((c0 + 2 * re) / n, 6) AS at0, round((c0 + 2 * (re * cos(2 * pi() * 5 / n) - im * sin(2 * pi() * 5 / n))) / n, 6) AS at5 FROM c")
def _(spark, sf):
    y = _vectors(spark, sf).select("vec_id", S.low_pass(F.col("v"), 2).alias("y"))
    return y.select("vec_id", r6(F.get("y", F.lit(0))).alias("at0"), r6(F.get("y", F.lit(5))).alias("at5"))


@Q("wavelet_haar", "WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings) SELECT vec_id, CAST(i AS BIGINT) AS i, round((v[2 * i + 1] + v[2 * i + 2]) / sqrt(2.0), 6) AS smooth, round((v[2 * i + 1] - v[2 * i + 2]) / sqrt(2.0), 6) AS detail FROM (SELECT vec_id, v, unnest(range(0, len(v) // 2)) AS i FROM e)")
def _(spark, sf):
    smooth, detail = S.haar(F.col("v"))
    both = _vectors(spark, sf).select("vec_id", F.arrays_zip(smooth.alias("s"), detail.alias("d")).alias("z"))
    out = both.select("vec_id", F.posexplode("z").alias("i", "z"))
    return out.select("vec_id", F.col("i").cast("long").alias("i"), r6(F.col("z.s")).alias("smooth"), r6(F.col("z.d")).alias("detail"))


def _pool(how: str):
    @Q(f"pyramid_pool_{how}", f"WITH {_IDX} SELECT group_id, channel, idx // 4 AS idx, round({how}(value), 6) AS value FROM i GROUP BY group_id, channel, idx // 4 HAVING count(*) = 4")
    def _(spark, sf):
        return windows.pooled(_indexed(spark, sf), KEYS, 4, how).select(*KEYS, "idx", r6("value").alias("value"))


_pool("avg")
_pool("max")


@Q("mask_causal", "SELECT CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j FROM range(0, 32) a(i), range(0, 32) b(j) WHERE j <= i")
def _(spark, sf):
    return graph.causal_pairs(spark, 32)


@Q("exp_naive_errors", f"WITH {_IDX}, st AS (SELECT group_id, channel, avg(value) AS m, CASE WHEN stddev_pop(value) = 0 THEN 1 ELSE stddev_pop(value) END AS sd FROM i WHERE idx < floor(n * 0.7) GROUP BY ALL), ok AS (SELECT DISTINCT group_id, channel FROM i WHERE floor(n * 0.7) >= 6), x AS (SELECT i.*, (value - m) / sd AS z, CAST(n - floor(n * 0.2) - 4 AS BIGINT) AS lo FROM i JOIN st USING (group_id, channel) SEMI JOIN ok USING (group_id, channel)), w AS (SELECT a.group_id, a.channel, b.z AS t, a.z AS q FROM x a JOIN x b ON a.group_id = b.group_id AND a.channel = b.channel AND b.idx - a.idx IN (1, 2) WHERE a.idx >= a.lo + 3 AND a.idx + 2 < a.n) SELECT 'test' AS part, round(avg(abs(q - t)), 5) AS mae, round(avg((q - t) * (q - t)), 4) AS mse FROM w")
def _(spark, sf):
    what = experiment.Experiment(datasets.DatasetSpec(seq_len=4, label_len=2, pred_len=2), "naive", parts=("test",))
    out = experiment.run(points(spark, sf).withColumn("o", F.struct("ts_ms", "value")), KEYS, ["o"], what)
    return out.select("part", F.round("mae", 5).alias("mae"), F.round("mse", 4).alias("mse"))
