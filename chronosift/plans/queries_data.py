"""Queries of sources, calendars, filters and data-set preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronosift.functions import calendar, series
from chronosift.operators import datasets, metrics, windows
from chronosift.plans.base import POINTS, Registry, points, r6, table
from chronosift.schema import label_value
from chronosift.sources import files

Q = Registry()
KEYS = ["group_id", "channel"]
_IDX = POINTS + ", i AS (SELECT *, row_number() OVER (PARTITION BY group_id, channel ORDER BY ts_ms, value) - 1 AS idx, count(*) OVER (PARTITION BY group_id, channel) AS n FROM p)"


def _indexed(spark, sf):
    return windows.with_length(windows.indexed(points(spark, sf), KEYS, ["ts_ms", "value"]), KEYS)


# ---- sources


def _matrix(spark, sf):
    p = points(spark, sf).groupBy("group_id", "channel").agg(F.array_sort(F.collect_list(F.struct((F.col("ts_ms") / 1000.0).alias("ts_s"), F.col("value").cast("string").alias("val")))).alias("values"))
    return p.select(F.create_map(F.lit("instance"), F.when(F.col("group_id") != "3", F.col("group_id")).otherwise(""), F.lit("__name__"), "channel").alias("metric"), "values")


@Q("src2_flatten_matrix", f"WITH {POINTS} SELECT CASE group_id WHEN '3' THEN 'default' ELSE group_id END AS group_id, channel, CAST(trunc(ts_ms / 1000.0::DOUBLE * 1000) AS BIGINT) AS ts_ms, value FROM p")
def _(spark, sf):
    return files.flatten_matrix(_matrix(spark, sf)).select("group_id", "channel", "ts_ms", "value")


@Q("src2_json_bodies", "SELECT CAST(user_id AS VARCHAR) AS group_id, event_type AS channel, event_id * 1000 AS ts_ms, CAST(event_id % 7 AS DOUBLE) AS value FROM events")
def _(spark, sf):
    body = '{"status":"success","data":{"result":[{"metric":{"__name__":"%s","instance":"%s"},"values":[[%s,"%s"]]}]}}'
    e = table(spark, sf, "events").select(F.format_string(body, "event_type", F.col("user_id").cast("string"), F.col("event_id").cast("string"), (F.col("event_id") % 7).cast("string")).alias("body"))
    return files.flatten_matrix(files.matrix_from_json(e)).select("group_id", "channel", "ts_ms", "value")


@Q("src4_synthetic", "SELECT g AS group_id, c AS channel, CAST(i * 15000 + 60000 AS BIGINT) AS ts_ms, CASE WHEN i = 40 THEN 20.0 ELSE 2.0 + 0.5 * i END::DOUBLE AS value FROM range(0, 100) t(i), (VALUES ('a'), ('b')) x(g), (VALUES ('cpu'), ('mem'), ('net')) y(c)")
def _(spark, sf):
    return files.synthetic(spark, ["a", "b"], ["cpu", "mem", "net"], 100, 60_000, 15, 2.0, 0.5, 40)


@Q("src6_wide_to_long", "SELECT CAST(l_orderkey AS VARCHAR) AS ts_cell, channel, value FROM (SELECT l_orderkey, l_quantity, l_discount, l_tax FROM lineitem) UNPIVOT (value FOR channel IN (l_quantity, l_discount, l_tax))")
def _(spark, sf):
    wide = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_tax")
    return files.wide_to_long(wide, "l_orderkey")


@Q("src9_decimal_comma", "SELECT s_suppkey, round(s_acctbal, 2) AS balance FROM supplier")
def _(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", F.regexp_replace(F.round("s_acctbal", 2).cast("decimal(18,2)").cast("string"), r"\.", ",").alias("t"))
    return s.select("s_suppkey", files.decimal_comma(F.col("t")).alias("balance"))


@Q("src12_transpose", "SELECT r, country, v FROM (SELECT CAST(o_orderkey AS VARCHAR) AS r, o_totalprice AS total, CAST(o_custkey AS DOUBLE) AS cust FROM orders) UNPIVOT (v FOR country IN (total, cust))")
def _(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("r"), F.col("o_totalprice").alias("total"), F.col("o_custkey").cast("double").alias("cust"))
    return files.wide_to_long(o, "r").toDF("r", "country", "v")


@Q("src14_parquet_scan", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE value > 10 GROUP BY 1")
def _(spark, sf):
    e = spark.read.schema("event_id long, user_id long, event_type string, value double").parquet(f"{sf}/events.parquet")
    return e.where("value > 10").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


_WAVES = "WITH k AS (SELECT CAST(s AS BIGINT) AS series_id, p, 5 + 5 * (('0x' || substr(md5(s || '/' || p || '/a/0'), 1, 8))::BIGINT / 4294967296.0) AS amp, 2 * pi() * (('0x' || substr(md5(s || '/' || p || '/f/0'), 1, 8))::BIGINT / 4294967296.0) AS phase FROM range(0, 6) t(s), (VALUES (24), (168), (720)) y(p))"


@Q("src15_sinusoids", _WAVES + " SELECT series_id, CAST(i AS BIGINT) AS idx, round(sum(amp * sin(2 * pi() * i / p + phase)), 6) AS value FROM k, range(0, 2000) r(i) GROUP BY 1, 2")
def _(spark, sf):
    return files.sinusoids(spark, 6, 2000, noise=0.0).select("series_id", "idx", r6("value").alias("value"))


# ---- scalar functions


@Q("f1_parse_ts", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 1467331200000 + event_id WHEN 1 THEN (1467331200 + event_id) * 1000 ELSE epoch_us(date_trunc('second', ts)) // 1000 END AS ts_ms FROM events")
def _(spark, sf):
    e = table(spark, sf, "events")
    i = F.col("event_id")
    cell = F.when(i % 3 == 0, (i + 1467331200000).cast("string")).when(i % 3 == 1, (i + 1467331200).cast("string")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return e.select("event_id", calendar.parse_ts(cell).alias("ts_ms"))


@Q("f2_shift_to_now", f"WITH {POINTS} SELECT group_id, channel, ts_ms + (2000000000000 - max(ts_ms) OVER ()) AS ts_ms, value FROM p")
def _(spark, sf):
    p = points(spark, sf)
    last = p.agg(F.max("ts_ms").alias("last"))
    return p.crossJoin(F.broadcast(last)).select("group_id", "channel", (F.col("ts_ms") + (F.lit(2_000_000_000_000) - F.col("last"))).alias("ts_ms"), "value")


@Q("f4_group_ids", "SELECT event_id, CASE WHEN user_id % 5 = 0 AND event_id % 2 = 0 THEN 'default' WHEN user_id % 5 = 0 THEN '/' ELSE user_id || CASE WHEN event_id % 2 = 0 THEN '' ELSE '/' END END AS group_id FROM events")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.when(F.col("user_id") % 5 != 0, F.create_map(F.lit("u"), F.col("user_id").cast("string"))).otherwise(F.create_map().cast("map<string,string>")).alias("m"))
    one, two = files.group_id(F.col("m"), ["u"]), files.group_id(F.col("m"), ["u", "v"])
    return e.select("event_id", F.when(F.col("event_id") % 2 == 0, one).otherwise(two).alias("group_id"))


@Q("f5_channel_names", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_type WHEN 1 THEN 'named' ELSE 'value' END AS channel FROM events")
def _(spark, sf):
    i = F.col("event_id")
    m = F.when(i % 3 == 0, F.create_map(F.lit("kind"), "event_type", F.lit("__name__"), F.lit("named"))).when(i % 3 == 1, F.create_map(F.lit("__name__"), F.lit("named"))).otherwise(F.create_map().cast("map<string,string>"))
    return table(spark, sf, "events").select("event_id", files.channel_name(m, "kind").alias("channel"))


@Q("f10_label_pairs", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type || '=x' ELSE '' END AS v FROM events")
def _(spark, sf):
    pair = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("k="), F.col("event_type"), F.lit("=x"))).otherwise("k")
    return table(spark, sf, "events").select("event_id", label_value(pair).alias("v"))


@Q("f15_marks", "SELECT event_id, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day, CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) // 15 AS INTEGER) AS minute FROM events")
def _(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", *[c.cast("int").alias(n) for n, c in calendar.marks(F.col("ts"), True).items()])


@Q("f16_encoded", "SELECT event_id, round(second(ts) / 59.0 - 0.5, 6) AS second_of_minute, round(minute(ts) / 59.0 - 0.5, 6) AS minute_of_hour, round(hour(ts) / 23.0 - 0.5, 6) AS hour_of_day, round((isodow(ts) - 1) / 6.0 - 0.5, 6) AS day_of_week, round((day(ts) - 1) / 30.0 - 0.5, 6) AS day_of_month, round((dayofyear(ts) - 1) / 365.0 - 0.5, 6) AS day_of_year FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", *[r6(c).alias(n) for n, c in calendar.encoded(F.col("ts"), "s").items()])


@Q("f16_encoded_long", "SELECT o_orderkey, round((month(o_orderdate) - 1) / 11.0 - 0.5, 6) AS month_of_year, round((weekofyear(o_orderdate) - 1) / 52.0 - 0.5, 6) AS week_of_year FROM orders")
def _(spark, sf):
    ts = F.col("o_orderdate")
    return table(spark, sf, "orders").select("o_orderkey", r6(calendar.encoded(ts, "m")["month_of_year"]).alias("month_of_year"), r6(calendar.encoded(ts, "w")["week_of_year"]).alias("week_of_year"))


@Q("f18_future_dates", "SELECT user_id, unnest(range(max(ts) + INTERVAL 1 HOUR, max(ts) + INTERVAL 4 HOUR + INTERVAL 1 SECOND, INTERVAL 1 HOUR)) AS ts FROM events GROUP BY 1")
def _(spark, sf):
    last = table(spark, sf, "events").groupBy("user_id").agg(F.max("ts").alias("last"))
    return last.select("user_id", F.explode(calendar.future(F.col("last"), 4)).alias("ts"))


@Q("f19_scaled_marks", "SELECT event_id, round((isodow(ts) - 1) / 7.0, 6) AS weekday, round(hour(ts) / 24.0, 6) AS hour, round(month(ts) / 12.0, 6) AS month FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", *[r6(c).alias(n) for n, c in calendar.scaled(F.col("ts")).items()])


@Q("f20_series_age", f"WITH {_IDX}, f AS (SELECT group_id, channel, coalesce(min(idx) FILTER (value <> 0), 0) AS f0 FROM i GROUP BY ALL), a AS (SELECT group_id, channel, idx, idx - f0 AS since FROM i JOIN f USING (group_id, channel) WHERE idx >= f0) SELECT group_id, channel, idx, round((since - avg(since) OVER w) / nullif(stddev_pop(since) OVER w, 0), 6) AS age FROM a WINDOW w AS (PARTITION BY group_id, channel)")
def _(spark, sf):
    return datasets.with_age(_indexed(spark, sf), KEYS).select(*KEYS, "idx", r6("age").alias("age"))


@Q("f21_hour_index_calendar", "SELECT CAST(i AS BIGINT) AS i, round(i % 24 / 24.0, 6) AS hour, round(i // 24 % 7 / 7.0, 6) AS weekday, round(i // 720 % 12 / 12.0, 6) AS month FROM range(0, 3000) t(i)")
def _(spark, sf):
    return spark.range(3000).select(F.col("id").alias("i"), *[r6(c).alias(n) for n, c in calendar.from_hour_index(F.col("id")).items()])


@Q("j6_covariates_by_time", "SELECT e.event_id, c.w AS weekday FROM events e JOIN (SELECT DISTINCT date_trunc('hour', ts) AS h, CAST(isodow(ts) - 1 AS INTEGER) AS w FROM events) c ON c.h = date_trunc('hour', e.ts)")
def _(spark, sf):
    e = table(spark, sf, "events").withColumn("h", F.date_trunc("hour", "ts"))
    cov = e.select("h", F.weekday("ts").alias("weekday")).distinct()
    return datasets.with_covariates(e, cov).select("event_id", "weekday")


# ---- filters and aggregates of data preparation


@Q("pf4_features", "SELECT p_partkey, p_size, p_retailprice FROM part")
def _(spark, sf):
    spec = datasets.DatasetSpec(target="p_retailprice")
    wide = table(spark, sf, "part").select("p_retailprice", "p_partkey", "p_size")
    return datasets.reordered(wide, spec, "p_partkey")


@Q("pf4_target_only", "SELECT p_partkey, p_retailprice FROM part")
def _(spark, sf):
    return datasets.reordered(table(spark, sf, "part").select("p_retailprice", "p_partkey", "p_size"), datasets.DatasetSpec(target="p_retailprice", features="S"), "p_partkey")


@Q("pf6_last_steps", "SELECT vec_id, round(CAST(list_sum(list_transform(embedding[-5:], lambda x: CAST(x AS DOUBLE))) AS DOUBLE), 5) AS total FROM embeddings")
def _(spark, sf):
    v = table(spark, sf, "embeddings").select("vec_id", series.last_steps(F.col("embedding").cast("array<double>"), 5).alias("v"))
    return v.select("vec_id", F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 5).alias("total"))


_SPARSE = POINTS + ", q AS (SELECT group_id, channel, ts_ms, CASE WHEN value < 8 THEN 0 ELSE value END AS value FROM p)"


def _sparse(spark, sf):
    return points(spark, sf).withColumn("value", F.when(F.col("value") < 8, 0.0).otherwise(F.col("value")))


@Q("pf8_mostly_zero", f"WITH {_SPARSE}, g AS (SELECT group_id, channel FROM q GROUP BY ALL HAVING avg(CASE WHEN value = 0 THEN 1.0 ELSE 0 END) <= 0.2 AND count(*) >= 10) SELECT q.* FROM q SEMI JOIN g USING (group_id, channel)")
def _(spark, sf):
    return windows.drop_mostly_zero(_sparse(spark, sf), KEYS, 0.2, 10).select("group_id", "channel", "ts_ms", "value")


_SI = _SPARSE + ", i AS (SELECT *, row_number() OVER (PARTITION BY group_id, channel ORDER BY ts_ms, value) - 1 AS idx FROM q)"


def _sparse_idx(spark, sf):
    return windows.indexed(_sparse(spark, sf), KEYS, ["ts_ms", "value"])


@Q("ag13_first_nonzero", f"WITH {_SI} SELECT group_id, channel, coalesce(min(idx) FILTER (value <> 0), 0) AS first_idx FROM i GROUP BY ALL")
def _(spark, sf):
    return windows.first_nonzero(_sparse_idx(spark, sf), KEYS)


@Q("pf9_latest_start", f"WITH {_SI}, f AS (SELECT group_id, channel, coalesce(min(idx) FILTER (value <> 0), 0) AS f0 FROM i GROUP BY ALL HAVING f0 < 4), c AS (SELECT max(f0) AS cut FROM f) SELECT i.group_id, i.channel, i.idx, i.value FROM i SEMI JOIN f USING (group_id, channel) WHERE i.idx >= (SELECT cut FROM c)")
def _(spark, sf):
    return windows.from_latest_start(_sparse_idx(spark, sf), KEYS, 4).select(*KEYS, "idx", "value")


@Q("pf10_positive_windows", f"WITH {_SI}, n AS (SELECT *, count(*) OVER (PARTITION BY group_id, channel) AS n FROM i), w AS (SELECT *, unnest(range(0, n)) AS win FROM n), x AS (SELECT * FROM w WHERE win * 3 + 6 <= n AND idx BETWEEN win * 3 AND win * 3 + 5), s AS (SELECT group_id, channel, win, avg(value) FILTER (value > 0 AND idx - win * 3 < 4) AS sc FROM x GROUP BY ALL) SELECT group_id, channel, win, round(sum(value / sc), 5) AS total FROM x JOIN s USING (group_id, channel, win) WHERE sc IS NOT NULL GROUP BY ALL")
def _(spark, sf):
    out = datasets.wind(_sparse(spark, sf).withColumn("o", F.struct("ts_ms", "value")), KEYS, "o", 6, 4, 3)
    return out.groupBy(*KEYS, "win").agg(F.round(F.sum("scaled"), 5).alias("total"))


@Q("pf11_date_range", "SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12'")
def _(spark, sf):
    return windows.date_range(table(spark, sf, "events"), "ts", "2024-01-05", "2024-01-12").select("event_id")


@Q("pf12_loss_mask", "SELECT event_type, count(*) FILTER (value <> 0) AS nonzero, count(*) FILTER (value >= 0) AS known FROM events GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count_if(metrics.loss_mask(F.col("value"))).alias("nonzero"), F.count_if(metrics.loss_mask(F.col("value"), "known")).alias("known"))


@Q("ag14_resample", "WITH e AS (SELECT event_type, CAST(ceil(CAST(epoch_us(ts) // 1000000 AS DOUBLE) / 3600) * 3600 - 3600 AS BIGINT) AS bucket, value FROM events), s AS (SELECT event_type, bucket, sum(value) AS v FROM e GROUP BY ALL), r AS (SELECT event_type, unnest(range(min(bucket), max(bucket) + 3600, 3600)) AS bucket FROM s GROUP BY 1) SELECT r.event_type, r.bucket, round(coalesce(v, 0), 5) AS value FROM r LEFT JOIN s ON s.event_type = r.event_type AND s.bucket = r.bucket")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_type", F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), "ts") / 1_000_000).alias("ts_s"), "value")
    return windows.resample_sum(e, ["event_type"]).select("event_type", "bucket", F.round("value", 5).alias("value"))


def _scale(how: str, sql: str):
    @Q(f"ag15_scale_{how}", f"WITH {_SI}, n AS (SELECT *, count(*) OVER (PARTITION BY group_id, channel) AS n FROM i), w AS (SELECT *, unnest(range(0, n)) AS win FROM n), s AS (SELECT group_id, channel, win, {sql} AS sc FROM w WHERE win * 3 + 6 <= n AND idx BETWEEN win * 3 AND win * 3 + 5 GROUP BY ALL) SELECT group_id, channel, win, round(CASE WHEN sc = 0 THEN 1 ELSE sc END, 5) AS scale FROM s")
    def _(spark, sf):
        w = windows.window_points(windows.with_length(_sparse_idx(spark, sf), KEYS), 6, 3)
        return windows.window_scale(w, [*KEYS, "win"], how).withColumn("scale", F.round("scale", 5))


_scale("nonzero", "coalesce(avg(value) FILTER (value <> 0), 0) + 1")
_scale("positive", "coalesce(avg(value) FILTER (value > 0), 0)")
_scale("std", "coalesce(stddev_samp(value), 0)")


@Q("ag17_series_split", f"WITH {POINTS} SELECT group_id || '/' || channel AS series, count(*) AS n, min(ts_ms) AS first_ts, max(ts_ms) AS last_ts FROM p GROUP BY 1")
def _(spark, sf):
    return windows.split_series(points(spark, sf), KEYS).groupBy("series").agg(F.count("*").alias("n"), F.min("ts_ms").alias("first_ts"), F.max("ts_ms").alias("last_ts"))


@Q("so1_union_of_buckets", f"WITH {POINTS} SELECT DISTINCT group_id, ts_ms - ts_ms % 3600000 AS bucket FROM p")
def _(spark, sf):
    from chronosift.operators.align import snap

    return points(spark, sf).select("group_id", snap(F.col("ts_ms"), 3_600_000).alias("bucket")).distinct()


@Q("so4_unique_channels", "SELECT user_id, count(*) = count(DISTINCT event_type) AS ok FROM events GROUP BY 1")
def _(spark, sf):
    c = table(spark, sf, "events").groupBy("user_id").agg(F.collect_list("event_type").alias("c"))
    return c.select("user_id", (F.size(F.array_distinct("c")) == F.size("c")).alias("ok"))


# ---- data sets

_SPEC = datasets.DatasetSpec(seq_len=4, label_len=2, pred_len=2)
_PARTS = "parts AS (SELECT 'train' AS part, 0.0 AS lo, 1 AS k UNION ALL SELECT 'val', 0, 2 UNION ALL SELECT 'test', 0, 3)"
_CUT = "CASE part WHEN 'train' THEN idx < floor(n * 0.7) WHEN 'val' THEN idx >= floor(n * 0.7) - 4 AND idx < n - floor(n * 0.2) ELSE idx >= n - floor(n * 0.2) - 4 END"


@Q("ds3_split_by_share", f"WITH {_IDX}, {_PARTS}, st AS (SELECT group_id, channel, avg(value) AS m, CASE WHEN stddev_pop(value) = 0 THEN 1 ELSE stddev_pop(value) END AS sd FROM i WHERE idx < floor(n * 0.7) GROUP BY ALL) SELECT part, group_id, channel, idx, round((value - m) / sd, 5) AS scaled FROM i JOIN st USING (group_id, channel) CROSS JOIN parts WHERE {_CUT}")
def _(spark, sf):
    out = datasets.prepare(points(spark, sf), _SPEC, KEYS, ["ts_ms", "value"])
    return out.select("part", *KEYS, "idx", F.round("scaled", 5).alias("scaled"))


@Q("ds6_sample_counts", f"WITH {_IDX}, {_PARTS}, st AS (SELECT group_id, channel FROM i WHERE idx < floor(n * 0.7) GROUP BY ALL) SELECT part, group_id, channel, count(*) AS rows, greatest(0, count(*) - 5) AS samples FROM i SEMI JOIN st USING (group_id, channel) CROSS JOIN parts WHERE {_CUT} GROUP BY ALL")
def _(spark, sf):
    out = datasets.prepare(points(spark, sf), _SPEC, KEYS, ["ts_ms", "value"])
    return datasets.sample_counts(out, _SPEC, KEYS)


@Q("ds7_drop_last", f"WITH {_IDX}, {_PARTS}, st AS (SELECT group_id, channel FROM i WHERE idx < floor(n * 0.7) GROUP BY ALL), c AS (SELECT part, group_id, channel, greatest(0, count(*) - 5) AS s FROM i SEMI JOIN st USING (group_id, channel) CROSS JOIN parts WHERE {_CUT} GROUP BY ALL) SELECT part, CAST(sum(s // 4 * 4) AS BIGINT) AS samples FROM c GROUP BY 1")
def _(spark, sf):
    out = datasets.prepare(points(spark, sf), _SPEC, KEYS, ["ts_ms", "value"])
    return datasets.sample_counts(out, _SPEC, KEYS, 4).groupBy("part").agg(F.sum("samples").alias("samples"))


def _borders(name: str, per_hour: int, n: int):
    month = 720 * per_hour
    spec = datasets.DatasetSpec(split="months", per_hour=per_hour)
    sql = f"SELECT part, min(i) AS first, max(i) AS last, count(*) AS n FROM range(0, {n}) t(i), (VALUES ('train', 0, {12 * month}), ('val', {12 * month - 336}, {16 * month}), ('test', {16 * month - 336}, {20 * month})) b(part, lo, hi) WHERE i >= lo AND i < hi GROUP BY 1"

    @Q(name, sql)
    def _(spark, sf):
        rows = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("o"), (F.col("id") % 24).cast("double").alias("value"))
        return datasets.prepare(rows, spec, ["k"], ["o"]).groupBy("part").agg(F.min("idx").alias("first"), F.max("idx").alias("last"), F.count("*").alias("n"))


_borders("ds1_hourly_months", 1, 17_420)
_borders("ds2_quarter_hourly_months", 4, 69_680)


@Q("ds4_prediction_set", f"WITH {_IDX}, st AS (SELECT group_id, channel, avg(value) AS m, CASE WHEN stddev_pop(value) = 0 THEN 1 ELSE stddev_pop(value) END AS sd FROM i GROUP BY ALL) SELECT group_id, channel, idx, round((value - m) / sd, 5) AS scaled FROM i JOIN st USING (group_id, channel) WHERE idx >= n - 4")
def _(spark, sf):
    out = datasets.prediction_set(points(spark, sf), _SPEC, KEYS, ["ts_ms", "value"])
    return out.select(*KEYS, "idx", F.round("scaled", 5).alias("scaled"))


@Q("ds8_hourly_load", "WITH e AS (SELECT event_type, CAST(ceil(CAST(epoch_us(ts) // 1000000 AS DOUBLE) / 3600) * 3600 - 3600 AS BIGINT) AS bucket, value FROM events), s AS (SELECT event_type, bucket, sum(value) AS v FROM e GROUP BY ALL), r AS (SELECT event_type, unnest(range(min(bucket), max(bucket) + 3600, 3600)) AS bucket FROM s GROUP BY 1), d AS (SELECT r.event_type, r.bucket, coalesce(v, 0) AS value, row_number() OVER (PARTITION BY r.event_type ORDER BY r.bucket) - 1 AS i0 FROM r LEFT JOIN s ON s.event_type = r.event_type AND s.bucket = r.bucket), f AS (SELECT event_type, min(i0) FILTER (value <> 0) AS f0 FROM d GROUP BY 1), i AS (SELECT d.event_type, value, i0 - coalesce(f0, 0) AS idx, count(*) OVER (PARTITION BY d.event_type) AS n FROM d JOIN f ON f.event_type = d.event_type WHERE i0 >= coalesce(f0, 0)), w AS (SELECT *, unnest(range(0, n // 24 + 1)) AS win FROM i) SELECT event_type, win, count(*) AS n_points, round(sum(value), 4) AS total FROM w WHERE win * 24 + 48 <= n AND idx BETWEEN win * 24 AND win * 24 + 47 GROUP BY ALL")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_type", F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), "ts") / 1_000_000).alias("ts_s"), "value")
    return datasets.hourly_load(e, ["event_type"], 48, 24).groupBy("event_type", "win").agg(F.count("*").alias("n_points"), F.round(F.sum("value"), 4).alias("total"))


@Q("ds9_flow", f"WITH {_SPARSE}, g AS (SELECT group_id, channel FROM q GROUP BY ALL HAVING avg(CASE WHEN value = 0 THEN 1.0 ELSE 0 END) <= 0.2), k AS (SELECT * FROM q SEMI JOIN g USING (group_id, channel)), l AS (SELECT min(c) AS least FROM (SELECT count(*) AS c FROM k GROUP BY group_id, channel)), r AS (SELECT *, row_number() OVER (PARTITION BY group_id, channel ORDER BY ts_ms DESC, value DESC) AS rn FROM k) SELECT group_id, channel, count(*) AS n, round(sum(value), 5) AS total FROM r WHERE rn <= (SELECT least FROM l) GROUP BY ALL")
def _(spark, sf):
    out = datasets.flow(_sparse(spark, sf).withColumn("o", F.struct("ts_ms", "value")), KEYS, "o", 1, 1)
    return out.groupBy(*KEYS).agg(F.count("*").alias("n"), F.round(F.sum("value"), 5).alias("total"))


@Q("ds5_sinusoid_set", f"WITH {_IDX}, {_PARTS}, st AS (SELECT group_id, channel, avg(value) AS m, CASE WHEN stddev_pop(value) = 0 THEN 1 ELSE stddev_pop(value) END AS sd FROM i WHERE idx < floor(n * 0.7) GROUP BY ALL) SELECT part, group_id, channel, idx, round((value - m) / sd, 5) AS scaled, 0.0::DOUBLE AS mark FROM i JOIN st USING (group_id, channel) CROSS JOIN parts WHERE {_CUT}")
def _(spark, sf):
    out = datasets.sinusoid_set(points(spark, sf), _SPEC, KEYS, ["ts_ms", "value"])
    return out.select("part", *KEYS, "idx", F.round("scaled", 5).alias("scaled"), "mark")


_STEP = f"WITH {_SI}, n AS (SELECT *, count(*) OVER (PARTITION BY group_id, channel) AS n FROM i), w AS (SELECT *, unnest(range(0, n)) AS win FROM n), qq AS (SELECT *, idx - win * 3 AS pos FROM w WHERE win * 3 + 6 <= n AND idx BETWEEN win * 3 AND win * 3 + 5), s AS (SELECT group_id, channel, win, coalesce(avg(value) FILTER (value <> 0), 0) + 1 AS v FROM qq GROUP BY ALL), h AS (SELECT *, unnest(range(0, 2)) AS h FROM qq JOIN s USING (group_id, channel, win))"


def _single_step(kind: str, given: str, target: str):
    @Q(f"ds11_single_step_{kind}", _STEP + f" SELECT group_id, channel, win, h, round(sum(CASE WHEN pos - h = 4 THEN -1 ELSE {given} END), 7) AS given, round(sum({target}) FILTER (pos - h = 4), 7) AS target FROM h WHERE pos - h BETWEEN 0 AND 4 GROUP BY ALL")
    def _(spark, sf):
        w = windows.window_points(windows.with_length(_sparse_idx(spark, sf), KEYS), 6, 3)
        scale = windows.window_scale(w, [*KEYS, "win"], "nonzero").withColumnRenamed("scale", "v")
        out = datasets.single_step_test(w.join(scale, [*KEYS, "win"]), kind, 6, 2)
        return out.groupBy(*KEYS, "win", F.col("h").cast("long").alias("h")).agg(F.round(F.sum("value"), 7).alias("given"), F.round(F.sum("target"), 7).alias("target"))


_single_step("elect", "CASE WHEN v > 0 THEN value / v ELSE value END", "value")
_single_step("flow", "value", "value * v")


@Q("ds11_single_step_train", _STEP.rsplit(", h AS", 1)[0] + """, c AS (SELECT group_id || '/' || channel || '/' || win AS key, sum(v) OVER (ORDER BY md5(group_id || '/' || channel || '/' || win)) AS hi, sum(v) OVER () AS total FROM s),
 d AS (SELECT draw, ('0x' || substr(md5(draw || '/4'), 1, 8))::BIGINT / 4294967296.0 * (SELECT any_value(total) FROM c) AS x FROM (SELECT CAST(unnest(range(0, (SELECT count(*) FROM c))) AS BIGINT) AS draw))
 SELECT draw, arg_min(key, hi) AS key, 10 AS n, 2 AS targets FROM d JOIN c ON c.hi > d.x GROUP BY 1""")
def _(spark, sf):
    w = windows.window_points(windows.with_length(_sparse_idx(spark, sf), KEYS), 6, 3)
    scale = windows.window_scale(w, [*KEYS, "win"], "nonzero").withColumnRenamed("scale", "v")
    out = datasets.single_step_train(w, scale, [*KEYS, "win"], 6, 2, seed=4)
    return out.groupBy("draw", F.concat_ws("/", *KEYS, "win").alias("key")).agg(F.count("*").alias("n"), F.count("target").alias("targets"))


@Q("ds12_long_range_set", f"WITH {_SI}, n AS (SELECT *, count(*) OVER (PARTITION BY group_id, channel) AS n FROM i), b AS (SELECT group_id, channel, max(n) AS n, 6 + floor(0.9 * ((max(n) - 6) / 2.0)) * 2 AS train_end FROM n GROUP BY ALL), c AS (SELECT *, train_end - 4 + 1 AS test_start FROM b), ww AS (SELECT group_id, channel, 'train' AS part, unnest(range(0, CAST(greatest(0, floor((train_end - 6) / 2)) AS BIGINT))) AS win, 0 AS beg FROM c UNION ALL SELECT group_id, channel, 'test', unnest(range(0, CAST(greatest(0, floor((n - test_start - 6) / 2)) AS BIGINT))), test_start FROM c), x AS (SELECT ww.*, i.value, i.idx - (beg + win * 2) AS pos FROM ww JOIN i ON i.group_id = ww.group_id AND i.channel = ww.channel AND i.idx >= beg + win * 2 AND i.idx < beg + win * 2 + 6), m AS (SELECT *, avg(value) FILTER (pos < 4) OVER (PARTITION BY group_id, channel, part, win) AS mean FROM x) SELECT part, group_id, channel, win, count(*) AS n, round(sum(CASE WHEN mean > 0 THEN value / (mean + 1) ELSE value END), 5) AS total FROM m GROUP BY ALL")
def _(spark, sf):
    out = datasets.long_range_set(_sparse(spark, sf).withColumn("o", F.struct("ts_ms", "value")), KEYS, ["o"], 4, 2, stride=2)
    return out.groupBy("part", *KEYS, "win").agg(F.count("*").alias("n"), F.round(F.sum("scaled"), 5).alias("total"))
