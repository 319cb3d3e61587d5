"""Windows over long series, splits of data sets, resampling and series filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronosift.storage import durable


def indexed(df: DataFrame, keys: list[str], order: list[str], name: str = "idx") -> DataFrame:
    """A running index from 0 within each key."""
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("long"))


def window_points(df: DataFrame, length: int, step: int = 1, n: str = "n", idx: str = "idx") -> DataFrame:
    """Each point once for every window it lies in: ``win`` (window number) and ``pos`` (place in it). Needs the index and the series' length; a point
    finds its windows by arithmetic, so no range join is made."""
    last = F.floor((F.col(n) - length) / step)
    low = F.greatest(F.lit(0), F.ceil((F.col(idx) - (length - 1)) / step))
    high = F.least(last, F.floor(F.col(idx) / step))
    wins = F.when((last >= 0) & (low <= high), F.sequence(low.cast("long"), high.cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn("win", F.explode(wins)).withColumn("pos", F.col(idx) - F.col("win") * step)


def with_length(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    return df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*keys)))


def sample_parts(points: DataFrame, seq_len: int, label_len: int, pred_len: int) -> DataFrame:
    """Rows of ``window_points`` (length seq_len + pred_len) as inputs x and targets y, which overlap by label_len: (part, step)."""
    x = points.where(F.col("pos") < seq_len).withColumn("part", F.lit("x")).withColumn("step", F.col("pos"))
    y = points.where(F.col("pos") >= seq_len - label_len).withColumn("part", F.lit("y")).withColumn("step", F.col("pos") - (seq_len - label_len))
    return x.unionByName(y)


#: 30-day months of train, validation and test data of the hourly benchmark.
MONTHS = (12, 4, 4)


def borders_by_months(seq_len: int, per_hour: int = 1) -> dict[str, tuple[int, int]]:
    """Row borders of the benchmark's splits; validation and test begin seq_len rows early."""
    month = 30 * 24 * per_hour
    a, b, c = MONTHS[0] * month, (MONTHS[0] + MONTHS[1]) * month, sum(MONTHS) * month
    return {"train": (0, a), "val": (a - seq_len, b), "test": (b - seq_len, c)}


def borders_by_share(n: Column, seq_len: int, train: float = 0.7, test: float = 0.2) -> dict[str, tuple[Column, Column]]:
    """The same by shares of the row count, rounded down."""
    a, t = F.floor(n * train).cast("long"), F.floor(n * test).cast("long")
    return {"train": (F.lit(0).cast("long"), a), "val": (a - seq_len, n - t), "test": (n - t - seq_len, n)}


def n_samples(length: Column, seq_len: int, pred_len: int) -> Column:
    return F.greatest(F.lit(0), length - seq_len - pred_len + 1)


def resample_sum(df: DataFrame, keys: list[str], step_s: int = 3600, ts_s: str = "ts_s", value: str = "value") -> DataFrame:
    """Sums over (t, t + step], labelled t; empty buckets between a key's first and last are 0."""
    label = (F.ceil(F.col(ts_s) / step_s) * step_s - step_s).cast("long")
    sums = df.groupBy(*keys, label.alias("bucket")).agg(F.sum(value).alias("value"))
    span = sums.groupBy(*keys).agg(F.explode(F.sequence(F.min("bucket"), F.max("bucket"), F.lit(step_s).cast("long"))).alias("bucket"))
    return span.join(sums, [*keys, "bucket"], "left").withColumn("value", F.coalesce("value", F.lit(0.0)))


def drop_mostly_zero(df: DataFrame, keys: list[str], share: float = 0.2, least: int = 0, value: str = "value") -> DataFrame:
    """Series with at most ``share`` zeros and at least ``least`` points."""
    good = df.groupBy(*keys).agg(F.avg((F.col(value) == 0).cast("double")).alias("z"), F.count("*").alias("c")).where((F.col("z") <= share) & (F.col("c") >= least))
    return df.join(good.select(*keys), keys, "left_semi")


def first_nonzero(df: DataFrame, keys: list[str], value: str = "value", idx: str = "idx") -> DataFrame:
    """Index of each series' first value that isn't 0, 0 if there is none."""
    return df.groupBy(*keys).agg(F.coalesce(F.min(F.when(F.col(value) != 0, F.col(idx))), F.lit(0).cast("long")).alias("first_idx"))


def from_latest_start(df: DataFrame, keys: list[str], limit: int, value: str = "value", idx: str = "idx") -> DataFrame:
    """Series that begin before ``limit``, all from the latest of their starts on."""
    starts = first_nonzero(df, keys, value, idx).where(F.col("first_idx") < limit)
    cut = starts.agg(F.max("first_idx").alias("cut"))
    return df.join(starts.select(*keys), keys, "left_semi").crossJoin(F.broadcast(cut)).where(F.col(idx) >= F.col("cut")).drop("cut")  # cut is one row


def right_aligned(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The newest points of each series, as many as the shortest has."""
    least = df.groupBy(*keys).count().agg(F.min("count").alias("least"))
    ranked = df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order))))
    return ranked.crossJoin(F.broadcast(least)).where(F.col("rn") <= F.col("least")).drop("rn", "least")  # least is one row


def window_scale(points: DataFrame, keys: list[str], how: str = "nonzero", value: str = "value") -> DataFrame:
    """Scale of each window: mean of non-zero values + 1, mean of positive values, mean + 1 or sample deviation; 0 becomes 1."""
    v = F.col(value)
    scale = {
        "nonzero": F.coalesce(F.avg(F.when(v != 0, v)), F.lit(0.0)) + 1,
        "positive": F.coalesce(F.avg(F.when(v > 0, v)), F.lit(0.0)),
        "mean": F.avg(v) + 1,
        "std": F.coalesce(F.stddev_samp(v), F.lit(0.0)),
    }[how]
    out = points.groupBy(*keys).agg(scale.alias("scale"))
    return out.withColumn("scale", F.when(F.col("scale") == 0, 1.0).otherwise(F.col("scale")))


def moving_average(df: DataFrame, keys: list[str], order: str, kernel: int, value: str = "value") -> DataFrame:
    """``trend`` (end values repeated at the edges) and ``residual`` in one window pass, no arrays."""
    front = (kernel - 1) // 2
    back = kernel - 1 - front
    part = Window.partitionBy(*keys)
    by = part.orderBy(order)
    whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rn, n = F.row_number().over(by), F.count(F.lit(1)).over(part)
    before, after = F.greatest(F.lit(0), front - (rn - 1)), F.greatest(F.lit(0), back - (n - rn))
    total = F.sum(value).over(by.rowsBetween(-front, back)) + before * F.first(value).over(whole) + after * F.last(value).over(whole)
    return df.withColumn("trend", total / kernel).withColumn("residual", F.col(value) - F.col("trend"))


def multi_trend(df: DataFrame, keys: list[str], order: str, kernels: list[int], weights: list[float], value: str = "value") -> DataFrame:
    """Weighted sum of moving averages, and what is left."""
    out = df
    for i, k in enumerate(kernels):
        out = moving_average(out, keys, order, k, value).withColumnRenamed("trend", f"_t{i}").drop("residual")
    trend = sum((F.col(f"_t{i}") * w for i, w in enumerate(weights)), F.lit(0.0))
    return out.withColumn("trend", trend).withColumn("residual", F.col(value) - F.col("trend")).drop(*[f"_t{i}" for i in range(len(kernels))])


def horizon_steps(windows: DataFrame, length: int, horizon: int, value: str = "value") -> DataFrame:
    """For each window of length + horizon - 1 points and horizon step h: ``length`` points from h on, the last masked with -1."""
    steps = windows.withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(horizon - 1)))).withColumn("at", F.col("pos") - F.col("h")).where((F.col("at") >= 0) & (F.col("at") < length))
    return steps.withColumn("target", F.when(F.col("at") == length - 1, F.col(value))).withColumn(value, F.when(F.col("at") == length - 1, -1.0).otherwise(F.col(value)))


def sliding(df: DataFrame, keys: list[str], ts_s: str, size_s: int, slide_s: int) -> DataFrame:
    """Each point once for every event-time window [start, start + size): ``win_start`` in seconds."""
    last = (F.col(ts_s) - F.pmod(F.col(ts_s), F.lit(slide_s))).cast("long")
    first = last - (size_s // slide_s - (0 if size_s % slide_s else 1)) * slide_s
    starts = F.filter(F.sequence(first, last, F.lit(slide_s).cast("long")), lambda s: s + size_s > F.col(ts_s))
    return df.withColumn("win_start", F.explode(starts))


def running_sum(df: DataFrame, keys: list[str], order: str, value: str = "value", name: str = "total") -> DataFrame:
    """The sum of a series up to each point."""
    return df.withColumn(name, F.sum(value).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def pooled(df: DataFrame, keys: list[str], size: int, how: str = "avg", idx: str = "idx", value: str = "value") -> DataFrame:
    """The next coarser level of a pyramid: mean or maximum of each whole group of ``size`` steps."""
    fn = {"avg": F.avg, "max": F.max}[how]
    out = df.groupBy(*keys, F.floor(F.col(idx) / size).alias(idx)).agg(fn(value).alias(value), F.count(F.lit(1)).alias("_n"))
    return out.where(F.col("_n") == size).drop("_n")


def date_range(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Rows from ``start`` to ``end``, both included; a filter that reaches the scan."""
    kind = dict(df.dtypes)[ts]
    return df.where(F.col(ts).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def split_series(df: DataFrame, keys: list[str], sep: str = "/") -> DataFrame:
    """The rows with the name of their series, dealt so that a series is in one partition and in order of time."""
    return df.withColumn("series", F.concat_ws(sep, *keys)).repartition("series")


def noise(keys: list[str], seed: int) -> Column:
    """A number in [0, 1) that hangs on the keys' values and the seed alone, the same in any plan and after any loss."""
    digest = F.md5(F.concat_ws("/", *keys, F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def shuffled_rank(df: DataFrame, keys: list[str], seed: int, name: str = "rank") -> DataFrame:
    """The place (from 0) of each row in a random order of all rows, given by the digest of its keys.

    Rows are dealt to ranges of the digest; the counts of the ranges give each its offset, so no task sees all rows.
    """
    digest = F.md5(F.concat_ws("/", *keys, F.lit(str(seed))))
    whole = df.withColumn("_d", digest)
    width = max(1, min(4, len(f"{df.count() // 50_000:x}")))  # 16, 256, 4096 or 65536 ranges
    whole = whole.withColumn("_r", F.substring("_d", 1, width))
    counts = whole.groupBy("_r").agg(F.count(F.lit(1)).alias("_c"))
    offsets = counts.select("_r", (F.sum("_c").over(Window.orderBy("_r")) - F.col("_c")).alias("_o"))  # at most 65536 rows
    within = F.row_number().over(Window.partitionBy("_r").orderBy("_d", *keys)) - 1
    return whole.withColumn("_w", within).join(F.broadcast(offsets), "_r").withColumn(name, (F.col("_o") + F.col("_w")).cast("long")).drop("_d", "_r", "_w", "_o")


def random_batches(df: DataFrame, keys: list[str], size: int, seed: int) -> DataFrame:
    """All rows in a random order, cut to batches of ``size``: batch and place in it."""
    ranked = shuffled_rank(df, keys, seed, "_rank")
    return ranked.withColumn("batch", F.floor(F.col("_rank") / size)).withColumn("place", F.pmod("_rank", F.lit(size))).drop("_rank")


def random_mask(patches: DataFrame, keys: list[str], patch: str, ratio: float, seed: int) -> DataFrame:
    """``masked`` for each patch: of a window's L patches the int(L * (1 - ratio)) of lowest noise are kept."""
    part = Window.partitionBy(*keys)
    rank = F.row_number().over(part.orderBy(noise([*keys, patch], seed), patch))
    kept = F.floor(F.count(F.lit(1)).over(part) * F.lit(1 - ratio) + 1e-9)
    return patches.withColumn("masked", rank > kept)


def ordinals(df: DataFrame, order: list[str], parts: int | None = None, name: str = "rn") -> DataFrame:
    """The place (from 1) of each row in the order of all rows. Ranges of the order are dealt once and kept, so that they are the same when
    they are read again; their counts give each its offset."""
    parts = parts or max(1, min(4096, df.count() // 50_000 + 1))
    dealt = durable(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_c"))
    before = counts.select("_part", (F.sum("_c").over(Window.orderBy("_part")) - F.col("_c")).alias("_o"))  # ``parts`` rows
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return dealt.withColumn("_w", within).join(F.broadcast(before), "_part").withColumn(name, (F.col("_o") + F.col("_w")).cast("long")).drop("_part", "_o", "_w")


def sample_with_replacement(df: DataFrame, n: int, weight: Column, seed: int, key: str) -> DataFrame:
    """``n`` draws in proportion to |weight|: seeded numbers are looked up in cumulative weights, the rows in order of ``key``'s digest.

    Rows are dealt to ranges of the digest; their sums (at most 65536) give each its offset, and a draw goes to its range. Within a range
    draws and rows are merged in order, so no task sees all rows and no range join is made on them. Draws and order hang on seed and keys alone.
    """
    spark = df.sparkSession
    width = max(1, min(4, len(f"{df.count() // 50_000:x}")))
    row = F.struct(*df.columns)
    dealt = df.select(row.alias("_row"), F.abs(weight).alias("_w"), F.md5(F.col(key).cast("string")).alias("_d")).where("_w > 0").withColumn("_part", F.substring("_d", 1, width))
    sums = dealt.groupBy("_part").agg(F.sum("_w").alias("_sum"))
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    spans = sorted(tuple(r) for r in sums.withColumn("_hi", F.sum("_sum").over(upto)).select("_part", "_sum", "_hi").collect())
    total = float(spans[-1][2]) if spans else 0.0
    table = F.broadcast(spark.createDataFrame([(p, float(hi - own), float(hi)) for p, own, hi in spans], "_part string, _lo double, _hi double"))
    inside = Window.partitionBy("_part").orderBy("_d").rowsBetween(Window.unboundedPreceding, 0)
    cum = dealt.join(table, "_part").select("_part", (F.col("_lo") + F.sum("_w").over(inside)).alias("_at"), F.lit(None).cast("long").alias("draw"), "_row")
    draws = spark.range(n).select(F.col("id").alias("draw")).select("draw", (noise(["draw"], seed) * F.lit(total)).alias("_at"))
    draws = draws.join(table, (F.col("_at") >= F.col("_lo")) & (F.col("_at") < F.col("_hi"))).select("_part", "_at", "draw")
    both = cum.unionByName(draws, allowMissingColumns=True)
    # a draw takes the first row whose cumulative weight is above it
    after = F.first(F.when(F.col("draw").isNull(), F.col("_row")), ignorenulls=True).over(Window.partitionBy("_part").orderBy("_at", F.asc_nulls_first("draw")).rowsBetween(1, Window.unboundedFollowing))
    found = both.withColumn("_row", F.coalesce("_row", after))
    return found.where("draw IS NOT NULL AND _row IS NOT NULL").select("draw", "_row.*")
