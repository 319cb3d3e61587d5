"""Row shapes of the engine and the rules that rows must meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Severities in ascending order, horizons, the metric name of entity roll-ups.
SEVERITIES = ("normal", "warning", "critical")
HORIZONS = ("", "short", "medium", "long")
ENTITY_METRIC = "__entity__"

_LABELS = T.MapType(T.StringType(), T.StringType())

PIVOT = T.StructType(
    [
        T.StructField("group_id", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("channels", T.ArrayType(T.StringType())),
        T.StructField("values", T.ArrayType(T.DoubleType())),
        T.StructField("labels", _LABELS),
    ]
)

SIGNAL = T.StructType(
    [
        T.StructField("entity_uid", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("severity", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("method", T.StringType()),
        T.StructField("horizon", T.StringType()),
        T.StructField("n_points", T.LongType()),
        T.StructField("labels", _LABELS),
        T.StructField("text", T.StringType()),
    ]
)

SERIES = T.StructType([T.StructField("labels", _LABELS), T.StructField("samples", T.ArrayType(T.StructType([T.StructField("ts_ms", T.LongType()), T.StructField("value", T.DoubleType())])))])


def severity_rank(severity: Column) -> Column:
    """0, 1, 2 for normal, warning, critical; null for anything else."""
    position = F.array_position(F.array(*map(F.lit, SEVERITIES)), severity)
    return F.when(position > 0, position - 1)


def pivot_problem(channels: str = "channels", values: str = "values", group: str = "group_id", ts: str = "ts_ms") -> Column:
    """What is wrong with a pivot row, null if nothing is."""
    return (
        F.when(F.coalesce(F.col(group), F.lit("")) == "", "empty group_id")
        .when(F.col(ts).isNull(), "no timestamp")
        .when(F.size(channels) != F.size(values), "values do not match channels")
        .when(F.size(F.array_distinct(channels)) != F.size(channels), "channels repeat")
    )


def signal_problem() -> Column:
    """What is wrong with a signal row, null if nothing is."""
    return (
        F.when(F.coalesce(F.col("entity_uid"), F.lit("")) == "", "empty entity_uid")
        .when(F.col("ts").isNull(), "no timestamp")
        .when(~F.coalesce(F.col("severity"), F.lit("?")).isin(*SEVERITIES), "unknown severity")
        .when(~F.coalesce(F.col("horizon"), F.lit("")).isin(*HORIZONS), "unknown horizon")
    )


def checked(df: DataFrame, problem: Column) -> DataFrame:
    """Fail the job on the first bad row."""
    return df.where(F.when(problem.isNotNull(), F.raise_error(problem)).otherwise(F.lit(True)))


def quarantine(df: DataFrame, problem: Column) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with their problem."""
    marked = df.withColumn("problem", problem)
    return marked.where("problem IS NULL").drop("problem"), marked.where("problem IS NOT NULL")


def ts_ms(ts: Column) -> Column:
    """Epoch milliseconds, rounded down, of a timestamp without zone, whatever the session's zone."""
    return F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts.cast("timestamp_ntz")) / 1000).cast("long")


def sorted_labels(labels: Column) -> Column:
    """The map with its keys in order."""
    return F.map_from_entries(F.array_sort(F.map_entries(labels)))


def labels_json(labels: Column) -> Column:
    """A label map as JSON with sorted keys."""
    return F.to_json(sorted_labels(labels))


def label_value(pair: Column) -> Column:
    """The value of a ``key=value`` text: all behind the first =, empty without one."""
    return F.coalesce(F.get(F.split(pair, "=", 2), F.lit(1)), F.lit(""))


def thousandths(x: Column) -> Column:
    """The number to three decimals, as printing its exact binary value gives them: halves that only a decimal reading has aren't ties.

    x * 1000 is split into a rounded product and its exact error, which decides at halves; real ties go to the even digit.
    """
    p = x * F.lit(1000.0)
    c = x * F.lit(134217729.0)
    high = c - (c - x)
    error = (high * F.lit(1000.0) - p) + (x - high) * F.lit(1000.0)
    low = F.floor(p)
    over = p - low
    up = (over > 0.5) | ((over == 0.5) & ((error > 0) | ((error == 0) & (F.pmod(low, F.lit(2)) == 1))))
    k = F.abs(low + F.when(up, 1).otherwise(0))
    sign = F.when((x < 0) & (k > 0), "-").otherwise("")
    whole = F.concat(sign, F.floor(k / 1000).cast("string"), F.lit("."), F.lpad((k % 1000).cast("string"), 3, "0"))
    return F.when(F.isnan(x) | (F.abs(x) >= 1e12), F.format_string("%.3f", x)).otherwise(whole)


def merge_labels(old: Column, new: Column) -> Column:
    """Both maps, the new one's values where keys meet."""
    return F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k)), new)


def signal_text(metric: Column, entity: Column, horizon: Column, severity: Column, score: Column, method: Column, n_points: Column) -> Column:
    """One line that tells a signal."""
    has_horizon = F.coalesce(horizon, F.lit("")) != ""
    return F.concat(
        F.lit("signal metric="), metric, F.lit(" entity="), entity, F.when(has_horizon, F.concat(F.lit(" horizon="), horizon)).otherwise(""),
        F.lit(" severity="), severity, F.lit(" score="), thousandths(score.cast("double")), F.lit(" method="), method, F.lit(" n="), n_points.cast("string"),
    )


def as_signals(df: DataFrame, now_ms: int | Column) -> DataFrame:
    """Columns of SIGNAL from (entity_uid, metric_name, severity, score, method, n_points[, horizon, labels])."""
    have = set(df.columns)
    horizon = F.col("horizon") if "horizon" in have else F.lit("")
    labels = F.col("labels") if "labels" in have else F.create_map().cast("map<string,string>")
    return df.select(
        "entity_uid", "metric_name", (F.lit(now_ms) if isinstance(now_ms, int) else now_ms).cast("long").alias("ts"), "severity", F.col("score").cast("double").alias("score"), "method",
        horizon.alias("horizon"), F.col("n_points").cast("long").alias("n_points"), labels.alias("labels"),
        signal_text(F.col("metric_name"), F.col("entity_uid"), horizon, F.col("severity"), F.col("score"), F.col("method"), F.col("n_points")).alias("text"),
    )
