"""Fixed and adaptive thresholds over a series of scores for each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronosift.operators.detect import R_CRITICAL, R_WARNING, cut_above, cut_at_least

#: Fixed values of the adaptive policies.
WINDOW, MIN_HISTORY = 64, 16
WARN_Q, CRIT_Q = 0.95, 0.99
K_WARN, K_CRIT, MAD_SCALE, MAD_FLOOR = 3.0, 5.0, 1.4826, 1e-8


def _history(keys: list[str], order: list[str], window: int):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(-window, -1)


def fixed(scores: DataFrame, warning: float = R_WARNING, critical: float = R_CRITICAL, score: str = "score") -> DataFrame:
    return scores.withColumn("severity", cut_at_least(F.col(score), warning, critical))


def rolling_quantile(scores: DataFrame, keys: list[str], order: list[str], window: int = WINDOW, min_history: int = MIN_HISTORY, warning: float = R_WARNING, critical: float = R_CRITICAL, warn_q: float = WARN_Q, crit_q: float = CRIT_Q, score: str = "score") -> DataFrame:
    """Cuts are quantiles of the key's last scores before this one; until there are enough the fixed cuts hold, exclusively too."""
    h = _history(keys, order, window)
    warm = F.count(score).over(h) >= min_history
    out = scores.withColumn("warn_cut", F.when(warm, F.percentile(score, warn_q).over(h)).otherwise(F.lit(warning))).withColumn("crit_cut", F.when(warm, F.percentile(score, crit_q).over(h)).otherwise(F.lit(critical)))
    return out.withColumn("severity", cut_above(F.col(score), F.col("warn_cut"), F.col("crit_cut")))


def _median(values: Column) -> Column:
    ordered, n = F.array_sort(values), F.size(values)
    low, high = F.get(ordered, F.floor((n - 1) / 2).cast("int")), F.get(ordered, F.floor(n / 2).cast("int"))
    return (low + high) / 2


def mad(scores: DataFrame, keys: list[str], order: list[str], window: int = WINDOW, min_history: int = MIN_HISTORY, warning: float = R_WARNING, critical: float = R_CRITICAL, k_warn: float = K_WARN, k_crit: float = K_CRIT, score: str = "score") -> DataFrame:
    """Cuts are median + k spreads of the key's last scores, a spread being the scaled median absolute deviation."""
    h = _history(keys, order, window)
    out = scores.withColumn("past", F.collect_list(score).over(h)).withColumn("mid", _median(F.col("past")))
    out = out.withColumn("spread", F.greatest(_median(F.transform("past", lambda x: F.abs(x - F.col("mid")))) * MAD_SCALE, F.lit(0.0)))
    spread, warm = F.when(F.col("spread") > 0, F.col("spread")).otherwise(MAD_FLOOR), F.size("past") >= min_history
    out = out.withColumn("warn_cut", F.when(warm, F.col("mid") + k_warn * spread).otherwise(F.lit(warning))).withColumn("crit_cut", F.when(warm, F.col("mid") + k_crit * spread).otherwise(F.lit(critical)))
    return out.withColumn("severity", cut_above(F.col(score), F.col("warn_cut"), F.col("crit_cut"))).drop("past", "mid", "spread")


POLICIES = {"fixed": fixed, "rolling-quantile": rolling_quantile, "mad": mad}
