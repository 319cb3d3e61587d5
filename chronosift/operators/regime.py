"""Two-state regime of each (entity, metric): a debounced machine over ordered ticks, and its window form without debouncing."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

REGIMES = ("normal", "incident")


def advance(regime: str, streak: int, forecast: str, recon: str, enter_after: int, exit_after: int) -> tuple[str, str, str, int]:
    """One tick of the machine: mode, severity, and regime and streak afterwards."""
    incident = regime == "incident"
    hit, need, other = (recon == "normal", exit_after, "normal") if incident else (forecast == "critical", enter_after, "incident")
    streak = streak + 1 if hit else 0
    after, streak = (other, 0) if streak >= need else (regime, streak)
    return ("detective", recon, after, streak) if incident else ("anticipation", forecast, after, streak)


def switch(ticks: DataFrame, keys: list[str], seq: str = "seq", enter_after: int = 1, exit_after: int = 1, seed: str | None = None) -> DataFrame:
    """keys, seq, mode (``anticipation`` or ``detective``: the face that judges the tick), regime after the tick and severity.

    In the normal regime the forecast face judges, and ``enter_after`` criticals in a row begin an incident; in an incident the reconstruction face
    judges, and ``exit_after`` normals in a row end it. ``seed`` names a column with the regime before the first tick (others than the two count as
    normal). Ticks of a key pass by in order, sorted on disk if need be; only regime and streak are held.
    """
    if min(enter_after, exit_after) < 1:
        raise ValueError("enter_after and exit_after must be 1 or more")
    kinds = dict(ticks.dtypes)
    start = F.col(seed).cast("string") if seed else F.lit("normal")
    ordered = ticks.select(*keys, F.col(seq).cast("bigint").alias(seq), "forecast_severity", "recon_severity", start.alias("_start")).repartition(*keys).sortWithinPartitions(*keys, seq)
    n = len(keys)

    def run(batches):
        last, regime, streak = None, "normal", 0
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                if row[:n] != last:
                    last, streak = row[:n], 0
                    regime = "incident" if row[-1] == "incident" else "normal"
                mode, severity, regime, streak = advance(regime, streak, row[n + 1], row[n + 2], enter_after, exit_after)
                out.append((*row[: n + 1], mode, regime, severity))
            yield pd.DataFrame(out, columns=[*keys, seq, "mode", "regime", "severity"])

    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + f", `{seq}` bigint, mode string, regime string, severity string"
    return ordered.mapInPandas(run, schema)


def switch_by_window(ticks: DataFrame, keys: list[str], seq: str = "seq", seed: str | None = None) -> DataFrame:
    """The same for enter_after = exit_after = 1 without arrays: each tick leaves, sets or swaps the regime, so the last setting tick and the
    parity of swaps since then tell it."""
    c, n = F.col("forecast_severity") == "critical", F.col("recon_severity") == "normal"
    order = Window.partitionBy(*keys).orderBy(seq)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    start = F.when(F.first(F.col(seed), ignorenulls=True).over(Window.partitionBy(*keys)) == "incident", 1).otherwise(0) if seed else F.lit(0)
    marked = ticks.withColumn("_set", F.when(c & ~n, 1).when(~c & n, 0)).withColumn("_swap", (c & n).cast("int")).withColumn("_start", start)
    marked = marked.withColumn("_swaps", F.sum("_swap").over(upto))
    base = F.last(F.when(F.col("_set").isNotNull(), F.struct(F.col("_set").alias("s"), F.col("_swaps").alias("k"))), ignorenulls=True).over(upto)
    after = marked.withColumn("_base", base)
    state = (F.coalesce(F.col("_base.s"), F.col("_start")) + F.col("_swaps") - F.coalesce(F.col("_base.k"), F.lit(0))) % 2
    after = after.withColumn("_state", state).withColumn("_prior", F.coalesce(F.lag("_state").over(order), F.col("_start")))
    name = lambda x: F.when(x == 1, "incident").otherwise("normal")
    return after.select(*keys, seq, F.when(F.col("_prior") == 1, "detective").otherwise("anticipation").alias("mode"), name(F.col("_state")).alias("regime"), F.when(F.col("_prior") == 1, F.col("recon_severity")).otherwise(F.col("forecast_severity")).alias("severity"))


def seeded(keys_df: DataFrame, latest: DataFrame, keys: tuple[str, str] = ("entity_uid", "metric_name")) -> DataFrame:
    """``start_regime`` for each key from the newest stored signal's regime label; normal where there is none or it is unknown."""
    found = latest.select(*keys, F.col("labels")["regime"].alias("r"))
    return keys_df.join(found, list(keys), "left").withColumn("start_regime", F.when(F.col("r").isin(*REGIMES), F.col("r")).otherwise("normal")).drop("r")
