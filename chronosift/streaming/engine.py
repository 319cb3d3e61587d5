"""Event-time windows over streams of points: the batch transform, run for each micro-batch or pane."""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from chronosift.operators import detect
from chronosift.operators import regime as machine
from chronosift.storage import laid_down

POINTS = "group_id string, channel string, ts_ms long, value double"
#: Keys of state machines and panes are dealt to so many states; a stream keeps its number for as long as its checkpoint.
BUCKETS = 512


@dataclasses.dataclass(frozen=True)
class WindowSpec:
    """Sliding windows of whole seconds. ``early_every`` and ``late_every`` fire a pane after so many elements; ``accumulating`` panes hold all
    of a window's elements so far, discarding ones those since the last pane."""

    size_s: int = 60
    period_s: int = 30
    lateness_s: int = 0
    accumulating: bool = True
    early_every: int | None = None
    late_every: int | None = None

    def __post_init__(self) -> None:
        if self.size_s <= 0 or self.period_s <= 0:
            raise ValueError("size_s and period_s must be above 0")
        if int(self.size_s) != self.size_s or int(self.period_s) != self.period_s:
            raise ValueError("size_s and period_s are whole seconds")
        if self.lateness_s < 0:
            raise ValueError("lateness_s must not be below 0")
        if any(n is not None and n < 1 for n in (self.early_every, self.late_every)):
            raise ValueError("early_every and late_every must be 1 or more")

    @property
    def tumbling(self) -> bool:
        return self.size_s == self.period_s


def stamped(points: DataFrame) -> DataFrame:
    return points.withColumn("event_time", F.timestamp_millis("ts_ms"))


def replay(spark: SparkSession, folder: str, schema: str = POINTS, files: int = 1) -> DataFrame:
    """Parquet files of a folder as a stream, one file or ``files`` a micro-batch in order of modification."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("recursiveFileLookup", "true").parquet(folder)


def record(points: DataFrame, folder: str, parts: int = 4, late: Column | None = None) -> None:
    """Long points as files to ``replay``, in order of time; rows where ``late`` holds come last, in a file of their own.

    Each part is one job, as the files' times give their order.
    """
    rows = points.select(*[c.split()[0] for c in POINTS.split(", ")]).withColumn("_late", F.coalesce(late, F.lit(False)) if late is not None else F.lit(False))
    with laid_down(rows) as rows:
        low, high = rows.where("NOT _late").agg(F.min("ts_ms"), F.max("ts_ms")).first()
        if low is not None:
            step = (high - low) // parts + 1
            for i in range(parts):
                part = rows.where(~F.col("_late") & (F.col("ts_ms") >= low + i * step) & (F.col("ts_ms") < low + (i + 1) * step))
                part.drop("_late").coalesce(1).write.mode("overwrite").parquet(f"{folder}/{i:05d}")
        if late is not None:
            rows.where("_late").drop("_late").coalesce(1).write.mode("overwrite").parquet(f"{folder}/{parts:05d}")


def windowed_points(points: DataFrame, spec: WindowSpec) -> DataFrame:
    """(group_id, channel, win_start, win_end, pts) for each window of a stream or table, pts ordered by time and value; in ms."""
    rows = stamped(points)
    if points.isStreaming:
        rows = rows.withWatermark("event_time", f"{spec.lateness_s} seconds")
    w = F.window("event_time", f"{spec.size_s} seconds", f"{spec.period_s} seconds")
    series = rows.groupBy("group_id", "channel", w.alias("w")).agg(F.array_sort(F.collect_list(F.struct("ts_ms", "value"))).alias("pts"))
    return series.select("group_id", "channel", F.unix_millis(F.col("w.start")).alias("win_start"), F.unix_millis(F.col("w.end")).alias("win_end"), "pts")


def windowed_zscore(points: DataFrame, spec: WindowSpec, streaming: bool = True) -> DataFrame:
    """z-score rows for each (group, channel, window), the same expressions in both modes. A window's points are held as one array."""
    rows = stamped(points)
    if streaming:
        rows = rows.withWatermark("event_time", f"{spec.lateness_s} seconds")
    w = F.window("event_time", f"{spec.size_s} seconds", f"{spec.period_s} seconds")
    series = rows.groupBy("group_id", "channel", w.alias("w")).agg(F.array_sort(F.collect_list(F.struct("ts_ms", "value"))).alias("pts"))
    v = F.col("pts.value")
    n = F.size(v)
    out = series.withColumn("n", n).withColumn("mu", F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / n)
    out = out.withColumn("sd", F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + (x - F.col("mu")) * (x - F.col("mu"))) / n))
    tail = F.slice(v, F.greatest(F.lit(1), n - F.greatest(F.lit(1), F.floor(n * detect.Z_RECENT).cast("int")) + 1), n)
    raw = F.when((n >= detect.Z_MIN_POINTS) & (F.col("sd") >= detect.Z_FLAT), F.array_max(F.transform(tail, lambda x: F.abs(x - F.col("mu")) / F.col("sd")))).otherwise(0.0)
    out = out.withColumn("raw", raw)
    return out.select(F.col("group_id").alias("entity_uid"), F.col("channel").alias("metric_name"), F.unix_millis(F.col("w.start")).alias("win_start"), F.unix_millis(F.col("w.end")).alias("ts"), detect.cut_at_least(F.col("raw"), detect.Z_WARNING, detect.Z_CRITICAL).alias("severity"), F.round("raw", 4).alias("score"), F.lit("zscore").alias("method"), F.col("n").cast("long").alias("n_points"))


def _in_buckets(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Rows with the number of their key's bucket. A bucket's keys are advanced in one call of Python and kept in one state, since a call for each key costs more than its rows."""
    if buckets < 1:
        raise ValueError("buckets must be 1 or more")
    return rows.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets))).groupBy("_bucket")


_KEPT = "kept binary"


def _load(state: GroupState) -> pa.Table | None:
    return pa.ipc.open_stream(bytes(state.get[0])).read_all() if state.exists else None


def _save(state: GroupState, **columns: pa.Array) -> None:
    batch = pa.record_batch(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    state.update((sink.getvalue().to_pybytes(),))


def _codes(columns: list[list[pd.Series]]) -> tuple[np.ndarray, int]:
    """Numbers of keys, whose columns come in parts, in order of appearance; nulls are a value like others."""
    code = np.zeros(sum(map(len, columns[0])), np.int64)
    for parts in columns:
        own, values = pd.factorize(np.concatenate([x.to_numpy() for x in parts]), use_na_sentinel=False)
        code, known = pd.factorize(code * len(values) + own)
    return code, len(known) if len(code) else 0


def counted_panes(points: DataFrame, spec: WindowSpec, buckets: int = BUCKETS) -> DataFrame:
    """Panes fired by element counts: (group_id, channel, win_start, pane, kind, n, total). A window is kept as four numbers and its time, whatever it holds."""
    rows = stamped(points).withWatermark("event_time", f"{spec.lateness_s} seconds")
    step, size = spec.period_s * 1000, spec.size_s * 1000
    last = F.col("ts_ms") - F.pmod("ts_ms", F.lit(step))
    starts = F.filter(F.sequence(last - (size // step) * step, last, F.lit(step).cast("long")), lambda s: s + size > F.col("ts_ms"))
    keyed = rows.withColumn("win_start", F.explode(starts))
    early, late, keep = spec.early_every, spec.late_every, spec.accumulating
    names = ["group_id", "channel", "win_start"]
    kinds = dict(group_id=pa.string(), channel=pa.string(), win_start=pa.int64(), n=pa.int64(), total=pa.float64(), pane=pa.int64(), waiting=pa.int64(), due=pa.int64())

    def fire(_, batches: Iterator[pd.DataFrame], state: GroupState):
        had = _load(state)
        windows = {} if had is None else {tuple(w[:3]): w[3:] for w in map(list, zip(*had.to_pydict().values(), strict=True))}
        now = state.getCurrentWatermarkMs()
        met = set()
        for pdf in batches if not state.hasTimedOut else ():
            out = []
            code, _ = _codes([[pdf[k]] for k in names])
            order = np.lexsort((pdf["value"].to_numpy(float), pdf["ts_ms"].to_numpy(), code))
            cuts = np.flatnonzero(np.diff(code[order], prepend=-1, append=-1))
            firsts = order[cuts[:-1]]
            values = pdf["value"].to_numpy(float)[order].tolist()
            for *key, a, b in zip(*[pdf[k].to_numpy()[firsts].tolist() for k in names], cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                key = tuple(key)
                n, total, pane, waiting, _ = windows.get(key, (0, 0.0, 0, 0, 0))
                end = key[2] + size
                kind, every = ("late", late) if now >= end else ("early", early)
                for v in values[a:b]:
                    n, total, waiting = n + 1, total + v, waiting + 1
                    if every and waiting >= every:
                        out.append((*key, pane, kind, n, total))
                        pane, waiting = pane + 1, 0
                        n, total = (n, total) if keep else (0, 0.0)
                windows[key] = [n, total, pane, waiting, max(end + spec.lateness_s * 1000, now + 1)]
                met.add(key)
            yield pd.DataFrame(out, columns=[*names, "pane", "kind", "n", "total"])
        over = [k for k, w in windows.items() if w[4] < now and k not in met]
        out = [(*k, w[2], "on_time", w[0], w[1]) for k in over for w in [windows.pop(k)] if w[3]]
        if windows:
            columns = zip(*((*k, *w) for k, w in windows.items()), strict=True)
            _save(state, **{c: pa.array(x, t) for (c, t), x in zip(kinds.items(), columns, strict=True)})
            state.setTimeoutTimestamp(min(w[4] for w in windows.values()))
        else:
            state.remove()
        yield pd.DataFrame(out, columns=[*names, "pane", "kind", "n", "total"])

    return _in_buckets(keyed, names, buckets).applyInPandasWithState(fire, "group_id string, channel string, win_start long, pane int, kind string, n int, total double", _KEPT, "append", GroupStateTimeout.EventTimeTimeout)


_SERIES = ["entity_uid", "metric_name"]


def _whole(batches: Iterator[pd.DataFrame], had: pa.Table | None) -> tuple[pd.DataFrame, np.ndarray, int, list[pd.Series]]:
    """A bucket's new rows in order of key and ``seq``, the numbers of their keys, how many keys there are, and their names; those that were kept come first."""
    new = pd.concat(list(batches), ignore_index=True)
    before = [[] if had is None else [had[k].to_pandas()] for k in _SERIES]
    code, n = _codes([[*b, new[k]] for k, b in zip(_SERIES, before, strict=True)])
    first = np.zeros(n, np.int64)
    first[code[::-1]] = np.arange(len(code))[::-1]
    names = [pd.concat([*b, new[k]], ignore_index=True).iloc[first] for k, b in zip(_SERIES, before, strict=True)]
    own = code[len(code) - len(new) :]
    order = np.lexsort((new["seq"].to_numpy(), own))
    return new.iloc[order], own[order], n, names


def streaming_regime(ticks: DataFrame, enter_after: int = 1, exit_after: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """The regime machine over a stream of ticks (entity_uid, metric_name, seq, forecast_severity, recon_severity). Keys that are as at the start are not kept."""

    def advance(_, batches: Iterator[pd.DataFrame], state: GroupState):
        had = _load(state)
        rows, code, n, names = _whole(batches, had)
        regimes, streaks = ["normal"] * n, [0] * n
        if had is not None:
            regimes[: len(had)], streaks[: len(had)] = had["regime"].to_pylist(), had["streak"].to_pylist()
        modes, after = [], []
        for k, forecast, recon in zip(code.tolist(), rows["forecast_severity"].tolist(), rows["recon_severity"].tolist(), strict=True):
            mode, _, regimes[k], streaks[k] = machine.advance(regimes[k], streaks[k], forecast, recon, enter_after, exit_after)
            modes.append(mode)
            after.append(regimes[k])
        kept = [k for k in range(n) if streaks[k] or regimes[k] != "normal"]
        _save(state, **{c: pa.array(x.iloc[kept], pa.string()) for c, x in zip(_SERIES, names, strict=True)}, regime=pa.array([regimes[k] for k in kept], pa.string()), streak=pa.array([streaks[k] for k in kept], pa.int64()))
        yield rows[[*_SERIES, "seq"]].assign(mode=modes, regime=after)

    return _in_buckets(ticks, _SERIES, buckets).applyInPandasWithState(advance, "entity_uid string, metric_name string, seq long, mode string, regime string", _KEPT, "append", GroupStateTimeout.NoTimeout)


def streaming_quantile(scores: DataFrame, window: int = 64, min_history: int = 16, warning: float = 1.8, critical: float = 3.0, warn_q: float = 0.95, crit_q: float = 0.99, buckets: int = BUCKETS, margin: float = 0.0) -> DataFrame:
    """The rolling-quantile threshold over a stream of (entity_uid, metric_name, seq, score); of a key its last scores are kept.

    Scores that equal a quantile can be above it in the last bits, as it is interpolated; above means by more than ``margin``. Fixed cuts hold without it.
    Missing scores are normal and have their place among the last ones, but no part in quantiles and in ``min_history``.
    """

    def cuts(past):
        known = (~np.isnan(past)).sum(axis=1)
        past = np.sort(past, axis=1)  # missing ones come last
        both = np.tile([[warning], [critical]], len(past))
        for n in np.unique(known[known >= max(1, min_history)]).tolist():
            same = known == n
            both[:, same] = np.quantile(past[same, :n], (warn_q, crit_q), axis=1) + margin
        return both

    return _judged(scores, window, min_history, (warning, critical), cuts, buckets)


def streaming_mad(scores: DataFrame, window: int = 64, min_history: int = 16, warning: float = 1.8, critical: float = 3.0, warn_k: float = 3.0, crit_k: float = 5.0, buckets: int = BUCKETS) -> DataFrame:
    """The same with cuts some deviations (1.4826 times the median distance to the median) above the median."""

    def cuts(past):
        mid = np.median(past, axis=1)
        spread = 1.4826 * np.median(np.abs(past - mid[:, None]), axis=1)
        spread[spread == 0] = 1e-8
        return mid + warn_k * spread, mid + crit_k * spread

    return _judged(scores, window, min_history, (warning, critical), cuts, buckets)


def _judged(scores: DataFrame, window: int, min_history: int, fixed: tuple[float, float], cuts, buckets: int) -> DataFrame:
    """``cuts`` has the two cuts of each row of past scores; with fewer than ``min_history`` of them the fixed ones hold."""

    def judge(_, batches: Iterator[pd.DataFrame], state: GroupState):
        had = _load(state)
        rows, code, n, names = _whole(batches, had)
        past = had["past"].combine_chunks() if had is not None else pa.array([], pa.list_(pa.float64()))
        lengths = np.diff(past.offsets.to_numpy())
        both = np.concatenate([np.repeat(np.arange(len(past)), lengths), code])
        order = np.argsort(both, kind="stable")  # of each key the past, then the new rows as they are
        values = np.concatenate([past.values.to_numpy(zero_copy_only=False), rows["score"].to_numpy(float)])[order]
        counts = np.bincount(both, minlength=n)
        ends = np.cumsum(counts)
        at = np.flatnonzero(order >= len(both) - len(rows))  # where the new rows are, in their order
        history = np.minimum(at - (ends - counts)[code], window)
        warn, crit = np.full(len(rows), fixed[0]), np.full(len(rows), fixed[1])
        for h in np.unique(history[history >= max(1, min_history)]).tolist():
            same = np.flatnonzero(history == h)
            for some in np.array_split(same, len(same) * h // 1_000_000 + 1):
                warn[some], crit[some] = cuts(values[at[some][:, None] + np.arange(-h, 0)])
        score = values[at]
        left = np.minimum(counts, window)
        starts = np.concatenate([[0], np.cumsum(left)])
        last = np.arange(starts[-1]) + np.repeat(ends - left - starts[:-1], left)
        _save(state, **{c: pa.array(x, pa.string()) for c, x in zip(_SERIES, names, strict=True)}, past=pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values[last])))
        yield rows[[*_SERIES, "seq", "score"]].assign(severity=np.where(score > crit, "critical", np.where(score > warn, "warning", "normal")))

    return _in_buckets(scores, _SERIES, buckets).applyInPandasWithState(judge, "entity_uid string, metric_name string, seq long, score double, severity string", _KEPT, "append", GroupStateTimeout.NoTimeout)


def run_stream(df: DataFrame, write_batch, checkpoint: str, mode: str = "update", once: bool = True):
    """Start a query whose micro-batches go to ``write_batch(df, batch_id)``; with ``once`` all that is there is processed and the query ends."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    return (writer.trigger(availableNow=True) if once else writer).start()
