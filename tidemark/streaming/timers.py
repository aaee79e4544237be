"""Detectors and monitors on ``transformWithState``: state variables and event-time timers.

* ``rolling_detector_event_time``  a key's rows wait in state until the
  watermark passes them and are then scored in event-time order (K5);
* ``silent_sources_stream``        a row per source that has sent nothing for
  longer than a gap -- it comes from a timer, not from input (K9);
* ``split_late``                   rows behind the watermark as a table of their
  own, with the watermark they missed (K4).

Each key keeps one timer, at the earliest moment it has something to do, so a
micro-batch touches the keys with input and the keys whose timer the watermark has
passed, never all of them.  State variables need the RocksDB state store, which the
two detectors set in the session; state is versioned by the query's checkpoint, and a
restarted query goes on from it.

Spark drops rows behind the watermark before a timer-driven operator sees them;
``split_late`` in front keeps them.  A stream that ends leaves rows younger than
the watermark in state; a heartbeat row (any key, a later time) lets the watermark
pass them.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.session import scratch_path, use_rocksdb_state
from tidemark.streaming.stateful import _from_ipc, _ms, _score, _to_ipc


class _Timed(StatefulProcessor):
    """One timer per key, at the earliest time asked for."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.timer = handle.getValueState("timer", "at long")

    def wake(self, at: int) -> None:
        held = self.timer.get()
        if held is not None and held[0] <= at:
            return
        if held is not None:
            self.handle.deleteTimer(held[0])
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def close(self) -> None:
        pass


#: rows sorted together before they go into state, and of one run there
DEAL_ROWS, RUN_ROWS = 200_000, 4_000
#: due rows that are scored together, about
SCORE_ROWS = 20_000
#: a row's place in the order of arrival
ARRIVAL = "_arrival"


class _Rolling(_Timed):
    """The buffer detector: the last ``window - 1`` values, the number seen, and the rows not yet due in runs sorted by
    time. Due runs are read from the earliest on, so a worker holds those that overlap in time and never all of a key."""

    def __init__(self, time_col, tie, value, cols, method, threshold, window, gate):
        self.order, self.value, self.cols = [time_col, tie], value, cols
        self.method, self.threshold, self.window, self.gate = method, threshold, window, gate

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.vals = handle.getListState("vals", "v double")
        self.seen = handle.getValueState("seen", "n long")
        self.arrived = handle.getValueState("arrived", "n long")
        self.runs = handle.getMapState("runs", "first long, n long", "rows binary")

    def _keep(self, rows: pd.DataFrame) -> None:
        """Rows that carry their arrival, as sorted runs under their first time."""
        rows = rows.sort_values([self.order[0], ARRIVAL]).reset_index(drop=True)
        ms = _ms(rows[self.order[0]]).to_numpy()
        for at in range(0, len(rows), RUN_ROWS):
            run = rows.iloc[at:at + RUN_ROWS]
            self.runs.updateValue((int(ms[at]), int(run[ARRIVAL].iloc[0])), (_to_ipc(run),))
        self.wake(int(ms[0]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n = self.arrived.get()
        n, held, size = 0 if n is None else int(n[0]), [], 0
        for new in rows:
            timed = new[self.order[0]].notna()
            if not timed.all():  # a row without a time has no place in a series
                yield self._out(new[~timed], False, 0.0, "statistical")
                new = new[timed]
            if not len(new):
                continue
            held.append(new.assign(**{ARRIVAL: np.arange(n, n + len(new))}))
            n, size = n + len(new), size + len(new)
            if size >= DEAL_ROWS:
                self._keep(pd.concat(held, ignore_index=True))
                held, size = [], 0
        if size:
            self._keep(pd.concat(held, ignore_index=True))
        self.arrived.update((n,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        wm = timerValues.getCurrentWatermarkInMs()
        runs = sorted((int(k[0]), int(k[1])) for k in self.runs.keys())
        due, later = [r for r in runs if r[0] <= wm], [r for r in runs if r[0] > wm]
        held, size, most = [], 0, SCORE_ROWS
        for i, run in enumerate(due):
            held.append(_from_ipc(self.runs.getValue(run)[0]))
            self.runs.removeKey(run)
            size, last = size + len(held[-1]), i + 1 == len(due)
            if not last and size < most:
                continue
            rows = pd.concat(held, ignore_index=True)
            # a run yet to be read begins no earlier than the next one
            ready = (_ms(rows[self.order[0]]) < (wm + 1 if last else due[i + 1][0])).to_numpy()
            held, size = [] if ready.all() else [rows[~ready]], int((~ready).sum())
            most = SCORE_ROWS + 2 * size
            if ready.any():
                yield self._score(rows[ready])
        if held:
            self._keep(held[0])
        if later:
            self.wake(later[0][0])

    def _score(self, ready: pd.DataFrame) -> pd.DataFrame:
        ready = ready.sort_values([*self.order, ARRIVAL])
        seen = self.seen.get()
        seen = 0 if seen is None else int(seen[0])
        prev = np.array([v[0] for v in self.vals.get()], dtype=float) if self.vals.exists() else np.zeros(0)
        arr = np.concatenate([prev, ready[self.value].to_numpy(dtype=float)])
        flags, scores, kinds = _score(arr, len(prev), seen, self.window, self.threshold, self.gate, self.method)
        keep = arr[-(self.window - 1):] if self.window > 1 else arr[:0]
        if len(keep):
            self.vals.put([(float(v),) for v in keep])
        self.seen.update((seen + len(ready),))
        return self._out(ready, flags, scores, kinds)

    def _out(self, rows: pd.DataFrame, flags, scores, kinds) -> pd.DataFrame:
        out = rows[self.cols].copy()
        out["is_anomaly"], out["anomaly_score"], out["anomaly_type"] = flags, scores, kinds
        return out


def rolling_detector_event_time(df: DataFrame, keys: Sequence[str], time_col: str, tie: str, value: str = "value",
                                method: str = "zscore", threshold: float = 3.0, window_size: int = 100,
                                min_history: int = 10, watermark: str = "30 seconds") -> DataFrame:
    """A key's rows wait in state until the watermark passes them, then are scored in
    ``(time_col, tie)`` order: any arrival order within the watermark delay gives the
    batch result.  ``time_col`` must be a ``timestamp`` column; a row without a time is
    passed through unscored.  NULL and NaN values score 0.0 and are left out of frames.
    Rows not yet due are kept as sorted runs of Arrow IPC bytes, bounded by delay x key rate, and read run by run."""
    schema = T.StructType(df.schema.fields + [
        T.StructField("is_anomaly", T.BooleanType()), T.StructField("anomaly_score", T.DoubleType()),
        T.StructField("anomaly_type", T.StringType())])
    use_rocksdb_state(df.sparkSession)
    processor = _Rolling(time_col, tie, value, df.columns, method, threshold, window_size, min_history)
    return (df.withWatermark(time_col, watermark).groupBy(*keys)
            .transformWithStateInPandas(processor, schema, "append", "eventTime"))


def _spans(start: np.ndarray, end: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans of time in order, those joined that are no more than ``gap`` apart."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.concatenate(([True], start[1:] - end[:-1] > gap))[:len(start)]
    return start[first], end[np.append(first[1:], True)[:len(end)]]


class _Silence(_Timed):
    """The time of the last row, whether its silence was told, and the times not yet due (microseconds): as spans without
    a silence inside, since only their ends can be told."""

    def __init__(self, names: list[str], time_col: str, gap_us: int):
        self.names, self.time_col, self.gap = names, time_col, gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "at long, told boolean")
        self.pending = handle.getListState("spans", "start long, end long")

    def _pending(self) -> tuple[np.ndarray, np.ndarray]:
        held = [(int(p[0]), int(p[1])) for p in self.pending.get()] if self.pending.exists() else []
        both = np.array(held, np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1]

    def _put(self, start: np.ndarray, end: np.ndarray) -> None:
        if len(start):
            self.pending.put(list(zip(start.tolist(), end.tolist())))
        else:
            self.pending.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        start = end = np.zeros(0, np.int64)
        for pdf in rows:
            t = pdf[self.time_col].dropna().to_numpy(np.int64)
            start, end = _spans(np.append(start, t), np.append(end, t), self.gap)
        if len(start):
            self._put(*_spans(*map(np.append, self._pending(), (start, end)), self.gap))
            self.wake(int(start[0]) // 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        wm = timerValues.getCurrentWatermarkInMs()
        start, end = self._pending()
        due = int(np.searchsorted(start // 1000, wm, "right"))
        last, told = self.last.get() or (None, False)
        found = []
        for s, e in zip(start[:due].tolist(), end[:due].tolist()):
            if last is not None and not told and s - last > self.gap:
                found.append(last)
            # of a span that is due in part the first row stands for those that are due: its silence is not yet to be told
            at = e if e // 1000 <= wm else s
            last, told = (at, False) if last is None or at >= last else (last, told)
        begun = due > 0 and int(end[due - 1]) // 1000 > wm
        if last is not None and not told and not begun and wm * 1000 > last + self.gap:
            found.append(last)
            told = True
        self.last.update((last, told))
        self._put(start[due - begun:], end[due - begun:])
        wakes = ([int(end[due - 1]) // 1000] if begun else []) + (start[due:due + 1] // 1000).tolist()
        if last is not None and not told and not begun:
            wakes.append((last + self.gap) // 1000 + 1)
        if wakes:
            self.wake(min(wakes))
        if found:
            out = pd.DataFrame({n: [k] * len(found) for n, k in zip(self.names, key)})
            yield out.assign(last_us=found)


def silent_sources_stream(df: DataFrame, keys: Sequence[str] = ("source",), time_col: str = "event_time",
                          gap: str = "90 minutes", watermark: str = "30 seconds") -> DataFrame:
    """``keys, last_seen, due``: one row for each silence longer than ``gap``, as soon as the watermark passes its
    ``due`` time, whether the source sends again or not.  Arrival order within the watermark delay does not matter;
    rows without a time are no sign of life."""
    keys = list(keys)
    spark = df.sparkSession
    use_rocksdb_state(spark)
    gap_us = int(spark.range(1).select(F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {gap})")).first()[0])
    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField("last_us", T.LongType())])
    marked = df.withWatermark(time_col, watermark).select(*keys, time_col, F.unix_micros(time_col).alias("at_us"))
    out = marked.groupBy(*keys).transformWithStateInPandas(_Silence(keys, "at_us", gap_us), schema, "append", "eventTime")
    return out.select(*keys, F.timestamp_micros("last_us").alias("last_seen"), F.timestamp_micros(F.col("last_us") + gap_us).alias("due"))


def split_late(stream: DataFrame, time_col: str, delay: str, out_path: str, late_path: str,
               checkpoint: str | None = None, trigger: dict | None = None):
    """Start a query that writes the rows of ``stream`` to ``out_path`` and those behind the watermark to
    ``late_path``, both by ``batch_id``, late rows with the ``watermark`` they missed.

    The watermark of a micro-batch is the greatest time of all earlier ones less ``delay``
    (Spark's rule for one source).  Each micro-batch records the greatest time up to its end under the checkpoint,
    so a retried or restarted micro-batch is cut at the same watermark; every row lands in exactly
    one of the two tables.  A row without a time is on time."""
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "late-ckpt")
    marks = f"{checkpoint}/greatest-times"

    def write(batch: DataFrame, epoch: int):
        spark = batch.sparkSession
        before = None
        if epoch:
            before = spark.read.schema("greatest timestamp").parquet(f"{marks}/batch_id={epoch - 1}").first()["greatest"]
        mark = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        late = F.coalesce(F.col(time_col) < mark, F.lit(False))
        batch.where(~late).write.mode("overwrite").parquet(f"{out_path}/batch_id={epoch}")
        batch.where(late).withColumn("watermark", mark).write.mode("overwrite").parquet(f"{late_path}/batch_id={epoch}")
        (batch.agg(F.greatest(F.max(F.col(time_col)), F.lit(before).cast("timestamp")).alias("greatest"))
         .write.mode("overwrite").parquet(f"{marks}/batch_id={epoch}"))

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()
