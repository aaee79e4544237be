"""Stateful rolling detectors on streams (per-key buffers).

Spark rejects row-count windows on streams, so the buffer detector runs as
``groupBy(keys).applyInPandasWithState``: the state of a key is its last
``window_size - 1`` values and the number of values seen.  Per micro-batch a
key's new rows are sorted by the order columns and scored against the state
followed by the earlier rows of the same batch -- the same frame as the batch
window operator, so a stream replayed in time order gives exactly the batch
result.  Rows that arrive after later rows of their key were already scored
are scored in arrival order (the original detector's behaviour).

The per-key work per batch is a vectorised numpy pass over (state + batch)
values in bounded blocks (no per-row Python); the state stays bounded
(``window_size - 1`` doubles per key).
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

STATE_SCHEMA = "vals array<double>, seen long"


def _score(arr: np.ndarray, start: int, seen0: int, window: int, thr: float, gate: int, method: str,
           block: int = 20_000):
    """Score arr[start:] given the previous values arr[:start], vectorised.

    Each row's buffer is the ``window - 1`` values before it (fewer at the
    start); rows are taken in blocks so memory stays ``block x (window - 1)``.
    """
    n = len(arr) - start
    flags = np.zeros(n, dtype=bool)
    scores = np.zeros(n, dtype=float)
    kinds = np.full(n, "statistical", dtype=object)
    w = window - 1
    if n == 0 or w < 1:
        return flags, scores, kinds
    padded = np.concatenate([np.full(w, np.nan), arr])
    views = np.lib.stride_tricks.sliding_window_view(padded, w)  # row j: values before arr[j]
    warm = (seen0 + np.arange(n)) >= gate
    for b0 in range(0, n, block):
        b1 = min(n, b0 + block)
        idx = np.arange(b0, b1)
        ok = warm[b0:b1] & (start + idx > 0)
        if not ok.any():
            continue
        rows = idx[ok]
        win = views[start + rows]          # (m, w) previous values, NaN-padded
        v = arr[start + rows]
        valid = ~np.isnan(win)
        if method == "iqr":
            kinds[rows] = "iqr"
            q1, q3 = _nan_quartiles(win, valid)
            iqr = q3 - q1
            lo, hi = q1 - thr * iqr, q3 + thr * iqr
            out = (v < lo) | (v > hi)
            dist = np.where(v < lo, lo - v, v - hi)
            with np.errstate(divide="ignore", invalid="ignore"):
                sc = np.where(iqr == 0, 1.0, np.minimum(dist / iqr / thr, 1.0))
            flags[rows] = out
            scores[rows] = np.where(out, sc, 0.0)
        else:
            kinds[rows] = "zscore"
            cnt = valid.sum(axis=1)
            m = np.where(valid, win, 0.0).sum(axis=1) / cnt
            sd = np.sqrt(np.where(valid, (win - m[:, None]) ** 2, 0.0).sum(axis=1) / cnt)
            # a frame of one repeated value may leave a rounding residue as its spread
            most = np.where(valid, win, -np.inf).max(axis=1)
            least = np.where(valid, win, np.inf).min(axis=1)
            use = (sd > 0) & (most > least) & ~np.isnan(v)
            with np.errstate(divide="ignore", invalid="ignore"):
                z = np.abs((v - m) / sd)
            flags[rows] = use & (z > thr)
            scores[rows] = np.where(use, np.minimum(z / thr, 1.0), 0.0)
    return flags, scores, kinds


def _nan_quartiles(win: np.ndarray, valid: np.ndarray):
    """Linear 25th / 75th percentiles of each row's non-NaN values (numpy rule)."""
    cnt = valid.sum(axis=1)
    srt = np.sort(np.where(valid, win, np.inf), axis=1)  # NaN padding sorts last
    out = []
    for q in (0.25, 0.75):
        h = (cnt - 1) * q
        lo = np.floor(h).astype(int)
        hi = np.minimum(lo + 1, cnt - 1)
        t = h - lo
        a = np.take_along_axis(srt, lo[:, None], axis=1)[:, 0]
        b = np.take_along_axis(srt, hi[:, None], axis=1)[:, 0]
        out.append(np.where(t >= 0.5, b - (b - a) * (1 - t), a + (b - a) * t))
    return out[0], out[1]


def rolling_detector_stream(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "value",
                            method: str = "zscore", threshold: float = 3.0, window_size: int = 100,
                            min_history: int = 10) -> DataFrame:
    """Streaming (or batch) per-key rolling detector; appends the detection columns."""
    keys, order = list(keys), list(order)
    out_schema = T.StructType(df.schema.fields + [
        T.StructField("is_anomaly", T.BooleanType()), T.StructField("anomaly_score", T.DoubleType()),
        T.StructField("anomaly_type", T.StringType())])
    cols = df.columns

    def fn(key, pdfs: Iterator[pd.DataFrame], state):
        batch = pd.concat(list(pdfs), ignore_index=True).sort_values(order, kind="mergesort")
        if state.exists:
            vals, seen = state.get
            prev = np.asarray(vals if vals is not None else [], dtype=float)
        else:
            prev, seen = np.zeros(0), 0
        cur = batch[value].to_numpy(dtype=float)
        arr = np.concatenate([prev, cur])
        flags, scores, kinds = _score(arr, len(prev), int(seen), window_size, threshold, min_history, method)
        keep = arr[-(window_size - 1):] if window_size > 1 else arr[:0]
        state.update((keep.tolist(), int(seen) + len(cur)))
        res = batch[cols].copy()
        res["is_anomaly"] = flags
        res["anomaly_score"] = scores
        res["anomaly_type"] = kinds
        yield res

    return df.groupBy(*keys).applyInPandasWithState(fn, out_schema, STATE_SCHEMA, "append",
                                                    GroupStateTimeout.NoTimeout)


BUFFERED_STATE = "vals array<double>, seen long, pending binary"


def _to_ipc(pdf: pd.DataFrame) -> bytes:
    import pyarrow as pa
    table = pa.Table.from_pandas(pdf, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def _from_ipc(data: bytes) -> pd.DataFrame:
    import pyarrow as pa
    return pa.ipc.open_stream(pa.py_buffer(bytes(data))).read_all().to_pandas()


def _ms(ts: pd.Series) -> pd.Series:
    return pd.to_datetime(ts).astype("datetime64[ms]").astype("int64")


def rolling_detector_event_time(df: DataFrame, keys: Sequence[str], time_col: str, tie: str, value: str = "value",
                                method: str = "zscore", threshold: float = 3.0, window_size: int = 100,
                                min_history: int = 10, watermark: str = "30 seconds") -> DataFrame:
    """Event-time variant: a key's rows wait in state until the watermark
    passes them, then are scored in ``(time_col, tie)`` order.  Any arrival
    order within the watermark delay gives the batch result; rows that arrive
    behind already-scored rows of their key are scored at once (arrival order).
    ``time_col`` must be a ``timestamp`` column.  Pending rows are kept in the
    state as Arrow IPC bytes (exact; bounded by the watermark delay x key rate)."""
    keys = list(keys)
    cols = df.columns
    out_schema = T.StructType(df.schema.fields + [
        T.StructField("is_anomaly", T.BooleanType()), T.StructField("anomaly_score", T.DoubleType()),
        T.StructField("anomaly_type", T.StringType())])
    order = [time_col, tie]

    def fn(key, pdfs: Iterator[pd.DataFrame], state):
        if state.exists:
            vals, seen, pending_bin = state.get
            prev = np.asarray(vals if vals is not None else [], dtype=float)
            pending = _from_ipc(pending_bin) if pending_bin else pd.DataFrame(columns=cols)
        else:
            prev, seen, pending = np.zeros(0), 0, pd.DataFrame(columns=cols)
        frames = [p for p in pdfs] if not state.hasTimedOut else []
        if frames:
            new = pd.concat(frames, ignore_index=True)
            pending = new if pending.empty else pd.concat([pending, new], ignore_index=True)
        wm = state.getCurrentWatermarkMs()
        if pending.empty:
            state.update((prev.tolist(), int(seen), None))
            return
        ts_ms = _ms(pending[time_col])
        ready = pending[ts_ms <= wm].sort_values(order, kind="mergesort")
        rest = pending[ts_ms > wm]
        if len(ready):
            cur = ready[value].to_numpy(dtype=float)
            arr = np.concatenate([prev, cur])
            flags, scores, kinds = _score(arr, len(prev), int(seen), window_size, threshold, min_history, method)
            prev = arr[-(window_size - 1):] if window_size > 1 else arr[:0]
            seen = int(seen) + len(cur)
            res = ready[cols].copy()
            res["is_anomaly"], res["anomaly_score"], res["anomaly_type"] = flags, scores, kinds
        else:
            res = None
        state.update((prev.tolist(), int(seen), _to_ipc(rest.reset_index(drop=True)) if len(rest) else None))
        if len(rest):
            state.setTimeoutTimestamp(int(_ms(rest[time_col]).min()))
        if res is not None:
            yield res

    return (df.withWatermark(time_col, watermark).groupBy(*keys)
            .applyInPandasWithState(fn, out_schema, BUFFERED_STATE, "append", GroupStateTimeout.EventTimeTimeout))
