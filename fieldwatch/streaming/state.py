"""The health history of each pump as keyed state of a stream, with a cap and a time to live.

A well's state is its last readings that are final and those that aren't yet. A reading is final once the watermark has passed it; final readings are taken in the order of
their times, whatever order they arrived in, so every frame is that of the table form. A timer closes readings when no others of the well come, and
forgets a well that has been idle for as long as its history lives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fieldwatch.functions.code import send
from fieldwatch.operators.history import CAP, HOUR_MS, IDLE_MS

ROWS = "well_id string, ts long, n long, phi double, extra string, n_history long, first_ts long, phi_sum double, slope double, intercept double, r2 double"
#: The held readings as compressed Arrow bytes: before the first watermark they are all of a batch's, and as lists of values would weigh some kilobytes each.
STATE = "held binary, final int"
HELD = ["ts", "n", "phi", "extra"]


def frames(ts: np.ndarray, phi: np.ndarray, cap: int, idle_ms: int) -> dict[str, np.ndarray]:
    """For each of a well's readings in order, what its history holds and the least-squares line over hours since the first reading held."""
    at = np.arange(len(ts))
    begins = np.maximum.accumulate(np.where(np.r_[True, np.diff(ts) >= idle_ms], at, 0))
    start = np.maximum(begins, at - cap + 1)
    changed = np.maximum.accumulate(np.where(np.r_[False, np.diff(phi) != 0], at, 0))
    n, hours = at - start + 1, (ts - ts[0]) / HOUR_MS
    # sums over at most cap readings, each taken from its own first reading, so nothing cancels out
    back = np.maximum(at[:, None] - np.arange(cap), 0)
    held = at[:, None] - np.arange(cap) >= start[:, None]
    x, y = np.where(held, hours[back] - hours[start][:, None], 0.0), np.where(held, phi[back], 0.0)
    total, mean_x = y.sum(1), x.sum(1) / n
    mean_y = total / n
    dx, dy = np.where(held, x - mean_x[:, None], 0.0), np.where(held, y - mean_y[:, None], 0.0)
    sxx, sxy, syy = (dx * dx).sum(1), (dx * dy).sum(1), (dy * dy).sum(1)
    still = (changed <= start) | (ts == ts[start])
    with np.errstate(divide="ignore", invalid="ignore"):
        slope = np.where(still, 0.0, sxy / sxx)
        r2 = np.where(still, np.nan, sxy * sxy / (sxx * syy))
    return {"n_history": n, "first_ts": ts[start], "phi_sum": total, "slope": np.round(slope, 9), "intercept": np.where(still, mean_y, mean_y - slope * mean_x), "r2": r2}


#: How many readings frames are computed of at a time: they take the cap's multiple of room.
PART = 4096


def sliced_frames(ts: np.ndarray, phi: np.ndarray, first: int, last: int, cap: int, idle_ms: int, part: int = PART) -> Iterator[tuple[int, int, dict[str, np.ndarray]]]:
    """frames of the readings from first to last, in parts (begin, end, frames); each part looks at the cap - 1 readings before it, so the frames are those of the whole."""
    for begin in range(first, last, part):
        before, end = max(0, begin - cap + 1), min(begin + part, last)
        yield begin, end, {name: values[begin - before :] for name, values in frames(ts[before:end], phi[before:end], cap, idle_ms).items()}


def packed(rows: pd.DataFrame) -> pd.DataFrame:
    """The held columns, texts without an object each: a well's readings of one batch are held together."""
    return rows[HELD].astype({"ts": "int64", "phi": "float64", "extra": pd.ArrowDtype(pa.large_string())})


def to_bytes(held: pd.DataFrame) -> bytes:
    table, out = pa.Table.from_pandas(held, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(table, max_chunksize=PART)
    return out.getvalue().to_pybytes()


def from_bytes(kept: bytes) -> pd.DataFrame:
    return packed(pa.ipc.open_stream(kept).read_all().to_pandas(types_mapper={pa.large_string(): pd.ArrowDtype(pa.large_string())}.get))


def texts(rows: pd.DataFrame) -> list[str | None]:
    return pa.array(rows["extra"], from_pandas=True).to_pylist()


def history_stream(readings: DataFrame, cap: int = CAP, idle_ms: int = IDLE_MS) -> DataFrame:
    """history.with_history on a stream of readings (well_id, ts, n, phi, extra) with a watermark on event_timestamp: final readings only. extra is carried along."""

    def keep(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        final, held = 0, packed(pd.DataFrame(columns=HELD))
        if state.exists:
            kept, final = state.get
            held = from_bytes(kept)
        watermark = state.getCurrentWatermarkMs()
        if not state.hasTimedOut:  # a timer brings no rows
            new = pd.concat([held.iloc[final:], *(packed(b) for b in batches)]).sort_values(["ts", "n"], kind="stable")
            held = pd.concat([held.iloc[:final], new], ignore_index=True)
            del new
        ts, phi = held["ts"].to_numpy(np.int64), held["phi"].to_numpy(float)
        closed = final + int((ts[final:] < watermark).sum())
        for begin, end, found in sliced_frames(ts, phi, final, closed, cap, idle_ms):
            rows = held.iloc[begin:end]
            yield rows.assign(well_id=key[0], extra=texts(rows), **found)[["well_id", *HELD, *found]]
        held = held.iloc[max(0, closed - cap + 1) :]
        closed = min(closed, cap - 1)
        ts = held["ts"].to_numpy()
        if len(held) == closed and watermark - ts[-1] > idle_ms:
            state.remove()
            return
        state.update((to_bytes(held), closed))
        wake = ts[closed] if len(held) > closed else ts[-1] + idle_ms
        state.setTimeoutTimestamp(int(max(wake, watermark + 1)))

    send(readings.sparkSession)
    rows = readings.select("well_id", "event_timestamp", "ts", "n", "phi", "extra")
    out = rows.groupBy("well_id").applyInPandasWithState(keep, ROWS, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return out.withColumn("r2", F.nanvl("r2", F.lit(None).cast("double")))
