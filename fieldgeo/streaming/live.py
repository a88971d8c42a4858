"""Live flight logs: recording sessions with watermarks, and gap filling that carries each flight's last sample."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def recording_sessions(log: DataFrame, ts: str = "ts", by: str = "flight_id", gap: str = "30 seconds", late: str = "30 seconds") -> DataFrame:
    """start, end and rows of each flight's recording sessions: recording rows no more than gap apart."""
    rows = log.where("recording").withWatermark(ts, late)
    return rows.groupBy(by, F.session_window(ts, gap).alias("session")).agg(F.count("*").alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last"))


GRID = "flight_id long, ts_ms long, lat double, lon double, interpolated boolean"


def fill_gaps(log: DataFrame, step_ms: int = 10) -> DataFrame:
    """Recording rows and the grid rows between each and the sample before it, as batches arrive; state is one sample a flight.

    Rows of a batch are put in time order; a row no later than the flight's last sample is dropped, as it came late.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values("ts_ms", kind="stable").drop_duplicates("ts_ms")
        if state.exists:
            last = pd.DataFrame([(*state.get, False)], columns=["ts_ms", "lat", "lon", "recording"])
            rows = pd.concat([last, rows[rows["ts_ms"] > state.get[0]]])
        t, recording = rows["ts_ms"].to_numpy(np.int64), rows["recording"].to_numpy(bool)
        state.update((int(t[-1]), float(rows["lat"].iloc[-1]), float(rows["lon"].iloc[-1])))
        first = (t[:-1] // step_ms + 1) * step_ms
        steps = np.where(recording[1:] & (np.diff(t) > step_ms), np.maximum(-((first - t[1:]) // step_ms), 0), 0)
        gap = np.repeat(np.arange(len(steps)), steps)
        at = first[gap] + step_ms * (np.arange(len(gap)) - np.repeat(np.cumsum(steps) - steps, steps))
        share = (at - t[gap]) / (t[gap + 1] - t[gap])
        between = {c: (x := rows[c].to_numpy(float))[gap] + (x[gap + 1] - x[gap]) * share for c in ("lat", "lon")}
        own = rows[recording]
        out = pd.concat([pd.DataFrame({"ts_ms": at, **between, "interpolated": True}), own[["ts_ms", "lat", "lon"]].assign(interpolated=False)]).sort_values("ts_ms", kind="stable")
        out.insert(0, "flight_id", key[0])
        yield out

    return log.groupBy("flight_id").applyInPandasWithState(step, GRID, "ts_ms long, lat double, lon double", "append", GroupStateTimeout.NoTimeout)
