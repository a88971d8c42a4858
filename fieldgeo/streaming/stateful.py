"""Live flight logs in event time: rows wait in state until the watermark has passed them, so that late ones find their place.

Every operator gives what its batch form gives over the rows that weren't later than the watermark, however they are
split into micro-batches, and after a restart from the checkpoint. State is what is open: rows the watermark hasn't reached, a flight's last
sample, and nothing of a flight that has been silent for long. Needs the RocksDB state store.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .. import workers

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
GRID = "flight_id long, ts_ms long, lat double, lon double, interpolated boolean"
NEVER = -(1 << 63)  # no time
MATCHES = "flight_id long, probe long, ts_ms long, match_ts_ms long, lat double, lon double"


class OpenRows(StatefulProcessor):
    """Keeps rows in state until the watermark has passed their time, then hands them to released() in order.

    A flight's rows go to state in pieces, packed, and are read when the earliest of them is due. A timer wakes a flight without new rows
    then; once nothing is open and idle_ms have gone by, all of its state is dropped. Of rows at one place the first to come counts.
    """

    row: list[tuple[str, str]] = []  # columns and NumPy types, those of a row's place first
    place: list[str] = []
    last, none = "ts_ms long", (NEVER,)  # what is kept of the last row released, and what stands for there being none
    PIECE = 10_000  # rows

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "rows binary")
        self.flight = handle.getValueState("flight", f"first_ms long, timer_ms long, {self.last}")  # first: of the open rows; timer: the one that is set

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, earliest = [], None
        for batch in rows:
            if not len(batch):
                continue
            held.append(self.packed(batch))
            low = int(held[-1]["ts_ms"].min())
            earliest = low if earliest is None else min(low, earliest)
            if sum(map(len, held)) >= self.PIECE:
                self.open.appendValue((np.concatenate(held).tobytes(),))
                held = []
        if held:
            self.open.appendValue((np.concatenate(held).tobytes(),))
        yield from self.flush(key, timerValues, earliest)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self.flush(key, timerValues, fired=True)

    def flush(self, key, timerValues, earliest: int | None = None, fired: bool = False) -> Iterator[pd.DataFrame]:
        now, was = timerValues.getCurrentWatermarkInMs(), self.flight.get()
        first, timer, *last = was or (NEVER, NEVER, *self.none)
        timer = NEVER if fired else timer
        if earliest is not None and (first == NEVER or earliest < first):
            first = earliest
        if NEVER < first <= now:
            rows = self.in_order(np.concatenate([np.frombuffer(x[0], self.row) for x in self.open.get()]))
            left, last = yield from self.released(key[0], rows, now, tuple(last))
            first = int(left["ts_ms"][0]) if len(left) else NEVER
            if len(left):
                self.open.put([(left[i : i + self.PIECE].tobytes(),) for i in range(0, len(left), self.PIECE)])
            else:
                self.open.clear()
        silent = last[0] + self.idle_ms if last[0] != NEVER else NEVER
        wanted = max(first, now) + 1 if first != NEVER else silent if silent > now else NEVER
        if wanted != timer:
            if timer != NEVER:
                self.handle.deleteTimer(timer)
            if wanted != NEVER:
                self.handle.registerTimer(wanted)
        if wanted != NEVER:
            self.flight.update((first, wanted, *last))
        elif was is not None:
            self.flight.clear()

    def packed(self, batch: pd.DataFrame) -> np.ndarray:
        out = np.empty(len(batch), self.row)
        for name, kind in self.row:
            out[name] = batch[name].astype(kind)
        return out

    def in_order(self, rows: np.ndarray) -> np.ndarray:
        """The rows by place, of those at one place the first."""
        rows = rows[np.lexsort([rows[c] for c in reversed(self.place)])]  # stable
        new = np.ones(len(rows), bool)
        new[1:] = np.logical_or.reduce([rows[c][1:] != rows[c][:-1] for c in self.place])
        return rows[new]

    def released(self, name, rows: np.ndarray, now: int, last: tuple) -> Generator[pd.DataFrame, None, tuple[np.ndarray, tuple]]:
        """Yields the results of the open rows that are done with, and returns the others in order and what is kept of the last one released."""
        raise NotImplementedError

    def close(self) -> None:
        pass


class GapFiller(OpenRows):
    row = [("ts_ms", "i8"), ("lat", "f8"), ("lon", "f8"), ("recording", "?")]
    place = ["ts_ms"]
    last, none = "ts_ms long, lat double, lon double", (NEVER, 0.0, 0.0)
    MOST = 500_000  # grid rows in one frame, but for those of one gap

    def __init__(self, step_ms: int, idle_ms: int):
        super().__init__(idle_ms)
        self.step_ms = step_ms

    def released(self, name, rows, now, last):
        n, step = int(np.searchsorted(rows["ts_ms"], now, "right")), self.step_ms
        due = np.concatenate([np.array([(*last, False)] if last[0] != NEVER else [], self.row), rows[:n]])
        t, here, there = due["ts_ms"][1:], due[1:], due[:-1]
        p = there["ts_ms"]
        at = (p // step + 1) * step
        many = np.where(here["recording"] & (t - p > step), np.maximum(-((at - t) // step), 0), 0)  # grid rows before each row
        own = rows[:n][rows["recording"][:n]]
        upto, i = np.cumsum(many), 0
        while i < len(many) or len(own):
            j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + self.MOST, "right")))
            gap = np.repeat(np.arange(i, min(j, len(many))), many[i:j])
            ts = at[gap] + step * (np.arange(len(gap)) - np.repeat(np.cumsum(many[i:j]) - many[i:j], many[i:j]))
            share = (ts - p[gap]) / (t[gap] - p[gap])
            between = {c: there[c][gap] + (here[c][gap] - there[c][gap]) * share for c in ("lat", "lon")}
            if len(own) or len(gap):
                values = {c: np.concatenate([own[c], x]) for c, x in {"ts_ms": ts, **between}.items()}
                yield pd.DataFrame({"flight_id": name, **values, "interpolated": np.arange(len(own) + len(gap)) >= len(own)})
            i, own = j, own[:0]
        return rows[n:], (int(due["ts_ms"][-1]), float(due["lat"][-1]), float(due["lon"][-1])) if n else last


class NextKey(OpenRows):
    row = [("ts_ms", "i8"), ("kind", "i1"), ("probe", "i8"), ("lat", "f8"), ("lon", "f8")]
    place = ["ts_ms", "kind", "probe"]
    KEY, PROBE = 0, 1

    def __init__(self, most_ms: int):
        super().__init__(0)
        self.most_ms = most_ms

    def released(self, name, rows, now, last):
        passed = rows["ts_ms"] <= now
        key, asked = passed & (rows["kind"] == self.KEY), passed & (rows["kind"] == self.PROBE)
        keys, probes = rows[key], rows[asked]
        at = np.searchsorted(keys["ts_ms"], probes["ts_ms"], "left")
        found = at < len(keys)
        wait = ~found & (probes["ts_ms"] + self.most_ms > now)
        waiting = int(probes["ts_ms"][wait].min()) if wait.any() else now + 1
        done = key & (rows["ts_ms"] < waiting)
        done[np.flatnonzero(asked)[~wait]] = True
        probes, at, found = probes[~wait], at[~wait], found[~wait]
        if len(probes):
            match = np.append(keys, np.zeros(1, self.row))[at]  # the last one stands for none
            near = found & (match["ts_ms"] - probes["ts_ms"] <= self.most_ms)
            place = {c: np.where(near, match[c], np.nan) for c in ("lat", "lon")}
            yield pd.DataFrame({"flight_id": name, "probe": probes["probe"], "ts_ms": probes["ts_ms"], "match_ts_ms": pd.Series(match["ts_ms"], dtype="Int64").mask(~near), **place})
        return rows[~done], last


def _run(rows: DataFrame, processor: StatefulProcessor, schema: str) -> DataFrame:
    spark = rows.sparkSession
    workers.ready(spark)
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != STORE:
        raise ValueError(f"set spark.sql.streaming.stateStore.providerClass to {STORE}")
    return rows.groupBy("flight_id").transformWithStateInPandas(processor, schema, "append", "eventTime")


def fill_gaps(log: DataFrame, step_ms: int = 10, late: str = "30 seconds", idle_ms: int = 3_600_000) -> DataFrame:
    """Recording rows of a live log (flight_id, ts, lat, lon, recording) and the grid rows between each and the row before, as series.interpolate_grid gives them.

    Rows up to `late` behind the latest one are taken in their order, later ones dropped; of rows at one time one counts. A flight silent for idle_ms starts anew.
    """
    rows = log.withWatermark("ts", late).select("flight_id", "ts", F.unix_millis("ts").alias("ts_ms"), "lat", "lon", "recording")
    return _run(rows, GapFiller(step_ms, idle_ms), GRID)


def asof_forward(probes: DataFrame, keys: DataFrame, most_ms: int, late: str = "30 seconds") -> DataFrame:
    """Each probe (flight_id, ts, probe) of a live stream with the first key (flight_id, ts, lat, lon) of another at or after it, no more than most_ms later; null where there is none.

    A probe is answered once the watermark has passed its key, or its time by most_ms; keys go when no probe can ask for them. Rows later than `late` are dropped.
    """
    none = F.lit(None).cast("double")
    asked = probes.select("flight_id", "ts", F.lit(NextKey.PROBE).alias("kind"), F.col("probe").cast("long").alias("probe"), none.alias("lat"), none.alias("lon"))
    given = keys.select("flight_id", "ts", F.lit(NextKey.KEY).alias("kind"), F.lit(0).cast("long").alias("probe"), "lat", "lon")
    rows = asked.unionByName(given).withWatermark("ts", late).select("*", F.unix_millis("ts").alias("ts_ms"))
    return _run(rows, NextKey(most_ms), MATCHES)
