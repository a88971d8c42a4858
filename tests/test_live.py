"""Streams in event time against their batch forms, through restarts; the database source and what it reads."""

import random
import sqlite3

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldgeo.operators import series
from fieldgeo.sources import tables
from fieldgeo.streaming import stateful

LOG = "flight_id long, ts timestamp, lat double, lon double, recording boolean"


@pytest.fixture(scope="module")
def rocks(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", stateful.STORE)
    yield spark
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def made(rng, n):
    rows = []
    for flight in (1, 2):
        at = 1_000_000 * flight
        for _ in range(n):
            at += rng.choice((10, 10, 30, 100, 170))
            rows.append((flight, at, rng.uniform(39, 40), rng.uniform(-97, -96), rng.random() < 0.7))
    return rows


def stamped(spark, rows, schema="flight_id long, ts_ms long, lat double, lon double, recording boolean"):
    return spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_millis("ts_ms")).drop("ts_ms")


def shuffled(rng, rows, reach):
    """Rows out of order by less than reach places."""
    return [r for _, r in sorted((i + rng.uniform(0, reach), r) for i, r in enumerate(rows))]


def run(query_of, sources, batches, checkpoint, out, spark):
    """Every batch of files in a run of its own: each starts from the checkpoint."""
    for batch in batches:
        for name, rows in batch.items():
            rows.coalesce(1).write.mode("append").parquet(sources[name])
        q = query_of().writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        assert q.awaitTermination(240)
    return spark.read.parquet(out)


def test_gaps_as_in_batch_through_restarts(rocks, tmp_path):
    rng = random.Random(1)
    rows = shuffled(rng, sorted(made(rng, 60), key=lambda r: r[1] % 1_000_000), 8)
    log = stamped(rocks, rows)
    end = stamped(rocks, [(9, 90_000_000, 0.0, 0.0, False)])  # moves the watermark past all others
    parts = [rows[:40], rows[40:41], rows[41:100], rows[100:]]
    source = str(tmp_path / "in")
    live = lambda: stateful.fill_gaps(rocks.readStream.schema(LOG).parquet(source), late="5000 seconds")
    got = run(live, {"log": source}, [{"log": stamped(rocks, p).select(*[c.split()[0] for c in LOG.split(", ")])} for p in parts] + [{"log": end.select(*[c.split()[0] for c in LOG.split(", ")])}], str(tmp_path / "c"), str(tmp_path / "out"), rocks)
    batch = series.interpolate_grid(log.withColumn("ts_ms", F.unix_millis("ts")), values=("lat", "lon"))
    read = lambda df: sorted((r["flight_id"], r["ts_ms"], r["interpolated"], round(r["lat"], 9), round(r["lon"], 9)) for r in df.collect())
    assert read(got) == read(batch) and any(r["interpolated"] for r in got.collect())


def test_live_asof_as_in_batch(rocks, tmp_path):
    rng = random.Random(2)
    keys = [r for r in made(rng, 40)]
    probes = [(r[0], r[1] - rng.choice((0, 3, 60)), i) for i, r in enumerate(made(rng, 50))]
    p = lambda rows: stamped(rocks, rows, "flight_id long, ts_ms long, probe long").select("flight_id", "ts", "probe")
    k = lambda rows: stamped(rocks, rows).select("flight_id", "ts", "lat", "lon")
    sources = {"p": str(tmp_path / "p"), "k": str(tmp_path / "k")}
    live = lambda: stateful.asof_forward(rocks.readStream.schema("flight_id long, ts timestamp, probe long").parquet(sources["p"]), rocks.readStream.schema("flight_id long, ts timestamp, lat double, lon double").parquet(sources["k"]), 200, late="5000 seconds")
    far = [(9, 90_000_000, 0.0, 0.0, False)]
    batches = [{"p": p(probes[:30]), "k": k(keys[:20])}, {"p": p(probes[30:]), "k": k(keys[20:])}, {"p": p([(9, 90_000_000, 1000)]), "k": k(far)}]
    got = {r["probe"]: r for r in run(live, sources, batches, str(tmp_path / "c"), str(tmp_path / "out"), rocks).collect()}
    left = rocks.createDataFrame(probes, "flight_id long, ts_ms long, probe long")
    right = rocks.createDataFrame(keys, "flight_id long, ts_ms long, lat double, lon double, recording boolean")
    for r in series.asof_forward(left, right, "ts_ms", "flight_id", ["lat", "lon"]).collect():
        near = r["delta"] is not None and r["delta"] <= 200
        found = got[r["probe"]]
        assert (found["match_ts_ms"], found["lat"]) == ((r["match_ts_ms"], r["lat"]) if near else (None, None))
    assert len(got.keys() - {1000}) == 100


class CountedState:
    """A flight's state in memory, which counts how often it is asked."""

    def __init__(self):
        self.calls, self.rows, self.value, self.timers = 0, [], None, set()

    def getListState(self, *_):
        return self

    def getValueState(self, *_):
        state = self

        class Value:
            get = lambda _: state.count() or state.value
            update = lambda _, value: state.count() or setattr(state, "value", value)
            clear = lambda _: state.count() or setattr(state, "value", None)

        return Value()

    def count(self):
        self.calls += 1

    def appendValue(self, row):
        self.count()
        self.rows.append(row)

    def put(self, rows):
        self.count()
        self.rows = rows

    def get(self):
        self.count()
        return iter(self.rows)

    def clear(self):
        self.put([])

    def registerTimer(self, at):
        self.count()
        self.timers.add(at)

    def deleteTimer(self, at):
        self.count()
        self.timers.discard(at)


@pytest.mark.parametrize("processor", [stateful.GapFiller(10, 1000), stateful.NextKey(200)])
def test_state_is_asked_by_the_piece_not_by_the_row(processor):
    rng, state = random.Random(3), CountedState()
    rows = pd.DataFrame([(i * 20, i % 2, i if i % 2 else 0, 1.0 * i, 2.0 * i, True) for i in range(4000)], columns=["ts_ms", "kind", "probe", "lat", "lon", "recording"])
    rows = rows.sample(frac=1, random_state=rng.randint(0, 99))
    clock = lambda now: type("Clock", (), {"getCurrentWatermarkInMs": lambda _: now})()
    processor.init(state)
    out = list(processor.handleInputRows((1,), iter([rows[:3000], rows[3000:]]), clock(-1)))
    assert not out and len(state.timers) == 1
    for now in (40_000, 1_000_000):
        state.timers.clear()  # it fires
        out += list(processor.handleExpiredTimer((1,), clock(now), None))
    found = pd.concat(out)
    if "probe" in found:
        assert sorted(found["probe"]) == list(range(1, 4000, 2)) and (found["match_ts_ms"] - found["ts_ms"]).dropna().eq(20).all()
    else:
        assert sorted(found["ts_ms"]) == list(range(0, 79_981, 10)) and (found["lat"] == found["ts_ms"] / 20).all()
    assert state.calls < 30 and not state.rows and state.value is None and not state.timers


def test_the_state_store_is_asked_for(spark):
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    with pytest.raises(ValueError, match="RocksDB"):
        stateful.fill_gaps(spark.readStream.format("rate").load().select(F.lit(1).cast("long").alias("flight_id"), F.col("timestamp").alias("ts"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"), F.lit(True).alias("recording")))


def test_filters_reach_the_database(spark, tmp_path):
    path = str(tmp_path / "plots.db")
    with sqlite3.connect(path) as db:
        db.execute("create table plots (id integer, plot_id text, area real)")
        db.executemany("insert into plots values (?, ?, ?)", [(i, f"{'18ASH' if i % 4 else '19ASH'}_{i:04d}", i / 2) for i in range(1000)] + [(None, "18ASH_none", None), (7, None, 1.0)])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(tables.TableSource)
    plots = spark.read.format("plot_table").schema("id long, plot_id string, area double").options(database=path, table="plots", key="id", parts=4).load()
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    every = spark.createDataFrame(plots.collect(), plots.schema)
    assert every.count() == 1002
    for where in ("plot_id like '19ASH%'", "id >= 990 and area < 498", "id in (3, 5, 7)", "plot_id is null", "plot_id like '18ASH%' and length(plot_id) = 10", "plot_id = '18ASH_0001'"):
        assert rows(plots.where(where)) == rows(every.where(where)), where
    plan = plots.where("plot_id like '19ASH%' and id < 500")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith" in plan or "startswith" not in plan.lower().split("scan")[0]
    reader = tables.TableReader(plots.schema, {"database": path, "table": "plots", "key": "id", "parts": "4"})
    left = list(reader.pushFilters([tables.StringStartsWith(("plot_id",), "19ASH"), tables.LessThan(("id",), 500)]))
    read = [row for part in reader.partitions() for row in reader.read(part)]
    assert left == [] and len(reader.partitions()) == 4 and len(read) == 125 and all(r[1].startswith("19ASH") for r in read)
