"""Golden cases of the ordered-series operators."""

import pytest
from pyspark.sql import functions as F

from fieldgeo.operators import series


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def log(spark, data, schema):
    return spark.createDataFrame([("f", *r) for r in data], "flight_id string, " + schema)


def test_segments(spark):
    df = log(spark, [(i, f == 1) for i, f in enumerate([0, 1, 1, 0, 1])], "ts_ms long, recording boolean")
    got = series.segment_by_flag(df, "recording", "ts_ms", "flight_id").orderBy("ts_ms")
    assert rows(got, "segment") == [(None,), (1,), (1,), (None,), (2,)]


def test_grid(spark):
    df = log(spark, [(900, False, -1.0), (1000, True, 0.0), (1100, True, 1.0)], "ts_ms long, recording boolean, lat double")
    got = {r["ts_ms"]: (round(r["lat"], 9), r["interpolated"]) for r in series.interpolate_grid(df, values=["lat"]).collect()}
    assert [got[1000 + 10 * i] for i in range(1, 10)] == [(round(i / 10, 9), True) for i in range(1, 10)]
    assert got[1000] == (0.0, False) and got[1100] == (1.0, False) and got[910] == (-0.9, True) and len(got) == 20


def test_asof(spark):
    keys = log(spark, [(10, "a"), (20, "b"), (30, "c")], "t long, p string")
    probe = lambda *ts: log(spark, [(t,) for t in ts], "t long")
    got = series.asof_forward(probe(10, 11, 30, 31), keys, "t", "flight_id", ["p"]).orderBy("t")
    assert rows(got, "match_t", "p", "delta") == [(10, "a", 0), (20, "b", 9), (30, "c", 0), (None, None, None)]
    got = series.asof_forward(probe(5, 14), keys, "t", "flight_id", strict=True, shift=5).orderBy("t")
    assert rows(got, "match_t") == [(20,), (20,)]
    got = series.asof_nearest(probe(14, 16, 15, 1, 99), keys, "t", "flight_id").orderBy("t")
    assert rows(got, "t", "match_t") == [(1, 10), (14, 10), (15, 10), (16, 20), (99, 30)]


def test_heading(spark):
    df = log(spark, [(i, float(y)) for i, y in enumerate([0, 1, 2, 3, 4, 3, 2, 1, 0])], "ts_ms long, y double")
    got = series.heading_sign(df, by="flight_id").orderBy("ts_ms")
    assert rows(got, "heading") == [("+",), ("+",), ("-",), ("-",), ("-",), (None,), (None,), (None,), (None,)]
    assert [None if v is None else round(v, 2) for (v,) in rows(got, "y_corrected")][:3] == [0.24, 1.24, 1.76]


def test_clock(spark):
    df = log(spark, [(0, 36_000_000), (1, 0), (2, 0), (3, 36_009_000), (4, None)], "seq long, clock_ms long")
    assert rows(series.repair_clock(df, by="flight_id").orderBy("seq"), "repaired_ms") == [(36_000_000,), (36_000_800,), (36_001_600,), (36_009_000,), (36_009_800,)]


def test_frame_times_and_rates(spark):
    by = ["flight_id", "segment"]
    segments = series.segment_durations(log(spark, [(1, t) for t in (0, 40, 100)] + [(None, 500)], "segment int, ts_ms long"))
    frames = log(spark, [(1, i) for i in range(4)], "segment int, i int")
    assert rows(series.frame_times(frames, segments, by).orderBy("i"), "ts_ms") == [(0,), (25,), (50,), (75,)]
    assert rows(series.frame_rate(frames, segments, by), "n_frames", "interval_ms", "frames_per_s") == [(4, 25.0, 40.0)]


def test_ranges_stop_where_time_runs_back(spark):
    w = log(spark, [(i + 1, t, 100) for i, t in enumerate([7, 200, 300, 400, 500, 350, 600, 700])], "seq int, ts_ms long, recording_ms long")
    got = series.range_segments(w).orderBy("segment_id")
    assert rows(got, "segment_id", "start_ms", "duration_ms") == [("WP_01-02", 0, 100), ("WP_03-04", 200, 100)]


def test_zip_by_order(spark):
    images = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (3, "e"), (4, "f")], "flight_id int, image string")
    events = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (2, 21), (3, 30)], "flight_id int, event int")
    got = {r["image"]: (r["status"], r["event"]) for r in series.zip_by_order(images, events, "flight_id", "image", "event").collect()}
    assert got == {"a": ("matched", 10), "b": ("matched", 11), "c": ("fewer images", None), "d": ("more images", None), "e": ("more images", None), "f": ("more images", None)}


def test_sliding_and_picks(spark):
    df = log(spark, [(i, i * 10) for i in range(7)], "ts_ms long, v int")
    got = series.sliding(df, ["v"], "ts_ms", "flight_id", 3, 2).orderBy("ts_ms")
    assert rows(got, "w_v") == [([0, 10, 20],), ([20, 30, 40],), ([40, 50, 60],)]
    with pytest.raises(ValueError):
        series.sliding(df, ["v"], "ts_ms", "flight_id", 2, 3)
    assert rows(series.every_nth(df, 3, "ts_ms", "flight_id").orderBy("ts_ms"), "ts_ms") == [(0,), (3,), (6,)]
    hits = df.withColumn("plot", F.col("ts_ms") % 3)
    assert sorted(rows(series.first_hit(hits, "plot", "ts_ms", "flight_id"), "plot", "ts_ms")) == [(0, 0), (1, 1), (2, 2)]
    line = series.range_lines(df.withColumns({"lon": F.col("v").cast("double"), "lat": F.lit(1.0)}), ["flight_id"], pieces=3).first()["line"]
    assert [p["x"] for p in line] == [0.0, 20.0, 40.0, 60.0]
