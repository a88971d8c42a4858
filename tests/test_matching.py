"""Cameras and points, images and events, stored tables: against brute force on small cases."""

import hashlib
import itertools
import math
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldgeo.functions.matching import match
from fieldgeo.operators import imaging, relational, series
from fieldgeo.sources import readers, sinks


def test_match_against_all_matchings():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(0, 5)
        few, many = (np.array(sorted(rng.randint(0, 30) for _ in range(k)), float) for k in (n, n + rng.randint(0, 4)))
        got = match(few, many)
        best = min(sum(abs(a - many[j]) for a, j in zip(few, way, strict=True)) for way in itertools.combinations(range(len(many)), n))
        assert list(got) == sorted(set(got.tolist())) and len(got) == n and sum(abs(few - many[got])) == best


def test_match_of_long_series():
    rng = np.random.default_rng(2)
    many = np.sort(rng.uniform(0, 1e6, 6000))
    keep = np.sort(rng.choice(6000, 5000, replace=False))
    assert (match(many[keep], many) == keep).all()


def test_match_takes_the_earliest_partners_of_equal_sums():
    rng = random.Random(6)
    for _ in range(400):
        n, top = rng.randint(0, 5), rng.choice((3, 12))
        few, many = (np.array(sorted(rng.randint(0, top) for _ in range(k)), float) for k in (n, n + rng.randint(0, 4)))
        ways = list(itertools.combinations(range(len(many)), n))
        sums = [sum(abs(a - many[j]) for a, j in zip(few, way, strict=True)) for way in ways]
        assert match(few, many).tolist() == [min(places) for places in zip(*[w for w, x in zip(ways, sums, strict=True) if x == min(sums)], strict=True)]


def test_match_of_very_long_series():
    """Two hundred thousand rows with half as many left over: rows times rest would be two and a half gigabytes of bits."""
    rng = np.random.default_rng(7)
    many = np.sort(rng.uniform(0, 1e6, 300_000))
    keep = np.sort(rng.choice(300_000, 200_000, replace=False))
    began = time.monotonic()
    assert (match(many[keep], many) == keep).all() and time.monotonic() - began < 30


def test_match_in_order(spark):
    rng = random.Random(3)
    images = [(g, i, rng.choice([None, *range(40)])) for i, g in enumerate(rng.choice(["a", "b", "c", None]) for _ in range(40))]
    events = [(g, 100 + i, rng.choice([None, *range(40)])) for i, g in enumerate(rng.choice(["a", "b", None]) for _ in range(30))] + [("b", 200 + i, i) for i in range(30)]
    left, right = spark.createDataFrame(images, "flight string, image int, t int"), spark.createDataFrame(events, "flight string, event int, t int")
    got = series.match_in_order(left, right, "t", "flight", "image", "event").collect()
    assert sorted(r["image"] for r in got) == list(range(40))
    times = {e: (g, t) for g, e, t in events}
    for g in ("a", "b", "c", None):
        own = sorted(((r["t"], r["image"], r["match_t"], r["event"], r["delta"]) for r in got if r["flight"] == g and r["event"] is not None), key=lambda r: r[:2])
        timed = [t for h, _, t in images if h == g and t is not None]
        usable = [t for h, _, t in events if h == g and t is not None] if g else []
        assert len(own) == min(len(timed), len(usable)) and len({r[3] for r in own}) == len(own)
        assert all(times[r[3]] == (g, r[2]) and r[4] == abs(r[0] - r[2]) for r in own) and [r[2] for r in own] == sorted(r[2] for r in own)
        few, many = sorted((sorted(timed), sorted(usable)), key=len)
        picked = match(np.array(few, float), np.array(many, float))
        assert sum(r[4] for r in own) == sum(abs(few[i] - many[j]) for i, j in enumerate(picked))


def camera(rng, i):
    """A perspective camera that looks some way from some place, or a matrix of any numbers."""
    if i % 4 == 3:
        return ("c%d" % i, 50, 40, *[rng.uniform(-5, 5) for _ in range(12)])
    a, tilt, f = rng.uniform(0, 2 * math.pi), rng.uniform(-1, 1), rng.uniform(20, 200)
    turn = np.array([[math.cos(a), math.sin(a), 0], [-math.sin(a), math.cos(a), 0], [0, 0, 1]]) @ np.array([[1, 0, 0], [0, math.cos(tilt), math.sin(tilt)], [0, -math.sin(tilt), math.cos(tilt)]])
    place = np.array([rng.uniform(-60, 60), rng.uniform(-60, 60), rng.uniform(-60, 60)])
    p = np.array([[f, 0, 25], [0, f, 20], [0, 0, 1]]) @ np.column_stack([turn, -turn @ place])
    return ("c%d" % i, 50, 40, *p.ravel().tolist())


def seen_by_hand(points, cameras, strict):
    out = []
    for (name, w, h, *m), (i, x, y, z) in itertools.product(cameras, points):
        if None in (x, y, z):
            continue
        a, b, c = (m[4 * r] * x + m[4 * r + 1] * y + m[4 * r + 2] * z + m[4 * r + 3] for r in range(3))
        if c != 0:
            u, v = math.floor(a / c), math.floor(b / c)
            if (0 <= u < w and 0 <= v < h) if strict else (0 <= u <= w and 0 < v <= h):
                out.append((name, i, u, v))
    return sorted(out)


def test_projection_against_all_pairs(spark):
    rng = random.Random(4)
    points = [(i, rng.uniform(-50, 50), rng.uniform(-50, 50), rng.choice((0.0, rng.uniform(-50, 50)))) for i in range(400)] + [(900, None, 1.0, 1.0)]
    cameras = [camera(rng, i) for i in range(24)]
    a = spark.createDataFrame(points, "idx int, x double, y double, z double")
    b = spark.createDataFrame(cameras, ["image", "width", "height", *imaging.MATRIX])
    for node_points, strict in ((1, False), (10, True), (4096, False)):
        got = imaging.project_points(a, b, strict=strict, node_points=node_points).collect()
        assert sorted(tuple(r) for r in got) == seen_by_hand(points, cameras, strict) and got
    flat = spark.createDataFrame([(i, 7e5 + i / 100, 4.3e6, 1.0) for i in range(100)], "idx int, x double, y double, z double")
    tree = imaging.Octree.of(flat, 2)
    assert tree.depth == 2 and imaging.tried_pairs(flat, b.limit(0), tree).count() == 0
    assert imaging.project_points(a.limit(0), b).count() == 0


def test_few_pairs_are_tried(spark):
    """Cameras that each see a small window of the ground."""
    points = spark.range(20_000).select(F.col("id").alias("idx"), (F.rand(1) * 100).alias("x"), (F.rand(2) * 100).alias("y"), F.rand(3).alias("z"))
    windows = spark.range(200).select(F.col("id").alias("image"), F.lit(50).alias("width"), F.lit(50).alias("height"), *[(F.lit(10.0) if m in ("m11", "m22") else F.lit(1.0) if m == "m34" else F.rand(i) * -950 if m in ("m14", "m24") else F.lit(0.0)).alias(m) for i, m in enumerate(imaging.MATRIX)])
    tried = imaging.tried_pairs(points, windows, imaging.Octree.of(points, 16)).count()
    assert tried < 20_000 * 200 / 40


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_updates_touch_their_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.range(100).select(F.col("id").alias("record_id"), F.when(F.col("id") % 3 != 0, F.lit("old")).alias("run_id"), (F.col("id") % 5).alias("part"))
    rows.coalesce(1).write.partitionBy("part").parquet(path)
    before = files_of(path)
    updates = spark.createDataFrame([(7, "new"), (12, None), (1000, "nowhere")], "record_id long, run_id string")
    sinks.update_table(updates, path, "record_id", ["run_id"], "part", str(tmp_path / "s1"))
    after = files_of(path)
    kept = {f for f in before if f in after and before[f] == after[f]}
    assert {f.split("part=")[1][0] for f in before.keys() - kept} == {"2"} and len(kept) == 4
    want = {i: "new" if i == 7 else None if i % 3 == 0 else "old" for i in range(100)}
    assert {r["record_id"]: r["run_id"] for r in spark.read.parquet(path).collect()} == want
    # a call whose staging folder is finished puts that in place, whatever became of the table meanwhile
    for f in after:
        if "part=2" in f:
            os.remove(f)
    sinks.update_table(updates, path, "record_id", ["run_id"], "part", str(tmp_path / "s1"))
    assert {r["record_id"]: r["run_id"] for r in spark.read.parquet(path).collect()} == want
    with pytest.raises(Exception, match="stands twice"):
        sinks.update_table(updates.unionAll(updates), path, "record_id", ["run_id"], "part", str(tmp_path / "s2"))
    assert {r["record_id"]: r["run_id"] for r in spark.read.parquet(path).collect()} == want
    sinks.fill_run_ids(spark, path, "filled", 94, "part", str(tmp_path / "s3"))
    want |= {96: "filled", 99: "filled"}
    assert {r["record_id"]: r["run_id"] for r in spark.read.parquet(path).collect()} == want


def test_keys_given_twice(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "k int, v string")
    assert relational.one_a_key(df, "k").count() == 3
    with pytest.raises(Exception, match="stands twice"):
        relational.one_a_key(df.unionAll(df), "k").collect()


def test_digests_by_blocks(spark, tmp_path):
    folder = tmp_path / "a b%20c"
    folder.mkdir()
    for name, data in (("one.tif", b"x" * 200_000), ("two.tif", b""), ("three.jpg", b"abc")):
        (folder / name).write_bytes(data)
    got = {r["name"]: r["md5sum"] for r in readers.list_images(spark, str(folder), "tif", md5=True).collect()}
    assert got == {"one.tif": hashlib.md5(b"x" * 200_000).hexdigest()}  # and not the empty one
    with open(folder / "large.raw", "wb") as f:  # beyond what one value can hold
        f.truncate(3 << 30)
    digest = hashlib.md5()
    for _ in range(3 << 10):
        digest.update(bytes(1 << 20))
    assert [r["md5sum"] for r in readers.list_images(spark, str(folder), "raw", md5=True).collect()] == [digest.hexdigest()]


def test_rows_without_a_first_field_are_kept(spark, tmp_path):
    lines = ["lat,lon,alt" + ",h" * 41] + [",".join(v if i == 0 else "1" for i in range(44)) for v in ("39.1", "")]
    (tmp_path / "log.csv").write_text("\n".join(lines))
    got = readers.read_flight_log(spark, str(tmp_path / "log.csv")).collect()
    assert sorted((r["lat"] for r in got), key=repr) == [39.1, None]
