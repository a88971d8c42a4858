"""Rings, spatial joins and geodesy on small cases."""

import math
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldgeo.functions import cover, geodesy, leaves, overlap, rings, text
from fieldgeo.operators import imaging, spatial, summary

RING = "array<struct<x:double,y:double>>"


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def ring(*points):
    return F.array(*[rings.point(*p) for p in points])


def square():
    return ring((0, 0), (4, 0), (4, 4), (0, 4))


def test_measures(spark):
    assert one(spark, rings.area(square())) == 16 and one(spark, rings.signed_area(F.reverse(square()))) == -16
    c = one(spark, rings.centroid(ring((0, 0), (6, 0), (0, 3))))
    assert (c["x"], c["y"]) == (2, 1)
    assert tuple(one(spark, rings.bbox(square()))) == (0, 0, 4, 4)


def test_contains_leaves_out_the_boundary(spark):
    inside = lambda x, y: one(spark, rings.contains(square(), F.lit(float(x)), F.lit(float(y))))
    assert inside(1, 1) and not inside(0, 1) and not inside(4, 4) and not inside(5, 1)


def test_lines(spark):
    meets = lambda *p: one(spark, rings.line_intersects(ring(*p), square()))
    assert meets((-1, 2), (5, 2)) and meets((1, 1), (2, 2)) and meets((4, 4), (9, 9)) and not meets((5, 0), (5, 4)) and meets((-1, 9), (2, 9), (2, 3))


def test_clip(spark):
    common = rings.clip(ring((2, 2), (6, 2), (6, 6), (2, 6)), F.reverse(square()))
    assert one(spark, rings.area(common)) == 4
    assert one(spark, F.size(rings.clip(ring((9, 9), (10, 9), (10, 10)), square()))) == 0


def brute_hull(points):
    points = sorted(set(points))
    if len(points) < 3:
        return points
    out = []
    for order in (points, points[::-1]):
        chain = []
        for p in order:
            while len(chain) > 1 and (chain[-1][0] - chain[-2][0]) * (p[1] - chain[-2][1]) - (chain[-1][1] - chain[-2][1]) * (p[0] - chain[-2][0]) <= 0:
                chain.pop()
            chain.append(p)
        out += chain[:-1]
    return out


def test_hulls(spark):
    rng = random.Random(2)
    groups = {g: [(float(rng.randint(0, 30)), float(rng.randint(0, 30))) for _ in range(n)] for g, n in enumerate([1, 2, 3, 10, 200, 3000])}
    groups[6] = [(1.0, float(i)) for i in range(9)]
    df = spark.createDataFrame([(g, *p) for g, ps in groups.items() for p in ps] + [(7, None, None)], "run_id int, x double, y double")
    for parts in (1, 3, 40):
        got = {r["run_id"]: [tuple(p) for p in r["hull"]] if r["hull"] else None for r in summary.convex_hull(df.repartition(parts), "run_id").collect()}
        assert got == {g: brute_hull(p) for g, p in groups.items()} | {7: None}


def test_hulls_are_merged_from_partial_ones(spark, monkeypatch):
    rng = random.Random(9)
    points = [(rng.choice(["a", None]), float(rng.randint(0, 99)), float(rng.randint(0, 99))) for _ in range(6000)] + [("b", float("nan"), 1.0)]
    df = spark.createDataFrame(points, "run_id string, x double, y double").repartition(5)
    got = {r["run_id"]: r["hull"] and [tuple(p) for p in r["hull"]] for r in summary.convex_hull(df, "run_id").collect()}
    assert got == {g: brute_hull([p[1:] for p in points if p[0] == g]) for g in ("a", None)} | {"b": None}
    monkeypatch.setattr(summary, "HULL_ROWS", 50)
    rows = pa.RecordBatch.from_arrays([pa.array([p[0] for p in points[:-1]]), *[pa.array([[p[i]] for p in points[:-1]]) for i in (1, 2)]], names=["g", "xs", "ys"])
    (found,) = summary._hulls_of([rows.slice(i, 7) for i in range(0, 6000, 7)], rows.schema)
    assert {g: list(zip(xs, ys, strict=True)) for g, xs, ys in zip(*(c.to_pylist() for c in found.columns), strict=True)} == {g: brute_hull([p[1:] for p in points if p[0] == g]) for g in ("a", None)}


def test_hull_of_a_million_corners(spark):
    """Every point of a circle is a corner: the most that a hull can hold."""
    n = 1_000_000
    angle = F.col("id") * (2 * math.pi / n)
    df = spark.range(n).select(F.lit(1).alias("run_id"), (1e6 * F.cos(angle)).alias("x"), (1e6 * F.sin(angle)).alias("y"))
    began = time.perf_counter()
    corners = summary.convex_hull(df, "run_id").select(F.size("hull").alias("n"), rings.area(F.slice("hull", 1, 3)).alias("a")).first()
    assert corners["n"] > 0.99 * n and time.perf_counter() - began < 40


def test_hull_shuffles_hulls_alone(spark):
    """Ten thousand points a task are a few corners each when they are shuffled."""
    df = spark.range(0, 40_000, 1, 4).select(F.lit(1).alias("run_id"), F.rand(3).alias("x"), F.rand(4).alias("y"))
    partial = df.select("run_id", F.array("x").alias("xs"), F.array("y").alias("ys"))
    names = pa.schema([(c, pa.null()) for c in partial.columns])
    kept = partial.mapInArrow(lambda batches: summary._hulls_of(batches, names), partial.schema).select(F.size("xs").alias("n")).collect()
    assert len(kept) == 4 and max(r["n"] for r in kept) < 120


def test_joins_against_all_pairs(spark):
    rng = random.Random(3)
    points = [(i, rng.uniform(-5, 15), rng.uniform(-5, 15)) for i in range(300)]
    plots = [(i, rng.uniform(-6, 12), rng.uniform(-6, 12), rng.uniform(0.5, 6), rng.uniform(0.5, 3)) for i in range(40)]
    p = spark.createDataFrame(points, "idx int, x double, y double")
    shapes = spark.createDataFrame(plots, "plot_id int, a double, b double, w double, h double")
    ring_of = F.array(rings.point(F.col("a"), F.col("b")), rings.point(F.col("a") + F.col("w"), F.col("b")), rings.point(F.col("a") + F.col("w") / 2, F.col("b") + F.col("h")))
    shapes = shapes.withColumn("ring", ring_of)

    def inside(x, y, a, b, w, h):
        return b < y < b + h and a + (y - b) / h * w / 2 < x < a + w - (y - b) / h * w / 2

    want = {(i, k) for i, x, y in points for k, a, b, w, h in plots if inside(x, y, a, b, w, h)}
    for cell in (0.7, 3.0, 50.0):
        assert {(r["idx"], r["plot_id"]) for r in spatial.assign_plot(p, shapes.select("plot_id", "ring"), cell).collect()} == want
    centres = shapes.select("plot_id", F.col("a").alias("rx"), F.col("b").alias("ry"))
    near = {r["idx"]: r["plot_id"] for r in spatial.nearest(p, centres, "idx", 1.5, right_key="plot_id").collect()}
    for i, x, y in points:
        d, k = min((math.hypot(x - a, y - b), k) for k, a, b, _, _ in plots)
        assert near[i] == (k if d <= 1.5 else None)


def test_overlap_threshold(spark):
    a = spark.createDataFrame([(1, 0.0, 1.0), (2, 0.0, 2.0)], "run_id int, x0 double, x1 double").select("run_id", rings.box_ring(F.col("x0"), F.lit(0.0), F.col("x1"), F.lit(10.0)).alias("ring_a"))
    b = spark.range(1).select(rings.box_ring(*map(F.lit, (0.0, 0.0, 10.0, 10.0))).alias("ring_b"))
    assert [(r["run_id"], r["overlap_pct"]) for r in spatial.overlap_join(a, b, 4.0).collect()] == [(2, 20.0)]


def test_utm(spark):
    u = one(spark, geodesy.to_utm(F.lit(39.1), F.lit(-96.6)))
    assert (u["zone"], u["band"]) == (14, "S") and abs(u["x"] - 707_540) < 200 and abs(u["y"] - 4_330_600) < 500
    r = one(spark, geodesy.from_utm(F.lit(u["x"]), F.lit(u["y"]), F.lit(14), F.lit("S")))
    assert abs(r["lat"] - 39.1) < 1e-9 and abs(r["lon"] + 96.6) < 1e-9
    equator = one(spark, geodesy.to_utm(F.lit(0.0), F.lit(3.0)))
    assert abs(equator["x"] - 500_000) < 1e-6 and abs(equator["y"]) < 1e-6


def test_degrees(spark):
    assert one(spark, geodesy.to_dms(F.lit(-96.5), "lon")) == "96:30:0.0W" and one(spark, geodesy.to_dms(F.lit(0.0), "lat")) == "0:0:0.0"
    assert abs(one(spark, geodesy.dms_to_decimal(F.lit("[96, 30, 1800/100]"), F.lit("W"))) + 96.505) < 1e-9
    assert one(spark, geodesy.rational(F.lit("7/0"))) is None and one(spark, geodesy.altitude(F.lit(None).cast("string"))) == 0


def test_wkt(spark):
    wkt = one(spark, text.wkt_polygon(square()))
    assert wkt.startswith("POLYGON((0.0000000000 0.0000000000, 4.") and one(spark, F.size(text.parse_wkt(F.lit(wkt)))) == 5
    assert one(spark, text.wkt_point(F.lit(None).cast("double"), F.lit(1.0))) is None


def test_pixel_bounds(spark):
    seen = lambda u, v, strict=False: one(spark, imaging.in_frame(F.lit(u), F.lit(v), F.lit(640), F.lit(480), strict))
    assert not seen(0, 0) and seen(0, 1) and seen(640, 480) and not seen(640, 480, True) and seen(0, 0, True)


def inside_by_parity(p, x, y):
    odd = False
    for (ax, ay), (bx, by) in zip(p, p[1:] + p[:1], strict=True):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            odd = not odd
    return odd


def star(rng, n, cx=0.0, cy=0.0, size=10.0):
    """A simple ring of n corners around a centre, concave as a rule."""
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return [(cx + size * r * math.cos(a), cy + size * r * math.sin(a)) for a in angles for r in [rng.uniform(0.2, 1)]]


def common_by_raster(a, b, n=400, lo=-12.0, hi=12.0):
    step = (hi - lo) / n
    at = lambda i: lo + (i + 0.5) * step
    return sum(inside_by_parity(a, at(i), at(j)) and inside_by_parity(b, at(i), at(j)) for i in range(n) for j in range(n)) * step * step


def test_common_area_of_concave_rings(spark):
    rng = random.Random(12)
    pairs = [(star(rng, rng.randint(3, 12)), star(rng, rng.randint(3, 12), 2.0, 1.0)[:: rng.choice((1, -1))]) for _ in range(6)]
    lake = [(0, 0), (8, 0), (8, 8), (0, 8), (0, 0), (2, 2), (2, 6), (6, 6), (6, 2), (2, 2)]  # touches itself along the way to its hole
    touching = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0), (-4, 0), (-4, -4), (0, -4)]  # two squares that meet in a corner
    arrow = [(0, 0), (4, 0), (4, 4), (2, 1)]
    square_ = [(-1, -1), (9, -1), (9, 9), (-1, 9)]
    pairs += [(arrow, square_), (square_, arrow), (lake, square_), (lake, star(rng, 9, 4, 4, 5)), (touching, star(rng, 9))]
    rows = [(i, [{"x": float(x), "y": float(y)} for x, y in a], [{"x": float(x), "y": float(y)} for x, y in b]) for i, (a, b) in enumerate(pairs)] + [(98, None, pairs_ring(square_)), (99, [], pairs_ring(square_))]
    df = spark.createDataFrame(rows, f"i int, a {RING}, b {RING}")
    got = {r["i"]: r["c"] for r in df.select("i", rings.common_area(F.col("a"), F.col("b")).alias("c")).collect()}
    for i, (a, b) in enumerate(pairs):
        assert abs(got[i] - common_by_raster(a, b)) < 0.6, i
    assert abs(got[6] - got[7]) < 1e-9 and abs(got[6] - 6) < 1e-9 and abs(got[8] - 48) < 1e-9 and got[98] is None and got[99] == 0


def pairs_ring(points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def test_common_area_far_from_the_origin_and_in_blocks(monkeypatch):
    a = [(0, 0), (4, 0), (4, 4), (2, 1)]
    kind = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
    column = lambda *rows: pa.array([None if r is None else pairs_ring(r) for r in rows], kind)
    moved = [(x + 7e5, y + 4.3e6) for x, y in a]
    box = [(x + 7e5, y + 4.3e6) for x, y in ((-1, -1), (9, -1), (9, 9), (-1, 9))]
    monkeypatch.setattr(overlap, "PAIRS_AT_ONCE", 5)
    got = overlap.common_area(column(a, moved, None, moved), column(a, box, a, [])).to_pylist()
    assert got[0] == 6 and abs(got[1] - 6) < 1e-6 and got[2:] == [None, 0]


def test_overlap_of_concave_fields(spark):
    rng = random.Random(5)
    shapes = [star(rng, 8, rng.uniform(-8, 8), rng.uniform(-8, 8), 4.0) for _ in range(12)]
    fields = spark.createDataFrame([(i, pairs_ring(p)) for i, p in enumerate(shapes)], f"i int, ring_b {RING}")
    runs = fields.select((F.col("i") + 100).alias("j"), F.col("ring_b").alias("ring_a"))
    want = {(i, j) for i, b in enumerate(shapes) for j, a in enumerate(shapes) if 100 * overlap.common_area(*(pa.array([pairs_ring(p)]) for p in (a, b)))[0].as_py() > 10 * abs(area_of(b))}
    for cell in (1.0, 30.0):
        got = {(r["i"], r["j"] - 100) for r in spatial.overlap_join(runs, fields, cell).collect()}
        assert got == want and len(got) > 12


def area_of(p):
    return sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(p, p[1:] + p[:1], strict=True)) / 2


def test_cover_holds_the_inside_once():
    rng = random.Random(6)
    for n, size in ((3, 10.0), (9, 100.0), (30, 5000.0), (12, 1e6)):
        p = star(rng, n, 3.0, -7.0, size)
        a = np.array(p)
        level = max(0, math.ceil(math.log2(max(np.ptp(a, axis=0)) / cover.ACROSS)))
        cells = cover.cover(a, 1.0, level)
        assert len(cells) <= 60 * n + 100
        by_level = {}
        for k, cx, cy, inner in cells:
            by_level.setdefault(k, {})[cx, cy] = inner
        for _ in range(2000):
            x, y = rng.uniform(3 - size, 3 + size), rng.uniform(-7 - size, size - 7)
            found = [kind for k, own in by_level.items() if (kind := own.get((math.floor(x / 2.0**k), math.floor(y / 2.0**k)))) is not None]
            assert len(found) <= 1 and (not inside_by_parity(p, x, y) or len(found) == 1) and (not any(found) or inside_by_parity(p, x, y))


def test_points_in_polygons_of_all_sizes(spark):
    rng = random.Random(7)
    shapes = [star(rng, rng.randint(3, 9), rng.uniform(-50, 50), rng.uniform(-50, 50), size) for size in (1.0, 2.0, 30.0, 400.0, 3e6) for _ in range(4)]
    points = [(i, rng.uniform(-90, 90), rng.uniform(-90, 90)) for i in range(600)]
    polygons = spark.createDataFrame([(i, pairs_ring(p)) for i, p in enumerate(shapes)], f"plot_id int, ring {RING}")
    want = {(i, k) for i, x, y in points for k, p in enumerate(shapes) if inside_by_parity(p, x, y)}
    for cell in (0.5, 20.0):
        got = spatial.assign_plot(spark.createDataFrame(points, "idx int, x double, y double"), polygons, cell).select("idx", "plot_id").collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert spatial.polygons_on_grid(polygons, 0.5).count() < 20 * 400


def test_polygons_from_wkt(spark):
    wkt = "POLYGON((0 0, 8 0, 8 8, 0 8, 0 0), (2 2, 6 2, 6 6, 2 6, 2 2))"
    ring_ = text.parse_polygon(F.lit(wkt))
    inside = lambda x, y: one(spark, rings.contains_prepared(rings.prepared(ring_), F.lit(float(x)), F.lit(float(y))))
    assert one(spark, rings.area(ring_)) == 48 and one(spark, F.size(text.parse_wkt(F.lit(wkt)))) == 5
    assert inside(1, 5) and not inside(3, 5) and inside(7, 5) and not inside(9, 5) and not inside(2, 3) and not inside(8, 1)
    assert one(spark, F.size(text.parse_polygon(F.lit("POLYGON((0 0, 1 0, 1 1, 0 0))")))) == 3


def test_boxes_are_told(spark):
    box = lambda *p: one(spark, rings.is_box(ring(*p)))
    assert box((0, 0), (2, 0), (2, 1), (0, 1)) and box((0, 1), (2, 1), (2, 0), (0, 0))
    assert not box((0, 0), (2, 0), (2, 1), (0, 2)) and not box((0, 0), (2, 1), (2, 0), (0, 1)) and not box((0, 0), (1, 0), (1, 1))


def nearest_by_hand(left, right, k, most=None):
    out = []
    for i, x, y in left:
        near = sorted((math.hypot(x - a, y - b), r) for r, a, b in right) if x is not None else []
        near = [n for n in near if most is None or n[0] <= most][:k]
        out += [(i, r, n + 1, round(d, 6)) for n, (d, r) in enumerate(near)] or [(i, None, None, None)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("leaf_rows", [2, 64])
def test_nearest_against_all_pairs(spark, leaf_rows):
    """A dense cluster, far points, many rows at one place, nulls."""
    rng = random.Random(leaf_rows)
    right = [(i, rng.gauss(0, 0.01), rng.gauss(0, 0.01)) for i in range(300)] + [(300 + i, rng.uniform(-50, 50), rng.uniform(-50, 50)) for i in range(60)] + [(400 + i, 7.0, 7.0) for i in range(20)]
    left = [(i, rng.uniform(-60, 60), rng.uniform(-60, 60)) for i in range(80)] + [(100 + i, rng.gauss(0, 0.02), rng.gauss(0, 0.02)) for i in range(40)] + [(200, 1e6, -1e6), (201, 7.0, 7.0), (202, None, 1.0)]
    a = spark.createDataFrame(left, "idx int, x double, y double")
    b = spark.createDataFrame([*right, (999, None, 0.0)], "right_key int, rx double, ry double")
    rows = lambda df: sorted(((r["idx"], r["right_key"], r["rank"], r["distance"] if r["distance"] is None else round(r["distance"], 6)) for r in df.collect()), key=repr)
    for k, most in ((5, None), (25, 30.0), (1000, None)):
        assert rows(spatial.nearest(a, b, "idx", most, k=k, leaf_rows=leaf_rows)) == nearest_by_hand(left, right, k, most)
    single = spatial.nearest(a, b, "idx", leaf_rows=leaf_rows)
    assert rows(single.withColumn("rank", F.when(F.col("right_key").isNotNull(), 1))) == nearest_by_hand(left, right, 1)
    assert spatial.nearest(a, b.limit(0), "idx").where("right_key is not null").count() == 0


def test_nearest_looks_at_few_leaves(spark):
    """A dense cluster and a sparse surround: of some four thousand leaves a point is joined with a few."""
    rng = np.random.default_rng(3)
    at = np.concatenate([rng.normal(0, 1e-3, (8000, 2)), rng.uniform(-100, 100, (8000, 2))])
    points = spark.createDataFrame([tuple(map(float, p)) for p in at], "rx double, ry double")
    found = leaves.build(points, "rx", "ry", 4, 64)
    assert found.boxes.count.sum() == len(at) and found.boxes.n_leaves > 2000 and found.boxes.count.max() < 40
    x, y = np.concatenate([rng.uniform(-150, 150, (2, 500)), rng.normal(0, 1e-3, (2, 500))], axis=1)
    rows, _ = found.boxes.near(x, y, 1, None)
    assert len(set(rows.tolist())) == 1000 and len(rows) < 1000 * 10


def test_boxes_and_lines_of_all_sizes(spark):
    """One very large box or line doesn't become very many rows, and meets what it should."""
    rng = random.Random(11)
    spans = [(i, x, y, x + w, y + w * rng.uniform(0.1, 2)) for i, w in enumerate([0.5, 1.0, 3.0, 40.0, 5e5, 3e6] * 6) for x, y in [(rng.uniform(-60, 60), rng.uniform(-60, 60))]]
    boxes = spark.createDataFrame(spans, "i int, xmin double, ymin double, xmax double, ymax double")
    points = [(j, rng.uniform(-80, 80), rng.uniform(-80, 80)) for j in range(300)]
    met = spatial.box_join(spark.createDataFrame(points, "j int, x double, y double"), boxes, 1.0).select("i", "j").collect()
    want = {(i, j) for i, a, b, c, d in spans for j, x, y in points if a <= x <= c and b <= y <= d}
    assert len(met) == len(want) and {tuple(r) for r in met} == want
    ringed = boxes.select("i", rings.box_ring(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")]).alias("ring_b"))
    met = spatial.overlap_join(ringed.select((F.col("i") + 100).alias("j"), F.col("ring_b").alias("ring_a")), ringed, 1.0, min_pct=0.001).select("i", "j").collect()
    shared = lambda p, q: max(0, min(p[3], q[3]) - max(p[1], q[1])) * max(0, min(p[4], q[4]) - max(p[2], q[2]))
    want = {(q[0], p[0] + 100) for p in spans for q in spans if shared(p, q) * 100 > 0.001 * (q[3] - q[1]) * (q[4] - q[2])}
    assert len(met) == len(want) and {tuple(r) for r in met} == want
    lines = boxes.select((F.col("i") + 100).alias("j"), F.array(rings.point(F.col("xmin"), F.col("ymin")), rings.point(F.col("xmax"), F.col("ymin"))).alias("line"))
    met = spatial.line_polygon_join(lines, ringed.withColumnRenamed("ring_b", "ring"), 1.0).select("i", "j").collect()
    want = {(q[0], p[0] + 100) for p in spans for q in spans if q[2] <= p[2] <= q[4] and p[1] <= q[3] and q[1] <= p[3]}
    assert len(met) == len(want) and {tuple(r) for r in met} == want
    large = boxes.withColumn("__b", F.struct("xmin", "ymin", "xmax", "ymax"))
    assert spatial._on_levels(large, 1.0, "__b", [0, 4, 18, 20]).count() < 36 * 4 * 36
