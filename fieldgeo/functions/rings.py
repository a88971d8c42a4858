"""Polygon rings as array<struct<x, y>>, without the closing point repeated; all are Column expressions."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import overlap

POINT = "struct<x:double,y:double>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often use reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def point(x: Column | float, y: Column | float) -> Column:
    as_col = lambda v: (v if isinstance(v, Column) else F.lit(float(v))).cast("double")
    return F.struct(as_col(x).alias("x"), as_col(y).alias("y"))


def ring(*points: Column) -> Column:
    return F.array(*points)


def box_ring(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """The box's corners, counter-clockwise from the lower left."""
    return F.array(point(xmin, ymin), point(xmax, ymin), point(xmax, ymax), point(xmin, ymax))


def _next(r: Column) -> Column:
    return F.concat(F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(0))), F.slice(r, 1, 1))


def edges(r: Column) -> Column:
    """array<struct<a, b>> of the ring's edges, the closing one last."""
    return F.zip_with(r, _next(r), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def cross(o: Column, a: Column, b: Column) -> Column:
    """Twice the area of o, a, b; positive if they turn left."""
    return (a["x"] - o["x"]) * (b["y"] - o["y"]) - (a["y"] - o["y"]) * (b["x"] - o["x"])


def _total(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0.0), lambda s, v: s + v)


def signed_area(r: Column) -> Column:
    """Shoelace area, positive if counter-clockwise; computed from the first corner, for far-off coordinates' sake."""
    o = F.get(r, F.lit(0))
    return F.coalesce(_total(F.transform(edges(r), lambda e: cross(o, e["a"], e["b"]))) / 2, F.lit(0.0))


def area(r: Column) -> Column:
    return F.abs(signed_area(r))


def centroid(r: Column) -> Column:
    """struct(x, y); the mean of the corners where the area is 0."""
    o = F.get(r, F.lit(0))
    weighted = lambda axis: _total(F.transform(edges(r), lambda e: cross(o, e["a"], e["b"]) * (e["a"][axis] + e["b"][axis] - 2 * o[axis])))
    mean = lambda axis: _total(F.transform(r, lambda p: p[axis])) / F.size(r)
    a = signed_area(r)
    return F.struct(*[F.when(a == 0, mean(c)).otherwise(o[c] + weighted(c) / (6 * a)).alias(c) for c in ("x", "y")])


def bbox(r: Column) -> Column:
    values = lambda axis: F.transform(r, lambda p: p[axis])
    return F.struct(F.array_min(values("x")).alias("xmin"), F.array_min(values("y")).alias("ymin"), F.array_max(values("x")).alias("xmax"), F.array_max(values("y")).alias("ymax"))


def on_edge(r: Column, x: Column, y: Column) -> Column:
    p = point(x, y)
    between = lambda e, axis: p[axis].between(F.least(e["a"][axis], e["b"][axis]), F.greatest(e["a"][axis], e["b"][axis]))
    return F.exists(edges(r), lambda e: (cross(e["a"], e["b"], p) == 0) & between(e, "x") & between(e, "y"))


def contains(r: Column, x: Column, y: Column) -> Column:
    """Whether the point lies inside, the boundary left out."""
    crossing = lambda e: ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (x < (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"])
    odd = F.size(F.filter(edges(r), crossing)) % 2 == 1
    return odd & ~on_edge(r, x, y)


def prepared(r: Column) -> Column:
    """The ring's edges as array<struct<ax, ay, bx, by>>, for contains_prepared: made once a ring, not once a point."""
    return F.zip_with(r, _next(r), lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")))


def contains_prepared(prepared_edges: Column, x: Column, y: Column) -> Column:
    """As contains, of a prepared ring: one pass over its edges, which counts those to the right and stops counting at one that holds the point."""
    turn = lambda e: (e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"])
    between = lambda e: y.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"])) & x.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"]))
    right = lambda e: ((e["ay"] > y) != (e["by"] > y)) & (x < (e["bx"] - e["ax"]) * (y - e["ay"]) / (e["by"] - e["ay"]) + e["ax"])
    on_edge = 1 << 20
    count = F.aggregate(prepared_edges, F.lit(0), lambda n, e: n + F.when(between(e) & (turn(e) == 0), F.lit(on_edge)).when(right(e), F.lit(1)).otherwise(F.lit(0)))
    return (count < on_edge) & (count % 2 == 1)


def digest(r: Column) -> Column:
    """16 bytes that tell a ring from others, to group and join equal ones by; none for a null ring, as a join's own test for nulls would make all rings once more, in the tasks
    that read them."""
    return F.coalesce(F.unhex(F.md5(r.cast("string").cast("binary"))), F.lit(b""))


def is_box(r: Column) -> Column:
    """Whether the ring is its own bounding box: four corners, each on two of the box's sides, none twice."""
    box = bbox(r)
    corner = lambda p: ((p["x"] == box["xmin"]) | (p["x"] == box["xmax"])) & ((p["y"] == box["ymin"]) | (p["y"] == box["ymax"]))
    straight = lambda e: (e["ax"] == e["bx"]) != (e["ay"] == e["by"])
    return (F.size(r) == 4) & F.forall(r, corner) & F.forall(prepared(r), straight)


@F.arrow_udf(T.DoubleType())
def _common_area(a: pa.Array, b: pa.Array) -> pa.Array:
    return overlap.common_area(a, b)


def common_area(a: Column, b: Column) -> Column:
    """The area that two simple rings of any shape have in common, concave and touching themselves included; null where one is null."""
    return _common_area(a.cast(f"array<{POINT}>"), b.cast(f"array<{POINT}>"))


def with_holes(outer: Column, holes: Column) -> Column:
    """One ring for a polygon with holes: from the outer ring's start over to each hole, round it the other way, and back.

    Area, common area and containment are those of the polygon with its holes, as the ways over and back cancel; points just
    on such a way count as on an edge.
    """
    start = F.slice(outer, 1, 1)
    turned = lambda h: F.when(F.signum(signed_area(h)) == F.signum(signed_area(outer)), F.reverse(h)).otherwise(h)
    ways = F.transform(F.filter(holes, lambda h: F.size(h) > 2), lambda h: F.concat(turned(h), F.slice(turned(h), 1, 1), start))
    return F.when(F.size(ways) > 0, F.concat(outer, start, F.flatten(ways))).otherwise(outer)


def _touch(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Whether segments ab and cd meet, touching included."""
    side = lambda o, p, q: F.signum(cross(o, p, q))
    apart = lambda axis: (F.greatest(a[axis], b[axis]) < F.least(c[axis], d[axis])) | (F.greatest(c[axis], d[axis]) < F.least(a[axis], b[axis]))
    return (side(a, b, c) * side(a, b, d) <= 0) & (side(c, d, a) * side(c, d, b) <= 0) & ~apart("x") & ~apart("y")


def line_intersects(line: Column, r: Column) -> Column:
    """Whether a line of points meets the polygon, its inside and boundary included."""
    parts = F.zip_with(F.slice(line, 1, F.greatest(F.size(line) - 1, F.lit(0))), F.slice(line, 2, F.greatest(F.size(line) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    meets = F.exists(parts, lambda s: F.exists(edges(r), lambda e: _touch(s["a"], s["b"], e["a"], e["b"])))
    return meets | contains(r, line[0]["x"], line[0]["y"])


def counter_clockwise(r: Column) -> Column:
    return F.when(signed_area(r) < 0, F.reverse(r)).otherwise(r)


def clip(subject: Column, window: Column) -> Column:
    """The part of a ring inside a convex ring, cut edge by edge; common_area takes rings of any shape."""
    return clip_convex(subject, counter_clockwise(window))


def clip_convex(subject: Column, window: Column) -> Column:
    """As clip, for a counter-clockwise window."""

    def cut(points: Column, e: Column) -> Column:
        def step(s: Column) -> Column:
            a, b, da, db = s["a"], s["b"], s["da"], s["db"]
            t = da / (da - db)
            meet = point(a["x"] + t * (b["x"] - a["x"]), a["y"] + t * (b["y"] - a["y"]))
            return F.when((da >= 0) & (db >= 0), F.array(b)).when(da >= 0, F.array(meet)).when(db >= 0, F.array(meet, b)).otherwise(F.array().cast(f"array<{POINT}>"))

        side = lambda p: cross(e["a"], e["b"], p)
        sided = F.transform(points, lambda p: F.struct(p.alias("p"), side(p).alias("d")))
        pairs = let(sided, lambda q: F.zip_with(q, _next(q), lambda a, b: F.struct(a["p"].alias("a"), b["p"].alias("b"), a["d"].alias("da"), b["d"].alias("db"))))
        return F.flatten(F.transform(pairs, step))

    return F.aggregate(edges(window), subject.cast(f"array<{POINT}>"), cut)


def hull_of(points: Column) -> Column:
    """Convex hull of array<struct<x, y>>, counter-clockwise from the leftmost lowest point, without points on its edges."""
    points = F.array_sort(F.array_distinct(points))

    def half(ordered: Column) -> Column:
        def push(chain: Column, p: Column) -> Column:
            left = lambda i: cross(F.get(chain, i - 2), F.get(chain, i - 1), p) > 0
            keep = F.when(F.size(chain) < 2, F.size(chain)).otherwise(F.coalesce(F.array_max(F.filter(F.sequence(F.lit(2), F.greatest(F.size(chain), F.lit(2))), left)), F.lit(1)))
            return F.array_append(F.slice(chain, F.lit(1), keep), p)

        return F.aggregate(ordered, F.array().cast(f"array<{POINT}>"), push)

    low, high = half(points), half(F.reverse(points))
    most = lambda c: F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0)))
    return F.when(F.size(points) < 3, points).otherwise(F.concat(most(low), most(high)))


def straight_somewhere(r: Column) -> Column:
    """Whether any corner lies on the line from the one before to the one after."""
    after = _next(r)
    return (F.size(r) > 2) & F.exists(F.zip_with(F.zip_with(r, after, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), _next(after), lambda e, c: cross(e["a"], e["b"], c) == 0), lambda v: v)


def side_pairs(hull: Column) -> Column:
    """struct(n, twice) of a hull with the points on its edges: pairs of points that have no other one to their right, and the sum of their shoelace terms.

    An edge with m points has m * (m - 1) / 2 of them; a hull that is a line has two edges, there and back.
    """
    none = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("twice"))

    def along(e: Column) -> Column:
        on = F.array_sort(F.filter(hull, lambda p: cross(e["a"], e["b"], p) == 0))
        sums = F.aggregate(on, none, lambda s, p: F.struct((s["x"] + p["x"]).alias("x"), (s["y"] + p["y"]).alias("y"), (s["twice"] + s["x"] * p["y"] - s["y"] * p["x"]).alias("twice")), lambda s: s["twice"])
        return F.struct((F.size(on) * (F.size(on) - 1) / 2).cast("long").alias("n"), F.when(e["a"] < e["b"], sums).otherwise(-sums).alias("twice"))

    sides = F.transform(edges(hull_of(hull)), along)
    return let(sides, lambda s: F.struct(F.aggregate(s, F.lit(0).cast("long"), lambda n, v: n + v["n"]).alias("n"), _total(F.transform(s, lambda v: v["twice"])).alias("twice")))
