"""Image sets, calibration, altitude cuts, and point projection into images."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geodesy, rings, text
from . import relational


def validate_sets(images: DataFrame, n: int = 5, min_size: int = 2_097_152, stem: str = "stem", size: str = "size") -> DataFrame:
    """images with n_members, is_valid and reason: 'truncated' if a member of the set is under min_size, else 'missing' if it has other than n."""
    sets = images.groupBy(stem).agg(F.count("*").alias("n_members"), F.min(size).alias("__least"))
    reason = F.when(F.col("__least") < min_size, "truncated").when(F.col("n_members") != n, "missing")
    sets = sets.select(stem, "n_members", reason.alias("reason"), reason.isNull().alias("is_valid"))
    return images.join(sets, stem)


def altitude_threshold(df: DataFrame, by: str, altitude: str = "altitude") -> DataFrame:
    """min_alt, mean_alt over altitudes above 0, and threshold = min + (mean - min) / 2."""
    out = df.where(F.col(altitude) > 0).groupBy(by).agg(F.min(altitude).alias("min_alt"), F.avg(altitude).alias("mean_alt"))
    return out.withColumn("threshold", F.col("min_alt") + 0.5 * (F.col("mean_alt") - F.col("min_alt")))


def split_low_altitude(images: DataFrame, by: str, stem: str = "stem", band: str = "band", lead: object = 1, altitude: str = "altitude") -> DataFrame:
    """images with low: whether the set's leading band lies under the group's threshold; sets without one are not low."""
    leads = images.where(F.col(band) == lead)
    marked = leads.join(altitude_threshold(leads, by, altitude), by).groupBy(stem).agg(F.max(F.col(altitude) < F.col("threshold")).alias("low"))
    return images.join(marked, stem, "left").withColumn("low", F.coalesce("low", F.lit(False)))


def calibration_factors(panel_pixels: DataFrame, panel: DataFrame) -> DataFrame:
    """(band, mean, factor): reflectance of the panel over the mean of images' mean radiance; null where that is 0.

    panel_pixels: image, band, radiance, in_panel. panel: band, reflectance. Unknown bands are left out.
    """
    inside = panel_pixels.where(F.col("in_panel")).withColumn("band", text.band_name(F.col("band"))).where("band is not null")
    means = inside.groupBy("band", "image").agg(F.avg("radiance").alias("m")).groupBy("band").agg(F.avg("m").alias("mean"))
    known = panel.withColumn("band", text.band_name(F.col("band")))
    return means.join(known, "band").select("band", "mean", F.when(F.col("mean") != 0, F.col("reflectance") / F.col("mean")).alias("factor"))


def panel_factors(calibration: DataFrame, serial: str) -> DataFrame:
    """(band, reflectance) of one panel from (serial_number, parameter_type, parameter_value); unknown types get a null band."""
    own = calibration.where(F.col("serial_number") == serial)
    return own.select(text.band_name(F.col("parameter_type")).alias("band"), F.col("parameter_value").alias("reflectance"), "parameter_type")


def apply_factors(pixels: DataFrame, factors: DataFrame, bits: Column | int = 16) -> DataFrame:
    """pixels with value: radiance scaled by the band's factor to an unsigned integer of `bits`."""
    known = factors.select("band", "factor")
    return pixels.join(known, "band").withColumn("value", geodesy.scale_reflectance(F.col("radiance"), F.col("factor"), bits)).drop("factor")


def with_sizes(cameras: DataFrame, sizes: DataFrame, ext: str = "dng") -> DataFrame:
    """cameras with the width and height of the image file that a matrix belongs to: its name's first part with ext. Cameras without one go."""
    name = F.concat(F.get(F.split("image", r"\."), F.lit(0)), F.lit(f".{ext}"))
    known = sizes.select(F.col("image").alias("__file"), "width", "height")
    return cameras.drop("width", "height").withColumn("__file", name).join(known, "__file").drop("__file")


NODE_POINTS = 4096  # points of an octree's leaf, about
DEEPEST = 8  # levels of the octree at most
MATRIX = [f"m{r}{c}" for r in (1, 2, 3) for c in (1, 2, 3, 4)]


class Octree:
    """Equal cubes of the box that holds all points, halved `depth` times each way; a node of a level is its three numbers there."""

    def __init__(self, low: list[float], high: list[float], depth: int):
        self.low, self.depth = low, depth
        self.sides = [b - a for a, b in zip(low, high, strict=True)]
        self.slack = [1e-9 * max(abs(a), abs(b)) for a, b in zip(low, high, strict=True)]

    @classmethod
    def of(cls, points: DataFrame, node_points: int) -> Octree:
        """For points (x, y, z), as deep as evenly spread ones need; one aggregate over them."""
        ends = [f(F.col(c).cast("double")).alias(f"{c}_{n}") for n, f in (("low", F.min), ("high", F.max)) for c in "xyz"]
        n, *found = points.agg(F.count("*"), *ends).first()
        if None in found:
            return cls([0.0] * 3, [0.0] * 3, 0)
        return cls(found[:3], found[3:], min(DEEPEST, max(0, math.ceil(math.log(max(n, 1) / node_points, 8)))))

    def leaf(self) -> dict[str, Column]:
        """A point's leaf."""
        cells = 1 << self.depth
        number = lambda c, low, side: F.least(F.floor((F.col(c) - low) / side * cells), F.lit(cells - 1)).cast("int") if side > 0 else F.lit(0)
        return {f"__n{c}": number(c, low, side) for c, low, side in zip("xyz", self.low, self.sides, strict=True)}

    def range_of(self, level: int, weights: list[Column]) -> tuple[Column, Column]:
        """The least and greatest value of w1 * x + w2 * y + w3 * z + w4 over a node of a level: its value in the middle, and how far it gets from there."""
        middle, reach = weights[3], F.lit(0.0)
        for w, c, low, side, slack in zip(weights, "xyz", self.low, self.sides, self.slack, strict=False):
            half = side / (1 << level) / 2
            middle = middle + w * (F.lit(low) + (2 * F.col(f"__n{c}") + 1) * half)
            reach = reach + F.abs(w) * (half * (1 + 1e-6) + slack)
        return middle - reach, middle + reach

    def may_see(self, level: int) -> Column:
        """Whether a camera (__m) may see any point of a node: no bound of its frame has all of the node on its outer side.

        For a depth w over 0, u >= 0 and u < width + 1 are u * w >= 0 and u * w - (width + 1) * w < 0, linear in the point; for w under 0 the other way
        round.
        """
        row = lambda r: [F.col(f"__m.m{r}{c}") for c in (1, 2, 3, 4)]
        over = lambda r, size: [a - (F.col(f"__m.{size}") + 1) * w for a, w in zip(row(r), row(3), strict=True)]
        depth = self.range_of(level, row(3))
        inner, outer = [self.range_of(level, row(r)) for r in (1, 2)], [self.range_of(level, over(r, size)) for r, size in ((1, "width"), (2, "height"))]
        before = (depth[1] > 0) & (inner[0][1] >= 0) & (inner[1][1] >= 0) & (outer[0][0] <= 0) & (outer[1][0] <= 0)
        behind = (depth[0] < 0) & (inner[0][0] <= 0) & (inner[1][0] <= 0) & (outer[0][1] >= 0) & (outer[1][1] >= 0)
        return before | behind

    def seen_by(self, cameras: DataFrame) -> DataFrame:
        """(__m, __nx, __ny, __nz): every camera with the leaves that it may see, from the root down; no shuffle."""
        nodes = cameras.select(F.struct("image", "width", "height", *MATRIX).alias("__m"), *[F.lit(0).alias(f"__n{c}") for c in "xyz"]).where(self.may_see(0))
        for level in range(1, self.depth + 1):
            halves = nodes.withColumn("__k", F.explode(F.array(*map(F.lit, range(8)))))
            part = {f"__n{c}": F.col(f"__n{c}") * 2 + F.shiftright("__k", i).bitwiseAND(F.lit(1)) for i, c in enumerate("xyz")}
            nodes = halves.withColumns(part).drop("__k").where(self.may_see(level))
        return nodes


def project_points(points: DataFrame, cameras: DataFrame, key: str = "idx", strict: bool = False, node_points: int = NODE_POINTS) -> DataFrame:
    """(image, key, u, v, and the points' other columns) of each point in each image that sees it.

    cameras: image, width, height and the 12 numbers m11..m34 row by row. Points are put into the leaves of an octree; each camera goes down the
    tree and drops every node that its frame rules out, by the least and greatest value of linear functions over the node's
    box. Points and cameras then meet by equality on the leaf, and are projected exactly. A point with a null coordinate is in no image. Equal cameras are
    projected once, and what they see is joined with their images; where these are many, pack by pack.
    """
    real = points.where("x is not null and y is not null and z is not null")
    named = cameras.withColumn("__shape", F.unhex(F.md5(F.struct("width", "height", *MATRIX).cast("string").cast("binary"))))
    firsts = named.groupBy("__shape").agg(F.first(F.struct("width", "height", *MATRIX)).alias("__f")).select(F.col("__shape").alias("image"), "__f.*")
    seen = projected(real, firsts, Octree.of(real, node_points), key, strict)
    columns = ["image", *[c for c in seen.columns if c != "image"]]
    seen, named = seen.withColumnRenamed("image", "__shape"), named.select("__shape", "image")
    if (named.groupBy("__shape").count().agg(F.max("count")).first()[0] or 0) < relational.PACK:
        return seen.join(named, "__shape").select(*columns)
    packs = math.ceil(max(real.count(), 1) / (4 * relational.PACK))  # a point is seen once at most by a camera
    return relational.with_all_rows(named.select("__shape").distinct(), seen, "__shape", named, "__shape", packs).select(*columns)


def tried_pairs(points: DataFrame, cameras: DataFrame, tree: Octree) -> DataFrame:
    """Points with the cameras that may see their leaf."""
    return points.withColumns(tree.leaf()).join(tree.seen_by(cameras), [f"__n{c}" for c in "xyz"])


def projected(points: DataFrame, cameras: DataFrame, tree: Octree, key: str, strict: bool) -> DataFrame:
    rows = tried_pairs(points, cameras, tree)
    line = lambda r: F.col(f"__m.m{r}1") * F.col("x") + F.col(f"__m.m{r}2") * F.col("y") + F.col(f"__m.m{r}3") * F.col("z") + F.col(f"__m.m{r}4")
    rows = rows.withColumn("__z", line(3)).where("`__z` <> 0")
    rows = rows.withColumns({"u": F.floor(line(1) / F.col("__z")), "v": F.floor(line(2) / F.col("__z"))})
    seen = in_frame(F.col("u"), F.col("v"), F.col("__m.width"), F.col("__m.height"), strict)
    return rows.where(seen).select(F.col("__m.image").alias("image"), key, "u", "v", *[c for c in points.columns if c not in (key, "x", "y", "z")])


def in_frame(u: Column, v: Column, w: Column, h: Column, strict: bool = False) -> Column:
    """0 <= u <= w and 0 < v <= h; strict: 0 <= u < w and 0 <= v < h."""
    return (u >= 0) & (u < w) & (v >= 0) & (v < h) if strict else (u >= 0) & (u <= w) & (v > 0) & (v <= h)


def mask_pixels(pixels: DataFrame, hulls: DataFrame, image: str = "image", u: str = "u", v: str = "v") -> DataFrame:
    """pixels with r, g, b at 128 outside their image's hull (column hull); images without one are all outside."""
    met = pixels.join(hulls.select(image, "hull"), image, "left")
    inside = F.coalesce(rings.contains(F.col("hull"), F.col(u).cast("double"), F.col(v).cast("double")) | rings.on_edge(F.col("hull"), F.col(u).cast("double"), F.col(v).cast("double")), F.lit(False))
    return met.withColumns({c: F.when(inside, F.col(c)).otherwise(F.lit(128)) for c in ("r", "g", "b")}).drop("hull")


def zip_points(a: DataFrame, b: DataFrame, key: str = "idx") -> DataFrame:
    """Points of two files by stored index, with mismatch where colours differ; index must be stored, as rows have no order."""
    right = b.select(key, F.col("x").alias("x2"), F.col("y").alias("y2"), *[F.col(c).alias(f"__{c}") for c in ("r", "g", "b")])
    differ = (F.col("r") != F.col("__r")) | (F.col("g") != F.col("__g")) | (F.col("b") != F.col("__b"))
    return a.join(right, key).withColumn("mismatch", differ).drop("__r", "__g", "__b")
