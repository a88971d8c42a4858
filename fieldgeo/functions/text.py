"""Names, WKT, and other strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rings

#: Fixed names of the five bands, by what listings call them.
BAND_NAMES = {"blue": "blue", "green": "green", "red": "red", "red edge": "red_edge", "red_edge": "red_edge", "rededge": "red_edge", "nir": "nir"}
BANDS = ("blue", "green", "red", "nir", "red_edge")

#: Fixed camera and image-type names of data-set folders, spelled as they may be there.
CAMERAS = {"RedEdge": "MRE", "rededge": "MRE", "Rededge": "MRE"}
IMAGE_TYPES = {"still": "Still", "Still": "Still", "stills": "Still", "video": "Video", "Video": "Video"}


def _lookup(names: dict[str, str], key: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, value in names.items():
        out = F.when(key == name, value).otherwise(out)
    return out


def coordinate(x: Column) -> Column:
    """A coordinate in WKT: 10 decimals."""
    return F.format_string("%.10f", x)


def wkt_point(x: Column, y: Column) -> Column:
    return F.when(x.isNotNull() & y.isNotNull(), F.concat(F.lit("POINT("), coordinate(x), F.lit(" "), coordinate(y), F.lit(")")))


def _wkt_rings(text: Column) -> Column:
    """The innermost brackets' points: a polygon's rings as they stand, or the one line."""
    pairs = lambda body: F.regexp_extract_all(body, F.lit(r"(-?[0-9.eE+-]+\s+-?[0-9.eE+-]+)"), 1)
    points = lambda body: F.transform(pairs(body), lambda p: F.struct(F.split(p, r"\s+")[0].cast("double").alias("x"), F.split(p, r"\s+")[1].cast("double").alias("y")))
    return F.transform(F.regexp_extract_all(text, F.lit(r"\(([^()]+)\)"), 1), points)


def parse_wkt(text: Column) -> Column:
    """The outer ring of a POLYGON, or a LINESTRING's points, as array<struct<x, y>>."""
    return F.get(_wkt_rings(text), F.lit(0))


def parse_polygon(text: Column) -> Column:
    """A POLYGON as one ring, not closed, holes taken in as rings.with_holes does."""
    opened = F.transform(_wkt_rings(text), lambda r: F.when(F.element_at(r, 1) == F.element_at(r, -1), F.slice(r, F.lit(1), F.size(r) - 1)).otherwise(r))
    return rings.let(opened, lambda parts: rings.with_holes(F.get(parts, F.lit(0)), F.slice(parts, F.lit(2), F.size(parts))))


def wkt_polygon(ring: Column) -> Column:
    """The ring closed, as WKT; null for a null or empty ring."""
    points = F.transform(F.concat(ring, F.slice(ring, 1, 1)), lambda p: F.concat(coordinate(p["x"]), F.lit(" "), coordinate(p["y"])))
    return F.when(F.size(ring) > 0, F.concat(F.lit("POLYGON(("), F.array_join(points, ", "), F.lit("))")))


def archive_image_name(sensor: Column, ts: Column, name: Column) -> Column:
    return F.concat_ws("_", sensor, F.date_format(ts, "yyyyMMdd_HHmmss"), name)


def rover_image_name(record: Column, serial: Column, data_set: Column, clock: Column) -> Column:
    """`<serial>_<data set>_<HHmmss>_C0<camera>_<number>` of a trigger record `CAM<n>_IMG_<number>` and its time `HHmmss.SSS`."""
    camera, number = F.substring(record, 4, 1), F.substring(record, 10, 1000)
    return F.concat_ws("_", serial, data_set, F.substring(clock, 1, 6), F.concat(F.lit("C0"), camera), number)


def flight_folder_name(day: Column, time: Column, elevation: Column, camera: Column, angle: Column, kind: Column, index: Column) -> Column:
    """`<date>_<time>_<elevation>_<camera>_<angle>_<type>_<index>`."""
    return F.concat_ws("_", day, time, *[c.cast("string") for c in (elevation, camera, angle, kind, index)])


def set_stem(name: Column) -> Column:
    return F.regexp_replace(name, "_[^_]*$", "")


def _token(text: Column, n: int) -> Column:
    return F.get(F.split(text, "_"), F.lit(n))


def folder_sensor(name: Column) -> Column:
    return _token(name, 1)


def folder_set(name: Column) -> Column:
    return _token(name, 2)


def name_sensor(name: Column) -> Column:
    return _token(name, 0)


def name_date(name: Column) -> Column:
    return _token(name, 1)


def zfill(value: Column, n: int) -> Column:
    text = value.cast("string")
    return F.when(F.length(text) >= n, text).otherwise(F.lpad(text, n, "0"))


def clean_id(text: Column) -> Column:
    return F.regexp_replace(F.trim(text), "_", "-")


def content_md5(content: Column) -> Column:
    return F.md5(content)


def band_name(text: Column) -> Column:
    """The band's usual name, null where unknown."""
    return _lookup(BAND_NAMES, F.lower(F.trim(text)))


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1)


def ext(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]*)$", 1))


def matches(text: Column, pattern: str) -> Column:
    return text.rlike(pattern)


def split_tabs(text: Column) -> Column:
    return F.split(text, r"\t+")


def of_type(path: Column, *suffixes: str) -> Column:
    return ext(path).isin(*[s.lower().lstrip(".") for s in suffixes])


def dataset_fields(name: Column) -> Column:
    """struct of a data-set folder's eight `_` tokens, what they mean, is_valid, and the first error.

    planned is the elevation as written, angle the lens angle without its sign.
    """
    parts = F.split(name, "_")
    at = lambda i: F.get(parts, F.lit(i))
    day = F.try_to_date(at(0), "yyyyMMdd")
    camera, kind = _lookup(CAMERAS, at(3)), _lookup(IMAGE_TYPES, at(6))
    elevation = F.when(at(4).rlike(r"^[0-9]+[a-zA-Z]+"), F.regexp_extract(at(4), r"^([0-9]+)", 1).cast("int"))
    angle = F.when(F.abs(at(5).try_cast("int")) <= 180, F.abs(at(5).try_cast("int")))
    flight = F.when(at(7).rlike(r"^[a-zA-Z]+[0-9]+"), F.regexp_extract(at(7), r"^[a-zA-Z]+([0-9]+)", 1).cast("int"))
    error = F.when(F.size(parts) != 8, "fields").when(day.isNull() | ~at(0).rlike(r"^\d{8}$"), "date").when(camera.isNull(), "camera").when(elevation.isNull(), "elevation").when(angle.isNull(), "angle").when(kind.isNull(), "type").when(flight.isNull(), "flight")
    return F.struct(day.alias("day"), at(1).alias("location"), at(2).alias("experiments"), camera.alias("camera"), elevation.alias("elevation"), at(4).alias("planned"), angle.alias("angle"), kind.alias("type"), flight.alias("flight"), error.isNull().alias("is_valid"), error.alias("error"))


def archived_fields(name: Column) -> Column:
    """struct of an archived folder `<date>_<time>_<elev>m_<camera>_<angle>_<type>_<seq>`, with an experiment first if there are eight."""
    parts = F.split(name, "_")
    skip = F.size(parts) - 7
    at = lambda i: F.get(parts, skip + i)
    return F.struct(F.when(skip == 1, parts[0]).alias("experiment"), at(0).alias("day"), at(1).alias("time"), F.regexp_replace(at(2), "m$", "").try_cast("double").alias("elevation"), at(3).alias("camera"), at(4).try_cast("int").alias("angle"), at(5).alias("type"), at(6).try_cast("int").alias("seq"))
