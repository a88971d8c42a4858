"""Distances, bearings, UTM, degree formats. Angles are in degrees; x is longitude or easting, y latitude or northing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0

# The WGS84 ellipsoid and the UTM grid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
SCALE = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING = 10000000.0
BANDS = "CDEFGHJKLMNPQRSTUVWXX"

_E2 = FLATTENING * (2 - FLATTENING)
_EP2 = _E2 / (1 - _E2)
_N = FLATTENING / (2 - FLATTENING)


def ft_to_m(feet: Column) -> Column:
    return feet * 0.3048


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return 2 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def legs_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Metres along each axis alone, as struct(lon, lat)."""
    return F.struct((haversine_km(lon1, lat1, lon2, lat1) * 1000).alias("lon"), (haversine_km(lon1, lat1, lon1, lat2) * 1000).alias("lat"))


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing, -180 to 180."""
    a, b, d = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    return F.degrees(F.atan2(F.sin(d) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d)))


def compass(degrees: Column) -> Column:
    return F.pmod(degrees + 360, F.lit(360.0))


def velocity_bearing(vx: Column, vy: Column) -> Column:
    return F.degrees(F.atan2(vy, vx))


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180) / 6).cast("int") % 60) + 1


def utm_band(lat: Column) -> Column:
    """Latitude band letter; null outside -80..84."""
    at = F.floor((lat + 80) / 8).cast("int") + 1
    return F.when(lat.between(-80, 84), F.substring(F.lit(BANDS), at, F.lit(1)))


#: Coefficients of the meridian arc in powers of the third flattening, by multiple of the latitude.
_ARC = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_FORWARD = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180, 13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440, 61 * _N**3 / 240 - 103 * _N**4 / 140, 49561 * _N**4 / 161280)
_BACK = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360, _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440, 17 * _N**3 / 480 - 37 * _N**4 / 840, 4397 * _N**4 / 161280)
_LATITUDE = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45, 7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45, 56 * _N**3 / 15 - 136 * _N**4 / 35, 4279 * _N**4 / 630)


def to_utm(lat: Column, lon: Column, zone: Column | None = None) -> Column:
    """struct(x, y, zone, band) by the Krueger series, good to under a millimetre within a zone."""
    zone = utm_zone(lon) if zone is None else zone
    phi, lam = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    e = _E2**0.5
    t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_FORWARD, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    north = SCALE * _ARC * y + F.when(lat < 0, FALSE_NORTHING).otherwise(0.0)
    return F.struct((FALSE_EASTING + SCALE * _ARC * x).alias("x"), north.alias("y"), zone.alias("zone"), utm_band(lat).alias("band"))


def to_utm_by_series(lat: Column, lon: Column, zone: Column | None = None) -> Column:
    """As to_utm, by the classical power series in the longitude's difference, which most tools use; good to a few millimetres within a zone."""
    zone = utm_zone(lon) if zone is None else zone
    f = F.radians(lat)
    a = F.radians(lon - (zone * 6 - 183)) * F.cos(f)
    n, t, c = SEMI_MAJOR / F.sqrt(1 - _E2 * F.pow(F.sin(f), 2)), F.pow(F.tan(f), 2), _EP2 * F.pow(F.cos(f), 2)
    arc = (1 - _E2 / 4 - 3 * _E2**2 / 64 - 5 * _E2**3 / 256) * f - (3 * _E2 / 8 + 3 * _E2**2 / 32 + 45 * _E2**3 / 1024) * F.sin(2 * f)
    arc = SEMI_MAJOR * (arc + (15 * _E2**2 / 256 + 45 * _E2**3 / 1024) * F.sin(4 * f) - 35 * _E2**3 / 3072 * F.sin(6 * f))
    x = a + (1 - t + c) * F.pow(a, 3) / 6 + (5 - 18 * t + F.pow(t, 2) + 72 * c - 58 * _EP2) * F.pow(a, 5) / 120
    y = F.pow(a, 2) / 2 + (5 - t + 9 * c + 4 * F.pow(c, 2)) * F.pow(a, 4) / 24 + (61 - 58 * t + F.pow(t, 2) + 600 * c - 330 * _EP2) * F.pow(a, 6) / 720
    north = SCALE * (arc + n * F.tan(f) * y) + F.when(lat < 0, FALSE_NORTHING).otherwise(0.0)
    return F.struct((SCALE * n * x + FALSE_EASTING).alias("x"), north.alias("y"), zone.alias("zone"), utm_band(lat).alias("band"))


def from_utm(x: Column, y: Column, zone: Column, band: Column) -> Column:
    """struct(lat, lon); bands from N on are north of the equator."""
    xi = (y - F.when(band < "N", FALSE_NORTHING).otherwise(0.0)) / (SCALE * _ARC)
    eta = (x - FALSE_EASTING) / (SCALE * _ARC)
    a, b = xi, eta
    for j, c in enumerate(_BACK, 1):
        a = a - c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        b = b - c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(a) / F.cosh(b))
    lat = chi
    for j, d in enumerate(_LATITUDE, 1):
        lat = lat + d * F.sin(2 * j * chi)
    lon = F.degrees(F.atan2(F.sinh(b), F.cos(a))) + (zone * 6 - 183)
    return F.struct(F.degrees(lat).alias("lat"), lon.alias("lon"))


def ring_from_utm(ring: Column, zone: Column, band: Column) -> Column:
    def point(p: Column) -> Column:
        g = from_utm(p["x"], p["y"], zone, band)
        return F.struct(g["lon"].alias("x"), g["lat"].alias("y"))

    return F.transform(ring, point)


def ring_to_utm(ring: Column, zone: Column | None = None) -> Column:
    def point(p: Column) -> Column:
        g = to_utm(p["y"], p["x"], zone)
        return F.struct(g["x"].alias("x"), g["y"].alias("y"))

    return F.transform(ring, point)


def roundtrip_error_cm(x: Column, y: Column, zone: Column, band: Column) -> Column:
    g = from_utm(x, y, zone, band)
    u = to_utm(g["lat"], g["lon"], zone)
    return F.sqrt(F.pow(u["x"] - x, 2) + F.pow(u["y"] - y, 2)) * 100


def to_dms(degrees: Column, axis: str) -> Column:
    """`D:M:S.s..L`, seconds cut to seven characters; axis is 'lat' or 'lon'; whole degrees of zero get no letter."""
    plus, minus = ("N", "S") if axis == "lat" else ("E", "W")
    whole = degrees.cast("long")
    parts = F.abs((degrees - whole) * 60)
    minutes = parts.cast("long")
    seconds = F.abs((parts - minutes) * 60)
    digits = F.when((seconds > 0) & (seconds < 0.001), F.format_string("%.5f", seconds)).otherwise(seconds.cast("string"))
    letter = F.when(whole > 0, plus).when(whole < 0, minus).otherwise("")
    return F.concat(F.abs(whole).cast("string"), F.lit(":"), minutes.cast("string"), F.lit(":"), F.substring(digits, 1, 7), letter)


def _number(text: Column) -> Column:
    """A decimal or a fraction `a/b`; null where it is neither or b is 0."""
    parts = F.split(F.trim(text), "/")
    top, bottom = parts[0].try_cast("double"), F.when(F.size(parts) > 1, F.get(parts, F.lit(1)).try_cast("double")).otherwise(F.lit(1.0))
    return F.when(bottom != 0, top / bottom)


def rational(text: Column) -> Column:
    return _number(text)


def dms_to_decimal(text: Column, ref: Column) -> Column:
    """`[d, m, s/k]` with a hemisphere letter to signed degrees."""
    parts = F.split(F.regexp_replace(text, r"[\[\]]", ""), ",")
    value = _number(F.get(parts, F.lit(0))) + _number(F.get(parts, F.lit(1))) / 60 + _number(F.get(parts, F.lit(2))) / 3600
    return signed_coord(value, ref)


def signed_coord(value: Column, ref: Column) -> Column:
    return F.when(F.upper(F.trim(ref)).isin("S", "W"), -value).otherwise(value)


def altitude(text: Column) -> Column:
    """Altitude of a rational string, 0 where missing."""
    return F.coalesce(_number(text), F.lit(0.0))


def altitude_ref(ref: Column) -> Column:
    return F.when(ref.isNull(), "Not Available").when(ref.cast("string") == "0", "AMSL").otherwise("BMSL")


def agl_to_amsl(height: Column, site: Column | float) -> Column:
    return height + site


def shift_position(lat: Column, lon: Column, dlat: float, dlon: float) -> tuple[Column, Column]:
    return lat + dlat, lon + dlon


def offset_point(x: Column, y: Column, dx: Column, dy: Column) -> Column:
    return F.struct((x + dx).alias("x"), (y + dy).alias("y"))


def scale_reflectance(radiance: Column, factor: Column, bits: Column | int) -> Column:
    """Radiance times factor in full scale of `bits`, clipped to it."""
    top = F.pow(F.lit(2.0), F.lit(bits) if isinstance(bits, int) else bits)
    return F.least(F.greatest(F.floor(radiance * factor * top), F.lit(0)), top - 1).cast("int")
