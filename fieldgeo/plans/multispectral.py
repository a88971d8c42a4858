"""Multispectral archive and calibration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clock, geodesy, text
from ..operators import imaging, series, summary


def decode_tags(images: DataFrame) -> DataFrame:
    """Tag strings of an image listing to lat, lon, altitude, altitude_ref and captured_at."""
    c = F.col
    return images.withColumns(
        {
            "lat": geodesy.dms_to_decimal(c("gps_lat"), c("gps_lat_ref")),
            "lon": geodesy.dms_to_decimal(c("gps_lon"), c("gps_lon_ref")),
            "altitude": geodesy.altitude(c("gps_alt")),
            "altitude_ref": geodesy.altitude_ref(c("gps_alt_ref")),
            "captured_at": clock.exif_timestamp(c("gps_date"), c("gps_time"), c("datetime_original")),
        }
    )


def archive_names(flights: DataFrame, name: str = "data_set", start: str = "start", order: str = "folder") -> DataFrame:
    """flights with archive_name: their data set's planned elevation, camera, angle and type after date and time, and their place in it from 0.

    A data set whose own name isn't valid gives null names.
    """
    fields = flights.withColumn("__f", text.dataset_fields(F.col(name)))
    placed = series.numbered(fields, order, name, "__i")
    of = lambda c: F.col(f"__f.{c}")
    made = text.flight_folder_name(F.date_format(start, "yyyyMMdd"), F.date_format(start, "HHmmss"), of("planned"), of("camera"), of("angle"), of("type"), F.col("__i"))
    return placed.withColumn("archive_name", F.when(of("is_valid"), made)).drop("__f", "__i")


def archive(images: DataFrame, by: str = "flight_id", min_size: int = 2_400_000) -> tuple[DataFrame, DataFrame]:
    """(image rows of complete sets, a run row for each flight with hull and count)."""
    listed = imaging.validate_sets(images.withColumn("stem", text.set_stem(text.stem(F.col("name")))), min_size=min_size).where("is_valid")
    rows = decode_tags(listed).withColumn("position", text.wkt_point(F.col("lon"), F.col("lat")))
    hulls = summary.convex_hull(rows, by, "lon", "lat").withColumn("flight_polygon", text.wkt_polygon(F.col("hull"))).drop("hull")
    runs = rows.groupBy(by).agg(F.min("captured_at").alias("start"), F.max("captured_at").alias("end"), F.count("*").alias("image_count")).join(hulls, by)
    return rows, runs.withColumn("run_id", clock.run_id("uas", F.col("start"), F.col("end")))


def calibrate(pixels: DataFrame, calibration: DataFrame, serial: str, bits: int = 16) -> DataFrame:
    """Pixels scaled by factors from their own panel pixels."""
    factors = imaging.calibration_factors(pixels, imaging.panel_factors(calibration, serial).where("band is not null"))
    return imaging.apply_factors(pixels.withColumn("band", text.band_name(F.col("band"))), factors, bits)
