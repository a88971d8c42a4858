"""Flight log to geotagged image rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clock, text
from ..operators import series, spatial


def frames(log: DataFrame) -> DataFrame:
    """A frame for each recording row, timed evenly over its segment and placed at the first log row at or after it."""
    segmented = series.segment_by_flag(log, "recording", "ts_ms", "flight_id")
    rows = segmented.where("segment is not null").select("flight_id", "segment", "ts_ms")
    images = series.numbered(rows, "ts_ms", ["flight_id", "segment"]).select("flight_id", "segment", F.col("i").alias("frame"))
    timed = series.frame_times(images, series.segment_durations(segmented), ["flight_id", "segment"], "frame").select("flight_id", "segment", "frame", "ts_ms")
    return series.asof_forward(timed, log, "ts_ms", "flight_id", ["lat", "lon", "alt"], sizes=log)  # a flight has no more frames than log rows


def geotag(log: DataFrame, plots: DataFrame, max_dist: float | None = None, sensor: str = "X5R") -> DataFrame:
    """Image rows of the frames that show a plot for the first time in their flight."""
    placed = frames(log).where("match_ts_ms is not null").withColumn("frame_id", F.concat_ws("_", "flight_id", "segment", "frame"))
    hits = spatial.nearest_plot_hits(placed, plots, "frame_id", "ts_ms", "flight_id", max_dist, "lon", "lat")
    name = text.archive_image_name(F.lit(sensor), F.timestamp_millis("ts_ms"), F.concat(F.col("frame_id"), F.lit(".jpg")))
    return hits.select(name.alias("image_file_name"), "flight_id", F.lit(sensor).alias("sensor_id"), clock.ms_to_date(F.col("ts_ms")).alias("date_utc"), clock.ms_to_time(F.col("ts_ms")).alias("time_utc"), text.wkt_point(F.col("lon"), F.col("lat")).alias("position"), F.col("alt").alias("altitude"), F.lit("AMSL").alias("altitude_ref"), "plot_id")
