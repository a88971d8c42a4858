"""Point cloud to plots, and plots' points to image outlines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import imaging, spatial, summary


def split_by_plot(points: DataFrame, plots: DataFrame, cell: float) -> DataFrame:
    """Every point with each plot that holds it; plots without points don't appear."""
    return spatial.assign_plot(points, plots.select("plot_id", "ring"), cell)


def image_outlines(points: DataFrame, cameras: DataFrame) -> DataFrame:
    """The hull of each image's projected points."""
    pixels = imaging.project_points(points, cameras)
    return summary.convex_hull(pixels.select("image", F.col("u").cast("double").alias("x"), F.col("v").cast("double").alias("y")), "image")
