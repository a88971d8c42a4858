"""Ground-vehicle run load and plot assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clock, text
from ..operators import spatial, summary


def load_run(observations: DataFrame, prefix: str = "phemu", by: str = "run_id", order: str = "seq", ts: str = "ts") -> DataFrame:
    """A row for each run: its name from start and end, box, last zone and sensor, count."""
    runs = summary.run_summary(observations, by, order, ts, last=[c for c in ("zone", "sensor_id") if c in observations.columns])
    return runs.withColumn("run_name", clock.run_id(prefix, F.col("start"), F.col("end")))


def assign_plots(observations: DataFrame, plots: DataFrame, cell: float) -> DataFrame:
    """Observations with position (WKT) and the smallest id of the plots that hold them, null where none does.

    A plot follows from x and y alone, so places are looked up once each and joined back by their coordinates.
    """
    places = observations.select("x", "y").distinct()
    hits = spatial.assign_plot(places, plots.select("plot_id", "ring"), cell).groupBy("x", "y").agg(F.min("plot_id").alias("plot_id"))
    return observations.join(hits, ["x", "y"], "left").withColumn("position", text.wkt_point(F.col("x"), F.col("y")))
