"""Long flights, independent coordinates, names by their rules, and guards."""

import math
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from fieldgeo.functions import geodesy, text
from fieldgeo.operators import series
from fieldgeo.plans import multispectral
from fieldgeo.sources import readers

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_asof_of_one_long_flight(spark):
    n = 300_000
    log = spark.range(n).select(F.lit(1).alias("flight_id"), (F.col("id") * 100).alias("ts_ms"), F.col("id").alias("event_id"))
    probes = spark.range(n).select(F.lit(1).alias("flight_id"), (F.col("id") * 100 + 30).alias("ts_ms"))
    got = series.asof_forward(probes, log, "ts_ms", "flight_id", ["event_id"]).agg(F.count("match_ts_ms"), F.sum("delta")).first()
    assert tuple(got) == (n - 1, 70 * (n - 1))
    got = series.asof_nearest(probes, log, "ts_ms", "flight_id", ["event_id"]).agg(F.count("match_ts_ms"), F.sum("delta")).first()
    assert tuple(got) == (n, 30 * n)


def arc(lat):
    """The meridian's length by Simpson's rule."""
    e2, n, f = 0.0066943799901413165, 4000, math.radians(lat)
    g = lambda p: 6378137 * (1 - e2) / (1 - e2 * math.sin(p) ** 2) ** 1.5
    return f / n / 3 * sum((1 if i in (0, n) else 4 if i % 2 else 2) * g(f * i / n) for i in range(n + 1))


def test_utm_to_a_millimetre(spark):
    """On the central meridian northing is the scaled arc; off it the figures are an independent numerical map of the same grid."""
    rows = [(lat, 3.0) for lat in (-79.0, -33.3, 0.0, 12.5, 45.0, 83.9)]
    for r in spark.createDataFrame(rows, "lat double, lon double").select("lat", geodesy.to_utm(F.col("lat"), F.col("lon")).alias("u")).collect():
        assert abs(r["u"]["x"] - 500_000) < 1e-6 and abs(r["u"]["y"] - (0.9996 * arc(r["lat"]) + (1e7 if r["lat"] < 0 else 0))) < 1e-3
    # scale along a parallel by finite differences of the map against the ellipsoid's: a conformal map stretches both ways alike
    step = 1e-5
    grid = [(lat + a * step, lon + b * step) for lat, lon in ((40.0, 5.5), (-20.0, 0.7), (60.0, 4.0)) for a, b in ((0, 0), (1, 0), (0, 1))]
    got = [r["u"] for r in spark.createDataFrame(grid, "lat double, lon double").coalesce(1).select(geodesy.to_utm(F.col("lat"), F.col("lon"), F.lit(31)).alias("u")).collect()]
    for i in range(0, len(grid), 3):
        lat, e2 = math.radians(grid[i][0]), 0.0066943799901413165
        m = 6378137 * (1 - e2) / (1 - e2 * math.sin(lat) ** 2) ** 1.5 * math.radians(step)
        p = 6378137 / math.sqrt(1 - e2 * math.sin(lat) ** 2) * math.cos(lat) * math.radians(step)
        north, east = (math.hypot(got[i + k]["x"] - got[i]["x"], got[i + k]["y"] - got[i]["y"]) for k in (1, 2))
        assert abs(north / m - east / p) < 2e-6 and abs(north / m - 0.9996) < 2e-3


def test_degree_strings(spark):
    cases = {-96.5: "96:30:0.0W", 0.25: "0:15:0.0", -0.25: "0:15:0.0", 10.0: "10:0:0.0E", 1.0041666666666667: "1:0:15.0000E"}
    got = {r[0]: r[1] for r in spark.createDataFrame([(x,) for x in cases], "x double").select("x", geodesy.to_dms(F.col("x"), "lon")).collect()}
    assert all(got[x] == want or abs(float(got[x].rstrip("EW").split(":")[2]) - float(want.rstrip("EW").split(":")[2])) < 1e-4 for x, want in cases.items())
    assert got[0.25][-1] == "0" and got[-0.25][-1] == "0" and got[-96.5][-1] == "W"


def test_names_follow_their_rules(spark):
    names = [("20240102_18ASH_BYD0_RedEdge_20m_-90_stills_Flight12",), ("20240102_18ASH_BYD0_X5R_20m_-90_still_Flight1",), ("20241399_18ASH_BYD0_rededge_20m_-90_still_Flight1",), ("20240102_18ASH_BYD0_Rededge_20m_-181_still_Flight1",), ("20240102_18ASH_BYD0_Rededge_20m_-90_STILL_Flight1",)]
    got = [r["x"] for r in spark.createDataFrame(names, "n string").coalesce(1).select(text.dataset_fields(F.col("n")).alias("x")).collect()]
    assert (got[0]["camera"], got[0]["type"], got[0]["angle"], got[0]["flight"], got[0]["planned"], got[0]["error"]) == ("MRE", "Still", 90, 12, "20m", None)
    assert [x["error"] for x in got[1:]] == ["camera", "date", "angle", "type"]
    rover = text.rover_image_name(F.lit("CAM2_IMG_0042.JPG"), F.lit("0123"), F.lit("RUN8"), F.lit("101112.500"))
    assert spark.range(1).select(rover).first()[0] == "0123_RUN8_101112_C02_0042.JPG"
    flights = spark.createDataFrame([(names[0][0], "b", "2024-01-02 10:00:00"), (names[0][0], "a", "2024-01-02 09:00:00"), (names[1][0], "c", "2024-01-02 09:00:00")], "data_set string, folder string, start string")
    made = {r["folder"]: r["archive_name"] for r in multispectral.archive_names(flights.withColumn("start", F.col("start").cast("timestamp"))).collect()}
    assert made == {"a": "20240102_090000_20m_MRE_90_Still_0", "b": "20240102_100000_20m_MRE_90_Still_1", "c": None}


def test_points_keep_their_lines(spark, tmp_path):
    path = str(tmp_path / "points.csv")
    with open(path, "w") as out:
        out.writelines(f"{i}.0,0,0,1,2,3\n" for i in range(20_000))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("128m", "20k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        assert readers.read_points(spark, path).where("idx <> x").count() == 0
        assert readers.read_points(spark, path).count() == 20_000
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_entry_works_without_the_corpus_package():
    code = "import sys\nsys.modules['fieldgeo.llm'] = None\nsys.modules['corpus_pipeline'] = None\nimport __spark_entry__ as e\nassert len(e.queries()) > 90 and not any(n.startswith('op') and n[2].isdigit() for n in e.queries())\n"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True).returncode == 0


@pytest.mark.parametrize("name", ["geotagged_images", "fine_grid", "unused_codes"])
def test_queries_return_rows(spark, sf, name):
    import __spark_entry__ as entry

    assert entry.queries()[name](spark, sf).count() > 0
