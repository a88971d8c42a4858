"""Queries against their SQL on small tables with what larger tables hold: longer keys, ties, many rows in one place."""

import datetime

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fieldgeo.functions import overlap, rings
from fieldgeo.operators import imaging, spatial


def against_sql(spark, folder, name, **tables):
    """The rows that the query and its SQL give over these tables, sorted."""
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for table, rows in tables.items():
        pq.write_table(rows if isinstance(rows, pa.Table) else pa.table(rows), f"{folder}/{table}.parquet")
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    want = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = entry.queries()[name](spark, str(folder)).select(*columns).collect()
    return sorted(map(tuple, got), key=repr), sorted(want.fetchall(), key=repr)


def test_image_names_of_long_keys(spark, tmp_path):
    got, want = against_sql(spark, tmp_path, "image_names", part={"p_partkey": pa.array([7, 9999, 10_000, 123_456], pa.int64())})
    assert got == want


def test_utm_positions_near_a_rounding_step(spark, tmp_path):
    """At 24.92, north of y = 5 mod 10 by less than the two series differ."""
    got, want = against_sql(spark, tmp_path, "utm_positions", events={"event_id": pa.array([100_336, 100_438, 5], pa.int64()), "value": [24.92, 24.92, 60.0]})
    assert got == want


def test_run_hulls_with_points_on_edges(spark, tmp_path):
    """Runs with three orders of one day on their hull's edge, on one day altogether, and in one place."""
    runs = {1: [(1000, 1), (2000, 1), (4000, 1), (3000, 9), (2500, 4)], 2: [(1000, 5), (3000, 5), (2000, 5)], 3: [(700, 2), (700, 2)], 4: [(0, 1), (1000, 2), (2000, 3), (0, 3), (0, 2), (1000, 3)]}
    rows = [(run, price, day) for run, points in runs.items() for price, day in points]
    orders = pa.table({"o_orderkey": list(range(len(rows))), "o_custkey": [r[0] for r in rows], "o_orderstatus": ["F"] * len(rows), "o_totalprice": [float(r[1]) for r in rows], "o_orderdate": pa.array([datetime.datetime(1992, 1, r[2]) for r in rows], pa.timestamp("us")), "o_orderpriority": ["x"] * len(rows)})
    got, want = against_sql(spark, tmp_path, "run_hulls", orders=orders)
    assert got == want and (3, 1, 0.0) in got and got[1][1] == 6


def test_fields_on_lines_and_alike(spark, tmp_path):
    """Points on the fields' inner lines and edges, and two fields of one shape."""
    at = [(float(q), price, 0.05) for q in (1, 6, 9, 14, 20) for price in (0.5, 4.5, 5.0, 7.0, 12.5, 15.5, 20.0, 25.5)]
    lines = pa.table({"l_quantity": [a[0] for a in at], "l_extendedprice": [a[1] for a in at], "l_discount": [a[2] for a in at], "l_suppkey": [1] * len(at), "l_orderkey": list(range(len(at))), "l_linenumber": [1] * len(at)})
    got, want = against_sql(spark, tmp_path, "points_in_fields", lineitem=lines, supplier={"s_suppkey": pa.array([1, 2, 3, 386, 7 * 5 * 11 + 2], pa.int64())})
    assert got == want and len(got) > 2


def test_equal_rings_and_cameras_are_compared_once(spark, monkeypatch):
    compared = []
    meeting, projected = spatial._meeting, imaging.projected
    monkeypatch.setattr(spatial, "_meeting", lambda a, b, cell: compared.append((a.count(), b.count())) or meeting(a, b, cell))
    monkeypatch.setattr(imaging, "projected", lambda points, cameras, *rest: compared.append(cameras.count()) or projected(points, cameras, *rest))
    box = rings.box_ring(F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(2.0))
    a, b = spark.range(30).select(F.col("id").alias("a"), box.alias("ring_a")), spark.range(20).select(F.col("id").alias("b"), box.alias("ring_b"))
    assert {tuple(r) for r in spatial.overlap_join(a, b, 1.0).select("a", "b", "overlap_pct").collect()} == {(i, j, 100.0) for i in range(30) for j in range(20)}
    cameras = spark.range(12).select(F.col("id").alias("image"), F.lit(10).alias("width"), F.lit(10).alias("height"), *[F.lit(1.0 if m in ("m11", "m22", "m34") else 0.0).alias(m) for m in imaging.MATRIX])
    points = spark.createDataFrame([(1, 2.0, 3.0, 0.0), (2, 20.0, 3.0, 0.0)], "idx long, x double, y double, z double")
    assert sorted(r["image"] for r in imaging.project_points(points, cameras).where("idx = 1 and u = 2 and v = 3").collect()) == list(range(12))
    assert compared == [(1, 1), 1]


def test_rows_out_of_reach_get_no_leaves(spark):
    right = spark.range(20_000).select(F.col("id").alias("right_key"), (F.col("id") % 50).cast("double").alias("rx"), F.floor(F.col("id") / 50).cast("double").alias("ry"))
    left = spark.range(40).select("id", (F.col("id") % 8).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("y"))
    kept, found = spatial._within_reach(left, right, "x", "y", "rx", "ry", 3, None, 8)
    assert kept.count() < 2000 and found.boxes.count.sum() == kept.count()
    got = {(r["id"], r["rank"]): (r["right_key"], r["distance"]) for r in spatial.nearest(left, right, "id", k=3).collect()}
    assert all(got[i, 1] == (i % 8 + i % 5 * 50, 0.0) and got[i, 2][1] == got[i, 3][1] == 1.0 for i in range(40)) and len(got) == 120


def test_heavy_rows_are_dealt_over_cores(spark, sf):
    for name in ("ring_measures", "utm_rings"):
        assert entry.queries()[name](spark, sf).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_points_on_polygons_edges_are_tested_without_a_copy_on_disk(spark, monkeypatch):
    """Rows on their way to a function's column are kept, on disk where they are many; points take another way, whether the cells are held by each task or joined."""
    at = lambda i, n: (F.col("id") * i % n / 7 - 9).alias("x" if n > 900 else "y")
    points = spark.range(20_000).select(at(13, 1009), at(29, 401), F.when(F.col("id") % 5 > 0, F.col("id")).alias("v"))
    c = F.col("id") % 40
    ring = F.array(*[rings.point(c * u + v, (c % 9) * w) for u, v, w in ((0.5, 0, 1), (1.0, 20, -1), (1.0, 21.5, 6), (0.5, 3, 2), (0.5, -4, 7))])
    fields = spark.range(60).select(F.col("id").alias("field_id"), ring.alias("ring"))
    want = {r["field_id"]: (r["n"], r["v"]) for r in spatial.assign_plot(points, fields, 0.5).groupBy("field_id").agg(F.count("*").alias("n"), F.sum("v").alias("v")).collect()}
    monkeypatch.setattr(overlap, "PAIRS_AT_ONCE", 1 << 10)
    for held in (0, 1 << 20):
        tally = spatial.tally_plots(points, fields, 0.5, "field_id", ["v"], held_edges=held)
        plan = tally._jdf.queryExecution().executedPlan().toString()
        assert all("cells(" in line for line in plan.splitlines() if "ArrowEvalPython" in line)
        assert {r["field_id"]: (r["n"], r["sum_v"]) for r in tally.collect()} == want and len(want) > 30


def test_many_rows_of_equal_rings_are_dealt_over_cores(spark):
    """2.1 million pairs of a few different rings: as many rows as there should be, of which no task makes most; nulls in rows stay."""
    box = lambda u: rings.box_ring(u, F.lit(0.0), u + 2.0, F.lit(2.0))
    i = F.col("id")
    a = spark.range(3000).select(i.alias("a"), F.when(i % 4 > 0, i % 7).alias("tag"), box((i % 2) * 50.0).alias("ring_a"))
    b = spark.range(1400).select(F.when(i % 5 > 0, i).alias("b"), box((i % 2) * 50.0 + 0.5).alias("ring_b"))
    got = spatial.overlap_join(a, b, 1.0, digits=1).withColumn("task", F.spark_partition_id()).cache()
    assert got.count() == 3000 * 700 and {r[0] for r in got.select("overlap_pct").distinct().collect()} == {75.0}
    assert max(r["count"] for r in got.groupBy("task").count().collect()) < 3000 * 700 / 2
    ids = lambda rows, key: {(r[key], r["n"]) for r in rows.groupBy(key).agg(F.count("*").alias("n")).collect()}
    assert ids(got, "a") == {(k, 700) for k in range(3000)} and ids(got, "b") == {(k, 1500) for k in range(1400) if k % 5} | {(None, 280 * 1500)}
    assert ids(got, "tag") == {(k, n * 700) for k, n in ids(a, "tag")} and got.where("ring_a[0].x + 0.5 <> ring_b[0].x").count() == 0
    got.unpersist()


def test_what_many_equal_cameras_see_is_dealt_over_cores(spark, tmp_path):
    """9,000 cameras of 30 kinds: the rows of the SQL, most of which come from no one task."""
    points = pa.table({"vec_id": list(range(150)), "embedding": pa.array([[i * 37 % 150 / 200 - 0.35, i * 53 % 150 / 200 - 0.35, i % 9 / 20, 0.0, 0.0, 0.0] for i in range(150)], pa.list_(pa.float32())), "label": [0] * 150})
    got, want = against_sql(spark, tmp_path, "culled_points", supplier={"s_suppkey": pa.array(range(9000), pa.int64())}, embeddings=points)
    assert got == want and len(got) > 100_000
    tasks = entry.queries()["culled_points"](spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in tasks) < len(got) / 2
