"""Queries of readers and sinks: the driver tables written in each file layout and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import schemas
from . import testbed as t
from .functions import rings
from .operators import imaging, relational, series
from .queries import _written, query, r6
from .plans import multispectral
from .sources import readers, sinks


def _events(spark, sf_dir) -> DataFrame:
    return t.table(spark, sf_dir, "events")


def _v(scale: str = "%.4f", c: str = "value") -> F.Column:
    return F.format_string(scale, c)


@query("select round(value, 4) as lat, -round(value, 4) as lon, 'stamp ' || event_id as local_stamp from events where event_type <> 'view'")
def reread_photo_log(spark, sf_dir):
    at = {0: _v(), 1: F.concat(F.lit("-"), _v()), 12: F.concat(F.lit("stamp "), "event_id"), 27: F.when(F.col("event_type") == "view", "1").otherwise("0")}
    lines = _events(spark, sf_dir).select(F.concat_ws(",", *[at.get(i, F.lit("7")) for i in range(30)]))
    path = _written(spark, lines.unionAll(spark.sql("select 'latitude,longitude,altitude'")))
    return readers.read_photo_log(spark, path).select(r6("lat").alias("lat"), r6("lon").alias("lon"), "local_stamp")


@query("select 'CAM1_IMG_' || o_orderkey as cam1, 'CAM2_IMG_' || o_orderkey as cam2, 'CAM3_IMG_' || o_orderkey as cam3, case when o_orderkey % 9 = 0 then '000000.000' else lpad((o_orderkey % 86400)::varchar, 6, '0') || '.250' end as t from orders")
def reread_trigger_log(spark, sf_dir):
    k = F.col("o_orderkey")
    clock = F.when(k % 9 == 0, "000000.000").otherwise(F.concat(F.lpad((k % 86400).cast("string"), 6, "0"), F.lit(".250")))
    path = _written(spark, t.table(spark, sf_dir, "orders").select(F.concat_ws(",", *[F.concat(F.lit(f"CAM{n}_IMG_"), k) for n in (1, 2, 3)], clock)))
    return readers.read_trigger_log(spark, path)


@query("select 'S' || l_suppkey as sensor_id, l_quantity as value, l_extendedprice as x, l_tax as y, strftime(l_shipdate, '%Y/%m/%d') as date, (l_suppkey % 60)::int as long_zone, l_discount as offset_z from lineitem")
def reread_observations(spark, sf_dir):
    li = t.table(spark, sf_dir, "lineitem")
    own = {"sensor_id": F.concat(F.lit("S"), "l_suppkey"), "value": F.col("l_quantity"), "x": F.col("l_extendedprice"), "y": F.col("l_tax"), "date": F.date_format("l_shipdate", "yyyy/MM/dd"), "long_zone": (F.col("l_suppkey") % 60).cast("int"), "offset_z": F.col("l_discount")}
    rows = li.select(*[(own[n] if n in own else F.lit(None).cast(kind)).alias(n) for n, kind in (x.split() for x in schemas.OBSERVATION.split(", "))])
    path = t.scratch(spark)
    sinks.write_observations(rows, path)
    return readers.read_observations(spark, path).select("sensor_id", "value", "x", "y", "date", "long_zone", "offset_z")


@query("select 'P' || p_partkey as plot_id, p_name as image_file_name, round(p_retailprice, 2) as utm_x, p_size::double as sampling_utc, 'full' as form from part union all select null, p_name, round(p_retailprice, 2), p_size::double, 'utm' from part")
def reread_image_positions(spark, sf_dir):
    p = t.table(spark, sf_dir, "part").select(F.concat(F.lit("P"), "p_partkey").alias("plot_id"), F.col("p_name").alias("image_file_name"), F.lit(1.5).alias("longitude"), F.lit(2.5).alias("latitude"), F.round("p_retailprice", 2).alias("utm_x"), F.lit(0.5).alias("utm_y"), F.col("p_size").cast("double").alias("sampling_utc"))
    whole, short = t.scratch(spark), t.scratch(spark)
    sinks.write_rows(p, whole)
    sinks.write_rows(p.select(F.lit("CAM1").alias("camera"), "image_file_name", "utm_x", "utm_y", "sampling_utc"), short)
    columns = ["image_file_name", "utm_x", "sampling_utc"]
    a = readers.read_image_positions(spark, whole).select("plot_id", *columns, F.lit("full").alias("form"))
    return a.unionAll(readers.read_image_positions(spark, short, utm_only=True).select(F.lit(None).cast("string"), *columns, F.lit("utm")))


@query("""select lpad((event_id % 86400)::varchar, 6, '0') as clock, '2016-05-17' as day, 'tab' as form from events
union all select round(value, 2)::varchar, (ts::date)::varchar, 'comma' from events""")
def reread_gnss(spark, sf_dir):
    e = _events(spark, sf_dir)
    tabs, commas = t.scratch(spark) + "/20160517", t.scratch(spark)
    e.select(F.concat_ws("\t", F.lit("x"), F.lpad((F.col("event_id") % 86400).cast("string"), 6, "0"), F.lit("y"))).write.text(tabs)
    e.select(F.concat_ws(",", F.lit("x"), F.round("value", 2).cast("string"), F.date_format("ts", "yyyyMMdd"))).write.text(commas)
    pick = lambda df, form: df.select("clock", F.col("day").cast("string").alias("day"), F.lit(form).alias("form"))
    return pick(readers.read_gnss(spark, tabs), "tab").unionAll(pick(readers.read_gnss(spark, commas, ","), "comma"))


@query("select n, sum(seq)::bigint as total from (select l_linenumber as n, row_number() over (partition by l_linenumber order by l_orderkey) as seq from lineitem) group by n")
def reread_plans(spark, sf_dir):
    """A plan for each line number: its rows' numbers are 1 to their count, whatever the splits."""
    path = t.scratch(spark)
    rows = t.table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("n"), F.col("l_quantity").alias("lat"), F.col("l_tax").alias("lon"))
    rows.repartition("n").sortWithinPartitions("n").write.partitionBy("n").option("header", True).csv(path)
    plan = readers.read_plan(spark, f"{path}/*")
    return plan.select(F.regexp_extract("file", r"n=(\d+)", 1).cast("int").alias("n"), "seq").groupBy("n").agg(F.sum("seq").alias("total"))


@query(f"with {t.PLOTS} select plot_id::varchar as plot_id, 0.64::double as area, 4 as corners from plots")
def reread_plot_corners(spark, sf_dir):
    at = lambda i, axis: F.format_string("%.4f", F.get("ring", F.lit(i))[axis]).alias(f"{axis}{i}")
    path = t.scratch(spark)
    sinks.write_rows(t.plots(spark, sf_dir).select("plot_id", *[at(i, axis) for i in (2, 0, 3, 1) for axis in ("x", "y")]), path)  # corners in no order
    return readers.read_plot_corners(spark, path).select("plot_id", F.round(rings.area(F.col("ring")), 6).alias("area"), F.size("ring").alias("corners"))


@query("select round(s_acctbal, 2) as dx, s_suppkey::double as dy, 0.5::double as dz from supplier")
def reread_offsets(spark, sf_dir):
    path = _written(spark, t.table(spark, sf_dir, "supplier").select(F.concat_ws(" ", _v("%.2f", "s_acctbal"), "s_suppkey", F.lit("0.5"))))
    return readers.read_offset(spark, path).select(F.round("dx", 2).alias("dx"), "dy", "dz")


@query(f"with {t.CLOUD} select 'img' || (idx % 7) as image_file, floor(x)::int as u, floor(y)::int as v, r, g, b from cloud")
def reread_pixels(spark, sf_dir):
    path = t.scratch(spark)
    sinks.write_rows(t.cloud(spark, sf_dir).select(F.concat(F.lit("img"), F.col("idx") % 7).alias("image_file"), F.floor("x").cast("int").alias("u"), F.floor("y").cast("int").alias("v"), "r", "g", "b"), path)
    return readers.read_pixels(spark, path)


@query(f"with {t.FLIGHT} select 'WP_' || segment as segment_id, min(ts_ms) as start_ms, max(ts_ms) - min(ts_ms) as duration_ms from segmented where segment is not null group by flight_id, segment")
def reread_segment_times(spark, sf_dir):
    d = series.segment_durations(series.segment_by_flag(t.flight_log(spark, sf_dir), "recording", "ts_ms", "flight_id"))
    path = _written(spark, d.select(F.concat_ws(",", F.concat(F.lit("WP_"), "segment"), "start_ms", "duration_ms")))
    return readers.read_segment_times(spark, path)


@query("select p_size as folder, sum(strlen(p_name) + 1)::bigint as size, md5(string_agg(p_name || chr(10), '' order by p_name)) as md5sum from part group by p_size")
def listed_images(spark, sf_dir):
    """A file for each size of part, told by its folder, with its length and the digest of its content."""
    path = t.scratch(spark)
    parts = t.table(spark, sf_dir, "part").select("p_size", "p_name")
    parts.repartition("p_size").sortWithinPartitions("p_size", "p_name").write.partitionBy("p_size").text(path)
    listed = readers.list_images(spark, path, "txt", md5=True)
    return listed.select(F.regexp_extract("path", "p_size=([0-9]+)", 1).cast("int").alias("folder"), "size", "md5sum")


@query("""with p as (select o_orderkey, o_orderkey % 180 as d, o_orderkey % 60 as m from orders)
select 'IMG_' || o_orderkey || '.tif' as name, round(case when o_orderkey % 2 = 1 then -1 else 1 end * (d + m / 60.0::double + 0.25 / 3600), 8) as lat, round(o_orderkey / 8.0::double, 6) as altitude,
case when o_orderkey % 3 = 2 then 'Not Available' else 'AMSL' end as altitude_ref from p""")
def reread_image_tags(spark, sf_dir):
    k = F.col("o_orderkey")
    tags = {"name": F.concat(F.lit("IMG_"), k, F.lit(".tif")), "size": k, "gps_lat": F.format_string("[%d, %d, 25/100]", k % 180, k % 60), "gps_lat_ref": F.when(k % 2 == 1, "S").otherwise("N"), "gps_alt": F.format_string("%d/8", k), "gps_alt_ref": F.when(k % 3 != 2, "0")}
    path = t.scratch(spark)
    t.table(spark, sf_dir, "orders").select(*[v.alias(c) for c, v in tags.items()]).write.json(path)
    found = multispectral.decode_tags(readers.read_image_tags(spark, path))
    return found.select("name", F.round("lat", 8).alias("lat"), r6("altitude").alias("altitude"), "altitude_ref")


@query(f"with {t.FLIGHT} select 'IMG_' || event_id || '.jpg' as image_file_name, flight_id, round(lat, 6) as uas_latitude, round(lon, 6) as cam_longitude, md5('IMG_' || event_id || '.jpg') as md5sum, null::varchar as notes from log")
def written_old_metadata(spark, sf_dir):
    name = F.concat(F.lit("IMG_"), "event_id", F.lit(".jpg"))
    rows = t.flight_log(spark, sf_dir).select(name.alias("image_file_name"), "flight_id", r6("lat").alias("uas_latitude"), r6("lon").alias("cam_longitude"), F.md5(name).alias("md5sum"))
    path = t.scratch(spark)
    sinks.write_metadata(rows, path, columns=schemas.IMAGE_ROW_OLD)
    kinds = {"flight_id": "bigint", "uas_latitude": "double", "cam_longitude": "double"}
    back = spark.read.csv(path, schema=", ".join(f"{c} {kinds.get(c, 'string')}" for c in schemas.IMAGE_ROW_OLD), header=True, enforceSchema=False)
    return back.select("image_file_name", "flight_id", "uas_latitude", "cam_longitude", "md5sum", "notes")


@query("select o_orderkey, case when o_orderkey % 10 <> 0 then (o_orderdate::date)::varchar end as day, 'POINT(' || printf('%.10f %.10f', o_totalprice, o_custkey::double) || ')' as position from orders")
def loaded_table(spark, sf_dir):
    o = t.table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 10 == 0, "0000/00/00").otherwise(F.date_format("o_orderdate", "yyyy/MM/dd")).alias("day"), F.col("o_totalprice").alias("x"), F.col("o_custkey").cast("double").alias("y"))
    path = t.scratch(spark)
    sinks.load_table(o, path, "day", "yyyy/MM/dd", "x", "y")
    return spark.read.schema("o_orderkey bigint, day date, x double, y double, position string").parquet(path).select("o_orderkey", F.col("day").cast("string").alias("day"), "position")


@query(f"with {t.FLIGHT} select flight_id, event_id, ts_ms, round(lat, 6) as lat from log")
def written_rows(spark, sf_dir):
    path = t.scratch(spark)
    sinks.write_rows(t.flight_log(spark, sf_dir).select("flight_id", "event_id", "ts_ms", r6("lat").alias("lat")), path)
    return spark.read.csv(path, schema="flight_id bigint, event_id bigint, ts_ms bigint, lat double", header=True)


@query("select 'RE_' || p_partkey as new, p_name as old from part")
def rename_plans(spark, sf_dir):
    p = t.table(spark, sf_dir, "part").select(F.concat(F.lit("RE_"), "p_partkey").alias("new"), F.col("p_name").alias("old"))
    path = t.scratch(spark)
    sinks.rename_plan(p, "new", "old", path)
    return spark.read.csv(path, schema="new string, old string", sep="\t")


@query(f"with {t.CLOUD} select idx % 40 as plot_id, count(*) as n, round(sum(x), 4) as sum_x from cloud group by 1")
def points_by_plot_files(spark, sf_dir):
    path = t.scratch(spark)
    sinks.write_points_by_plot(t.cloud(spark, sf_dir).select((F.col("idx") % 40).alias("plot_id"), "x", "y", "z", "r", "g", "b"), path)
    back = spark.read.schema("x double, y double, z double, r int, g int, b int, plot_id bigint").csv(path)
    return back.groupBy("plot_id").agg(F.count("*").alias("n"), F.round(F.sum("x"), 4).alias("sum_x"))


@query("select 'run_7' as run_id, l_suppkey, 'POINT(' || printf('%.10f %.10f', l_quantity, l_tax) || ')' as position from lineitem")
def tagged_observations(spark, sf_dir):
    li = t.table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_quantity").alias("x"), F.col("l_tax").alias("y"), F.lit("gone").alias("plot_id"))
    path = t.scratch(spark)
    sinks.write_observations(relational.tag_observations(li, "run_7", "x", "y", drop="plot_id"), path)
    return spark.read.csv(path, schema="l_suppkey bigint, x double, y double, run_id string, position string", header=True, sep="\t", enforceSchema=False).select("run_id", "l_suppkey", "position")


@query("select s_name || '.tif' as image, (100 + s_suppkey)::int as width, s_suppkey::double as m11 from supplier where s_suppkey % 5 <> 0")
def sized_cameras(spark, sf_dir):
    """Matrices with the sizes of the .dng files of the same stem; every fifth has no file."""
    s, k = t.table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    cameras = s.select(F.concat("s_name", F.lit(".tif")).alias("image"), k.cast("double").alias("m11"))
    sizes = s.select(F.concat("s_name", F.when(k % 5 == 0, ".jpg").otherwise(".dng")).alias("image"), (100 + k).cast("int").alias("width"), F.lit(7).alias("height"))
    return imaging.with_sizes(cameras, sizes).select("image", "width", "m11")
