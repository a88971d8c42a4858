"""The driver tables projected into the package's input schemas, in Spark and in SQL."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import rings


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df's rows dealt over all cores, for work that is much for each row of a table in few and small files."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def flight_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("flight_id"),
        "event_id",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        F.col("event_type").isin("view", "click", "purchase").alias("recording"),
        "event_type",
        (F.lit(-96.6) + (F.col("value") % 50) / 1000).alias("lon"),
        (F.lit(39.1) + (F.col("event_id") % 50) / 1000).alias("lat"),
        (F.col("value") * 0.3048).alias("alt"),
        F.col("value").alias("y"),
    )


FLIGHT = """log as (select user_id as flight_id, event_id, epoch_us(ts) // 1000 as ts_ms, event_type in ('view', 'click', 'purchase') as recording, event_type,
  -96.6 + (value % 50) / 1000 as lon, 39.1 + (event_id % 50) / 1000 as lat, value * 0.3048 as alt, value as y from events),
started as (select *, recording and not coalesce(lag(recording) over (partition by flight_id order by ts_ms), false) as starts from log),
segmented as (select *, case when recording then sum(starts::int) over (partition by flight_id order by ts_ms rows unbounded preceding) end::bigint as segment from started)"""


def plots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parallelograms on a grid: a unit square with a margin, leaning by 0.3."""
    p = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 50).cast("double").alias("c"), F.floor(F.col("p_partkey") / 50).cast("double").alias("r"))
    c, r = F.col("c"), F.col("r")
    ring = F.array(rings.point(c + 0.1, r + 0.1), rings.point(c + 0.9, r + 0.1), rings.point(c + 1.2, r + 0.9), rings.point(c + 0.4, r + 0.9))
    return p.select(F.col("p_partkey").alias("plot_id"), ring.alias("ring"), (c + 0.1).alias("xmin"), (r + 0.1).alias("ymin"), (c + 0.9).alias("xmax"), (r + 0.9).alias("ymax"), "c", "r")


PLOTS = "plots as (select p_partkey as plot_id, (p_partkey % 50)::double as c, floor(p_partkey / 50)::double as r from part)"


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select((F.col("l_quantity") - 1 + F.col("l_discount") + 0.0137).alias("x"), F.pmod(F.col("l_extendedprice"), F.lit(40.0)).alias("y"), F.col("l_suppkey").alias("run_id"), "l_orderkey", "l_linenumber")


POINTS = "points as (select l_quantity - 1 + l_discount + 0.0137 as x, l_extendedprice % 40 as y, l_suppkey as run_id, l_orderkey, l_linenumber from lineitem)"


def run_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("run_id"), F.col("o_orderkey").alias("seq"), (F.col("o_totalprice") / 1000).alias("x"), F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("double").alias("y"), F.col("o_orderdate").cast("timestamp").alias("ts"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))


RUNS = "runs as (select o_custkey as run_id, o_orderkey as seq, o_totalprice / 1000 as x, (o_orderdate::date - date '1992-01-01')::double as y, o_orderdate as ts, o_orderpriority as priority, o_orderstatus as status from orders)"


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.floor(F.col("doc_id") / 5).alias("stem"), (F.col("doc_id") % 5).cast("int").alias("band"), F.col("n_chars").alias("size"), F.col("source").alias("flight_id"), F.col("n_chars").cast("double").alias("altitude"))


IMAGES = "images as (select doc_id // 5 as stem, (doc_id % 5)::int as band, n_chars as size, source as flight_id, n_chars::double as altitude from documents)"


def cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points from embeddings: the first three components, colours from the next three."""
    v = table(spark, sf_dir, "embeddings")
    e = lambda i: F.col("embedding")[i].cast("double")
    rgb = lambda i: F.floor((e(i) + 1) * 100).cast("int")
    return v.select(F.col("vec_id").alias("idx"), (e(0) * 100).alias("x"), (e(1) * 100).alias("y"), (e(2) * 100).alias("z"), rgb(3).alias("r"), rgb(4).alias("g"), rgb(5).alias("b"), F.col("label"))


CLOUD = """cloud as (select vec_id as idx, embedding[1]::double * 100 as x, embedding[2]::double * 100 as y, embedding[3]::double * 100 as z,
  floor((embedding[4]::double + 1) * 100)::int as r, floor((embedding[5]::double + 1) * 100)::int as g, floor((embedding[6]::double + 1) * 100)::int as b, label from embeddings)"""


def panel_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    bands = F.array(*map(F.lit, ("Blue", "green", "Red", "NIR", "Red edge", "thermal")))
    return li.select(F.col("l_suppkey").alias("image"), bands[F.col("l_linenumber") % 6].alias("band"), F.floor(F.col("l_extendedprice")).cast("double").alias("radiance"), (F.col("l_returnflag") != "N").alias("in_panel"))


PANEL = """px as (select l_suppkey as image, (['blue', 'green', 'red', 'nir', 'red_edge', null])[l_linenumber % 6 + 1] as band, floor(l_extendedprice) as radiance, l_returnflag <> 'N' as in_panel from lineitem),
means as (select band, avg(m) as mean from (select band, image, avg(radiance) as m from px where in_panel and band is not null group by band, image) group by band)"""


def cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One camera for each nation, its matrix made from the key."""
    n = F.col("n_nationkey").cast("double")
    one = {"m11": n + 50, "m12": F.lit(3.0), "m13": F.lit(1.0), "m14": F.lit(2000.0), "m21": F.lit(2.0), "m22": n + 40, "m23": F.lit(5.0), "m24": F.lit(1500.0), "m31": F.lit(0.01), "m32": F.lit(0.02), "m33": F.lit(0.03), "m34": n / 10 + 4}
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("image"), F.lit(640).alias("width"), F.lit(480).alias("height"), *[v.cast("double").alias(k) for k, v in one.items()])


def scratch(spark: SparkSession) -> str:
    """A new folder for what a query writes: below spark.checkpoint.dir, or of its own in local mode where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not re.match(r"local(\[[^,]*\])?$", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    base = base or "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"
