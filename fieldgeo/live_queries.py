"""Queries of the event-time streams: the log arrives as files, in two runs from one checkpoint, and what they write is read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import testbed as t
from .queries import query
from .streaming import stateful

LATE = "10000 days"  # the tables' rows come in any order
END = "timestamp '2199-01-01'"  # a row so late that the watermark passes all others
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _streamed(spark: SparkSession, sources: dict[str, tuple[DataFrame, DataFrame]], build: Callable[..., DataFrame]) -> DataFrame:
    """What build makes of streams of the sources: each its rows first, then, after a restart, the row that ends it."""
    folder, before = t.scratch(spark), spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, stateful.STORE)
    try:
        for part in (0, 1):
            for name, rows in sources.items():
                rows[part].write.mode("append").parquet(f"{folder}/{name}")
            streams = {name: spark.readStream.schema(rows[0].schema).parquet(f"{folder}/{name}") for name, rows in sources.items()}
            out = build(**streams)
            done = out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").outputMode("append").trigger(availableNow=True).start()
            done.awaitTermination()
    finally:
        spark.conf.set(PROVIDER, before)
    return spark.read.schema(out.schema).parquet(f"{folder}/out").where("flight_id >= 0")


def _log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    log = t.flight_log(spark, sf_dir).select(F.col("flight_id").cast("long").alias("flight_id"), F.timestamp_millis("ts_ms").alias("ts"), "lat", "lon", "recording")
    return log, spark.sql(f"select cast(-1 as bigint) as flight_id, {END} as ts, 0D as lat, 0D as lon, false as recording")


@query(f"""with {t.FLIGHT}, linked as (select *, lag(ts_ms) over w as p, lag(lat) over w as plat from log window w as (partition by flight_id order by ts_ms)),
grid as (select flight_id, ts_ms, lat, false as interpolated from linked where recording union all
  select flight_id, g, plat + (lat - plat) * (g - p) / (ts_ms - p), true from (select *, unnest(range((p // 600000 + 1) * 600000, ts_ms, 600000)) as g from linked where recording and ts_ms - p > 600000))
select flight_id, count(*) as n, sum(interpolated::int)::bigint as n_interpolated, sum(ts_ms)::bigint as sum_ts, round(sum(lat), 4) as sum_lat from grid group by flight_id""")
def live_grid(spark, sf_dir):
    grid = _streamed(spark, {"log": _log(spark, sf_dir)}, lambda log: stateful.fill_gaps(log, step_ms=600_000, late=LATE))
    return grid.groupBy("flight_id").agg(F.count("*").alias("n"), F.sum(F.col("interpolated").cast("int")).alias("n_interpolated"), F.sum("ts_ms").alias("sum_ts"), F.round(F.sum("lat"), 4).alias("sum_lat"))


@query(f"""with {t.FLIGHT}, p as (select flight_id, event_id as probe, ts_ms + 97000 as ts_ms from log), m as (select p.*, log.ts_ms as match_ts_ms, log.lat from p asof left join log on p.flight_id = log.flight_id and p.ts_ms <= log.ts_ms)
select flight_id, probe, ts_ms, case when match_ts_ms - ts_ms <= 43200000 then match_ts_ms end as match_ts_ms, case when match_ts_ms - ts_ms <= 43200000 then round(lat, 6) end as lat from m""")
def live_asof(spark, sf_dir):
    """Probes and keys as two streams; matches of half a day at most."""
    log, end = _log(spark, sf_dir)
    probes = t.flight_log(spark, sf_dir).select(F.col("flight_id").cast("long").alias("flight_id"), F.timestamp_millis(F.col("ts_ms") + 97_000).alias("ts"), F.col("event_id").cast("long").alias("probe"))
    sources = {"probes": (probes, end.select("flight_id", "ts", F.lit(-1).cast("long").alias("probe"))), "keys": (log.drop("recording"), end.drop("recording"))}
    found = _streamed(spark, sources, lambda probes, keys: stateful.asof_forward(probes, keys, 43_200_000, late=LATE))
    return found.select("flight_id", "probe", "ts_ms", "match_ts_ms", F.round("lat", 6).alias("lat"))
