"""Summaries of runs and flights: boxes, hulls, first and last records, and the keeping of run tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import workers
from ..functions import clock, rings
from ..functions.hull import hull


def bbox(df: DataFrame, by: str, x: str = "x", y: str = "y") -> DataFrame:
    out = df.groupBy(by).agg(F.min(x).alias("xmin"), F.min(y).alias("ymin"), F.max(x).alias("xmax"), F.max(y).alias("ymax"))
    return out.withColumn("ring", rings.box_ring(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax")))


def bbox_center(df: DataFrame) -> DataFrame:
    return df.withColumns({"x": (F.col("xmin") + F.col("xmax")) / 2, "y": (F.col("ymin") + F.col("ymax")) / 2})


HULL_ROWS = 200_000  # points a task holds before it reduces them to hulls
HULL_SALTS = 64  # partial hulls of a group meet in so many tasks before they meet in one


def _hulls_of(batches: Iterable[pa.RecordBatch], schema: pa.Schema, on_edges: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows (group, hull as lists x and y) of batches of such rows: groups' points gathered and reduced to their hulls, HULL_ROWS points at a time."""
    Held = tuple[pa.Array, np.ndarray, np.ndarray]  # groups, how many points each has, the points

    def reduced(held: list[Held]) -> Held:
        codes = pc.dictionary_encode(pa.concat_arrays([h[0] for h in held]), null_encoding="encode")
        points = np.concatenate([h[2] for h in held])
        owner = np.repeat(codes.indices.to_numpy(zero_copy_only=False), np.concatenate([h[1] for h in held]))
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(len(codes.dictionary) + 1)).tolist()
        found = [hull(points[order[a:b]], on_edges) if b > a else points[:0] for a, b in pairwise(cuts)]
        return codes.dictionary, np.array([len(f) for f in found]), np.concatenate(found)

    def read(batch: pa.RecordBatch) -> Held:
        size = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        return batch.column(0), size, np.column_stack([batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (1, 2)])

    held: list[Held] = []
    rows, most = 0, HULL_ROWS
    for batch in batches:
        if batch.num_rows:
            held.append(read(batch))
            rows += len(held[-1][1]) + len(held[-1][2])
        if rows > most:
            held = [reduced(held)]
            rows = len(held[0][1]) + len(held[0][2])
            most = HULL_ROWS + 2 * rows  # corners that stay don't make each batch a reduction
    if held:
        group, size, points = reduced(held)
        ends = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(points[:, i]))) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([group, *lists], names=schema.names)


def convex_hull(df: DataFrame, by: str, x: str = "x", y: str = "y", on_edges: bool = False) -> DataFrame:
    """(by, hull) of each group's points, null where there is none: array<struct<x, y>>, counter-clockwise from the leftmost lowest corner.

    A mergeable aggregate: each task reduces its points to its groups' hulls before anything is shuffled, partial hulls of a group
    meet in HULL_SALTS tasks, what is left of them in one. A task holds HULL_ROWS points and its groups' corners. Points
    with a null or NaN coordinate don't count; a null group is a group. With on_edges the different points on a hull's edges stand between its corners.
    """
    workers.ready(df.sparkSession)
    real = F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(F.col(x).cast("double")) & ~F.isnan(F.col(y).cast("double"))
    one = lambda c: F.when(real, F.array(F.col(c).cast("double"))).otherwise(F.array().cast("array<double>")).alias(c)
    schema = T.StructType([df.schema[by], *T._parse_datatype_string("xs array<double>, ys array<double>").fields])
    points = df.select(by, one(x).alias("xs"), one(y).alias("ys"))
    names = pa.schema([(c, pa.null()) for c in schema.names])

    def step(batches):
        return _hulls_of(batches, names, on_edges)

    parts = points.mapInArrow(step, schema).withColumn("__salt", F.spark_partition_id() % HULL_SALTS)
    parts = parts.repartition(by, "__salt").drop("__salt").mapInArrow(step, schema)
    whole = parts.repartition(by).mapInArrow(step, schema)
    corners = F.zip_with("xs", "ys", lambda a, b: F.struct(a.alias("x"), b.alias("y")))
    return whole.select(by, F.when(F.size("xs") > 0, corners).alias("hull"))


def corner_hull(df: DataFrame, corners: Sequence[Column]) -> DataFrame:
    return df.withColumn("ring", rings.hull_of(F.array(*corners)))


def run_window(df: DataFrame, by: str, order: str, day: str, time: str) -> DataFrame:
    """start and end date and clock time of each run; an end before its start is on the next day."""
    out = df.groupBy(by).agg(F.min_by(F.struct(day, time), order).alias("__a"), F.max_by(F.struct(day, time), order).alias("__z"))
    out = out.select(by, F.col(f"__a.{day}").alias("start_date"), F.col(f"__a.{time}").alias("start_time"), F.col(f"__z.{time}").alias("end_time"))
    return out.withColumn("end_date", clock.roll_end_date(F.col("start_date"), F.col("start_time"), F.col("end_time")))


def run_summary(df: DataFrame, by: str, order: str, ts: str, x: str = "x", y: str = "y", last: Sequence[str] = ()) -> DataFrame:
    """Box, start and end, row count of each run, and the last row's values of `last` columns; one pass, one shuffle."""
    return df.groupBy(by).agg(F.min(x).alias("xmin"), F.min(y).alias("ymin"), F.max(x).alias("xmax"), F.max(y).alias("ymax"), F.min(ts).alias("start"), F.max(ts).alias("end"), F.count("*").alias("n"), *[F.max_by(c, order).alias(c) for c in last])


def summarise_runs(runs: DataFrame, observations: DataFrame, key: str, x: str = "x", y: str = "y") -> DataFrame:
    """All runs with the box and count of their observations; those without keep nulls and 0."""
    found = observations.groupBy(key).agg(F.min(x).alias("xmin"), F.min(y).alias("ymin"), F.max(x).alias("xmax"), F.max(y).alias("ymax"), F.count("*").alias("n"))
    return runs.join(found, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def first_where(df: DataFrame, condition: Column, order: str, by: str, columns: Sequence[str]) -> DataFrame:
    return df.where(condition).groupBy(by).agg(F.min_by(F.struct(*columns), order).alias("__f")).select(by, *[F.col(f"__f.{c}").alias(c) for c in columns])


def extent(df: DataFrame, key: str, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.min(key).alias("first"), F.max(key).alias("last"))


def sensor_offsets(df: DataFrame, sensor: str = "sensor_id", offsets: Sequence[str] = ("dx", "dy", "dz"), order: str = "seq") -> DataFrame:
    """Distinct sensors and offsets, each with the place it was first seen at."""
    return df.groupBy(sensor, *offsets).agg(F.min(order).alias("first_seen"))


def append_new(df: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows whose key the target hasn't, one for each key."""
    return df.join(target.select(key), key, "left_anti").dropDuplicates([key])


def fill_run_id(df: DataFrame, run: Column | str, after: int, key: str = "record_id", column: str = "run_id") -> DataFrame:
    value = F.lit(run) if isinstance(run, str) else run
    return df.withColumn(column, F.when(F.col(column).isNull() & (F.col(key) > after), value).otherwise(F.col(column)))


def load_audit(before: DataFrame, after: DataFrame, run_column: str) -> DataFrame:
    """Of each run: rows before and after a load, inserted, and whether it was there."""
    a, b = (df.groupBy(run_column).agg(F.count("*").alias(n)) for df, n in ((before, "before"), (after, "after")))
    out = a.join(b, run_column, "full")
    n, m = F.coalesce("before", F.lit(0)), F.coalesce("after", F.lit(0))
    return out.select(run_column, n.alias("before"), m.alias("after"), (m - n).alias("inserted"), (n > 0).alias("found"))
