"""As-of joins against brute force: nulls, bursts, slices of time."""

import random

import pytest
from pyspark.sql import functions as F

from fieldgeo.operators import series


def by_hand(probes, keys, kind, shift=0):
    out = []
    for group, t, n in probes:
        own = [k for g, k, _ in keys if g == group and g is not None and k is not None]
        match = None
        if group is not None and t is not None:
            if kind == "forward":
                match = min((k for k in own if k >= t + shift), default=None)
            elif kind == "strict":
                match = min((k for k in own if k > t + shift), default=None)
            else:
                match = min(own, key=lambda k: (abs(k - t), k), default=None)
        out.append((group, t, n, match, None if match is None else f"p{group}/{match}"))
    return sorted(out, key=repr)


def made(rng, n, groups, dense):
    """Rows of (group, time, number): times in bursts, some null, some groups null, one group with most rows."""
    out = []
    for i in range(n):
        group = rng.choice([None, "big", "big", "big", *groups])
        t = None if rng.random() < 0.05 else rng.choice((0, 5000, 5000, 90_000)) + rng.randrange(dense)
        out.append((group, t, i))
    return out


@pytest.mark.parametrize("slice_rows", [series.SLICE_ROWS, 50, 7])
def test_asof_against_brute_force(spark, slice_rows):
    rng = random.Random(slice_rows)
    probes, keys = made(rng, 600, ["a", "b"], 300), made(rng, 150, ["b", "c"], 300)
    left = spark.createDataFrame(probes, "flight string, t long, n int").repartition(3)
    right = spark.createDataFrame([(g, t, f"p{g}/{t}") for g, t, _ in keys], "flight string, t long, p string").repartition(2)
    read = lambda df: sorted(((r["flight"], r["t"], r["n"], r["match_t"], r["p"]) for r in df.collect()), key=repr)
    of = {"payload": ["p"], "slice_rows": slice_rows}
    assert read(series.asof_forward(left, right, "t", "flight", **of)) == by_hand(probes, keys, "forward")
    assert read(series.asof_forward(left, right, "t", "flight", strict=True, shift=40, **of)) == by_hand(probes, keys, "strict", 40)
    assert read(series.asof_nearest(left, right, "t", "flight", **of)) == by_hand(probes, keys, "nearest")


def test_slices_share_a_flight_out(spark):
    """Bursts and gaps: no slice holds much more than its share, and few keys are carried."""
    n, each = 40_000, 1000
    bursts = spark.range(n).select(F.lit("f").alias("flight"), (F.floor(F.col("id") / 10_000) * 10_000_000 + F.col("id") % 10_000).alias("t"))
    merged = series._merged(bursts, bursts.where("t % 40 = 0"), "t", "flight", (), 0, ["next", "last"], each)
    sizes = [r["count"] for r in merged.groupBy("__slice").count().collect()]
    assert sum(sizes) - n * 41 // 40 <= 2 * len(sizes) and len(sizes) >= 16 and max(sizes) <= 4000


def test_rows_without_a_time_are_spread(spark):
    left = spark.range(1000).select(F.lit(None).cast("string").alias("flight"), F.col("id").alias("t")).repartition(8)
    merged = series._merged(left, left, "t", "flight", (), 0, ["next"], 100)
    assert merged.count() == 1000 and merged.select("__slice").distinct().count() == 8
    assert series.asof_forward(left, left, "t", "flight").where("match_t is not null").count() == 0


def test_empty_sides(spark):
    left, none = spark.createDataFrame([("f", 1)], "flight string, t long"), spark.createDataFrame([], "flight string, t long")
    for join in (series.asof_forward, series.asof_nearest):
        assert [r["match_t"] for r in join(left, none, "t", "flight").collect()] == [None]
        assert join(none, left, "t", "flight").count() == 0
