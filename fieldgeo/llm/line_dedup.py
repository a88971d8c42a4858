"""Removal of lines that recur across many sites, with DataFrame functions alone.

Each line's hash gets a HyperLogLog sketch of the sites it stands on; sketches merge by aggregation, so that a line on a
third of all rows costs one sketch a task. Lines whose estimate is within the sketch's error of the threshold get an exact
distinct count. Marks (document, place) of the lines to go are joined back to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, hashable, materialize

SALTS = 16  # parts into which a line's places are dealt in joins, so that a line on very many rows isn't one task's


def _lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda x: F.trim(x))


def _salted(lines: DataFrame) -> DataFrame:
    return lines.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def boilerplate(lines: DataFrame, lg_k: int = 12) -> DataFrame:
    """Hashes (column line) of lines on as many distinct sites as they need, or more, from rows (line, site, needed, salt). A null site counts for nothing."""
    error = 3 * 1.04 / 2 ** (lg_k / 2)  # three standard errors of the sketch
    spread = lines.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"), F.max("needed").alias("needed"))
    spread = spread.where(F.col("sites") >= F.col("needed") * (1 - error))
    certain = F.col("sites") > F.col("needed") * (1 + error)
    near = _salted(spread.where(~certain).select("line"))
    exact = lines.join(near, ["line", "salt"], "left_semi").where("site is not null").select("line", "site", "needed").distinct()
    exact = exact.groupBy("line").agg(F.count("*").alias("sites"), F.max("needed").alias("needed")).where("sites >= needed").select("line")
    return spread.where(certain).select("line").unionAll(exact)


def dedup_lines(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = 8, short_chars: int = 12, short_sites: int = 16, lg_k: int = 12) -> DataFrame:
    """docs with the boilerplate lines taken out of text, and columns n_lines (before) and n_removed after the others.

    A line is boilerplate on min_sites distinct sites or more, one under short_chars characters on short_sites or more, since
    short ones recur by chance; empty lines never are. Lines are compared without outer spaces. The lines left are joined by
    line feeds, untouched. A text all of whose lines go becomes empty; a
    null text stays null with 0 lines; repeated rows are all kept; very long texts are treated as any; an empty table gives an empty result. Rows are
    told apart by two 64-bit hashes over all their columns, lines by one. Own columns named n_lines or n_removed are replaced.
    """
    docs = docs.drop("n_lines", "n_removed")
    key, other, gone = fresh(docs, "row_key", "other_key", "gone_places")
    keyed = docs.withColumns({key: F.xxhash64(*hashable(docs)), other: F.xxhash64(F.lit(1), *hashable(docs))})
    places = keyed.select(F.col(key).alias("key"), F.col(other).alias("other"), F.col(site).cast("string").alias("site"), F.posexplode(_lines(F.col(text))).alias("place", "content")).where(F.length("content") > 0)
    needed = F.when(F.length("content") < short_chars, short_sites).otherwise(min_sites).alias("needed")
    places = places.select("key", "other", "site", "place", F.xxhash64("content").alias("line"), needed, F.pmod("key", F.lit(SALTS)).cast("int").alias("salt"))
    found = materialize(boilerplate(places.select("line", "site", "needed", "salt"), lg_k), "boilerplate")  # a table, so that a join with it is broadcast by its size
    marks = places.select("key", "other", "place", "line", "salt").join(_salted(found), ["line", "salt"]).groupBy("key", "other").agg(F.collect_set("place").alias(gone))
    whole = F.split(F.col(text), "\n")
    left = F.filter(whole, lambda x, i: ~F.array_contains(F.col(gone), i))
    out = keyed.join(marks.withColumnsRenamed({"key": key, "other": other}), [key, other], "left")
    cleaned = F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    n_removed = F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long").alias("n_removed")
    return out.select(*[cleaned.alias(c) if c == text else F.col(c) for c in docs.columns], F.when(whole.isNull(), 0).otherwise(F.size(whole)).cast("long").alias("n_lines"), n_removed)
