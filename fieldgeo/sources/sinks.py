"""Sinks: every one writes by Spark's own writers, whole frames at a time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text
from ..operators import relational, summary


def write_metadata(df: DataFrame, path: str, partition_by: Sequence[str] = (), form: str = "csv", columns: Sequence[str] = schemas.IMAGE_ROW) -> None:
    """Image rows in the metadata columns' order; columns that df lacks are written as null."""
    rows = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])
    writer = rows.write.mode("overwrite").partitionBy(*partition_by)
    writer.option("header", True).csv(path) if form == "csv" else writer.parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def load_table(df: DataFrame, path: str, day: str, form: str, x: str, y: str) -> None:
    """Bulk append with the date parsed and the position as WKT."""
    append_table(df.withColumns({day: F.try_to_date(F.col(day), form), "position": text.wkt_point(F.col(x), F.col(y))}), path)


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Rows whose key the table at path hasn't."""
    append_table(summary.append_new(df, df.sparkSession.read.parquet(path), key), path)


def _finished(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end there."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def rewrite_partitions(spark: SparkSession, path: str, partition: str, touched: DataFrame, change: Callable[[DataFrame], DataFrame], staging: str) -> None:
    """The partitions of the Parquet table at path whose values `touched` has, replaced by what change makes of their rows; all other files stay as they are.

    The new rows are written to the folder `staging` first, then put in place by a dynamic partition overwrite. If a run ends between the two,
    the same call finds the finished staging folder and puts it in place, without reading the table again: so a call can be repeated.
    Use a new staging folder for each update. change must keep the columns and the partition of each row.
    """
    table = spark.read.parquet(path)
    if not _finished(spark, staging):
        values = touched.select(F.col(partition).alias("__value")).distinct()
        own = table.join(values, F.col(partition).eqNullSafe(F.col("__value")), "left_semi")
        change(own).select(table.columns).write.mode("overwrite").partitionBy(partition).parquet(staging)
    staged = spark.read.schema(table.schema).parquet(staging)
    if not staged.isEmpty():
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def update_table(updates: DataFrame, path: str, key: str, columns: Sequence[str], partition: str, staging: str) -> None:
    """The stored table with columns taken from updates where they have a row's key and a value; partitions without such a key aren't touched. A key given twice is an error."""
    spark = updates.sparkSession
    once = relational.one_a_key(updates, key)
    hit = spark.read.parquet(path).join(updates.select(key), key, "left_semi").select(partition)
    rewrite_partitions(spark, path, partition, hit, lambda rows: relational.merge_update(rows, once, key, columns), staging)


def fill_run_ids(spark: SparkSession, path: str, run: str, after: int, partition: str, staging: str, key: str = "record_id", column: str = "run_id") -> None:
    """run in rows of the stored table that have no run and a key over after; partitions without such rows aren't touched."""
    open_rows = spark.read.parquet(path).where(F.col(column).isNull() & (F.col(key) > after)).select(partition)
    rewrite_partitions(spark, path, partition, open_rows, lambda rows: summary.fill_run_id(rows, run, after, key, column), staging)


def rename_plan(df: DataFrame, new: str, old: str, path: str) -> None:
    df.select(F.concat_ws("\t", new, old)).write.mode("overwrite").text(path)


def write_points_by_plot(df: DataFrame, path: str) -> None:
    """A folder of text files for each plot, written by few tasks each: rows are brought together by plot, very large plots by more than one task."""
    df.hint("rebalance", "plot_id").write.mode("overwrite").partitionBy("plot_id").csv(path)


def write_points(df: DataFrame, path: str, columns: Sequence[str] = ("x", "y", "z", "r", "g", "b")) -> None:
    df.select(*columns).write.mode("overwrite").csv(path)


def write_observations(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path, sep="\t")


def write_rows(df: DataFrame, path: str) -> None:
    """Plain CSV of any frame: ranges, intersections, interpolated logs."""
    df.write.mode("overwrite").option("header", True).csv(path)
