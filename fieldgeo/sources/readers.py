"""Readers. Every file is read by Spark with a given schema; nothing is inferred, and nothing opens a path on the driver."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas, workers
from ..functions import rings, text


def _fields(parts: Column, layout: dict[int, str]) -> list[Column]:
    return [F.get(parts, F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in ((i, d.split()) for i, d in layout.items())]


def _lines(spark: SparkSession, path: str, sep: str, header: bool = False) -> DataFrame:
    """parts (array of trimmed fields) and the file's path; a header line is told by a first field that is neither empty nor a number."""
    df = spark.read.text(path).withColumn("file", F.input_file_name())
    df = df.select(F.transform(F.split("value", sep), lambda x: F.trim(x)).alias("parts"), "file").where(F.size("parts") > 1)
    return df.where((F.col("parts")[0] == "") | F.col("parts")[0].try_cast("double").isNotNull()) if header else df


def read_flight_log(spark: SparkSession, path: str) -> DataFrame:
    """flight_id is the file's stem. Rows whose time can't be read are left out."""
    df = _lines(spark, path, ",", header=True)
    out = df.select(text.stem(F.col("file")).alias("flight_id"), *_fields(F.col("parts"), schemas.FLIGHT_LOG))
    return out.where("ts_ms is not null").withColumns({"recording": F.col("recording") == "1", "alt": F.col("alt_ft") * 0.3048})


def read_photo_log(spark: SparkSession, path: str) -> DataFrame:
    df = _lines(spark, path, ",", header=True)
    return df.select(text.stem(F.col("file")).alias("flight_id"), *_fields(F.col("parts"), schemas.PHOTO_LOG)).where("taking_photo = '0'")


def read_tagged_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(camera records, position records) of an autopilot log, told by the first three characters."""
    df = _lines(spark, path, ",")
    of = lambda tag, layout: df.where(F.substring(F.col("parts")[0], 1, 3) == tag).select(text.stem(F.col("file")).alias("flight_id"), *_fields(F.col("parts"), layout))
    return of("CAM", schemas.CAM), of("GPS", schemas.GPS)


def read_rover_log(spark: SparkSession, path: str) -> DataFrame:
    df = _lines(spark, path, r"\t+")
    return df.select(*_fields(F.col("parts"), schemas.ROVER)).where("elevation is not null")


def _csv(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    return spark.read.csv(path, schema=schema, **options)


def read_trigger_log(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.TRIGGER_LOG)


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.OBSERVATION, sep="\t", header=True, enforceSchema=True)


def read_image_positions(spark: SparkSession, path: str, utm_only: bool = False) -> DataFrame:
    return _csv(spark, path, schemas.IMAGE_POSITION_UTM if utm_only else schemas.IMAGE_POSITION, header=True)


def read_gnss(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """(file, clock, day): tab-separated logs take the day from eight digits that stand alone in their path, comma-separated ones from field 2."""
    df = _lines(spark, path, sep)
    at = lambda i: F.get(F.col("parts"), F.lit(i))
    day = F.regexp_extract("file", r"(?<![0-9A-Za-z])(\d{8})(?![0-9A-Za-z])", 1) if sep == "\t" else at(2)
    return df.select("file", at(1).alias("clock"), F.try_to_date(day, "yyyyMMdd").alias("day")).where(F.col("clock").try_cast("double").isNotNull())


def _line_numbers(df: DataFrame, out: str) -> DataFrame:
    """df, read from text files, with the number of each line of data in its file from 0, and its file.

    Lines are counted by split; a split's first number is the sum of those before it, whatever tasks splits fall to. There is a row for each split.
    """
    at = df.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__split"), F.monotonically_increasing_id().alias("__at"))
    splits = at.groupBy("file", "__split").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("file").orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select("file", "__split", (before - F.col("__first")).alias("__shift"))
    return at.join(splits, ["file", "__split"]).withColumn(out, F.col("__at") + F.col("__shift")).drop("__split", "__at", "__shift")


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """Waypoints with seq from 1 in their file's order."""
    df = _line_numbers(_csv(spark, path, schemas.WAYPOINT, header=True), "seq")
    return df.select("lat", "lon", "file", (F.col("seq") + 1).cast("int").alias("seq"))


def read_plot_corners(spark: SparkSession, path: str) -> DataFrame:
    df = _csv(spark, path, schemas.PLOT_CORNER, header=True)
    corners = [F.struct(F.col(f"{c}_lon").alias("x"), F.col(f"{c}_lat").alias("y")) for c in ("c1_1", "c2_1", "c2_2", "c1_2")]
    return df.select("plot_id", rings.hull_of(F.array(*corners)).alias("ring"))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Points with idx, their line in their file from 0, by which those of two files can be zipped."""
    return _line_numbers(_csv(spark, path, schemas.POINT), "idx").select("idx", *[c.split()[0] for c in schemas.POINT.split(", ")])


def read_pmatrix(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.PMATRIX, sep=" ")


def read_offset(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.OFFSET, sep=" ")


def read_pixels(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.PIXEL, header=True)


def read_segment_times(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.SEGMENT_TIME)


def read_image_tags(spark: SparkSession, path: str) -> DataFrame:
    """Tag strings of images, one JSON object a line, missing ones null; plans.multispectral.decode_tags reads them."""
    return spark.read.schema(schemas.IMAGE_TAGS).json(path)


BLOCK_BYTES = 65_536
STREAMED = ("file", "hdfs", "s3", "s3a", "gs", "abfs")  # schemes that Arrow opens by itself


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (path, ...) with each file's MD5, read in blocks."""
    for batch in batches:
        found = []
        for path in batch.column(0).to_pylist():
            digest = hashlib.md5()
            local = re.match("file:/+(.*)", path)
            system, name = (fs.LocalFileSystem(), "/" + local[1]) if local else fs.FileSystem.from_uri(quote(re.sub("^s3a:", "s3:", path), safe=":/@"))
            with system.open_input_stream(name) as stream:
                while block := stream.read(BLOCK_BYTES):
                    digest.update(block)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, "md5sum"])


def list_images(spark: SparkSession, path: str, ext: str = "*", md5: bool = False) -> DataFrame:
    """path, name, size (and md5sum, the only column that reads content) of files by extension, sub-folders included.

    Files in stores that Arrow opens are digested in blocks of BLOCK_BYTES, whatever their size; those in others are read as one value by Spark, which ends
    at 2 GB. Spark's listing leaves files without content out.
    """
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{ext.lstrip('.')}" if ext != "*" else "*").load(path)
    columns = [F.col("path"), F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size")]
    if not md5:
        return df.select(*columns)
    home = path if re.match("[a-zA-Z0-9]+:", path) else spark._jsc.hadoopConfiguration().get("fs.defaultFS")
    if home.split(":")[0] not in STREAMED:
        return df.select(*columns, text.content_md5(F.col("content")).alias("md5sum"))
    workers.ready(spark)
    slim = df.select(*columns)
    return slim.repartition("path").mapInArrow(_digests, slim.schema.add("md5sum", "string"))  # a listing's own partitions go by size
