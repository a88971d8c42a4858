"""A corpus pipeline: quality, boilerplate lines, near duplicates, benchmark leaks, then packed sequences.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns the documents' columns, the
last one the packed pieces. run() writes each stage's result to the shared folder and reads it again. Columns that are
named as a stage's own results come through unchanged; n_chars follows the text where there is such a column. Rows without a
text go at the first stage, repeated rows are treated alike by all but the third, which keeps one; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgeo.llm import decontaminate, jaccard_join, line_dedup, packing, quality
from fieldgeo.llm.common import fresh, materialize, prepare, table


def aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns of these names under other ones, and each column's present name."""
    present = {c: c for c in docs.columns}
    for column in docs.columns:
        if column.lower() in names:
            (present[column],) = fresh(docs, f"input_{column}")
            docs = docs.withColumnRenamed(column, present[column])
    return docs, present


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts outside their language's range of perplexity go."""
    prepare(spark)
    docs, names = aside(docs, "log_perplexity", "log_recurrence", "keep")
    kept = quality.classify(docs, table(spark, sf_dir, "labels")).where("keep")
    return kept.select(*[F.col(now).alias(c) for c, now in names.items()])


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites go; n_chars follows the text left."""
    docs, names = aside(docs, "n_lines", "n_removed")
    cleaned = line_dedup.dedup_lines(docs)
    if "n_chars" in names:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("n_removed") > 0, length).otherwise(F.col("n_chars")))
    return cleaned.select(*[F.col(now).alias(c) for c, now in names.items()])


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8, the one of the smallest id stays."""
    prepare(spark)
    return jaccard_join.drop_similar(docs, k=5, percent=80)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    prepare(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents left, in sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [("quality", quality_stage), ("lines", line_stage), ("near duplicates", duplicate_stage), ("benchmark leaks", leak_stage), ("packing", packing_stage)]

#: Tokenisation and the trained model have no SQL form; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
