"""Importance resampling towards a target distribution by hashed n-gram features (data selection with importance resampling).

1. One narrow pass cuts texts into words and writes each document's feature buckets, two or four bytes a feature.
2. Bucket histograms of corpus and target are summed within tasks, then by bucket; a bucket's gain is a log ratio of the two.
3. A document's weight is the sum of its features' gains. Gumbel noise drawn from its id makes the highest scores a sample
   without replacement. Ranks come from one sort by ranges and the ranges' row counts, no group in one task.
"""

from __future__ import annotations

import math
import re
import zlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, fresh, materialize, prepare, released, texts, words_of

#: What isn't part of a word, of ASCII: all but digits and lower-case letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
INDEX_BITS = 33  # of monotonically_increasing_id: a row's place in its partition


class Words(dict):
    """White-space-separated part of an ASCII-lowered text to its words; keeps the parts seen lately.

    New parts go through an untrained regex Split together, whose offsets tell which part a word is of. A part of more than
    `long` bytes (a text without white space) is cut by the same pattern on bytes, as Split keeps many times a text's bytes.
    """

    def __init__(self, most: int = 200_000, long: int = 1 << 16):
        from tokenizers import Regex
        from tokenizers.pre_tokenizers import Split

        super().__init__()
        self.most, self.long = most, long
        self.split, self.pattern = Split(Regex(BETWEEN), "removed"), re.compile(BETWEEN.encode())

    def kept(self, words: list[str]):
        """What is kept of a part's words."""
        return words

    def learn(self, parts: set[bytes]) -> None:
        for part in [x for x in parts if len(x) > self.long]:
            self[part] = self.kept([w.decode() for w in self.pattern.split(part) if w])
        some, size = [], 0
        for part in parts:
            if len(part) <= self.long:
                some.append(part.decode())
                size += len(part)
            if size > self.long:
                self._learn(some)
                some, size = [], 0
        if some:
            self._learn(some)

    def _learn(self, parts: list[str]) -> None:
        found = self.split.pre_tokenize_str("\n".join(parts))
        starts = np.cumsum([0, *[len(x) + 1 for x in parts]])
        first = np.searchsorted(np.fromiter((a for _, (a, _) in found), np.int64, len(found)), starts).tolist()
        words = [w for w, _ in found]
        for part, (a, b) in zip(parts, pairwise(first), strict=True):
            self[part.encode()] = self.kept(words[a:b])

    def of(self, texts: list[str]) -> list[list]:
        """What is kept of every text's parts, in order."""
        if len(self) > self.most:
            self.clear()
        split = [words_of(x) for x in texts]
        self.learn({y for x in split for y in x if y not in self})
        found = [list(map(self.__getitem__, x)) for x in split]
        for x in split:
            for part in x if len(x) < 100 else ():
                if len(part) > 256:
                    self.pop(part, None)
        return found


class WordBuckets(Words):
    """As Words, with the words' buckets in place of the words, as bytes of a fixed width."""

    def __init__(self, buckets: int, kind: str):
        super().__init__()
        self.buckets, self.kind = buckets, kind

    def kept(self, words: list[str]) -> bytes:
        return np.array([zlib.crc32(w.encode()) % self.buckets for w in words], self.kind).tobytes()


def runs(words: list[str], most: int) -> list[str]:
    """All runs of 1 to most successive words, joined by spaces: windows over pairs of a first and a last word."""
    return [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def kind_of(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def blocks(texts: list[str], most: int = 1 << 20):
    """The texts in lists of a bounded number of characters, beside a long text."""
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text)
        if size > most:
            yield some
            some, size = [], 0
    if some:
        yield some


def bucket_features(df: DataFrame, text: str, keep: tuple[str, ...], ngrams: int, buckets: int) -> DataFrame:
    """Columns of keep, n_words, n_features and features (their buckets, little-endian) of every row's whole text."""
    (body,) = fresh(df.select(*keep), "text")
    chosen = df.select(*keep, df[text].alias(body))
    schema = T.StructType([*chosen.schema.fields[:-1], *T._parse_datatype_string("n_words long, n_features long, features binary").fields])
    kind = kind_of(buckets)

    def run(batches):
        words, single = Words(), WordBuckets(buckets, kind)
        for batch in released(batches):
            n, found = [], []
            for some in blocks(texts(batch.column(batch.num_columns - 1))):
                if ngrams == 1:
                    found += [b"".join(x) for x in single.of(some)]
                    continue
                for parts in words.of(some):
                    own = [w for part in parts for w in part]
                    n.append(len(own))
                    found.append(np.fromiter((zlib.crc32(x.encode()) % buckets for x in runs(own, ngrams)), kind).tobytes())
            width = np.dtype(kind).itemsize
            size = [len(x) // width for x in found]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n if ngrams > 1 else size, pa.int64()), pa.array(size, pa.int64()), pa.array(found, pa.binary())], names=schema.names)

    return chosen.mapInArrow(run, schema)


def flat(column: pa.Array, kind: str) -> np.ndarray:
    """All values of a binary column one after the other."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer((column.buffers()[2] or b"")[ends[0] : ends[-1]], kind)


def histogram(features: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket stands in features: summed within tasks, then by bucket; what the driver gets is a row a bucket."""
    kind = kind_of(buckets)

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in released(batches):
            if batch.num_rows:
                total += np.bincount(flat(batch.column(0), kind), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    counts = np.zeros(buckets, np.int64)
    for r in features.select("features").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t + 1) (S + B) / ((s + 1) (T + B)))) for counts s and t of every bucket, sums S and T, and B buckets."""
    b, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weighted(features: DataFrame, gains: np.ndarray) -> DataFrame:
    """features' other columns, and weight: the sum of each row's gains."""
    at = features.columns.index("features")
    names = [c for c in features.columns if c != "features"]
    schema = T.StructType([features.schema[c] for c in names] + [T.StructField("weight", T.LongType())])
    kind = kind_of(len(gains))

    def add(batches):
        for batch in released(batches):
            column = batch.column(at)
            sums = np.concatenate([[0], np.cumsum(gains[flat(column, kind)])]) if batch.num_rows else np.zeros(1, np.int64)
            ends = np.concatenate([[0], np.cumsum(pa.compute.binary_length(column).to_numpy(zero_copy_only=False) // np.dtype(kind).itemsize)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([c for i, c in enumerate(batch.columns) if i != at] + [pa.array(np.diff(sums[ends]), pa.int64())], names=schema.names)

    return features.mapInArrow(add, schema)


def sorted_places(df: DataFrame, order: list, label: str, out: str = "place") -> DataFrame:
    """df with each row's place (from 1) in a total order: one sort by ranges, written, and the row counts of the ranges before."""
    (at,) = fresh(df, "at")
    placed = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()), label)
    part = F.shiftright(at, INDEX_BITS)
    before, first = 0, []
    for r in sorted(placed.groupBy(part.alias("part")).count().collect()):  # a row for each range
        first.append((r["part"], before))
        before += r["count"]
    (key, start) = fresh(placed, "part", "start")
    firsts = df.sparkSession.createDataFrame(first, f"{key} long, {start} long")
    ranked = placed.join(F.broadcast(firsts), part == F.col(key))
    out_df = ranked.withColumn(out, F.col(start) + F.col(at).bitwiseAND(F.lit((1 << INDEX_BITS) - 1)) + 1).drop(at, key, start)
    out_df.written_to = placed.written_to
    return out_df


def resample(docs: DataFrame, target: DataFrame, text: str = "text", id_col: str = "doc_id", target_text: str = "text", ngrams: int = 1, buckets: int = 10_000, seed: int = 2024, percent: int = 10, min_words: int = 20) -> DataFrame:
    """(id_col, n_features, weight, score, rank) of every row: rank from 1 of those drawn, null elsewhere.

    Of the N rows with min_words words or more, floor(percent * N / 100) of the highest scores are drawn, ties to the smaller
    id, then by place in the tables. The noise of a score depends on seed and id alone: repeated rows have one score and are drawn one by
    one; a null id draws as an empty one and stands behind all others. A null or empty text has no features and weight 0, and so
    have all where the target is empty but for its smoothing. Texts of any length are read whole. Other columns aren't
    read, so their names may clash. An empty table gives an empty result. Two tables of a slim row a document stay in
    the shared folder, as the result reads them.
    """
    if not 0 < buckets <= 1 << 32:
        raise ValueError("buckets are numbers of at most 32 bits")
    prepare(docs.sparkSession)
    ids = docs.select(docs[id_col].alias("doc_id"), docs[text].alias("text"))
    features = materialize(bucket_features(ids, "text", ("doc_id",), ngrams, buckets).withColumn("row", F.monotonically_increasing_id()), "features")
    aims = bucket_features(target.select(target[target_text].alias("text")), "text", (), ngrams, buckets)
    gains = bucket_gains(histogram(features, buckets), histogram(aims, buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    scored = weighted(features, gains).withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(uniform))))
    scored = materialize(scored, "scored")
    discard(features)
    enough = F.col("n_words") >= min_words
    placed = sorted_places(scored.where(enough), [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")], "drawn")
    drawn = placed.count() * percent // 100
    columns = [F.col("doc_id").alias(id_col), "n_features", "weight", "score"]
    rest = scored.where(~enough).select(*columns, F.lit(None).cast("long").alias("rank"))
    return placed.select(*columns, F.when(F.col("place") <= drawn, F.col("place")).alias("rank")).unionAll(rest)
