"""Benchmark items inside documents: size-partitioned MinHash containment search, verified by exact shingle containment.

Items are put into classes by their number of shingles, doubling from class to class. For a class of at most u shingles a
document is the set of its windows of 2u shingles at a step of u, so that every run of u shingles lies whole in one of
them and a window's size is within four times an item's, however long the document. Item and window are candidates if one
of `bands` MinHash values agrees (one row a band): a contained share c then is missed with probability at most
(1 - c / (5 - c)) ** bands, under 2e-6 for c = 0.8 and 64 bands. A window's least value can only agree where it holds the very
shingle that is the item's least, so values are computed for windows that hold one of those. Candidates are verified
against the whole document's shingle set.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WordHashes, mix, prepare, released, shingle_hashes, texts, words_of


class Items:
    """A bounded block of benchmark items, with what the search needs of them."""

    def __init__(self, rows: list[tuple[int, str]], k: int, bands: int, seed: int = 7):
        self.k = k
        self.seeds = mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)
        hashes = WordHashes()
        self.ids: list[int] = []
        self.sets: list[np.ndarray] = []
        self.short: dict[int, list[int]] = {}
        self.classes: dict[int, list[int]] = {}
        for item, text in rows:
            words = words_of(text)
            if item is None or not words:
                continue
            at = len(self.ids)
            self.ids.append(item)
            self.sets.append(np.unique(shingle_hashes(hashes.of(words), k)))
            if len(words) < k:
                self.short.setdefault(len(words), []).append(at)
            else:
                self.classes.setdefault(1 << (len(self.sets[at]) - 1).bit_length(), []).append(at)
        self.signatures = {u: np.array([self.least(self.sets[i]) for i in own]) for u, own in self.classes.items()}
        self.keys = {u: [dict() for _ in self.seeds] for u in self.classes}
        marks = [np.zeros(0, np.uint64)]
        for u, own in self.classes.items():
            for i, row in zip(own, self.signatures[u], strict=True):
                for b, value in enumerate(row.tolist()):
                    self.keys[u][b].setdefault(value, []).append(i)
                marks.append(self.sets[i][np.array([(mix(self.sets[i] * s)).argmin() for s in self.seeds])])
        self.marks = np.unique(np.concatenate(marks))

    def least(self, shingles: np.ndarray) -> np.ndarray:
        return np.array([mix(shingles * s).min() for s in self.seeds])

    def matches(self, hashes: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """(item, containment) of the items contained in the document of these word hashes."""
        found: set[int] = set()
        for length, own in self.short.items():
            if len(hashes) >= length:
                there = np.isin(np.array([self.sets[i][0] for i in own]), shingle_hashes(hashes, length))
                found.update(i for i, yes in zip(own, there, strict=True) if yes)
        whole = shingle_hashes(hashes, self.k) if len(hashes) >= self.k else np.zeros(0, np.uint64)
        out = [(self.ids[i], 1.0) for i in found]
        if not len(whole) or not len(self.marks):
            return out
        at = np.searchsorted(self.marks, whole)
        hits = np.flatnonzero(self.marks[np.minimum(at, len(self.marks) - 1)] == whole)
        if not len(hits):
            return out
        candidates: set[int] = set()
        for u in self.classes:
            windows = set((hits // u).tolist()) | set((hits // u - 1).clip(0).tolist())
            for w in windows:
                for b, value in enumerate(self.least(whole[w * u : (w + 2) * u]).tolist()):
                    candidates.update(self.keys[u][b].get(value, ()))
        if candidates:
            own = np.unique(whole)
            for i in candidates:
                share = np.isin(self.sets[i], own, assume_unique=True).mean()
                if share >= threshold:
                    out.append((self.ids[i], float(share)))
        return out


def contained_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", id_col: str = "doc_id", threshold: float = 0.8, k: int = 5, bands: int = 64, block_items: int = 20_000) -> DataFrame:
    """(doc_id, item_id, containment) for every item whose shingles lie in a document's to the share threshold or more.

    The benchmark is taken in blocks of at most block_items items, each sent to the tasks of a pass of its own over docs; no pass
    shuffles. Items without words match nothing; an item under k words is one shingle of its own length. Null and empty
    texts match nothing; repeated rows give repeated results; an empty table on either side gives an empty result. Texts of any length are searched
    whole, with some thirty bytes a word in a task. Item ids are cast to long; other columns aren't read, so their names may clash.
    """
    spark = prepare(docs.sparkSession)
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([chosen.schema["doc_id"], T.StructField("item_id", T.LongType()), T.StructField("containment", T.DoubleType())])
    out = spark.createDataFrame([], schema)
    for sent in item_blocks(benchmark, block_items):

        def run(batches, sent=sent):
            found, hashes = Items(sent.value, k, bands), WordHashes()
            for batch in released(batches):
                rows = [(doc, i, c) for doc, x in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True) for i, c in found.matches(hashes.of(words_of(x)), threshold)]
                d, i, c = zip(*rows, strict=True) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(d, batch.schema.field(0).type), pa.array(i, pa.int64()), pa.array(c, pa.float64())], names=schema.names)

        out = out.unionAll(chosen.mapInArrow(run, schema))
    return out


def item_blocks(benchmark: DataFrame, block_items: int) -> list:
    """Broadcasts of at most about block_items (item_id, text) rows each."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item_text"))
    blocks = -(-items.count() // block_items)
    part = F.pmod(F.xxhash64("item_id", "item_text"), F.lit(max(blocks, 1)))
    context = benchmark.sparkSession.sparkContext
    return [context.broadcast([tuple(r) for r in items.where(part == b).collect()]) for b in range(blocks)]


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", threshold: float = 0.8, k: int = 5, bands: int = 64, block_items: int = 20_000) -> DataFrame:
    """docs without the rows whose text contains a benchmark item; rows with null texts stay.

    One narrow pass for each block of items. Repeated rows stay or go together, all columns come through whatever their names, an empty
    table or benchmark gives docs as they are.
    """
    prepare(docs.sparkSession)
    names = docs.columns
    for sent in item_blocks(benchmark, block_items):

        def keep(batches, sent=sent):
            found, hashes = Items(sent.value, k, bands), WordHashes()
            for batch in released(batches):
                column = batch.column(names.index(text))
                yield batch.filter(pa.array([not found.matches(hashes.of(words_of(x)), threshold) for x in texts(column)], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
