"""What several corpus operators share: a shared folder for intermediate tables, Arrow helpers, hashing, components."""

from __future__ import annotations

import contextlib
import ctypes
import os
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows an Arrow batch may hold, so that a batch of long texts stays small in a Python worker.
BATCH_ROWS = 250

#: What Python workers are started with: buffers that go back to the system when freed, and no threads of libraries' own.
WORKER_ENV = {"TOKENIZERS_PARALLELISM": "false", "ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1", "MALLOC_TRIM_THRESHOLD_": "1048576", "OMP_NUM_THREADS": "1", "OPENBLAS_NUM_THREADS": "1", "RAYON_NUM_THREADS": "1"}


def prepare(spark: SparkSession) -> SparkSession:
    """Lets workers import this package from the driver's copy and keeps Arrow batches small."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
    for name, value in WORKER_ENV.items():
        env.setdefault(name, value)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like those given that df doesn't have, whatever case it writes its own in."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def hashable(df: DataFrame) -> list:
    """df's columns for a hash over all of them: those that hold a map, which no hash takes, as JSON."""
    return [F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in t else F.col(f"`{c}`") for c, t in df.dtypes]


def released(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task; after the last one, what it has freed goes back to the system, as workers outlive their tasks."""
    yield from batches
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def gathered(batches: Iterable[pa.RecordBatch], rows: int, n_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The batches put together until they have that many rows or bytes, for work that is dearer by the call than by the row."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows or sum(b.nbytes for b in held) >= n_bytes:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one of its own only in local mode where that is unset, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[[^,]*\])?$", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: a cut in the lineage that any executor can read."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes what materialize() wrote for these tables. Nothing that is still to be computed may read them."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """A file's own path, or its name within the installed collection of public vocabularies."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def texts(column: pa.Array) -> list[str]:
    """Python strings of an Arrow string column, null as the empty text."""
    return ["" if x is None else x for x in column.to_pylist()]


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but the six ASCII white-space characters, A-Z lower-cased: what bytes.lower and bytes.split do."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class WordHashes(dict):
    """Word to 64-bit hash, kept for the words seen last; forgets all when full."""

    def __init__(self, most: int = 100_000):
        import xxhash

        super().__init__()
        self.most, self.digest = most, xxhash.xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = self.digest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of uint64 values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words, in order of place; of the whole sequence where it is shorter; none where it is empty."""
    if not len(hashes):
        return hashes
    k = min(k, len(hashes))
    out = np.zeros(len(hashes) - k + 1, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(out)]
    return mix(out ^ np.uint64(k))


def are_stars(edges: DataFrame) -> bool:
    """Whether every node of the distinct edges (u, v) is u of one edge alone, or v of any number of edges and u of none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    most = ends.groupBy("node").agg((F.sum("up") + F.max("down")).alias("n")).agg(F.max("n")).first()[0]
    return most is None or most == 1


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, component) for every node of the undirected edges (a, b), the component named by its smallest node.

    Alternates large-star and small-star steps until the edges are stars, each of a component's nodes with its smallest; the
    edge table never leaves the cluster and each round is cut by a written table, of which the last alone stays. A round's
    shuffle is linear in the edges.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = materialize(e, label)
    while not are_stars(e):
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").where("u <> v").distinct()
        last, e = e, materialize(small, label)
        discard(last)
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out = nodes.unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    out.written_to = e.written_to
    return out
