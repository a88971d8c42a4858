"""Exact top-k by inner product: vectors in shards by a shallow KD-tree, a KD-tree per shard, searched best-first.

A shallow tree of median splits, fitted on a bounded sample, deals all vectors to shards; each shard's tight box is taken over all
its vectors. A box's bound on the inner product is the sum over components of the larger of q*low and q*high. A query visits the
shard of the best bound, then the next few, then all others whose box can still beat the kth score it has so far. Within a
shard a tree of the same kind is searched best-first from that score on, and the search ends when the best open box can't beat
the kth score.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, prepare, released

RESULT = "query long, query_id long, vec_id long, row long, score long"
WAVES = (1, 4)  # shards a query visits in the first rounds; what can still win comes in the last


class Tree:
    """Median splits down to leaves; node i has box lows[i], highs[i], children or a slice of rows."""

    def __init__(self, ids: np.ndarray, numbers: np.ndarray, rows: np.ndarray, leaf: int = 128):
        order = np.arange(len(ids))
        self.lows, self.highs, self.kids, self.spans = [], [], [], []
        out: list[np.ndarray] = []
        self.size = 0

        def build(part: np.ndarray) -> int:
            node, own = len(self.kids), rows[part]
            low, high = own.min(0), own.max(0)
            self.lows.append(low)
            self.highs.append(high)
            self.kids.append(None)
            self.spans.append(None)
            wide = int((high - low).argmax())
            if len(part) <= leaf or high[wide] == low[wide]:
                self.spans[node] = (self.size, self.size + len(part))
                self.size += len(part)
                out.append(part)
                return node
            part = part[np.argsort(own[:, wide], kind="stable")]
            half = len(part) // 2
            self.kids[node] = (build(part[:half]), build(part[half:]))
            return node

        build(order)
        order = np.concatenate(out)
        self.ids, self.numbers, self.rows = ids[order], numbers[order], np.ascontiguousarray(rows[order])
        self.lows, self.highs = np.array(self.lows), np.array(self.highs)

    def search(self, query: np.ndarray, own: int, k: int, floor: float) -> list[tuple[int, int, int]]:
        """Up to k (score, vec_id, row), best first, ties to smaller ids, without the row numbered own; none under floor is owed."""
        plus, minus = np.maximum(query, 0), np.minimum(query, 0)
        bound = lambda i: float(plus @ self.highs[i] + minus @ self.lows[i])
        best: list[tuple[int, int, int]] = []  # a heap of (score, -vec_id, -row), the worst first
        open_ = [(-bound(0), 0)]
        while open_:
            top, node = heapq.heappop(open_)
            kth = max(floor, best[0][0]) if len(best) == k else floor
            if -top < kth:
                break
            if self.kids[node] is not None:
                for child in self.kids[node]:
                    if (b := bound(child)) >= kth:
                        heapq.heappush(open_, (-b, child))
                continue
            a, z = self.spans[node]
            scores = self.rows[a:z] @ query
            for j in np.flatnonzero(scores >= kth).tolist():
                item = (int(scores[j]), -int(self.ids[a + j]), -int(self.numbers[a + j]))
                if -item[2] == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        return [(s, -i, -r) for s, i, r in sorted(best, reverse=True)]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def quantised(vectors: DataFrame, id_col: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, v, dim): rows with an id and a vector of finite components, as floor(scale * x)."""
    x = F.col(vector).cast("array<double>")
    fine = F.col(id_col).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.where(fine).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale)).alias("v"), F.size(vector).alias("dim"))


class Splits:
    """A shallow tree of median splits over a sample, down to parts of `rows` rows; tells the shard of any vector."""

    def __init__(self, sample: np.ndarray, rows: float):
        self.axis, self.at, self.kids, self.shards = [], [], [], 0

        def build(part: np.ndarray) -> int:
            node = len(self.axis)
            self.axis.append(-1)
            self.at.append(0.0)
            self.kids.append((self.shards, self.shards))
            wide = int((part.max(0) - part.min(0)).argmax()) if len(part) else 0
            side = part[:, wide]
            if len(part) <= rows or side.max() == side.min():
                self.shards += 1
                return node
            cut = float(np.median(side))
            if cut == side.max():  # so that both parts hold rows
                cut = float(side[side < cut].max())
            low = side <= cut
            self.axis[node], self.at[node] = wide, cut
            self.kids[node] = (build(part[low]), build(part[~low]))
            return node

        build(sample)

    def of(self, rows: np.ndarray) -> np.ndarray:
        out, open_ = np.zeros(len(rows), np.int64), [(0, np.arange(len(rows)))]
        while open_:
            node, own = open_.pop()
            if self.axis[node] < 0:
                out[own] = self.kids[node][0]
            elif len(own):
                low = rows[own, self.axis[node]] <= self.at[node]
                open_ += [(self.kids[node][0], own[low]), (self.kids[node][1], own[~low])]
        return out


def dealt(v: DataFrame, splits: dict[int, Splits]) -> DataFrame:
    """v with the shard of each row, by the splits of its length; lengths that the sample didn't show have one shard."""
    names = [*v.columns, "shard"]
    schema = T.StructType([*v.schema.fields, T.StructField("shard", T.LongType())])
    dim_at, v_at = names.index("dim"), names.index("v")

    def deal(batches):
        for batch in released(batches):
            dims, shard = batch.column(dim_at).to_numpy(zero_copy_only=False), np.zeros(batch.num_rows, np.int64)
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                if dim in splits:
                    shard[own] = splits[dim].of(_matrix(batch.column(v_at).take(pa.array(own)), dim))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard)], names=names)

    return v.mapInArrow(deal, schema)


class Boxes:
    """The shards of one length of vectors, and their tight boxes."""

    def __init__(self, shards: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.shards, self.low, self.high = shards, low.T, high.T

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The most that each query's inner product with any vector of each shard can be."""
        return np.maximum(queries, 0) @ self.high + np.minimum(queries, 0) @ self.low


def boxes_of(v: DataFrame) -> dict[int, Boxes]:
    """By length of vectors; the driver gets two numbers for each component of each shard."""
    ends = v.select("dim", "shard", F.posexplode("v").alias("place", "x")).groupBy("dim", "shard", "place").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    rows = ends.groupBy("dim", "shard").agg(F.array_sort(F.collect_list(F.struct("place", "low", "high"))).alias("ends")).collect()
    found: dict[int, list] = {}
    for r in rows:
        found.setdefault(r["dim"], []).append((r["shard"], [(e["low"], e["high"]) for e in r["ends"]]))
    return {dim: Boxes(np.array([s for s, _ in own]), *np.array([e for _, e in own], float).transpose(2, 0, 1)) for dim, own in found.items()}


def routed(q: DataFrame, boxes: dict[int, Boxes], first: int, last: int | None) -> DataFrame:
    """Rows of q (query, query_id, dim, v, floor) for each shard in places first to last by its bound (last None: all) that may hold a score of floor or more."""
    schema = T.StructType([*q.schema.fields, T.StructField("shard", T.LongType())])
    names = schema.names
    dim_at, v_at, floor_at = (names.index(c) for c in ("dim", "v", "floor"))

    def route(batches):
        for batch in released(batches):
            dims, floors = (batch.column(i).to_numpy(zero_copy_only=False) for i in (dim_at, floor_at))
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                bounds = boxes[dim].bounds(_matrix(batch.column(v_at).take(pa.array(own)), dim))
                order = np.argsort(-bounds, axis=1, kind="stable")[:, first:last]
                best = np.take_along_axis(bounds, order, 1)
                floor = np.where(np.isnan(floors[own]), -np.inf, floors[own])
                row, place = np.nonzero(best >= floor[:, None])
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(own[row])).columns, pa.array(boxes[dim].shards[order[row, place]])], names=names)

    return q.mapInArrow(route, schema)


def _search(v: DataFrame, asked: DataFrame, k: int, shard_rows: int, query_rows: int) -> DataFrame:
    """RESULT rows of asked queries in their shards. A shard of more rows than shard_rows (alike vectors) is searched in parts, and
    so are more queries than query_rows, each part of the one with each of the other."""
    size = lambda df, rows, name: df.groupBy("dim", "shard").agg(F.ceil(F.count("*") / rows).cast("int").alias(name))
    parts = size(v, shard_rows, "parts").join(size(asked, query_rows, "groups"), ["dim", "shard"])  # a row a shard
    numbered = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = v.join(parts, ["dim", "shard"]).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")).withColumn("group", numbered("groups"))
    right = asked.join(parts, ["dim", "shard"]).withColumn("group", F.pmod(F.xxhash64("query"), F.col("groups")).cast("int")).withColumn("part", numbered("parts"))
    left = left.select("dim", "shard", "part", "group", "vec_id", "row", "v")
    right = right.select(*[F.col(c).alias(f"q_{c}") for c in ("dim", "shard", "part", "group", "query", "query_id", "v", "floor")])  # names of their own, as both come from one table

    def run(key, rows, queries):
        found: list[tuple[int, int, int, int, int]] = []
        if rows.num_rows and queries.num_rows:
            dim = key[0].as_py()
            column = lambda t, c: t.column(c).combine_chunks()
            tree = Tree(column(rows, "vec_id").to_numpy(), column(rows, "row").to_numpy(), _matrix(column(rows, "v"), dim))
            floors = column(queries, "q_floor").to_numpy(zero_copy_only=False)
            for own, name, query, floor in zip(column(queries, "q_query").to_pylist(), column(queries, "q_query_id").to_pylist(), _matrix(column(queries, "q_v"), dim), floors, strict=True):
                found += [(own, name, i, r, s) for s, i, r in tree.search(query, own, k, -np.inf if np.isnan(floor) else floor)]
        names = [x.split()[0] for x in RESULT.split(", ")]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, zip(*found, strict=True) if found else [()] * len(names), strict=True)})

    return left.groupBy("dim", "shard", "part", "group").cogroup(right.groupBy("q_dim", "q_shard", "q_part", "q_group")).applyInArrow(run, RESULT)


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector: str = "embedding", scale: int = 64, shard_rows: int = 4096, most_shards: int = 16_384, sample_rows: int = 20_000, query_rows: int = 16_384) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest integer inner product for each row whose id is divisible by every.

    Vectors that are null, empty or hold null or non-finite components take no part, nor do rows without an id. Every row but the
    query's own is a candidate, repeated rows and rows of the query's id included; a query that is repeated is answered each time. Only
    vectors of the query's own length are candidates. Ties go to the smaller vec_id. Scores must stay under 2**53. An
    empty table gives an empty result. Other columns aren't read, so their names may clash.

    Shards hold shard_rows rows, or more where that would make more than most_shards; their splits come from sample_rows
    rows, by a hash, while boxes and searches cover all. Vectors and results of the first rounds stay in the shared folder.
    """
    prepare(vectors.sparkSession)
    raw = quantised(vectors, id_col, vector, scale)
    n = raw.count()
    shard_rows = max(shard_rows, -(-n // most_shards))
    sample: dict[int, list] = {}
    if n > shard_rows:
        for r in raw.withColumn("h", F.xxhash64("vec_id", "v")).orderBy("h").limit(sample_rows).collect():
            sample.setdefault(r["dim"], []).append(r["v"])
    splits = {dim: Splits(np.array(own, float), shard_rows * min(sample_rows, n) / n) for dim, own in sample.items()}
    v = materialize(dealt(raw, splits).withColumn("row", F.monotonically_increasing_id()), "vectors")
    boxes = boxes_of(v)
    shards = max((len(b.shards) for b in boxes.values()), default=0)
    q = v.where(F.col("vec_id") % every == 0).select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"), "dim", "v")
    found, first = None, 0
    for wave in (*WAVES, None):
        if found is not None and first >= shards:
            break
        asked = q.withColumn("floor", F.lit(None).cast("double"))
        if found is not None:
            ranked = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
            kth = found.select("query", "score", ranked.alias("rank")).where(F.col("rank") == k).select("query", F.col("score").cast("double").alias("floor"))
            asked = q.join(kth, "query", "left").select(*q.columns, "floor")
        last = None if wave is None else first + wave
        more = _search(v, routed(asked, boxes, first, last), k, shard_rows, query_rows)
        found = more if found is None else found.unionAll(more)
        if last is not None and last < shards:
            found = materialize(found, "found")
        first = shards if last is None else last
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
