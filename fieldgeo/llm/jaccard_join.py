"""Similarity self-join on word shingles: documents whose shingle sets reach a Jaccard threshold, as linked components.

1. Equal shingle sets are one class, so copies never meet in pairs.
2. Partition. For a threshold t two sets differ in at most d = (1 - t) / (1 + t) * (|A| + |B|) elements. Elements are dealt
   to more than d parts by a hash, so some part is equal in both: classes that share a part's hash may link, others can't.
   Sizes are banded by powers of 1 / t; a class signs its own band and the next, so that partners always share one.
3. Candidates. Where classes share a part, a bound on their overlap from hashed token bitmaps decides whether they may link:
   first of each class with the part's first one, then, in parts whose classes that leaves apart, by a dual tree traversal.
   Spanning candidates make areas: families of texts that are alike, not all that share a passage.
4. Areas are cut into chunks of bounded size, and every pair of an area's chunks is a task that holds both chunks' sets.
   Each chunk is a signature tree: leaves and nodes hold an OR-combined token bitmap and the range of sizes. The dual
   traversal drops node pairs whose largest possible overlap is under what the smallest sizes need; pairs of classes that
   remain, unless already linked by others, are verified exactly. Spanning links are kept, and components follow.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WordHashes, components, discard, fresh, materialize, mix, prepare, released, shingle_hashes, texts, words_of


def links(common: int, a: int, b: int, percent: int) -> bool:
    return 100 * common >= percent * (a + b - common)


def band_of(n: int, percent: int) -> int:
    """The least i with n <= edge(i), where edges grow by 1 / t at most and by one at least."""
    return EDGES.setdefault(percent, Edges(percent)).of(n)


class Edges:
    """Upper ends of size bands: a set in band i has all its partners in bands i - 1 to i + 1."""

    def __init__(self, percent: int):
        self.percent, self.ends = percent, [1]

    def reach(self, n: int) -> None:
        while self.ends[-1] < n:
            self.ends.append(max(self.ends[-1] + 1, 100 * (self.ends[-1] + 1) // self.percent))

    def of(self, n: int) -> int:
        self.reach(n)
        return int(np.searchsorted(self.ends, n))

    def end(self, i: int) -> int:
        while len(self.ends) <= i:
            self.reach(self.ends[-1] + 1)
        return self.ends[i]


EDGES: dict[int, Edges] = {}


def parts_of(band: int, percent: int) -> tuple[int, int]:
    """(d, parts) of a band: the most elements that linked sets signed there differ in, and how many parts their elements are dealt to.

    The least number of parts that leaves more than d of them filled, with five standard deviations to spare, by the smallest set
    that signs the band (the first of the band before). So all but never is an empty part signed, which sets would share by chance.
    """
    if (band, percent) not in PARTS:
        ends = EDGES.setdefault(percent, Edges(percent))
        d = (100 - percent) * 2 * ends.end(band) // (100 + percent)
        least = ends.end(band - 2) + 1 if band > 1 else 1

        def enough(parts: int) -> bool:
            empty = math.exp(-least / parts)
            deviation = math.sqrt(max(parts * empty * (1 - (1 + least / parts) * empty), 0))
            return parts * (1 - empty) - 5 * deviation >= d + 1

        parts = d + 1
        while d and not enough(parts) and parts < 2 * d + 8:  # the smallest sets have too few elements for any number of parts
            parts += 1 + parts // 256
        PARTS[band, percent] = (d, parts)
    return PARTS[band, percent]


PARTS: dict[tuple[int, int], tuple[int, int]] = {}


def signatures(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Hashes (int64) of the parts of a set of uint64 tokens, for its own band and the next."""
    own = band_of(len(tokens), percent)
    out = []
    for band in (own, own + 1):
        d, parts = parts_of(band, percent)
        part = (mix(tokens ^ np.uint64(band + 1)) % np.uint64(parts)).astype(np.int64)
        filled = np.zeros(parts, bool)
        filled[part] = True
        sums = np.zeros(parts, np.uint64)
        np.add.at(sums, part, mix(tokens))
        sums = mix(sums + mix(np.arange(parts, dtype=np.uint64) + np.uint64(band << 32)))
        out.append(sums[filled] if filled.sum() > d else sums)  # more filled parts than differences: one of them is equal
    return np.concatenate(out).view(np.int64)


def shingle_sets(batches_texts: list[str], k: int, hashes: WordHashes) -> list[np.ndarray]:
    return [np.unique(shingle_hashes(hashes.of(words_of(x)), k)) for x in batches_texts]


def class_of(tokens: np.ndarray) -> int:
    """64-bit id of a shingle set; null ids are left to empty sets."""
    sums = [int(mix(tokens ^ np.uint64(seed)).sum(dtype=np.uint64)) for seed in (0, 0x5851F42D4C957F2D)]
    both = (sums[0] ^ (sums[1] * 0x9E3779B97F4A7C15 + len(tokens))) & (2**64 - 1)
    return int(mix(np.array([both], np.uint64)).view(np.int64)[0])


class Node:
    __slots__ = ("bits", "kids", "largest", "loss", "rows", "smallest")

    def __init__(self, rows, kids, bits, smallest, largest, loss):
        self.rows, self.kids, self.bits, self.smallest, self.largest, self.loss = rows, kids, bits, smallest, largest, loss


def signature_tree(sizes: np.ndarray, bits: np.ndarray, loss: np.ndarray, rows: np.ndarray, leaf: int = 32) -> Node:
    """rows are sorted by size; halves down to leaves of a few documents."""
    if len(rows) <= leaf:
        own = np.bitwise_or.reduce(bits[rows], axis=0)
        return Node(rows, (), own, int(sizes[rows[0]]), int(sizes[rows[-1]]), int(loss[rows].max()))
    half = len(rows) // 2
    kids = (signature_tree(sizes, bits, loss, rows[:half], leaf), signature_tree(sizes, bits, loss, rows[half:], leaf))
    return Node(rows, kids, kids[0].bits | kids[1].bits, kids[0].smallest, kids[1].largest, max(x.loss for x in kids))


def bitmap(tokens: np.ndarray) -> bytes:
    """Bits of the tokens' hashes in a power of two of places, at least four a token."""
    width = 1 << max(8, (4 * len(tokens) - 1).bit_length())
    bits = np.zeros(width, bool)
    bits[(tokens % np.uint64(width)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def same_width(maps: list[bytes]) -> np.ndarray:
    """Bitmaps (rows of uint64) folded to the narrowest one's width: a token's place in half the width is its place modulo that."""
    least = min(map(len, maps))
    return np.stack([np.bitwise_or.reduce(np.frombuffer(x, np.uint64).reshape(-1, least // 8), axis=0) for x in maps])


class Chunk:
    """Classes in order of size, with their bitmaps, the tokens that bitmaps hide, and their tree."""

    def __init__(self, ids: list[int], sizes: list[int], maps: np.ndarray, sets: list[np.ndarray] | None = None):
        order = np.argsort(sizes, kind="stable")
        self.ids = [ids[i] for i in order]
        self.sets = [sets[i] for i in order] if sets else []
        self.sizes = np.array(sizes)[order]
        self.bits = maps[order]
        self.loss = self.sizes - np.bitwise_count(self.bits).sum(1, dtype=np.int64)
        self.root = signature_tree(self.sizes, self.bits, self.loss, np.arange(len(ids)))


def chunks_of(rows: pa.Table) -> tuple[Chunk, Chunk]:
    """The one or two chunks of a task's rows (class_id, n, bits, chunk, and tokens if they're there)."""
    names, sizes, side = rows.column("class_id").to_pylist(), rows.column("n").to_pylist(), rows.column("chunk").to_numpy()
    maps = same_width(rows.column("bits").to_pylist())
    sets = [np.frombuffer(x, np.uint64) for x in rows.column("tokens").to_pylist()] if "tokens" in rows.column_names else None
    parts = []
    for c in np.unique(side):
        at = np.flatnonzero(side == c)
        parts.append(Chunk([names[i] for i in at], [sizes[i] for i in at], maps[at], [sets[i] for i in at] if sets else None))
    return parts[0], parts[-1]


def in_chunk_pairs(rows: DataFrame, key: str) -> DataFrame:
    """rows (key, chunk, chunks, ...) once for each pair of chunks that theirs is in, as low and high."""
    out = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return out.withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")}).drop("other", "chunks")


def needed(a, b, percent: int):
    """The least overlap at which sets of these sizes link."""
    return -(-percent * (a + b) // (100 + percent))


def spanning_links(one: Chunk, two: Chunk, percent: int, exact: bool = True) -> list[tuple[int, int]]:
    """Links between the chunks (or within one, if they're the same) that join all that link, or (not exact) may link."""
    lead: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := lead.get(x, x)) != x:
            lead[x] = lead.get(up, up)
            x = up
        return x

    out = []
    open_ = [(one.root, two.root)]
    while open_:
        a, b = open_.pop()
        if 100 * a.largest < percent * b.smallest or 100 * b.largest < percent * a.smallest:
            continue
        if int(np.bitwise_count(a.bits & b.bits).sum()) + min(a.loss, b.loss) < needed(a.smallest, b.smallest, percent):
            continue
        if a.kids or b.kids:
            if not b.kids or a.kids and len(a.rows) >= len(b.rows):
                open_ += [(x, b) for x in a.kids]
            else:
                open_ += [(a, x) for x in b.kids]
            continue
        most = np.bitwise_count(one.bits[a.rows][:, None, :] & two.bits[b.rows][None, :, :]).sum(2, dtype=np.int64)
        most += np.minimum(one.loss[a.rows][:, None], two.loss[b.rows][None, :])
        n, m = one.sizes[a.rows][:, None], two.sizes[b.rows][None, :]
        for i, j in np.argwhere(np.minimum(most, np.minimum(n, m)) >= needed(n, m, percent)):
            x, y = a.rows[i], b.rows[j]
            u, v = one.ids[x], two.ids[y]
            if u == v or find(u) == find(v):
                continue
            common = len(np.intersect1d(one.sets[x], two.sets[y], assume_unique=True)) if exact else 0
            if not exact or links(common, len(one.sets[x]), len(two.sets[y]), percent):
                lead[find(u)] = find(v)
                out.append((u, v))
    return out


def lead_order() -> Column:
    """Of two rows the lead is the one with an id, of the smaller id, then of the smaller hash."""
    return F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))


def grouped_classes(docs: DataFrame, text: str, id_col: str, k: int, percent: int, chunk_rows: int, chunk_tokens: int) -> tuple[DataFrame, DataFrame]:
    """Every row's (doc_id, row, n_shingles, class_id), row a hash of its id and text, and every class's (class_id, doc_id,
    row, n, group): its lead row, its size, and the smallest class linked to it."""
    prepare(docs.sparkSession)
    row = F.xxhash64(F.col(id_col).cast("long"), F.col(text))
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"), row.alias("row"))

    def describe(batches):
        hashes = WordHashes()
        for batch in released(batches):
            sets = shingle_sets(texts(batch.column(2)), k, hashes)
            columns = [pa.array([len(x) for x in sets], pa.int64()), pa.array([class_of(x) if len(x) else None for x in sets], pa.int64()), pa.array([bitmap(x) if len(x) else None for x in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=["doc_id", "row", "n_shingles", "class_id", "bits"])

    def sign(batches):
        hashes, seen = WordHashes(), set()
        for batch in released(batches):
            signs, names = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for tokens in shingle_sets(texts(batch.column(0)), k, hashes):
                if len(tokens) and (name := class_of(tokens)) not in seen:  # a task signs a class once
                    seen.add(name)
                    own = signatures(tokens, percent)
                    signs.append(own)
                    names.append(np.full(len(own), name))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(signs)), pa.array(np.concatenate(names))], names=["sign", "class_id"])

    slim = materialize(chosen.select("doc_id", "row", "text").mapInArrow(describe, "doc_id long, row long, n_shingles long, class_id long, bits binary"), "slim")
    signed = chosen.select("text").mapInArrow(sign, "sign long, class_id long")
    low = F.first("class_id").over(Window.partitionBy("sign").orderBy("class_id"))
    shared = materialize(signed.withColumn("low", low).where("class_id <> low").distinct(), "shared")

    # candidates by bitmap: every class with its part's first, then, where that leaves a part's classes apart, each with each
    maps = slim.where("class_id is not null").select("class_id", F.col("n_shingles").alias("n"), "bits").groupBy("class_id").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
    maps = materialize(maps.join(shared.select("class_id").union(shared.select("low")).distinct(), "class_id", "left_semi"), "maps")

    def may_link(batches):
        for batch in released(batches):
            keep = []
            for n, m, x, y in zip(*[batch.column(c).to_pylist() for c in ("n_a", "n_b", "bits_a", "bits_b")], strict=True):
                one, two = same_width([x, y])
                hidden = min(n - int(np.bitwise_count(one).sum()), m - int(np.bitwise_count(two).sum()))
                keep.append(int(np.bitwise_count(one & two).sum()) + hidden >= needed(n, m, percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    stars = shared.select(F.col("low").alias("a"), F.col("class_id").alias("b")).distinct()
    for side in ("a", "b"):
        stars = stars.join(maps.select(F.col("class_id").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")), side)
    strong = materialize(stars.mapInArrow(may_link, "a long, b long"), "strong")
    first = components(strong, "first")
    named = lambda c: F.coalesce("component", F.col(c))
    low_named = shared.select("sign", F.col("low").alias("class_id")).distinct()
    members = shared.select("sign", "class_id").unionAll(low_named).join(first, F.col("class_id") == F.col("node"), "left").select("sign", "class_id", named("class_id").alias("component"))
    apart = members.groupBy("sign").agg(F.count("*").alias("rows"), F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y and rows > 2")
    chunk = lambda n: F.pmod(F.xxhash64("class_id"), n).cast("int")
    apart = apart.select("sign", F.ceil(F.col("rows") / chunk_rows).cast("int").alias("chunks"))
    open_ = shared.select("sign", "class_id").unionAll(low_named).join(apart, "sign").join(maps, "class_id").withColumn("chunk", chunk(F.col("chunks")))

    def candidates(key, rows):
        found = spanning_links(*chunks_of(rows), percent, exact=False)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    more = in_chunk_pairs(open_, "sign").groupBy("sign", "low", "high").applyInArrow(candidates, "a long, b long")
    areas = components(strong.unionAll(more), "near")
    near = areas.select(F.col("node").alias("class_id"), F.col("component").alias("area"))

    # one row of each class that has candidates brings its set along
    ids = slim.where("class_id is not null").groupBy("class_id").agg(F.min("doc_id").alias("doc_id"), F.min_by("row", lead_order()).alias("row"), F.first("n_shingles").alias("n"))
    chosen_ids = materialize(near.join(ids, "class_id"), "areas")
    discard(shared, maps, strong, first, areas)
    sizes = chosen_ids.groupBy("area").agg(F.count("*").alias("rows"), F.sum("n").alias("tokens"))
    chunks = F.greatest(F.lit(1), F.ceil(F.col("rows") / chunk_rows), F.ceil(F.col("tokens") / chunk_tokens))
    plan = chosen_ids.join(sizes.select("area", chunks.cast("int").alias("chunks")), "area").select("row", "class_id", "area", "chunks", chunk(F.col("chunks")).alias("chunk"))
    leads = chosen.select("row", "text").join(plan.hint("merge"), "row").select("text", "class_id", "area", "chunk", "chunks")

    def bring(batches):
        hashes = WordHashes()
        for batch in released(batches):
            sets = shingle_sets(texts(batch.column(0)), k, hashes)
            columns = [pa.array([len(x) for x in sets], pa.int64()), pa.array([bitmap(x) for x in sets], pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], names=["class_id", "area", "chunk", "chunks", "n", "bits", "tokens"])

    sets = leads.mapInArrow(bring, "class_id long, area long, chunk int, chunks int, n long, bits binary, tokens binary")

    def verify(key, rows):
        found = spanning_links(*chunks_of(rows), percent)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    edges = in_chunk_pairs(sets, "area").groupBy("area", "low", "high").applyInArrow(verify, "a long, b long")
    groups = components(edges, "links").select(F.col("node").alias("class_id"), F.col("component").alias("group"))
    discard(chosen_ids)
    return slim, ids.join(groups, "class_id", "left").withColumn("group", F.coalesce("group", "class_id"))


def similar_groups(docs: DataFrame, text: str = "text", id_col: str = "doc_id", k: int = 5, percent: int = 80, chunk_rows: int = 512, chunk_tokens: int = 500_000) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id, n_classes) for every row of docs; percent is the Jaccard threshold in hundredths.

    class_id names the row's shingle set; component_id is the smallest doc_id reachable by links, itself included, and
    n_classes how many different sets the component has. Rows with
    equal sets are linked. Null, empty or wordless texts have 0 shingles, null class_id, and their own id as component; a
    null id is never a component's name while another is there. Repeated rows are all returned. Sets are compared by 64-bit hashes. Ids are
    cast to long. Texts of any length are one set, with some forty bytes a word in a task. Other columns aren't read, so their names may clash; an
    empty table gives an empty result.
    """
    slim, grouped = grouped_classes(docs, text, id_col, k, percent, chunk_rows, chunk_tokens)
    lowest = grouped.groupBy("group").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n_classes"))
    by_class = grouped.join(lowest, "group").select("class_id", "component_id", "n_classes")
    out = slim.join(by_class, "class_id", "left")
    return out.select("doc_id", "n_shingles", "class_id", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_classes", F.lit(1)).alias("n_classes"))


def drop_similar(docs: DataFrame, text: str = "text", id_col: str = "doc_id", k: int = 5, percent: int = 80, chunk_rows: int = 512, chunk_tokens: int = 500_000) -> DataFrame:
    """docs with one row of each group left: that of the smallest id, a null id last; of rows that share id and text, one.

    Where rows of a group share the smallest id with different texts, the one whose id and text have the smallest hash stays. Texts that are null, empty or without words are all kept.
    """
    _, grouped = grouped_classes(docs, text, id_col, k, percent, chunk_rows, chunk_tokens)
    row, n = fresh(docs, "row", "n")
    leads = grouped.groupBy("group").agg(F.min_by("row", lead_order()).alias(row)).select(row)
    hashed = docs.withColumn(row, F.xxhash64(F.col(id_col).cast("long"), F.col(text)))
    wordless = F.col(text).isNull() | ~F.col(text).rlike(r"[^ \t-\r]")
    met = hashed.where(~wordless).join(leads, row)
    one = met.withColumn(n, F.row_number().over(Window.partitionBy(row).orderBy(row))).where(F.col(n) == 1)
    return one.select(*docs.columns).unionAll(docs.where(wordless))
