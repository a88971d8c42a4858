"""Packs tokenised documents into fixed-length sequences by cutting-stock column generation.

1. One narrow pass tokenises each text, cuts it into full sequences and a rest, and keeps lengths and checksums alone.
2. The rests' length histogram (at most capacity / grain classes, whatever the corpus) makes a linear program over
   patterns; a knapsack dynamic program prices new patterns until none improves it.
3. Rounded-down pattern counts, and first-fit patterns for what rounding leaves, give each class numbered slots.
4. Pieces are ranked within their class (ranks by salted counts, no group in one task) and take the slot of their rank.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, prepare, released, texts, tokenizer_path

#: The tokenizer's pattern for lower-cased Latin-1 texts: contractions, letters, one digit or fraction, other signs.
RUNS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
PIECE = "start long, length long, ids_crc32 long, doc_tokens long"


class WordIds(dict):
    """Space-separated part to its ids as little-endian uint32 bytes.

    The pre-tokenizer never joins characters over white space and drops it, so parts can be encoded one by one; a
    Latin-1 text falls into the tokenizer's own runs, which are kept and encoded by themselves. Runs of letters are encoded
    many at a time and told apart by their word-end ids.
    """

    def __init__(self, path: str, most: int = 200_000):
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for piece, i in self.tokenizer.get_vocab().items() if piece.endswith("</w>")]] = True

    def encode(self, parts: list[str]) -> None:
        """Keeps the ids of parts that have none yet."""
        words = [x for x in parts if x.isalpha()]
        for at in range(0, len(words), 1024):
            some = words[at : at + 1024]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some):  # the vocabulary's word ends don't tell the words apart
                self.update((w, np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes()) for w in some)
                continue
            data, last = ids.tobytes(), 0
            for word, cut in zip(some, cuts.tolist(), strict=True):
                self[word] = data[4 * last : 4 * cut]
                last = cut
        rest = [x for x in parts if not x.isalpha()]
        for part, found in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self[part] = np.array(found.ids, "<u4").tobytes()

    def runs(self, text: str) -> list[str]:
        """Parts of a text that the tokenizer treats one by one: its own runs where all characters are Latin-1, else by spaces."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text.replace("\n", " ").split(" ")
        return [text] if "<|" in text else RUNS.findall(text.lower())

    def of(self, texts: list[str]) -> list[bytes]:
        if len(self) > self.most:
            self.clear()
            self[""] = b""
        split = [self.runs(x) for x in texts]
        self.encode([x for x in set().union(*split) if x not in self])
        found = [b"".join(map(self.__getitem__, x)) for x in split]
        for x in split:
            if len(x) == 1 and len(x[0]) > 64:  # whole texts with special strings, or one very long part
                self.pop(x[0], None)
        return found


_loaded: dict[str, WordIds] = {}


def word_ids(name: str) -> WordIds:
    if name not in _loaded:
        _loaded[name] = WordIds(tokenizer_path(name))
    return _loaded[name]


def encoded(table: WordIds, texts: list[str], most: int = 200_000):
    """The ids of each text, a few characters' worth of texts at a time."""
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text)
        if size > most:
            yield from table.of(some)
            some, size = [], 0
    if some:
        yield from table.of(some)


def cut_pieces(docs: DataFrame, text: str, id_col: str, capacity: int, end_id: int, tokenizer: str) -> DataFrame:
    """Pieces of every document's ids (its end id included): full ones of capacity ids, then the rest."""
    chosen = docs.select(docs[id_col].alias("doc_id"), docs[text].alias("text"))
    schema = T.StructType([chosen.schema["doc_id"], *T._parse_datatype_string(PIECE).fields])
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        table = word_ids(tokenizer)
        for batch in released(batches):
            rows = []
            for doc, data in zip(batch.column(0).to_pylist(), encoded(table, texts(batch.column(1))), strict=True):
                data += end
                total = len(data) // 4
                rows += [(doc, at, min(capacity, total - at), zlib.crc32(data[4 * at : 4 * (at + capacity)]), total) for at in range(0, total, capacity)]
            names = schema.names
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, batch.schema.field(0).type if i == 0 else pa.int64()) for i, c in enumerate(columns)], names=names)

    return chosen.mapInArrow(cut, schema)


def best_pattern(values: np.ndarray, most: np.ndarray, size: int) -> np.ndarray:
    """Bounded-enough knapsack: the pattern of classes 1..size (weight = class) with the largest value that fits size."""
    best, last = np.zeros(size + 1), np.zeros(size + 1, int)
    weights = np.flatnonzero((values > 1e-12) & (most > 0)) + 1
    for w in range(1, size + 1):
        own = weights[weights <= w]
        best[w] = best[w - 1]
        if len(own):
            gains = best[w - own] + values[own - 1]
            k = int(gains.argmax())
            if gains[k] > best[w] + 1e-12:
                best[w], last[w] = gains[k], own[k]
    pattern, w = np.zeros(size, int), size
    while w > 0:
        if last[w]:
            pattern[last[w] - 1] += 1
            w -= last[w]
        else:
            w -= 1
    return pattern


def solve_patterns(counts: np.ndarray, rounds: int = 2000) -> list[tuple[np.ndarray, int]]:
    """Patterns over classes 1..len(counts) (a sequence holds weight len(counts)) and how often each is used; covers all counts.

    The linear program min sum(x), A x = counts, is solved by revised simplex from single-class patterns, each round
    pricing the best new pattern by dynamic programming. What rounding down leaves is packed by first fit, largest first.
    """
    size = len(counts)
    rows = np.flatnonzero(counts)
    use: dict[tuple[int, ...], int] = {}
    if len(rows):
        columns = np.zeros((size, len(rows)))
        for j, r in enumerate(rows):
            columns[r, j] = max(1, min(size // (r + 1), counts[r]))
        inverse = np.diag(1.0 / columns[rows, np.arange(len(rows))])
        x = inverse @ counts[rows]
        for _ in range(rounds):
            dual = inverse.sum(axis=0)
            values = np.zeros(size)
            values[rows] = dual
            new = best_pattern(values, counts, size)
            if values @ new <= 1 + 1e-7:
                break
            step = inverse @ new[rows]
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio = np.where(step > 1e-9, x / step, np.inf)
            out = int(ratio.argmin())
            if not np.isfinite(ratio[out]):
                break
            x = x - ratio[out] * step
            x[out] = ratio[out]
            x = np.maximum(x, 0)
            columns[:, out] = new
            row = inverse[out] / step[out]
            inverse -= np.outer(step, row)
            inverse[out] = row
        for j, value in enumerate(np.floor(x + 1e-9).astype(int)):
            if value > 0:
                key = tuple(columns[:, j].astype(int))
                use[key] = use.get(key, 0) + int(value)
    left = counts.astype(int).copy()
    for key, n in use.items():
        left -= n * np.array(key)
    for key in list(use):  # patterns from the basis may give more of a class than there is
        while use[key] > 0 and (left < 0)[np.array(key) > 0].any():
            use[key] -= 1
            left += np.array(key)
    rooms = np.zeros(0, int)
    made: list[np.ndarray] = []
    for c in range(size, 0, -1):  # at most one sequence or two a class are left
        for _ in range(left[c - 1]):
            fit = np.flatnonzero(rooms >= c)
            if len(fit):
                k = int(fit[rooms[fit].argmin()])
            else:
                k, rooms = len(rooms), np.append(rooms, size)
                made.append(np.zeros(size, int))
            rooms[k] -= c
            made[k][c - 1] += 1
    for pattern in made:
        key = tuple(pattern)
        use[key] = use.get(key, 0) + 1
    return [(np.array(k), n) for k, n in use.items() if n]


def slots(patterns: list[tuple[np.ndarray, int]]) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, one past the last, slots of the class in a sequence, first sequence) of every use of a class."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, n in patterns:
        for c in np.flatnonzero(pattern):
            a = int(pattern[c])
            first = taken.get(int(c), 0)
            taken[int(c)] = first + a * n
            out.append((int(c) + 1, first, first + a * n, a, sequence))
        sequence += n
    return out


def ranked(df: DataFrame, group: str, order: list[str], rows_each: int = 5_000) -> DataFrame:
    """rank (from 0) of every row within group, dense and without putting a group into one task.

    Rows are dealt to sub-groups by a hash; sub-groups get first ranks from a running sum over their counts, whose table
    holds a row for each group and sub-group.
    """
    parts = max(1, -(-df.count() // rows_each))
    df = df.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    counts = df.groupBy(group, "__part").agg(F.count("*").alias("__n"))
    first = F.coalesce(F.sum("__n").over(Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(group, "__part", first.alias("__first"))
    inner = F.row_number().over(Window.partitionBy(group, "__part").orderBy(*order)) - 1
    return df.withColumn("__inner", inner).join(counts, [group, "__part"]).withColumn("rank", F.col("__first") + F.col("__inner")).drop("__part", "__inner", "__first")


def pack(docs: DataFrame, text: str = "text", id_col: str = "doc_id", capacity: int = 2048, grain: int = 16, end_id: int = 1, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): where each piece of a document's ids lies.

    A null or empty text has its end id alone. Repeated rows and null ids are documents of their own. Texts of any length
    are cut into full pieces and a rest; rests are rounded up to grain for the program, but lie gapless in their sequence.
    Pieces alike in all of the order's columns are ranked in any order, which changes no row but for their places. Other columns aren't read,
    so their names may clash. An empty table gives an empty result.
    """
    spark = prepare(docs.sparkSession)
    size = capacity // grain
    pieces = materialize(cut_pieces(docs, text, id_col, capacity, end_id, tokenizer), "pieces")
    pieces = pieces.withColumn("class", F.ceil(F.col("length") / grain).cast("int"))
    histogram = {r["class"]: r["count"] for r in pieces.groupBy("class").count().collect()}  # at most capacity / grain rows
    counts = np.array([histogram.get(c, 0) for c in range(1, size + 1)], int)
    where = spark.createDataFrame(slots(solve_patterns(counts)), "class int, lo long, hi long, each long, first_sequence long")
    order = ["doc_id", "start", "ids_crc32", "length", "doc_tokens"]
    placed = ranked(pieces, "class", order).join(F.broadcast(where), "class").where("rank >= lo and rank < hi")  # bounded by patterns x classes, not by rows
    placed = placed.withColumn("sequence_id", F.col("first_sequence") + F.expr("(rank - lo) div each"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "class", "rank").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
