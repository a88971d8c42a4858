"""Language-model scores of documents by a weighted backoff automaton over word trigrams.

The model. Unigrams: p(w) = (c(w) - d) / N for known words and d V / N for the one unknown outcome, d = n1 / (n1 + 2 n2).
Above them each order is drawn towards the one below as if by k tokens more: p(w | v) = (c(vw) + k2 p(w)) / (c(v) + k2) and
p(w | uv) = (c(uvw) + k3 p(w | v)) / (c(uv) + k3), k being the distinct n-grams of that order for each context seen. As an automaton: a state
for each context with successors, an arc for each seen n-gram that carries its log probability, and a failure arc to the
state of the context's last word, or to the root, that carries log(k / (c + k)); the root has an arc for each word.

Its counts grow with the corpus, so no task holds the whole model. Documents are read into blocks of a few megabytes, in
which words are numbers, and written so to the shared folder; texts are never shuffled. A block asks only for the n-grams
that stand in it, in packed arrays by shard:

1. block -> word shards, by 64-bit hashes: a shard adds the blocks' training counts up and numbers its words, often used ones first.
2. block -> n-gram shards, by those numbers, without n-grams that hold an unknown word: a shard adds the counts up.
   Each shard tells every block its totals too, whose sums a block needs.
3. With both answers a block builds its part of the automaton, and its documents are traversed once from left to right, all of
   them at once: the state before a token is that of the two tokens before it, which a shift by one place carries along.

A word, pair or triple on a third of all rows is one entry for each block. An n-gram goes to a shard by its first word, by its
first two where that word stands in training more than SPREAD times, and by all three where the second does so too, so that nothing
brings more than about SPREAD entries to a shard.
"""

from __future__ import annotations

import struct
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix, prepare, released, word_hashes, words_of

END = np.uint64(0x2545F4914F6CDD1D)
WORDS, PAIRS, TRIPLES = 1, 2, 3  # n-grams by their order
BLOCK = "block long, docs array<long>, held array<boolean>, tokens binary, words array<struct<shard int, data binary>>"
ASK = "kind int, shard int, block long, data binary"
ANSWER = "kind int, shard int, block long, data binary, n long, types long, ones long, twos long"
SUMS = ("n", "types", "ones", "twos")
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


SPREAD = 1_000_000


class Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self) + 1
        return n


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers from 0 as few bytes as their largest one needs, the lower bytes of all first, compressed."""
    parts = []
    for x in arrays:
        width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
        parts += [struct.pack("<qq", len(x), width), x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()]
    return zstandard.compress(b"".join(parts), 1)


def unpacked(data: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.decompress(data), 0, []
    while at < len(data):
        n, width = struct.unpack_from("<qq", data, at)
        whole = np.zeros((n, 8), np.uint8)
        whole[:, :width] = np.frombuffer(data, np.uint8, n * width, at + 16).reshape(width, n).T
        out.append(whole.view("<u8").reshape(n).astype(np.uint64))
        at += 16 + n * width
    return out


def steps(x: np.ndarray) -> np.ndarray:
    """Differences of sorted uint64 values, the first from 0; np.cumsum undoes it."""
    return np.diff(x, prepend=x.dtype.type(0))


def run_starts(first: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, by the steps between them."""
    starts = first != 0
    starts[:1] = True
    return np.flatnonzero(starts)


def steps_in_runs(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """As steps, anew in each run of the first column, whose steps are given; x is sorted within those."""
    out, at = steps(x), run_starts(first)
    out[at] = x[at]
    return out


def sums_in_runs(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Undoes steps_in_runs."""
    if not len(x):
        return x
    at, total = run_starts(first), np.cumsum(x)
    return total - np.repeat(total[at] - x[at], np.diff(np.append(at, len(x))))


def whole(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int64)


def table_of(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    names, types = zip(*[x.split() for x in schema.split(", ")], strict=True)
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.table({n: pa.array(c, kinds[t]) for n, t, c in zip(names, types, columns, strict=True)})


def as_blocks(batches, shards: int, most: int):
    """A row for each most bytes of a task's texts; a block's number holds the task's."""
    some, size, n = [], 0, 0
    for batch in batches:
        some.append(batch)
        size += batch.nbytes
        if size > most:
            yield from as_numbers((TaskContext.get().partitionId() << 24) + n, pa.Table.from_batches(some), shards).to_batches()
            some, size, n = [], 0, n + 1
    if sum(x.num_rows for x in some):
        yield from as_numbers((TaskContext.get().partitionId() << 24) + n, pa.Table.from_batches(some), shards).to_batches()


def as_numbers(block: int, table: pa.Table, shards: int) -> pa.Table:
    """One row for a block: its documents' tokens as places in the list of its words, which are sorted by shard and hash."""
    numbers = Numbers()
    documents = [np.array([*map(numbers.__getitem__, words_of(x.as_py())), 0], np.int64) for x in table.column("text")]
    held = table.column("held_out").to_pylist()
    hashes = np.concatenate([np.array([END]), word_hashes(list(numbers))])
    shard = whole(hashes % np.uint64(shards))
    order = np.lexsort((hashes, shard))
    rank = np.argsort(order)
    tokens, sizes = rank[np.concatenate(documents)], np.array([len(x) for x in documents])
    counts = np.bincount(tokens, np.repeat(~np.array(held, bool), sizes), len(order)).astype(np.int64)
    ends = np.searchsorted(shard[order], np.arange(shards + 1))
    words = [{"shard": s, "data": packed(steps(hashes[order[a:z]]), counts[a:z])} for s, (a, z) in enumerate(zip(ends[:-1], ends[1:], strict=True))]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.list_(pa.struct([("shard", pa.int32()), ("data", pa.binary())]))]
    often = np.argsort(-np.bincount(tokens, minlength=len(order)), kind="stable")  # places by how often they are used: small numbers pack well
    row = (block, table.column("doc_id").to_pylist(), held, packed(np.argsort(often)[tokens], sizes, often), words)
    return pa.table({n: pa.array([x], t) for n, x, t in zip(("block", "docs", "held", "tokens", "words"), row, kinds, strict=True)})


class Block:
    """A block's documents with what the word shards told of its words, and its distinct n-grams of known words.

    grams[n] are the n-grams of order n as rows of places in numbers, in order; places[n] is each token's row there, or -1; weights[n] their
    counts in training documents.
    """

    def __init__(self, row: dict, told: dict[int, bytes], spread: int = SPREAD):
        self.spread = spread
        tokens, sizes, often = map(whole, unpacked(row["tokens"]))
        numbers, counts = zip(*[unpacked(told[s]) for s in sorted(told)], strict=True)
        numbers = whole(np.concatenate(numbers))
        order = np.argsort(numbers)  # words by their numbers, so that n-grams come in the order of those
        self.numbers, self.counts, tokens = numbers[order], whole(np.concatenate(counts))[order], np.argsort(order)[often[tokens]]
        self.docs, self.held, self.sizes, self.tokens = row["docs"], row["held"], sizes, tokens
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.first, end = first, tokens[-1]
        before = np.concatenate([[end], tokens[:-1]])  # the end also stands before the first word
        before[first] = end
        second = np.concatenate([[end], before[:-1]])
        known, trained = self.counts > 0, np.repeat(~np.array(self.held, bool), sizes)
        n = len(self.numbers)
        self.grams, self.places, self.weights = {}, {}, {}
        open_ = known[tokens] & known[before]
        pair = np.where(open_, before * n + tokens, -1)
        self.take(PAIRS, pair, trained, n)
        open_ &= known[second]
        open_[first] = False
        triple = np.full(len(tokens), -1)
        triple[open_] = self.places[PAIRS][np.flatnonzero(open_) - 1] * n + tokens[open_]  # the pair before, then the word
        self.take(TRIPLES, triple, trained, n)

    def take(self, kind: int, keys: np.ndarray, trained: np.ndarray, n: int) -> None:
        some = np.flatnonzero(keys >= 0)
        found, at = np.unique(keys[some], return_inverse=True)
        self.places[kind] = np.full(len(keys), -1)
        self.places[kind][some] = at
        self.weights[kind] = np.bincount(at, trained[some], len(found)).astype(np.int64)
        left = (found // n)[:, None] if kind == PAIRS else self.grams[PAIRS][found // n]
        self.grams[kind] = np.hstack([left, (found % n)[:, None]]) if len(found) else np.zeros((0, kind), np.int64)

    def by_shard(self, kind: int, shards: int) -> list[tuple[int, np.ndarray]]:
        """Each shard's n-grams, in the order of their first words' numbers."""
        rows = self.grams[kind]
        hashed, spread = np.zeros(len(rows), np.uint64), np.ones(len(rows), bool)
        for column in rows.T:
            hashed[spread] = mix(hashed[spread] + self.numbers[column[spread]].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
            spread &= self.counts[column] > self.spread
        shard = (hashed % np.uint64(shards)).astype(np.uint16 if shards < 1 << 16 else np.uint32)
        order = np.argsort(shard, kind="stable")
        ends = np.searchsorted(shard[order], np.arange(shards + 1))
        return [(s, order[a:z]) for s, (a, z) in enumerate(zip(ends[:-1], ends[1:], strict=True))]

    def asked(self, kind: int, shards: int) -> list[tuple[int, bytes]]:
        out = []
        for s, at in self.by_shard(kind, shards):
            first, second, *rest = self.numbers[self.grams[kind][at]].T
            moved = steps(first)
            out.append((s, packed(moved, steps_in_runs(second, moved), *rest, self.weights[kind][at])))
        return out

    def answered(self, kind: int, shards: int, told: dict[int, bytes]) -> np.ndarray:
        """Training counts of the block's n-grams."""
        out = np.zeros(len(self.grams[kind]), np.int64)
        for s, at in self.by_shard(kind, shards):
            out[at] = whole(unpacked(told[s])[0])
        return out


def added_up(kind: int, requests: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of a shard's requests: their distinct n-grams' total counts, and the place of each entry among those, a list for each request."""
    columns = [np.concatenate([np.cumsum(r[0]) for r in requests])]
    if kind != WORDS:
        columns += [np.concatenate([sums_in_runs(r[1], r[0]) for r in requests]), *[np.concatenate([r[i] for r in requests]) for i in range(2, len(requests[0]) - 1)]]
    keys = columns[0]
    for column in columns[1:]:
        _, keys = np.unique(keys, return_inverse=True)
        if len(column) and int(column.max()) >> 32:  # numbers too large for half a key: their places among the shard's own
            _, column = np.unique(column, return_inverse=True)
        keys = (keys.astype(np.uint64) << np.uint64(32)) | column.astype(np.uint64)
    _, place = np.unique(keys, return_inverse=True)
    totals = np.bincount(place, np.concatenate([r[-1] for r in requests])).astype(np.int64)
    return totals, np.split(place, np.cumsum([len(r[0]) for r in requests])[:-1])


class Automaton:
    """A block's states and arcs: the root, a state for each of its words and pairs that was seen in training."""

    def __init__(self, block: Block, pairs: np.ndarray, triples: np.ndarray, total: Totals):
        c = block.counts
        root = np.where(c > 0, c - total.discount, max(total.discount * total.types, total.discount)) / max(total.tokens, 1)
        if not total.tokens:
            root = np.ones(len(c))
        self.root = np.log10(root)
        before = np.concatenate([[0], block.tokens[:-1]])
        before[block.first] = block.tokens[-1]
        self.pair, self.triple = block.places[PAIRS], block.places[TRIPLES]
        # a probability of every distinct n-gram that was seen; by the place of one of its tokens its lower orders are known
        at = self.one_place(self.pair, len(pairs))
        two = (pairs + total.pull_pairs * root[block.tokens[at]]) / np.maximum(c[before[at]] + total.pull_pairs, 1e-9)
        at = self.one_place(self.triple, len(triples))
        context = pairs[self.pair[at - 1]]
        three = (triples + total.pull_triples * two[self.pair[at]]) / np.maximum(context + total.pull_triples, 1e-9)
        log = lambda p, seen: np.log10(np.where(seen, p, np.nan))
        self.arcs = {PAIRS: log(two, pairs > 0), TRIPLES: log(three, triples > 0)}
        self.fail = {PAIRS: np.log10(total.pull_pairs / (c + total.pull_pairs)), TRIPLES: np.log10(total.pull_triples / (pairs + total.pull_triples))}
        self.word_states, self.pair_states = c > 0, pairs > 0
        self.before = before
        self.last = np.concatenate([[-1], self.pair[:-1]])  # the pair that ends before each token
        self.last[block.first] = -1

    @staticmethod
    def one_place(places: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(n, np.int64)
        out[places[places >= 0]] = np.flatnonzero(places >= 0)
        return out

    def scores(self, block: Block) -> np.ndarray:
        """Each document's sum over its tokens: the arc of the state before a token if it has one for it, else failure arcs to the state that has.

        A word's arc at the root, with the failure arc of the state of the word before; then pairs' arcs, with the failure arc
        of the state of the pair before; then triples' arcs.
        """
        cost = self.root[block.tokens] + np.where(self.word_states[self.before], self.fail[PAIRS][self.before], 0.0)
        self.taken(cost, self.arcs[PAIRS], self.pair)
        at = np.flatnonzero(self.last >= 0)
        at = at[self.pair_states[self.last[at]]]
        cost[at] += self.fail[TRIPLES][self.last[at]]
        self.taken(cost, self.arcs[TRIPLES], self.triple)
        return np.add.reduceat(cost, block.first)

    @staticmethod
    def taken(cost: np.ndarray, arcs: np.ndarray, places: np.ndarray) -> None:
        at = np.flatnonzero(places >= 0)
        own = arcs[places[at]]
        seen = ~np.isnan(own)
        cost[at[seen]] = own[seen]


class Totals(NamedTuple):
    """Of the training documents: tokens, and the distinct words, pairs and triples, words seen once and twice, pairs followed by a word."""

    tokens: int
    types: int
    ones: int
    twos: int
    pairs: int
    triples: int

    @property
    def discount(self) -> float:
        """n1 / (n1 + 2 n2), kept within (0, 1)."""
        return min(max(self.ones / (self.ones + 2 * self.twos), 1e-3), 1 - 1e-6) if self.ones + self.twos else 0.5

    @property
    def pull_pairs(self) -> float:
        return max(self.pairs, 1) / max(self.types, 1)

    @property
    def pull_triples(self) -> float:
        return max(self.triples, 1) / max(self.pairs, 1)


def by_kind(rows: pa.Table) -> tuple[dict[int, dict[int, bytes]], dict[int, dict[str, int]]]:
    """What the shards told a block, by kind and shard, and their totals, by kind and column."""
    told: dict[int, dict[int, bytes]] = {WORDS: {}, PAIRS: {}, TRIPLES: {}}
    sums = {kind: dict.fromkeys(SUMS, 0) for kind in told}
    for r in rows.to_pylist():
        told[r["kind"]][r["shard"]] = r["data"]
        for c in SUMS:
            sums[r["kind"]][c] += r[c]
    return told, sums


def score_documents(docs: DataFrame, text: str = "text", id_col: str = "doc_id", held_out=None, block_bytes: int = 5_000_000, spread: int = SPREAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row; learns from rows not held out.

    Tokens are words with A-Z lower-cased, then one end. Null and empty texts have the end alone. held_out is a boolean
    column, null meaning held out; by default rows whose crc32(doc_id) mod 10 is 0, a null id's being held out. Repeated rows count as often
    as they stand there. Ids are cast to long; one that isn't a number is an error under ANSI rules. A text of any length is one block's at least, which a
    task holds with some forty bytes a token. Other columns aren't read, so their names may clash. Without training rows every word is unknown and has probability 1. An empty table gives an empty result.
    """
    spark = prepare(docs.sparkSession)
    if held_out is None:
        held_out = F.crc32(F.col(id_col).cast("string")) % 10 == 0
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(True)).alias("held_out"))
    size = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // (4 * block_bytes)))
    numbered = materialize(chosen.mapInArrow(lambda batches: released(as_blocks(batches, shards, block_bytes)), BLOCK), "blocks")

    def answer_words(key, rows):
        shard, asks = key[0].as_py(), sorted(zip(rows.column("block").to_pylist(), map(unpacked, rows.column("data").to_pylist()), strict=True), key=lambda x: x[0])
        totals, places = added_up(WORDS, [x for _, x in asks])
        number = np.argsort(np.argsort(-totals, kind="stable"), kind="stable") * shards + shard  # small numbers for words that are often used
        sums = [int(totals.sum()), *(int(x.sum()) for x in (totals > 0, totals == 1, totals == 2))]
        return table_of([(WORDS, shard, block, packed(number[p], totals[p]), *sums) for (block, _), p in zip(asks, places, strict=True)], ANSWER)

    def ask(key, left, right):
        if not left.num_rows:
            return table_of([], ASK)
        own = Block(left.to_pylist()[0], by_kind(right)[0][WORDS], spread)
        return table_of([(kind, s, key[0].as_py(), data) for kind in (PAIRS, TRIPLES) for s, data in own.asked(kind, shards)], ASK)

    def answer(key, rows):
        kind, shard = (x.as_py() for x in key)
        asks = sorted(zip(rows.column("block").to_pylist(), map(unpacked, rows.column("data").to_pylist()), strict=True), key=lambda x: x[0])
        totals, places = added_up(kind, [x for _, x in asks])
        sums = [int(totals.sum()), int((totals > 0).sum()), 0, 0]
        return table_of([(kind, shard, block, packed(totals[p]), *sums) for (block, _), p in zip(asks, places, strict=True)], ANSWER)

    words = numbered.select("block", F.explode("words").alias("x")).select(F.lit(WORDS).alias("kind"), "x.shard", "block", "x.data")
    words = words.groupBy("shard").applyInArrow(answer_words, ANSWER)
    texts = numbered.select("block", "docs", "held", "tokens")
    grams = texts.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(ask, ASK)
    grams = grams.groupBy("kind", "shard").applyInArrow(answer, ANSWER)

    def score(key, left, right):
        out = []
        if left.num_rows:
            told, sums = by_kind(right)
            total = Totals(*sums[WORDS].values(), sums[PAIRS]["types"], sums[TRIPLES]["types"])
            own = Block(left.to_pylist()[0], told[WORDS], spread)
            machine = Automaton(own, own.answered(PAIRS, shards, told[PAIRS]), own.answered(TRIPLES, shards, told[TRIPLES]), total)
            c = own.counts
            base = np.log10((c + 0.1) / (total.tokens + 0.1 * (total.types + 1)))[own.tokens]
            sums = [np.add.reduceat(x, own.first).tolist() for x in (base, (c > 0)[own.tokens].astype(np.int64))]
            out = [(doc, held, n, known, total.tokens, b, s) for doc, held, n, b, known, s in zip(own.docs, own.held, own.sizes.tolist(), *sums, machine.scores(own).tolist(), strict=True)]
        return table_of(out, RESULT)

    return texts.groupBy("block").cogroup(words.unionAll(grams).groupBy("block")).applyInArrow(score, RESULT)
