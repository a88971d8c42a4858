"""Byte-pair encoding by speculation: greedy longest matches, checked pair by pair; only words that fail are merged.

Merges happen in the order of their ranks, as every merge's parts are made by earlier ones. Between two neighbouring tokens a
merge can only join a node of the left one's right spine with a node of the right one's left spine, at the merge's rank, if
neither node has been taken up by its own parent before. Where no pair of spine nodes does so, the neighbours are compatible;
a tiling of a word whose neighbours are all compatible is the word's encoding, as no first crossing merge can exist. Tokens
that merging alone doesn't make (found by the same check on each merge's parts) are never proposed.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import fresh, prepare, released, texts, tokenizer_path
from .packing import RUNS

NEVER = np.int64(2**62)
WORD_END = "\n"  # stands for the vocabulary's own mark of a word's end; no byte is written so


def byte_signs() -> dict[int, str]:
    """The sign of every byte in byte-level vocabularies: itself where it prints in Latin-1, else the next one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(prints)]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Compatibility:
    """Whether two tokens can stand side by side, for arrays of pairs at a time."""

    def __init__(self, size: int, merges: list[tuple[int, int, int]]):
        """merges: (left, right, made) token ids in the order of ranks."""
        self.size = size
        left, right, made = (np.array(x, np.int64) for x in zip(*merges, strict=True)) if merges else (np.zeros(0, np.int64),) * 3
        keys = left * size + right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.sound = np.ones(size, bool)
        self.spines: list[list[tuple[np.ndarray, np.ndarray]]] = [self._grown([], np.full(size, -1)), self._grown([], np.full(size, -1))]
        self._derive(left, right, made)

    def _grown(self, spine: list, parts: np.ndarray, ranks: np.ndarray | None = None) -> list:
        """Levels of a spine for every token: the node there (-1: none) and the rank at which its parent takes it up."""
        levels = [(np.arange(self.size), np.full(self.size, NEVER))]
        while True:
            node, _ = levels[-1]
            alive = node >= 0
            below = np.where(alive, parts[node], -1)
            if not (below >= 0).any():
                return levels
            levels.append((below, np.where(below >= 0, ranks[node] if ranks is not None else NEVER, -1)))

    def _derive(self, left: np.ndarray, right: np.ndarray, made: np.ndarray) -> None:
        """Each token's last merge; tokens that aren't made by exactly the merges of their own parts are unsound."""
        n = np.arange(len(made))
        rank = np.full(self.size, -1, np.int64)
        parts = [np.full(self.size, -1, np.int64), np.full(self.size, -1, np.int64)]
        again = np.zeros(self.size, bool)
        again[made[np.bincount(made, minlength=self.size)[made] > 1]] = True  # two ways to make a token: left to merging
        rank[made] = n
        parts[0][made], parts[1][made] = left, right
        self.sound &= ~again
        self.sound[made[(rank[left] >= n) | (rank[right] >= n)]] = False
        for p in parts:
            p[again] = -1
        rank[again] = -1
        self.spines = [self._grown([], parts[1], rank), self._grown([], parts[0], rank)]
        crossed = self.crossing(left, right)
        self.sound[made[crossed != n]] = False
        for a, b, m in zip(left.tolist(), right.tolist(), made.tolist(), strict=True):  # in the order of ranks: parts before what they make
            if not (self.sound[a] and self.sound[b]):
                self.sound[m] = False

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the merge of a and b, NEVER where there is none."""
        key = a * self.size + b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.order[at], NEVER) if len(self.keys) else np.full(len(a), NEVER)

    def crossing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the first merge over the border between a and b, NEVER where they are compatible.

        Of equal ranks the merge on the left goes first: it takes up a's node before it can cross, b's node after.
        """
        first = np.full(len(a), NEVER)
        for nodes, taken in self.spines[0]:
            rows = np.flatnonzero(nodes[a] >= 0)
            for others, gone in self.spines[1]:
                rows = rows[others[b[rows]] >= 0]
                if not len(rows):
                    break
                x, y = a[rows], b[rows]
                rank = self.ranks(nodes[x], others[y])
                crosses = (rank < taken[x]) & (rank <= gone[y]) & (rank < NEVER)
                first[rows] = np.where(crosses, np.minimum(first[rows], rank), first[rows])
        return first


class SpeculativeEncoder(dict):
    """White-space-separated part of a text to its ids as little-endian uint32 bytes; keeps the parts seen lately."""

    def __init__(self, path: str, most: int = 200_000):
        import ahocorasick
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        self.most, self.tokenizer = most, Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        specials = {x["content"]: x["id"] for x in model["added_tokens"]}
        model = model["model"]
        self.suffix, ids = model["end_of_word_suffix"] or "", model["vocab"]
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.size = max([*ids.values(), *specials.values()]) + 1
        self.pairs = Compatibility(self.size, [(ids[a], ids[b], ids[a + b]) for a, b in pairs])
        self.lengths = np.zeros(self.size, np.int64)
        self.trie = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for piece, i in ids.items():
            if piece in specials or not self.pairs.sound[i]:
                continue
            key = piece[: -len(self.suffix)] + WORD_END if self.suffix and piece.endswith(self.suffix) and piece != self.suffix else piece
            self.lengths[i] = len(key)
            self.trie.add_word(key, i)
        self.trie.make_automaton()
        self.specials = {s: np.array([i], "<u4").tobytes() for s, i in specials.items()}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None
        self.signs = byte_signs()
        self.merged = 0  # words that failed their check

    def words(self, part: str) -> list[str]:
        """The pre-tokens of a part, in signs of bytes: by the tokenizer's own pattern where all its characters are Latin-1, else by the tokenizer."""
        try:
            part.encode("latin-1")
        except UnicodeEncodeError:
            return [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(part))]
        return [w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(self.signs) for w in RUNS.findall(part.lower())]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of pre-tokens: longest matches over all of them at once, every pair of neighbours checked, the rest merged."""
        hay = "".join([w + WORD_END for w in words])
        found = np.fromiter((x for match in self.trie.iter_long(hay) for x in match), np.int64).reshape(-1, 2)
        ends, ids = found[:, 0] + 1, found[:, 1]
        starts = ends - self.lengths[ids]
        word_ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        word = np.searchsorted(word_ends, starts, side="right")
        beside = word[1:] == word[:-1]
        bad = np.zeros(len(words), bool)
        bad[word[1:][starts[1:] != ends[:-1]]] = True  # matches that leave a gap
        bad[word[:-1][(starts[1:] != ends[:-1])]] = True
        last = np.searchsorted(word, np.arange(len(words)), side="right")  # one past each word's last match
        bad |= (last == 0) | (np.append(0, ends)[last] != word_ends)
        checked, where = np.unique(ids[:-1][beside] * self.size + ids[1:][beside], return_inverse=True)
        fails = self.pairs.crossing(checked // self.size, checked % self.size) < NEVER
        bad[word[1:][beside][fails[where]]] = True
        data, out, at = ids.astype("<u4").tobytes(), [], 0
        for i, end in enumerate(last.tolist()):
            out.append(self.merge(words[i]) if bad[i] else data[4 * at : 4 * end])
            at = end
        return out

    def merge(self, word: str) -> bytes:
        """A word's ids by exact merging."""
        self.merged += 1
        return np.array([t.id for t in self.tokenizer.model.tokenize(word)], "<u4").tobytes()

    def learn(self, parts: Iterable[str]) -> None:
        """Keeps the ids of parts that have none yet."""
        split = [(part, self.words(part)) for part in parts]
        distinct = list(dict.fromkeys(w for _, words in split for w in words))
        ids = dict(zip(distinct, self.encode_words(distinct), strict=True)) if distinct else {}
        for part, words in split:
            self[part] = b"".join(map(ids.__getitem__, words))

    def parts(self, text: str) -> list[str]:
        """Spaces and line ends part words whatever the normalizer does, and no character joins another over one."""
        return text.replace("\n", " ").split(" ")

    def of(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; special tokens in it are cut out first, as by default."""
        if len(self) > self.most:
            self.clear()
            self[""] = b""
        split: list[list[str]] = []
        for text in texts:
            pieces = self.special.split(text) if self.special else [text]
            split.append([x for i, piece in enumerate(pieces) for x in ([piece] if i % 2 else self.parts(piece))])
        for s, ids in self.specials.items():
            self[s] = ids
        self.learn([x for x in set().union(*split) if x not in self])
        found = [b"".join(map(self.__getitem__, x)) for x in split]
        for x in split:
            if len(x) < 3 and max(map(len, x)) > 256:  # a text without spaces isn't kept
                for part in x:
                    self.pop(part, None)
            self.setdefault("", b"")
        return found


_loaded: dict[str, SpeculativeEncoder] = {}
_pieces: dict[str, pa.Array] = {}


def encoder(name: str) -> SpeculativeEncoder:
    if name not in _loaded:
        _loaded[name] = SpeculativeEncoder(tokenizer_path(name))
    return _loaded[name]


def pieces(name: str) -> pa.Array:
    """The vocabulary's strings by id, null where an id has none."""
    if name not in _pieces:
        with open(tokenizer_path(name), encoding="utf-8") as f:
            model = json.load(f)
        if model["decoder"] is not None:
            raise ValueError("only vocabularies without a decoder, whose pieces are joined by spaces")
        strings = {i: p for p, i in model["model"]["vocab"].items()} | {x["id"]: x["content"] for x in model["added_tokens"]}
        _pieces[name] = pa.array([strings.get(i) for i in range(max(strings) + 1)], pa.large_string())
    return _pieces[name]


def encoded(table: SpeculativeEncoder, texts: list[str], most: int = 400_000) -> Iterable[bytes]:
    """The ids of each text, a bounded number of characters at a time beside a long text."""
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text)
        if size > most:
            yield from table.of(some)
            some, size = [], 0
    if some:
        yield from table.of(some)


def decoded(ids: np.ndarray, vocabulary: pa.Array) -> str:
    """The pieces of ids joined by spaces; ids beyond the vocabulary have none."""
    blocks = [vocabulary.take(pa.array(ids[at : at + (1 << 20)])).drop_null() for at in range(0, len(ids), 1 << 20)]
    return " ".join(x for x in (" ".join(b.to_pylist()) for b in blocks) if x)


def encode(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """Columns of keep, n_tokens and ids (binary: little-endian unsigned 32-bit integers) of every row's whole text; one narrow pass.

    Ids are the library's, with add_special_tokens=False, special strings in texts made special tokens as by default, no
    truncation, no padding. A null text counts as empty: no ids. Repeated rows give repeated rows. A very long text is
    encoded as a whole; a task holds some ten times its bytes. Other columns than keep and text aren't read, so their names may clash;
    keep may not name n_tokens or ids. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    (body,) = fresh(docs.select(*keep), "text")
    chosen = docs.select(*keep, docs[text].alias(body))
    schema = T.StructType([*chosen.schema.fields[:-1], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches):
        table = encoder(tokenizer)
        for batch in released(batches):
            ids = list(encoded(table, texts(batch.column(batch.num_columns - 1))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], names=schema.names)

    return chosen.mapInArrow(run, schema)


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """df with the text of its ids (binary, as encode gives them) in out, special tokens included; null or empty ids give the empty text."""
    prepare(df.sparkSession)
    if out.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"{out} is there already")
    at = df.columns.index(ids)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])

    def run(batches):
        vocabulary = pieces(tokenizer)
        for batch in released(batches):
            found = []
            column = pc.fill_null(batch.column(at), b"").to_pylist()
            size = np.fromiter((len(x) // 4 for x in column), np.int64, len(column))
            if size.sum() > 1 << 22:  # long texts one by one
                found = pa.array([decoded(np.frombuffer(x, "<u4"), vocabulary) for x in column], pa.string())
            else:
                strings = vocabulary.take(pa.array(np.frombuffer(b"".join(column), "<u4")))
                lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)])), strings)
                found = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=schema.names)

    return df.mapInArrow(run, schema)
