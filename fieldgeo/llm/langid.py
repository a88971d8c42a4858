"""Language by segmentation-marginalised unigrams over the pieces of a fixed public vocabulary.

A word's probability in a language is the sum, over all ways to cut it into pieces of the vocabulary, of the product of the
pieces' probabilities there; a forward pass over the word's places computes it without listing the ways. Pieces never
cross spaces, so a text's log probability is the sum over its words. The probabilities come from a few rounds of
expectation-maximisation over a bounded sample of different labelled texts, whose word counts are spread over tasks; every
document is then scored in one narrow pass. Long words are rescaled as the pass goes, so that none is cut.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, fresh, gathered, materialize, prepare, released, texts, tokenizer_path

MARK = "▁"
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
RESCALED = 24  # characters after which a pass is rescaled; a product of that many piece probabilities stays in double's range


def words_in(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Pieces:
    """The vocabulary's pieces, found by a rolling hash of their characters in direct tables, each for what clashes in those before."""

    BASE, BITS = np.uint64(0x100000001B3), 20

    def __init__(self, name: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name))
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.pieces = sorted({p.lower() for p in pieces if p.lower().strip(MARK)} | {MARK})
        self.longest = max(map(len, self.pieces))
        self.hash = np.zeros(len(self.pieces), np.uint64)
        for i, p in enumerate(self.pieces):
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for c in p:
                    h = h * self.BASE + np.uint64(ord(c) + 1)
            self.hash[i] = h
        if len(np.unique(self.hash)) < len(self.hash):
            raise ValueError("two pieces of the vocabulary have one hash")
        self.tables, left = [], np.arange(len(self.pieces))
        while len(left):
            table = np.full(1 << self.BITS, -1, np.int32)
            slot = self.slot(self.hash[left], len(self.tables))
            table[slot] = left
            left = left[table[slot] != left]
            self.tables.append(table)

    def slot(self, h: np.ndarray, table: int) -> np.ndarray:
        return (((h ^ np.uint64(table)) * np.uint64(0x9E3779B97F4A7C15 + 2 * table)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of the piece with each hash; len(pieces) for none."""
        out = np.full(h.shape, len(self.pieces))
        for i, table in enumerate(self.tables):
            at = table[self.slot(h, i)]
            out = np.where((at >= 0) & (self.hash[at] == h), at, out)
        return out

    def spans(self, words: list[str]) -> list[np.ndarray]:
        """For words of one length n: for each piece length l, the piece at every place (words x (n - l + 1))."""
        codes = np.array([[ord(c) for c in w] for w in words], np.uint64) + np.uint64(1)
        n, out = codes.shape[1], []
        h = np.zeros(codes.shape, np.uint64)
        for size in range(1, min(self.longest, n) + 1):
            h = h[:, : n - size + 1] * self.BASE + codes[:, size - 1 :]
            out.append(self.find(h))
        return out

    def by_length(self, words: list[str], most: int = 200_000):
        """Places of words of one length, as many at a time as have about that many characters."""
        lengths = np.array([len(w) for w in words])
        for n in np.unique(lengths):
            own = np.flatnonzero(lengths == n)
            step = max(1, most // int(n))
            for at in range(0, len(own), step):
                yield own[at : at + step]

    def log_probabilities(self, words: list[str], p: np.ndarray) -> np.ndarray:
        """ln of each word's probability in each language (words x languages). p: (pieces + 1) x languages; the last row is
        0, and a character in no piece has the probability UNKNOWN."""
        out = np.zeros((len(words), p.shape[1]))
        for own in self.by_length(words):
            alpha, scale = self.forward([words[i] for i in own], p)[:2]
            out[own] = np.log(alpha[-1]) + scale[-1]
        return out

    def forward(self, words: list[str], p: np.ndarray, spans: list[np.ndarray] | None = None) -> tuple[list[np.ndarray], list, list[np.ndarray]]:
        """For words of one length: at each place the summed probability of all ways to get there (words x languages), the
        logarithm of what it is to be multiplied by, and the pieces at all places."""
        spans = self.spans(words) if spans is None else spans
        n = len(words[0])
        alpha, scale, own = [np.ones((len(words), p.shape[1]))], [0.0], 0.0
        window = [alpha[0]]  # the last places' sums, all by the present scale
        for i in range(1, n + 1):
            total = np.zeros_like(alpha[0])
            for size in range(1, min(i, len(spans)) + 1):
                piece = spans[size - 1][:, i - size]
                known = np.flatnonzero(piece < len(self.pieces))
                if size == 1:
                    q = p[piece]
                    q[piece == len(self.pieces)] = UNKNOWN
                    total += window[-1] * q
                elif len(known):
                    total[known] += window[-size][known] * p[piece[known]]
            window = [*window[-len(spans) :], total]
            if i % RESCALED == 0 and i < n:
                window = [x / total for x in window]
                own, total = own + np.log(total), window[-1]
            alpha.append(total)
            scale.append(own)
        return alpha, scale, spans

    def expected(self, words: list[str], counts: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in words of one language that stand there counts times; p has one column."""
        out = np.zeros(len(self.pieces) + 1)
        for own in self.by_length(words):
            some = [words[i] for i in own]
            alpha, up, spans = self.forward(some, p)
            n = len(some[0])
            q = [np.where(x == len(self.pieces), UNKNOWN if size == 0 else 0.0, p[x, 0]) for size, x in enumerate(spans)]
            beta, scale = np.ones(len(some)), np.zeros(len(some))
            window = [beta]  # the sums from the next places on to the word's end, all by the present scale
            whole = np.log(alpha[n][:, 0]) + (up[n] if n < RESCALED + 1 else up[n][:, 0])
            for i in range(n - 1, -1, -1):
                beta = np.zeros(len(some))
                by = counts[own] * np.exp((up[i] if isinstance(up[i], float) else up[i][:, 0]) + scale - whole)
                for size in range(1, min(n - i, len(spans)) + 1):
                    piece = spans[size - 1][:, i]
                    part = q[size - 1][:, i] * window[-size]
                    beta += part
                    out += np.bincount(piece, by * alpha[i][:, 0] * part, len(out))
                window = [*window[-len(spans) :], beta]
                if (n - i) % RESCALED == 0:
                    window = [x / beta for x in window]
                    scale = scale + np.log(beta)
        return out[:-1]


UNKNOWN = 1e-7
WORDS_AT_ONCE = 50_000  # words learned from at a time: a pass over the places of one word costs nearly what it costs for hundreds
DOCUMENTS_AT_ONCE = 2_000
_pieces: dict[str, Pieces] = {}


def pieces_of(name: str) -> Pieces:
    if name not in _pieces:
        _pieces[name] = Pieces(name)
    return _pieces[name]


def learn(labelled: DataFrame, vocabulary: str, text: str = "text", lang: str = "lang", docs_each: int = 1500, rounds: int = 3, smoothing: float = 0.02) -> tuple[list[str], np.ndarray]:
    """(languages in order, piece probabilities) from about docs_each different texts a language, those of the lowest hashes."""
    spark = prepare(labelled.sparkSession)
    usable = labelled.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.pmod(F.xxhash64(text), F.lit(1 << 40)).alias("place"))
    # copies count once: a language's share of the hash range is set by its different texts, and no task ranks a language
    n_each = {r["lang"]: r["count"] for r in usable.select("lang", "place").distinct().groupBy("lang").count().collect()}  # a row a language
    if not n_each:
        return [], np.zeros((1, 0))
    share = F.lit(0.0)
    for name, n in n_each.items():
        share = F.when(F.col("lang") == name, min(1.0, docs_each / n)).otherwise(share)
    few = usable.where(F.col("place") < share * (1 << 40)).groupBy("lang", "place").agg(F.min("text").alias("text"))

    def count(batches):
        for batch in released(batches):
            tallies: dict[str, Counter] = {}
            for name, x in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                tallies.setdefault(name, Counter()).update(MARK + w for w in words_in(x))
            rows = [(name, w, n) for name, tally in tallies.items() for w, n in tally.items()]
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)], names=["lang", "word", "n"])

    tally = few.select("lang", "text").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    tasks = spark.sparkContext.defaultParallelism  # a number given, as these few bytes, dear to work on, would else be one task's
    tally = materialize(tally.repartition(tasks, "word"), "words")
    languages = sorted(n_each)
    own = pieces_of(vocabulary)
    p = np.full((len(own.pieces) + 1, len(languages)), 1.0 / len(own.pieces))
    for _ in range(rounds):
        p[-1] = 0
        sent = spark.sparkContext.broadcast(p)

        def expect(batches, sent=sent):
            found = pieces_of(vocabulary)
            totals = np.zeros((len(found.pieces), len(languages)))
            for batch in gathered(released(batches), WORDS_AT_ONCE):
                names, words, n = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_numpy()
                for i, name in enumerate(languages):
                    at = [j for j, x in enumerate(names) if x == name]
                    if at:
                        totals[:, i] += found.expected([words[j] for j in at], n[at], sent.value[:, [i]])
            piece, i = np.nonzero(totals)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(i), pa.array(totals[piece, i])], names=["piece", "language", "uses"])

        uses = tally.mapInArrow(expect, "piece long, language long, uses double").groupBy("piece", "language").agg(F.sum("uses").alias("uses")).toPandas()  # at most pieces x languages rows
        new = np.full((len(own.pieces), len(languages)), smoothing)
        new[uses["piece"], uses["language"]] += uses["uses"]
        p = np.vstack([new / new.sum(0), np.zeros(len(languages))])
        sent.unpersist()
    discard(tally)
    return languages, p


def identify(docs: DataFrame, labelled: DataFrame, text: str = "text", lang: str = "lang", vocabulary: str = "piece_bpe_32k.model", keep: tuple[str, ...] = ("doc_id",), most_words: int = 50_000, **options) -> DataFrame:
    """Columns of keep, lang_pred and score (the posterior of lang_pred, 0 to 1) of every row of docs.

    Only text is read to predict. Texts that are null or hold no letter get `und` with score 0; ties go to the first
    language by name; repeated rows are treated alike. Without labelled texts all are `und`. Texts of any length are read whole: a task holds the
    counts of a block's words, and a word of any length is summed over with rescaling. Other columns than keep and text aren't read, so
    their names may clash; an empty table gives an empty result.
    """
    spark = prepare(docs.sparkSession)
    languages, p = learn(labelled, vocabulary, text, lang, **options)
    sent = spark.sparkContext.broadcast(p)  # pieces x languages
    (body,) = fresh(docs.select(*keep), "text")
    chosen = docs.select(*keep, docs[text].alias(body))
    schema = T.StructType([*chosen.schema.fields[:-1], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def predict(batches):
        found = pieces_of(vocabulary)
        numbers: dict[str, int] = {}
        values = np.zeros((0, len(languages)))  # of the words met lately
        for batch in gathered(released(batches), DOCUMENTS_AT_ONCE, 4 << 20):
            documents = [Counter(words_in(x)) for x in texts(batch.column(batch.num_columns - 1))]
            if len(numbers) > most_words:
                numbers, values = {}, values[:0]
            new = list(dict.fromkeys(w for tally in documents for w in tally if w not in numbers))
            if new and languages:
                numbers.update(zip(new, range(len(numbers), len(numbers) + len(new)), strict=True))
                values = np.concatenate([values, found.log_probabilities([MARK + w for w in new], sent.value)])
            names, scores = [], []
            for tally in documents:
                if not languages or not any(map(str.isalpha, chain.from_iterable(tally))):
                    names.append("und")
                    scores.append(0.0)
                    continue
                at = np.fromiter((numbers[w] for w in tally), np.int64, len(tally))
                total = np.fromiter(tally.values(), np.float64, len(tally)) @ values[at]
                best = int(total.argmax())
                names.append(languages[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(names), pa.array(scores, pa.float64())], names=schema.names)

    return chosen.mapInArrow(predict, schema)
