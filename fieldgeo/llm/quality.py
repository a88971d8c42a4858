"""Quality by perplexity under an interpolated modified Kneser-Ney model of byte n-grams, trained on trusted text.

Counts. All trusted documents are learned from, in two folds by a hash of their ids; each fold's n-grams are counted and summed by key
across tasks. Each order's counts are joined with its contexts' totals and with the next lower order's probabilities, shard by shard, up
to the full order. A document's score is the mean of both folds' log perplexities.
Scores. Documents are dealt to blocks of a few megabytes. A block asks the model's shards for the n-grams that stand in it;
all orders that an n-gram may back off through lie in the shard of the two bytes before its last, so that one join of the
blocks' n-grams with the model's shards gives each its cost. With the costs a block has every document's perplexity.
Recurrences. Junk that repeats a word or phrase has ordinary bytes. A second model of the same kind reads a text as words, each
written as the distance to its last occurrence if that is REACH words or less: bigrams over these marks, in which 'X X X' is all
but unseen whatever the word. Its perplexity has an upper limit alone; the model has some ninety rows.
Thresholds. Each language's quantiles of log perplexity over all trusted documents, widened by a share of their distance
from the median, give the range a document must lie in; repetition lies under it, noise above. For the upper ones each document
is scored by the fold that has not learned from it, as the other knows it too well; the lower ones take the mean, so that
trusted documents and their copies stay.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, fresh, gathered, hashable, materialize, prepare, released, texts, words_of

ORDER = 5
START, END = 2, 3
REACH, MARKS = 8, 2  # words back; marks in an n-gram
ALPHABET = 256
FOLDS = 2
COST, GAP = 1 << 17, 1 << 13  # steps to one, as costs and half the differences of the folds' costs are sent


def keys_of(data: bytes, n: int, order: int = ORDER) -> np.ndarray:
    """The n-grams that end at each byte of data and at its end mark, as n in the top byte and the bytes below."""
    x = np.frombuffer(bytes([START]) * (order - 1) + data + bytes([END]), np.uint8).astype(np.int64)
    size, key = len(data) + 1, np.zeros(len(data) + 1, np.int64)
    for i in range(n):
        key = (key << 8) | x[order - n + i : order - n + i + size]
    return key | (n << 56)


def marks_of(text: str) -> np.ndarray:
    """The bigrams of a text's recurrences, a key each word: 0 for a word not among the REACH before it, else how far back it stands."""
    words = words_of(text)
    number = {word: i for i, word in enumerate(words)}
    own = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    marks = np.full(len(words), ALPHABET // 2, np.uint8)
    for back in range(min(REACH, len(words) - 1), 0, -1):
        marks[back:][own[back:] == own[:-back]] = ALPHABET // 2 + back
    return keys_of(marks.tobytes(), MARKS, MARKS)[:-1]  # without the end, which would weigh by shortness


def sample_of(docs: DataFrame, labels: DataFrame, size: int, text: str, id_col: str, most_bytes: int = 32_000_000) -> DataFrame:
    """(id, text) of the trusted documents that the models learn from: half of them by a hash of their ids, size and most_bytes at most.

    Of rows that share an id one text is taken, so that repeated rows don't enlarge the sample. Where the texts are more than most_bytes, the
    longest ones are left out until the rest fits.
    """
    ids = labels.where("quality = 1").select(F.col("doc_id").alias("id")).distinct()
    ids = ids.where(F.xxhash64(F.lit(1), "id") % 2 == 0).withColumn("place", F.xxhash64("id")).orderBy("place", "id").limit(size)
    some = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(ids), "id")  # size ids
    some = some.groupBy("id", "place").agg(F.min("text").alias("text"))
    so_far = F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).over(Window.orderBy(F.octet_length("text").asc_nulls_first(), "place", "id").rowsBetween(Window.unboundedPreceding, 0))  # over size rows
    return some.withColumn("so_far", so_far).where(F.col("so_far") <= most_bytes).select("id", "text")


def fold_of(name: str) -> Column:
    """The fold that learns from a trusted document, by its id."""
    return F.pmod(F.xxhash64(F.lit(1), name), F.lit(FOLDS)).cast("int")


def ids_of(labels: DataFrame) -> DataFrame:
    """The trusted ids, in the shared folder: whole numbers as (word, bits), a bit for each of 64 neighbours, which is a small table even
    of very many ids; others as (word) alone."""
    ids = labels.where("quality = 1 and doc_id is not null")
    if labels.schema["doc_id"].dataType.typeName() not in ("byte", "short", "integer", "long"):
        return materialize(ids.select(F.col("doc_id").alias("word")).distinct(), "trusted-ids")
    place = F.col("doc_id").cast("long")
    bit = F.expr("shiftleft(1L, cast(cast(doc_id as bigint) & 63 as int))")
    return materialize(ids.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits")), "trusted-ids")


def trusted_rows(rows: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows whose id is among ids_of()'s."""
    if "bits" not in ids.columns:
        (word,) = fresh(rows, "word")
        ids = ids.withColumnRenamed("word", word)
        return rows.join(ids, rows[id_col] == ids[word], "left_semi")
    word, bits = fresh(rows, "word", "bits")
    ids = ids.select(F.col("word").alias(word), F.col("bits").alias(bits))
    place = rows[id_col].cast("long")
    found = rows.join(ids, F.shiftright(place, 6) == ids[word])
    return found.where(F.getbit(F.col(bits), place.bitwiseAND(F.lit(63)).cast("int")) == 1).drop(word, bits)


def trusted_of(scored: DataFrame, labels: DataFrame, sample: DataFrame, id_col: str) -> DataFrame:
    """The rows of all trusted documents, and whether the model learned from them (own)."""
    name, own = fresh(scored, "trusted_id", "own")
    ids = labels.where("quality = 1").select(F.col("doc_id").alias(name)).distinct()
    learned = sample.select(F.col("id").alias(name), F.lit(True).alias(own))  # as many as the sample has
    ids = ids.join(F.broadcast(learned), name, "left").withColumn(own, F.coalesce(own, F.lit(False)))
    return scored.join(ids, scored[id_col] == ids[name]).drop(name).withColumnRenamed(own, "own")


def count_ngrams(sample: DataFrame, text: str, order: int = ORDER) -> DataFrame:
    return _count(sample, text, lambda x: keys_of(x.encode("utf-8", "surrogatepass"), order, order))


def count_marks(sample: DataFrame, text: str) -> DataFrame:
    return _count(sample, text, marks_of)


def _count(sample: DataFrame, text: str, keys_in) -> DataFrame:
    """(fold, key, c) of the texts; without a column fold all are of fold 0."""

    def count(batches):
        for batch in gathered(released(batches), 4000, 4 << 20):
            fold, every = batch.column(0).to_numpy(), texts(batch.column(1))
            for f in range(FOLDS):
                keys = [keys_in(every[i]) for i in np.flatnonzero(fold == f)]
                if keys:
                    place, key = pd.factorize(np.concatenate(keys))
                    n = np.bincount(place, minlength=len(key)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), f, np.int32)), pa.array(key), pa.array(n)], names=["fold", "key", "c"])

    fold = F.col("fold") if "fold" in sample.columns else F.lit(0)
    return sample.select(fold.cast("int").alias("fold"), text).mapInArrow(count, "fold int, key long, c long").groupBy("fold", "key").agg(F.sum("c").alias("c"))


def kneser_ney(counts: DataFrame, order: int = ORDER) -> tuple[DataFrame, list[DataFrame]]:
    """Rows (fold, key, log_p, log_backoff): of every n-gram up to order, seen or seen as a context, from counts (fold, key, c) of the full order.

    Each order is written before the next one is joined with it, which keeps plans short; the second value are those tables.
    """
    levels, written = {order: counts}, []
    low = lambda n: F.col("key").bitwiseAND(F.lit((1 << (8 * n)) - 1))
    for n in range(order - 1, 0, -1):  # continuation counts: distinct bytes to the left
        levels[n] = materialize(levels[n + 1].groupBy("fold", low(n).bitwiseOR(F.lit(n << 56)).alias("key")).agg(F.count("*").alias("c")), "level")
        written.append(levels[n])
    ranks = F.array(*[F.sum((F.col("c") == i).cast("long")) for i in (1, 2, 3, 4)])
    of_counts = {n: {r[0]: r[1] for r in levels[n].groupBy("fold").agg(ranks).collect()} for n in levels}  # four numbers an order and fold
    out, below, backoffs = [], None, []
    for n in range(1, order + 1):
        c, cut = F.col("c"), F.lit(None).cast("double")
        for fold, (n1, n2, n3, n4) in of_counts[n].items():
            y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
            d = [min(max(v, 0.05), top - 0.05) for v, top in ((1 - 2 * y * n2 / max(n1, 1), 1), (2 - 3 * y * n3 / max(n2, 1), 2), (3 - 4 * y * n4 / max(n3, 1), 3))]
            cut = F.when(F.col("fold") == fold, F.when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])).otherwise(cut)
        prefix = F.shiftright(low(n), 8).bitwiseOR(F.lit((n - 1) << 56)).alias("prefix")
        grams = levels[n].select("fold", "key", "c", prefix, low(n - 1).bitwiseOR(F.lit((n - 1) << 56)).alias("suffix") if n > 1 else F.lit(0).cast("long").alias("suffix"))
        contexts = grams.groupBy("fold", "prefix").agg(F.sum("c").alias("total"), (F.sum(cut) / F.sum("c")).alias("gamma"))
        grams = grams.join(contexts, ["fold", "prefix"])
        if below is None:
            grams = grams.withColumn("lower", F.lit(1.0 / ALPHABET))
        else:
            grams = grams.join(below.select("fold", F.col("key").alias("suffix"), F.col("p").alias("lower")), ["fold", "suffix"])
        grams = materialize(grams.select("fold", "key", ((c - cut) / F.col("total") + F.col("gamma") * F.col("lower")).alias("p")), "probabilities")
        written.append(grams)
        below = grams
        out.append(grams)
        backoffs.append(contexts.select("fold", F.col("prefix").alias("key"), F.log("gamma").alias("log_backoff")))
    p, backoff = out[0], backoffs[0]
    for x, b in zip(out[1:], backoffs[1:], strict=True):
        p, backoff = p.unionAll(x), backoff.unionAll(b)
    return p.select("fold", "key", F.log("p").alias("log_p")).join(backoff, ["fold", "key"], "full"), written


class Model:
    """The model's rows as sorted arrays: for each order, n-grams with a probability and contexts with a backoff weight."""

    def __init__(self, key: np.ndarray, log_p: np.ndarray, log_backoff: np.ndarray, order: int = ORDER):
        self.order = order

        def level(n: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            own = np.flatnonzero((key >> 56 == n) & ~np.isnan(values))
            own = own[np.argsort(key[own])]
            return key[own], values[own]

        self.grams = [level(n, log_p) for n in range(order + 1)]
        self.contexts = [level(n, log_backoff) for n in range(order + 1)]

    @staticmethod
    def find(level: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the keys that the level has, and which those are."""
        known, values = level
        if not len(known):
            return np.zeros(0), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        found = known[at] == keys
        return values[at[found]], found

    def costs(self, full: np.ndarray) -> np.ndarray:
        """Negative log probability of the last byte of each n-gram of the full order, given the others."""
        out, at = np.zeros(len(full)), np.arange(len(full))
        for n in range(self.order, 0, -1):
            p, found = self.find(self.grams[n], (full[at] & ((1 << (8 * n)) - 1)) | (n << 56))
            out[at[found]] -= p
            at = at[~found]
            if not len(at):
                return out
            backoff, known = self.find(self.contexts[n - 1], ((full[at] >> 8) & ((1 << (8 * (n - 1))) - 1)) | ((n - 1) << 56))
            out[at[known]] -= backoff
        out[at] += np.log(ALPHABET)
        return out


def models_of(rows: pa.Table, order: int = ORDER, folds: int = FOLDS) -> list[Model]:
    """A model for each fold of rows (fold, key, log_p, log_backoff)."""
    fold = rows.column("fold").to_numpy()
    columns = [rows.column(c).to_numpy() for c in ("key", "log_p", "log_backoff")]
    return [Model(*[x[fold == f] for x in columns], order) for f in range(folds)]


def mean_and_gap(costs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The folds' mean, and half of what the first one has more than the last one."""
    return sum(costs) / len(costs), (costs[0] - costs[-1]) / 2


def packed(values: np.ndarray, steps: int) -> bytes:
    """Values in whole steps, byte by byte of all of them, which compresses better than the numbers one by one."""
    return np.ascontiguousarray(np.rint(values * steps).astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unpacked(data: bytes, steps: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<i4").ravel() / steps


def fit(sample: DataFrame) -> DataFrame:
    """The byte model's rows, in the shared folder."""
    return _fitted(count_ngrams(sample, "text"), ORDER)


def fit_marks(sample: DataFrame) -> DataFrame:
    return _fitted(count_marks(sample, "text"), MARKS)


def _fitted(counts: DataFrame, order: int) -> DataFrame:
    counts = materialize(counts, "ngrams")
    rows, written = kneser_ney(counts, order)
    model = materialize(rows, "model")
    discard(counts, *written)
    return model


def shard_of(pair, shards: int):
    """The shard of two bytes (a number, a NumPy array or a Column of them)."""
    return (pair * 40503) % 65521 % shards


def sharded(model: DataFrame, shards: int, waves: int) -> DataFrame:
    """The model's rows once for each wave of blocks, by the two bytes before an n-gram's last; those without two go to all shards."""
    n, key = F.shiftright("key", 56), F.col("key")
    gram = model.where("log_p is not null").select("fold", "key", "log_p", F.lit(None).cast("double").alias("log_backoff"), F.when(n > 2, F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF))).alias("pair"))
    context = model.where("log_backoff is not null").select("fold", "key", F.lit(None).cast("double").alias("log_p"), "log_backoff", F.when(n > 1, key.bitwiseAND(F.lit(0xFFFF))).alias("pair"))
    numbers = lambda k: F.sequence(F.lit(0), F.lit(k - 1))
    to = F.when(F.col("pair").isNull(), numbers(shards)).otherwise(F.array(shard_of(F.col("pair"), shards).cast("int")))
    return gram.unionAll(context).withColumn("shard", F.explode(to)).withColumn("wave", F.explode(numbers(waves))).drop("pair")


def perplexity(docs: DataFrame, model: DataFrame, marks: DataFrame, text: str = "text", keep: list[str] | None = None, block_bytes: int = 8_000_000, wave_blocks: int | None = None, shard_rows: int = 100_000, folds: int = 1) -> DataFrame:
    """Columns of keep (all, if not given) and last log_perplexity and log_recurrence of every row of docs.

    log_perplexity is null where the text is null or empty, log_recurrence also where it has no words. Own columns of those
    names are replaced. A group holds a block of texts, or a shard of the model with the n-grams of at most wave_blocks blocks: 64, or ten
    for each shard, so that the model's copies for all waves grow no faster than the texts. With two folds the values are their means,
    and further columns of these names and _gap hold half of what the first fold gives more than the second.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.drop("log_perplexity", "log_recurrence")
    gaps = [f"{c}_gap" for c in ("log_perplexity", "log_recurrence")] if folds > 1 else []
    kept = docs.columns if keep is None else keep
    (block,) = fresh(docs, "block")
    sent = kept if text in kept else [text, *kept]
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    shards = max(1, -(-model.count() // shard_rows))
    wave_blocks = wave_blocks or max(64, 10 * shards)
    waves = -(-blocks // wave_blocks)
    dealt = docs.select(F.pmod(F.xxhash64(*hashable(docs)), F.lit(blocks)).cast("int").alias(block), *sent).groupBy(block)
    few = marks.toArrow()  # (REACH + 1) * (REACH + 2) bigrams a fold at most

    def in_parts(table, most=500_000):
        """Each text's n-grams in order, some texts' at once: (an array of them all, how many each has)."""
        some, n = [], 0
        for x in table.column(text):
            some.append(keys_of(x.as_py().encode("utf-8", "surrogatepass"), ORDER) if x.is_valid and x.as_py() else np.zeros(0, np.int64))
            n += len(some[-1])
            if n > most:
                yield np.concatenate(some), [len(x) for x in some]
                some, n = [], 0
        if some:
            yield np.concatenate(some), [len(x) for x in some]

    def known(table):
        """The distinct n-grams of a block, in order."""
        return np.unique(np.concatenate([np.zeros(0, np.int64), *(pd.unique(keys) for keys, _ in in_parts(table))]))

    def by_shard(keys):
        own = shard_of((keys >> 8) & 0xFFFF, shards)
        return [(s, np.flatnonzero(own == s)) for s in range(shards)]

    def ask(key, table):
        keys, rows = known(table), []
        for s, at in by_shard(keys):
            if len(at):
                rows.append((s, key[0].as_py() // wave_blocks, key[0].as_py(), zlib.compress(np.diff(keys[at], prepend=0).astype("<i8").tobytes(), 1)))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("shard", "wave", "block", "data"), columns, (pa.int32(), pa.int32(), pa.int32(), pa.binary()), strict=True)})

    def answer(key, asked, rows):
        own, out = None, []
        for number, data in zip(asked.column("block").to_pylist(), asked.column("data").to_pylist(), strict=True):
            own = own or models_of(rows, folds=folds)
            keys = np.cumsum(np.frombuffer(zlib.decompress(data), "<i8"))
            cost, gap = mean_and_gap([model.costs(keys) for model in own])
            out.append((key[0].as_py(), number, zlib.compress(packed(cost, COST) + (packed(gap, GAP) if gaps else b""), 1)))
        columns = list(zip(*out, strict=True)) or [()] * 3
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("shard", "block", "data"), columns, (pa.int32(), pa.int32(), pa.binary()), strict=True)})

    schema = T.StructType([*[docs.schema[c] for c in kept], *[T.StructField(c, T.DoubleType()) for c in ("log_perplexity", "log_recurrence", *gaps)]])

    def means(values, sizes):
        at = np.cumsum([0, *sizes])
        return [float(values[i:j].mean()) if i < j else None for i, j in zip(at[:-1], at[1:], strict=True)]

    def score(key, table, told):
        keys, data = known(table), dict(zip(told.column("shard").to_pylist(), told.column("data").to_pylist(), strict=True))
        costs, place = [np.zeros(len(keys)) for _ in range(1 + len(gaps) // 2)], pd.Index(keys)
        for s, at in by_shard(keys):
            if len(at):
                found = zlib.decompress(data[s])
                for i, (cost, steps) in enumerate(zip(costs, (COST, GAP), strict=False)):
                    cost[at] = unpacked(found[4 * len(at) * i : 4 * len(at) * (i + 1)], steps)
        by_bytes, by_marks = [[] for _ in costs], [[] for _ in costs]
        for found, sizes in in_parts(table):
            at = place.get_indexer(found)
            for values, cost in zip(by_bytes, costs, strict=True):
                values += means(cost[at], sizes)
        by_pair = mean_and_gap([model.costs(np.arange(1 << 16) | (MARKS << 56)) for model in models_of(few, MARKS, folds)])
        for x in table.column(text):
            seen = marks_of(x.as_py() or "") & 0xFFFF
            for values, cost in zip(by_marks, by_pair, strict=False):
                values += means(cost[seen], [len(seen)])
        found = [by_bytes[0], by_marks[0], *([by_bytes[1], by_marks[1]] if gaps else [])]
        return pa.table([*[table.column(c) for c in kept], *[pa.array(x, pa.float64()) for x in found]], names=schema.names)

    asked = dealt.applyInArrow(ask, "shard int, wave int, block int, data binary")
    told = asked.groupBy("shard", "wave").cogroup(sharded(model, shards, waves).groupBy("shard", "wave")).applyInArrow(answer, "shard int, block int, data binary")
    return dealt.cogroup(told.groupBy("block")).applyInArrow(score, schema)


def thresholds(scored: DataFrame, lang: str = "lang", low: float = 0.001, high: float = 0.995, slack: float = 0.5, least: int = 50, of: str = "log_perplexity") -> dict[str | None, tuple[float, float]]:
    """Lowest and highest value of a score to keep, by language and (None) over all; languages with few trusted texts take the latter.

    Quantiles are exact in rank to 1 / 100,000 of a language's texts, in bounded memory.
    """
    q = lambda x: F.percentile_approx(of, x, 100_000)
    rows = scored.where(F.col(of).isNotNull()).rollup(lang).agg(q(low).alias("a"), q(0.5).alias("m"), q(high).alias("z"), F.count("*").alias("n"), F.grouping(lang).alias("all")).collect()  # a row a language
    wide = {(None if r["all"] else r[lang]): (r["a"] - slack * (r["m"] - r["a"]), r["z"] + slack * (r["z"] - r["m"])) for r in rows if r["n"] and (r["all"] or r[lang] is not None and r["n"] >= least)}
    return wide


def limits_of(trusted: DataFrame, lang: str, of: str, **quantiles) -> dict[str | None, tuple[float, float]]:
    """thresholds() of rows (lang, of, own, and unseen: the value by a model that has not learned from the row): the lower ones over all of
    them, the upper ones of the unseen values where own is false, if there are such rows."""
    every, others = thresholds(trusted, lang, of=of, **quantiles), thresholds(trusted.where("not own").withColumn(of, F.col(f"unseen.{of}")), lang, of=of, **quantiles)
    high = {name: (others.get(name) or others.get(None) or pair)[1] for name, pair in every.items()}
    return {name: (pair[0], high[name]) for name, pair in every.items()}


def _by_language(limits: dict[str | None, tuple[float, float]], lang: str, inside, without: Column) -> Column:
    """Whether a row's score lies inside its language's limits, else those over all; without where there are none."""
    keep = inside(limits[None]) if None in limits else without
    for name, pair in limits.items():
        if name is not None:
            keep = F.when(F.col(lang) == name, inside(pair)).otherwise(keep)
    return keep


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", lang: str = "lang", size: int | None = None, columns: list[str] | None = None, **quantiles) -> DataFrame:
    """docs (or its columns given, which must hold id_col and lang) with log_perplexity, log_recurrence and keep (boolean) after the others.

    labels (doc_id, quality) names the trusted documents: quality 1. The models learn from all of their rows, and so do the limits; where size is
    given, one model learns from at most so many of half of them, and the upper limits from the others. A null or empty text is not
    kept; a null or rare language takes the limits over all languages; without any trusted text all non-empty rows are kept.
    Repeated rows are treated alike; columns of those names are replaced; an empty table gives an empty result.
    """
    docs = docs.drop("log_perplexity", "log_recurrence", "keep")
    (key,) = fresh(docs, "row_key")
    keyed = docs.withColumn(key, F.xxhash64(*hashable(docs)))
    kept, values = columns or [key, id_col, lang], ("log_perplexity", "log_recurrence")
    if size is None:
        ids = ids_of(labels)
        sample = trusted_rows(docs.select(id_col, text), ids, id_col).select(fold_of(id_col).alias("fold"), F.col(text).alias("text"))  # read twice, never written
        model, marks = fit(sample), fit_marks(sample)
        scored = materialize(perplexity(keyed, model, marks, text, kept, folds=FOLDS), "scored")  # without texts, as this table stays
        unseen = [F.when(fold_of(id_col) == 0, F.col(c) - F.col(f"{c}_gap")).otherwise(F.col(c) + F.col(f"{c}_gap")).alias(c) for c in values]
        trusted = trusted_rows(scored, ids, id_col).select(F.col(lang), *values, F.struct(*unseen).alias("unseen"), F.lit(False).alias("own"))
        used = [ids]
    else:
        sample = materialize(sample_of(docs, labels, size, text, id_col), "trusted")
        model, marks = fit(sample), fit_marks(sample)
        scored = materialize(perplexity(keyed, model, marks, text, kept), "scored")
        trusted = trusted_of(scored, labels, sample, id_col).select(F.col(lang), *values, F.struct(*values).alias("unseen"), "own")
        used = [sample]
    limits = limits_of(trusted, lang, "log_perplexity", **quantiles)
    keep = _by_language(limits, lang, lambda pair: F.col("log_perplexity").between(*pair), F.col("log_perplexity").isNotNull())
    limits = limits_of(trusted, lang, "log_recurrence", **quantiles)
    keep &= F.coalesce(_by_language(limits, lang, lambda pair: F.col("log_recurrence") <= pair[1], F.lit(True)), F.lit(True))
    discard(model, marks, *used)
    judged = scored.select(*kept, *values, F.coalesce(keep, F.lit(False)).alias("keep"))
    if columns:
        return judged
    judged = judged.select(key, "log_perplexity", "log_recurrence", "keep").dropDuplicates([key])  # equal rows score alike
    return keyed.join(judged, key).drop(key)
