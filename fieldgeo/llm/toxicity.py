"""Toxicity by a weighted finite-state grammar over clauses.

A cascade of small weighted transducers reads a clause's tags: the first writes offences as targeted where someone is
spoken to or of, before or after them, and drops threats without a target; the next writes what a negation covers as
negated, the last what a report covers as reported. Each arc carries a weight; their composition is one table over product
states whose arcs carry the products, and a clause's score is the sum over its run of arc weight times lexical weight. Only clauses that hold
an insult or threat are run. A document's clause scores make features that a logistic model, fitted on a bounded sample of
labelled rows, turns into a probability. The insult lexicon is learned from labels: words that stand after many different
words in toxic texts and hardly in others, so that copies of one text don't vote many times; the features that the logistic model is fitted
on come from lexicons learned without the document's own part of the sample.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, fresh, materialize, prepare, released, texts

#: Fixed word lists of the grammar, in four languages.
THREATS = "kill hurt destroy beat burn die töten schlagen vernichten sterben tuer frapper détruire mourir matar golpear destruir morir".split()
TARGETS = "you your he she they them him her du dich dein ihr euch sie tu toi vous ton ils elles tú usted ustedes ellos ellas".split()
NEGATIONS = "not no never neither nor nicht kein keine nie pas jamais aucun nunca jamás ni tampoco".split()
REPORTS = "said says say told called wrote sagte sagt schrieb nannte dit disait appelé écrit dijo dice llamó escribió".split()

TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;:\n]")
STOPS = frozenset(".!?;:\n")
SCOPE = 3  # words that a negation covers, and within which a target may follow an offence
FEATURES = ("insult", "targeted", "negated", "reported", "threat", "strongest", "clauses", "share")
TAGS = ("word", "insult", "threat", "target", "negation", "report")
OFFENCES = ("insult", "threat", "targeted")
PARTS = 4  # of the sample, each left out of one lexicon


class Transducer:
    """States 0..n-1 with arcs (state, tag) -> (state, tag written, weight); a missing arc keeps state and tag, at weight 1."""

    def __init__(self, states: int, arcs: dict[tuple[int, str], tuple[int, str, float]]):
        self.states, self.arcs = states, arcs

    def step(self, state: int, tag: str) -> tuple[int, str, float]:
        return self.arcs.get((state, tag), (state, tag, 1.0))


def targets() -> Transducer:
    """State 1: a target was named. States from 2 on: so many words since an offence without one, which a target may still turn."""
    arcs = {(0, "insult"): (2, "insult", 1.0), (0, "threat"): (0, "word", 0.0), (0, "target"): (1, "target", 1.0)}
    arcs |= {(1, "insult"): (1, "targeted", 1.5), (1, "threat"): (1, "threat", 1.5)}
    for left in range(2, 2 + SCOPE):
        after = left + 1 if left < 1 + SCOPE else 0
        arcs |= {(left, "insult"): (2, "insult", 1.0), (left, "threat"): (after, "word", 0.0), (left, "target"): (1, "targeted", 0.5)}
        arcs |= {(left, tag): (after, tag, 1.0) for tag in ("word", "negation", "report")}
    return Transducer(2 + SCOPE, arcs)


def negation() -> Transducer:
    """State: how many words the last negation still covers."""
    arcs = {}
    for left in range(SCOPE + 1):
        arcs |= {(left, tag): (max(left - 1, 0), tag, 1.0) for tag in ("word", "target", "report")}
        arcs |= {(left, tag): (max(left - 1, 0), "negated" if left else tag, 0.5 if left else 1.0) for tag in OFFENCES}
        arcs[left, "negation"] = (SCOPE, "negation", 1.0)
    return Transducer(SCOPE + 1, arcs)


def reported() -> Transducer:
    return Transducer(2, {(0, "report"): (1, "report", 1.0)} | {(1, tag): (1, "reported", 0.5) for tag in OFFENCES})


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The second reads what the first writes; weights multiply. State p of the first and q of the second is p * states of the second + q."""
    arcs = {}
    for state in range(first.states * second.states):
        p, q = divmod(state, second.states)
        for tag in TAGS:
            p_next, between, v = first.step(p, tag)
            q_next, out, w = second.step(q, between)
            arcs[state, tag] = (p_next * second.states + q_next, out, v * w)
    return Transducer(first.states * second.states, arcs)


class Grammar:
    def __init__(self, insults: dict[str, float]):
        self.insults = insults
        self.known = dict.fromkeys(REPORTS, "report") | dict.fromkeys(NEGATIONS, "negation") | dict.fromkeys(TARGETS, "target") | dict.fromkeys(THREATS, "threat") | dict.fromkeys(insults, "insult")
        self.offences = frozenset(w for w, t in self.known.items() if t in ("insult", "threat"))
        self.arcs = compose(compose(targets(), negation()), reported()).arcs

    def tag(self, word: str) -> str:
        """A word's tag; of a contraction that of its negation, or of its first part that has one."""
        found = self.known.get(word)
        if found is None and ("'" in word or "’" in word):
            if word.endswith(("n't", "n’t")):
                return "negation"
            found = next((self.known[x] for x in re.split("['’]", word) if x in self.known), None)
        return found or "word"

    def features(self, text: str) -> list[float]:
        out = dict.fromkeys(FEATURES, 0.0)
        tokens = TOKEN.findall(text.lower())
        if not tokens or self.offences.isdisjoint(tokens):
            return list(out.values())
        clause: list[str] = []
        for token in [*tokens, "."]:
            if token not in STOPS:
                clause.append(token)
                continue
            if clause and not self.offences.isdisjoint(clause):
                self.match(clause, out)
            clause = []
        out["share"] = np.log1p(1000 * out["share"] / len(tokens))
        for name in ("insult", "targeted", "negated", "reported", "threat", "clauses"):
            out[name] = np.log1p(out[name])
        return [float(x) for x in out.values()]

    def match(self, clause: list[str], out: dict[str, float]) -> None:
        state, score = 0, 0.0
        for word in clause:
            state, wrote, weight = self.arcs[state, self.tag(word)]
            if wrote in out:
                weight *= self.insults.get(word, 1.0)
                out[wrote] += weight
                score += weight
                out["share"] += word in self.offences
        out["clauses"] += score > 0
        out["strongest"] = max(out["strongest"], score)


def learn_insults(labelled: DataFrame, least: int = 5, ratio: float = 12.0) -> list[dict[str, float]]:
    """Lexicons from rows (toxic, text, part): one without each part, then one of all.

    A word is in if least or more different words stand before it in toxic texts, and ratio times as many, for each text, as in others.
    The sample's bound is the lexicons' as well.
    """

    def pairs(batches):
        for batch in released(batches):
            seen = set()
            for toxic, part, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2)), strict=True):
                tokens = [t for t in TOKEN.findall(x.lower()) if t not in STOPS]
                seen.update((word, before, toxic, 1 << part) for before, word in zip(["", *tokens], tokens, strict=False))
            columns = list(zip(*seen, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.int32()), strict=True)], names=["word", "before", "toxic", "part"])

    met = labelled.select(F.col("toxic").cast("int").alias("toxic"), F.col("part").cast("int").alias("part"), "text").mapInArrow(pairs, "word string, before string, toxic int, part int")
    met = met.groupBy("word", "before").agg(*[F.bit_or(F.when(F.col("toxic") == i, F.col("part"))).alias(c) for i, c in ((1, "a"), (0, "b"))])
    without = [((1 << PARTS) - 1) ^ (1 << i if i < PARTS else 0) for i in range(PARTS + 1)]
    some = lambda c, parts: F.sum((F.coalesce(F.col(c), F.lit(0)).bitwiseAND(F.lit(parts)) > 0).cast("long")).alias(f"{c}{parts}")
    by_word = met.groupBy("word").agg(*[some(c, parts) for c in "ab" for parts in without])
    sizes = {(r["toxic"], r["part"]): r["count"] for r in labelled.groupBy("toxic", "part").count().collect()}  # two rows a part
    scale = {}
    for parts in without:
        clean, toxic = (sum(n for (t, part), n in sizes.items() if t == kind and parts >> part & 1) for kind in (0, 1))
        scale[parts] = (clean + 1) / (toxic + 1)
    odds = lambda parts: (F.col(f"a{parts}") + 0.5) / (F.col(f"b{parts}") + 0.5) * scale[parts]
    rows = by_word.select("word", *[F.when((F.col(f"a{parts}") >= least) & (odds(parts) >= ratio), odds(parts)).alias(str(parts)) for parts in without])
    rows = rows.where(F.coalesce(*[str(parts) for parts in without]).isNotNull()).collect()  # words of the bounded sample that pass
    return [{r["word"]: min(float(np.log(r[str(parts)])), 8.0) / 4 for r in rows if r[str(parts)]} for parts in without]


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, scales and weights (constant first) of a penalised logistic model, by Newton's steps."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    ridge = penalty * np.diag([1e-6, *np.ones(x.shape[1])])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z @ w))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + ridge, z.T @ (p - y) + ridge @ w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, w


def score_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", limit: float = 0.3, sample_docs: int = 16_000, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns of keep, score (0 to 1) and predicted (1 where score >= limit) of every row of docs.

    labels (doc_id, toxic) are the rows to learn from; at most sample_docs ids of them are, taken by a hash. An id that is
    labelled both ways counts as toxic, and of rows that share an id one text is learned from. Null and empty texts score as texts without any match; rows
    without both kinds of label to learn from give a constant score. Repeated rows are treated alike. A score of just the limit counts as
    toxic. Texts of any length are read whole, clause by clause. Other columns than keep and text aren't read, so their names may clash; an empty
    table gives an empty result.
    """
    spark = prepare(docs.sparkSession)
    ids = labels.where("doc_id is not null and toxic in (0, 1)").groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(sample_docs)
    sample = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(ids), "id")  # sample_docs ids
    sample = sample.groupBy("id", "toxic").agg(F.min("text").alias("text")).withColumn("part", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(PARTS)).cast("int"))
    sample = materialize(sample, "labelled")
    lexicons = learn_insults(sample)
    names = list(FEATURES)

    def describe(batches):
        grammars = [Grammar(x) for x in lexicons]
        for batch in released(batches):
            x = np.array([grammars[part].features(t) for part, t in zip(batch.column(1).to_pylist(), texts(batch.column(2)), strict=True)], np.float64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([pa.array(batch.column(0).to_numpy(zero_copy_only=False), pa.int32()), *[pa.array(c) for c in x.T]], names=["toxic", *names])

    rows = sample.select("toxic", "part", "text").mapInArrow(describe, "toxic int, " + ", ".join(f"{n} double" for n in names)).toPandas()  # sample_docs rows
    discard(sample)
    x, y = rows[names].to_numpy(np.float64), rows["toxic"].to_numpy(np.float64)
    both = 0 < y.sum() < len(y)
    mean, scale, w = fit(x, y) if both else (np.zeros(len(names)), np.ones(len(names)), np.zeros(len(names) + 1))
    constant = float(y.mean()) if len(y) else 0.0
    (body,) = fresh(docs.select(*keep), "text")
    chosen = docs.select(*keep, docs[text].alias(body))
    schema = T.StructType([*chosen.schema.fields[:-1], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def predict(batches):
        grammar = Grammar(lexicons[-1])
        for batch in released(batches):
            x = np.array([grammar.features(t) for t in texts(batch.column(batch.num_columns - 1))], np.float64).reshape(-1, len(names))
            s = 1 / (1 + np.exp(-(w[0] + (x - mean) / scale @ w[1:]))) if both else np.full(len(x), constant)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(s, pa.float64()), pa.array((s >= limit).astype(np.int32))], names=schema.names)

    return chosen.mapInArrow(predict, schema)
