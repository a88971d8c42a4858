"""Scores of language identification and toxicity against plain forms of their models."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldgeo.llm import langid, toxicity
from fieldgeo.llm.common import table


def sums(word, p, known):
    """Forward and backward sums of a word under the pieces' probabilities, by their definition."""
    weight = lambda a, b: p[word[a:b]] if word[a:b] in known else langid.UNKNOWN if b == a + 1 else 0.0
    n = len(word)
    ahead, back = [1.0] + [0.0] * n, [0.0] * n + [1.0]
    for b in range(1, n + 1):
        ahead[b] = sum(ahead[a] * weight(a, b) for a in range(b))
    for a in range(n - 1, -1, -1):
        back[a] = sum(weight(a, b) * back[b] for b in range(a + 1, n + 1))
    return ahead, back, weight


def learned_by_hand(labelled, known, rounds, smoothing):
    tallies = defaultdict(Counter)
    for text, lang in labelled:
        tallies[lang].update(langid.MARK + w for w in langid.words_in(text))
    models = {lang: dict.fromkeys(known, 1 / len(known)) for lang in tallies}
    for _ in range(rounds):
        for lang, tally in tallies.items():
            uses = dict.fromkeys(known, smoothing)
            for word, n in tally.items():
                ahead, back, weight = sums(word, models[lang], known)
                for a in range(len(word)):
                    for b in range(a + 1, len(word) + 1):
                        if word[a:b] in known:
                            uses[word[a:b]] += n * ahead[a] * weight(a, b) * back[b] / ahead[-1]
            total = sum(uses.values())
            models[lang] = {k: v / total for k, v in uses.items()}
    return models


def test_language_scores_against_the_plain_model(spark):
    rng = random.Random(1)
    stock = {"de": "der die und nicht straße über schön haus katze".split(), "en": "the and with house cat over these under".split(), "fr": "le la été où maison chat avec déjà".split()}
    say = lambda lang, n: " ".join(rng.choice(stock[lang]) for _ in range(n))
    labelled = [(say(lang, 12), lang) for lang in stock for _ in range(6)]
    docs = [(i, say(rng.choice(list(stock)), rng.randint(1, 4)) + rng.choice(("", " the le", " zzq 42"))) for i in range(30)] + [(90, "日本 the"), (91, "1 2"), (92, None)]
    known = set(langid.pieces_of("piece_bpe_32k.model").pieces)
    models = learned_by_hand(labelled, known, 2, 0.02)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labelled, "text string, lang string"), rounds=2).collect()}
    names = sorted(models)
    for doc, text in docs:
        words = [langid.MARK + w for w in langid.words_in(text or "")]
        if not any(c.isalpha() for w in words for c in w):
            assert got[doc] == ("und", 0.0)
            continue
        logs = [sum(math.log(sums(w, models[name], known)[0][-1]) for w in words) for name in names]
        best = max(range(3), key=lambda i: (logs[i], -i))
        assert got[doc][0] == names[best] and got[doc][1] == pytest.approx(1 / sum(math.exp(x - logs[best]) for x in logs), rel=1e-6)


def lexicon_by_hand(rows):
    before = {0: defaultdict(set), 1: defaultdict(set)}
    for toxic, text in rows:
        tokens = [t for t in toxicity.TOKEN.findall(text.lower()) if t not in toxicity.STOPS]
        for a, b in zip(["", *tokens], tokens, strict=False):
            before[toxic][b].add(a)
    scale = (sum(not t for t, _ in rows) + 1) / (sum(t for t, _ in rows) + 1)
    odds = {w: (len(before[1][w]) + 0.5) / (len(before[0][w]) + 0.5) * scale for w in before[1] if len(before[1][w]) >= 5}
    return {w: min(math.log(x), 8) / 4 for w, x in odds.items() if x >= 12}


def logistic_by_hand(x, y):
    """The penalised logistic model by plain gradient steps on scaled features."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z, w, b = (x - mean) / scale, np.zeros(x.shape[1]), 0.0
    for _ in range(60_000):
        p = 1 / (1 + np.exp(-(b + z @ w)))
        w, b = w - 0.004 * (z.T @ (p - y) + w), b - 0.004 * ((p - y).sum() + 1e-6 * b)
    return lambda rows: 1 / (1 + np.exp(-(b + (rows - mean) / scale @ w)))


def test_toxicity_scores_against_the_plain_model(spark):
    """Lexicons without each row's own part, the clause grammar's features, and a logistic model: each by a plain form of its own."""
    rng = random.Random(2)
    vocabulary = [a + b for a in "bdfgk" for b in ("an", "el", "ir", "o", "u")]
    rows = []
    for i in range(160):
        toxic = int(i % 4 == 0)
        words = [rng.choice([*vocabulary, ".", "you"]) for _ in range(24)]
        for _ in range(rng.randint(1, 4) * toxic + (i % 37 == 0)):
            words.insert(rng.randrange(20), rng.choice(("grub", "oaf", "you grub", "not an oaf")))
        rows.append((i, " ".join(words), toxic))
    docs = spark.createDataFrame([r[:2] for r in rows] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, toxic) for i, _, toxic in rows if i < 120], "doc_id long, toxic int")
    parts = {r["doc_id"]: r["part"] for r in docs.select("doc_id", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(toxicity.PARTS)).alias("part")).collect()}
    learn = [(i, text, toxic) for i, text, toxic in rows if i < 120]
    grammars = [toxicity.Grammar(lexicon_by_hand([(t, x) for i, x, t in learn if parts[i] != part])) for part in range(toxicity.PARTS)]
    whole = toxicity.Grammar(lexicon_by_hand([(t, x) for _, x, t in learn]))
    assert {"grub", "oaf"} <= set(whole.insults)
    model = logistic_by_hand(np.array([grammars[parts[i]].features(x) for i, x, _ in learn]), np.array([t for _, _, t in learn], float))
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in toxicity.score_toxicity(docs, labels).collect()}
    for i, text in [r[:2] for r in rows] + [(900, ""), (901, "")]:
        score = float(model(np.array([whole.features(text)]))[0])
        assert got[i][0] == pytest.approx(score, abs=2e-3) and got[i][1] == int(got[i][0] >= 0.3)
    held = [(got[i][1], toxic) for i, _, toxic in rows if i >= 120]
    assert sum(p for p, t in held if t) == sum(t for _, t in held) and sum(p for p, t in held if not t) <= 2


def test_toxicity_of_held_out_documents(spark, sf):
    """What the sample shows is found in the rows that weren't learned from, and hardly anything else."""
    folder = sf.replace("sf0.001", "sf0.01")
    labels = table(spark, folder, "labels")
    learn = labels.where("crc32(cast(doc_id as string)) % 4 <> 2").select("doc_id", "toxic")
    docs = table(spark, folder, "documents")
    scored = toxicity.score_toxicity(docs, learn).join(labels.where("crc32(cast(doc_id as string)) % 4 = 2"), "doc_id").select("toxic", "predicted").collect()
    found, toxic = sum(r["predicted"] for r in scored if r["toxic"]), sum(r["toxic"] for r in scored)
    assert found >= 0.6 * toxic and sum(r["predicted"] for r in scored if not r["toxic"]) <= 0.02 * len(scored)
