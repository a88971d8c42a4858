"""Fill-in-middle, importance resampling and byte-pair encoding against brute force on whole small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldgeo.llm import bpe, fim, queries, resample
from fieldgeo.llm.common import table, tokenizer_path

EDGES = [(1001, ""), (1002, None), (None, "no id here at all"), (1003, "   \n\t "), (1004, "word " * 30_000), (1005, "twice the same row"), (1005, "twice the same row"), (1006, "é" * 5000), (1007, "one"), (1008, "42 !! 17"), (1009, "a <P> in it"), (1010, " x y \x1c\x85 z\n"), (1011, "x" * 90_000 + "!y")]
EDGES += [(2000 + i, f"some words {i}  here <|endoftext|> \n {'and more ' * (i % 7)}{'é中' * (i % 3)} ") for i in range(120)]
CLASHES = "n_tokens string, ids string, n int, form string, output string, weight double, score double, rank string, n_words string, place int, row int, at int, h1 string, decoded array<int>, TEXT_ string"


@pytest.fixture(scope="module")
def docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text").cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [tuple(r) for r in docs.collect()]


@pytest.fixture(scope="module")
def edges(spark):
    extra = ("a", "b", 1, "c", "d", 1.0, 2.0, "e", "f", 3, 4, 5, "g", [6], "h")
    return spark.createDataFrame([(*r, *extra) for r in EDGES], f"doc_id long, text string, {CLASHES}").repartition(3)


@pytest.fixture(scope="module")
def nothing(edges):
    return edges.limit(0)


def by_row(found):
    return sorted(map(tuple, found), key=repr)


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


UNITS = re.compile("[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")


def cut_by_hand(doc, text, seed=42, percent=50, spm=80, marks=fim.SENTINELS):
    text = text or ""
    units, h = UNITS.findall(text), sha(f"{seed}:{'' if doc is None else doc}")
    r = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(m in text for m in marks) or r[2] % 100 >= percent:
        return doc, n, "plain", None, None, text
    a, b = sorted((r[0] % (n + 1), r[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if r[3] % 100 < spm else "psm"
    return doc, n, form, len(p), len(m), (f"{marks[1]}{s}{marks[0]}{p}" if form == "spm" else f"{marks[0]}{p}{marks[1]}{s}") + f"{marks[2]}{m}"


def test_rank_index_is_exact_and_bounded():
    rng = np.random.default_rng(1)
    for steps in (rng.integers(1, 12, 20_000), np.concatenate([np.full(500, 3), np.full(700, 4000), rng.integers(1, 9, 900)]), rng.geometric(0.001, 3000), np.array([5]), np.array([], int)):
        offsets = np.cumsum(steps)
        for error in (0, 7, 100, 127):
            index = fim.RankIndex(offsets, error, window=16)
            ranks = np.arange(len(offsets))
            if len(offsets):
                assert (index[ranks] == offsets).all() and np.abs(index.residuals.astype(int)).max() <= error
            assert len(index.starts) <= max(len(offsets), 1)
    assert len(fim.RankIndex(np.arange(0, 70_000, 7)).starts) == 1
    with pytest.raises(ValueError):
        fim.RankIndex(np.arange(3), 128)


def test_segments_are_the_longest():
    """No segment could have held its successor's first boundary: a brute-force check of the slopes it would need."""
    rng = np.random.default_rng(2)
    offsets, error = np.cumsum(rng.geometric(0.05, 4000)), 20
    index = fim.RankIndex(offsets, error, window=8)
    for a, b in zip(index.starts.tolist(), index.starts[1:].tolist(), strict=False):
        steps, rise = np.arange(1, b + 1 - a), offsets[a + 1 : b + 1] - offsets[a]
        assert ((rise - error) / steps).max() > ((rise + error) / steps).min()


def test_boundaries_are_units():
    rng = random.Random(2)
    for _ in range(300):
        own = ["".join(rng.choice(" \t\n\v\f\rabé中\x1c\x85 ") for _ in range(rng.randint(0, 9))) for _ in range(5)]
        data = [x.encode() for x in own]
        starts = np.cumsum([0, *map(len, data)])
        ends = fim.boundaries(np.frombuffer(b"".join(data), np.uint8), starts)
        want, at = [], 0
        for text in own:
            for unit in UNITS.findall(text):
                at += len(unit.encode())
                want.append(at)
        assert ends.tolist() == want


def test_fill_in_middle(docs, rows, edges, nothing):
    want = [cut_by_hand(*r) for r in rows + EDGES]
    got = fim.fill_in_middle(docs).unionAll(fim.fill_in_middle(edges)).collect()
    assert by_row(got) == sorted(want, key=repr)
    assert {"plain", "psm", "spm"} <= {r["form"] for r in got}
    assert fim.fill_in_middle(nothing).count() == 0
    marks = ("[a.", "(b|", "c*")
    other = fim.fill_in_middle(edges, seed=7, percent=90, spm_percent=40, sentinels=marks)
    back = other.withColumn("back", fim.restored(F.col("output"), F.col("form"), marks)).collect()
    assert by_row(r[:-1] for r in back) == sorted((cut_by_hand(*r, 7, 90, 40, marks) for r in EDGES), key=repr)
    assert sorted(r["back"] for r in back) == sorted(t or "" for _, t in EDGES)


def test_fill_in_middle_query(spark, sf, rows):
    got = queries.op11_fill_in_middle(spark, sf).collect()
    want = [(*cut_by_hand(*r)[:5], sha(cut_by_hand(*r)[5]), sha(r[1] or "")) for r in rows]
    assert by_row(got) == sorted(want, key=repr)


def drawn_by_hand(docs, target, ngrams=1, buckets=10_000, seed=2024, percent=10, min_words=20):
    cut = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    features = lambda w: [" ".join(w[i : i + n]) for n in range(1, ngrams + 1) for i in range(len(w) - n + 1)]
    code = lambda x: zlib.crc32(x.encode()) % buckets
    words = [cut(t) for _, t in docs]
    s, t = Counter(code(x) for w in words for x in features(w)), Counter(code(x) for d in target for x in features(cut(d)))
    big, small = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big + buckets) / ((s[b] + 1) * (small + buckets))))
    gains = {b: gain(b) for b in s}
    out = []
    for (doc, _), w in zip(docs, words, strict=True):
        weight = sum(gains[code(x)] for x in features(w))
        h = int(sha(f"{seed}:{'' if doc is None else doc}")[:8], 16)
        out.append([doc, len(features(w)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w) >= min_words])
    order = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): i + 1 for i, r in enumerate(order[: percent * len(order) // 100])}
    return [(*r[:4], ranks.get(id(r))) for r in out]


def test_resampling(spark, sf, docs, rows, edges, nothing):
    target = table(spark, sf, "benchmark")
    aims = [r["text"] for r in target.collect()]
    got = queries.op12_importance_resampling(spark, sf).collect()
    assert by_row(got) == sorted(drawn_by_hand(rows, aims), key=repr) and sum(r["rank"] is not None for r in got) > 5
    both = docs.unionAll(edges.select("doc_id", "text"))
    got = resample.resample(both, target, ngrams=3, buckets=70_000, percent=30, min_words=3).collect()
    assert by_row(got) == sorted(drawn_by_hand(rows + EDGES, aims, 3, 70_000, percent=30, min_words=3), key=repr)
    few = resample.resample(edges, target, percent=100, min_words=0).collect()
    assert by_row(few) == sorted(drawn_by_hand(EDGES, aims, percent=100, min_words=0), key=repr)
    assert sorted(r["rank"] for r in few) == list(range(1, len(EDGES) + 1))
    assert resample.resample(nothing, target).count() == 0
    bare = resample.resample(edges, target.limit(0)).collect()
    assert by_row(bare) == sorted(drawn_by_hand(EDGES, []), key=repr)


def test_words_by_parts_are_the_whole_text_s():
    rng = random.Random(5)
    table = resample.Words(most=50, long=40)
    for _ in range(400):
        text = "".join(rng.choice("ab9Zé中 -_\n.\x7f\x1c") for _ in range(rng.randint(0, 120)))
        lower = text.encode().lower().decode()
        assert [w for part in table.of([text])[0] for w in part] == [w for w, _ in table.split.pre_tokenize_str(lower)]


def test_places_of_ties_are_dense(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("score"), F.col("id").alias("at"), F.lit("x").alias("part")).repartition(7)
    got = resample.sorted_places(df, [F.desc("score")], "ties").collect()
    assert sorted(r["place"] for r in got) == list(range(1, 5001))
    assert [r["score"] for r in sorted(got, key=lambda r: r["place"])] == sorted((i % 3 for i in range(5000)), reverse=True)


SIGNS = [" ", "\n", "a", "b", "aa", "the", "The", "É", "ß", "İ", "Σ", "'s", "'", "''", "9", "42", ".", "..", "!!", ",", "<|endoftext|>", "<|startoftext|>", "<|", "<s>", "\xa0", "\x1c", "\x85", "é", "́", "中", "don't", "ﬁ", "\U0001f600", "½", "</w>", "w", "ing", "hahaha", "aaaa", "\x00", "\xad", "ẞ"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))


def test_encoder_agrees_with_the_library(library):
    rng, own = random.Random(4), bpe.encoder("word_bpe_49k.json")
    several = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    several += ["".join(rng.choice("aeinorsthl!?." if i % 2 else "ahlowx") for _ in range(rng.randint(1, 25))) for i in range(6000)]
    before = own.merged
    for text, ids in zip(several, own.of(several), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    assert 0 < own.merged - before < len(several)


def merged_by_hand(symbols, ranks, size):
    """Plain merging, the lowest rank first, of equal ones the leftmost; and whether a merge ever crossed the border."""
    parts = [(s, (i, i + 1)) for i, s in enumerate(symbols)]
    while True:
        best = min(((ranks[a[0], b[0]][0], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if (a[0], b[0]) in ranks), default=None)
        if best is None:
            return [p for p, _ in parts]
        i = best[1]
        parts[i : i + 2] = [(ranks[parts[i][0], parts[i + 1][0]][1], (parts[i][1][0], parts[i + 1][1][1]))]


def test_compatibility_against_plain_merging():
    """Random small vocabularies: two sound tokens are compatible just when merging what they are made of gives the two again."""
    rng = random.Random(8)
    for _ in range(40):
        strings, merges = list("abc"), []
        for _ in range(rng.randint(1, 14)):
            a, b = rng.choice(strings), rng.choice(strings)
            if (a, b) not in [m[:2] for m in merges] and len(a + b) < 9:
                merges.append((a, b))
                if a + b not in strings:
                    strings.append(a + b)
        ids = {s: i for i, s in enumerate(strings)}
        table = bpe.Compatibility(len(ids), [(ids[a], ids[b], ids[a + b]) for a, b in merges])
        ranks = {(ids[a], ids[b]): (i, ids[a + b]) for i, (a, b) in enumerate(merges)}
        alone = {s: merged_by_hand([ids[c] for c in s], ranks, len(ids)) == [ids[s]] for s in strings}
        assert all(alone[s] for s in strings if table.sound[ids[s]])
        sound = [s for s in strings if table.sound[ids[s]]]
        pairs = [(x, y) for x in sound for y in sound]
        a, b = (np.array([ids[p[i]] for p in pairs]) for i in (0, 1))
        for (x, y), rank in zip(pairs, table.crossing(a, b).tolist(), strict=True):
            assert (rank == bpe.NEVER) == (merged_by_hand([ids[c] for c in x + y], ranks, len(ids)) == [ids[x], ids[y]]), (x, y, merges)


def test_bpe(docs, rows, edges, nothing, library):
    want = []
    for doc, text in rows + EDGES:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    both = bpe.encode(docs).unionAll(bpe.encode(edges))
    assert sorted(((r[0], r[1], bytes(r[2]), r[3]) for r in bpe.decode(both).collect()), key=repr) == sorted(want, key=repr)
    assert bpe.decode(bpe.encode(nothing)).count() == 0
    kept = bpe.encode(edges, keep=("doc_id", "text", "form"))
    assert kept.columns == ["doc_id", "text", "form", "n_tokens", "ids"]
    assert bpe.decode(kept.withColumn("ids", F.lit(None).cast("binary"))).select("decoded").distinct().collect()[0][0] == ""


def test_bpe_query(spark, sf, rows, library):
    want = []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False))))
    assert by_row(queries.op13_bpe(spark, sf).collect()) == sorted(want, key=repr)


def test_long_ids_are_decoded_in_blocks(library):
    ids = np.array(library.encode("some words <|endoftext|> here", add_special_tokens=False).ids * 3, "<u4")
    assert bpe.decoded(ids, bpe.pieces("word_bpe_49k.json")) == library.decode(ids.tolist(), skip_special_tokens=False)
