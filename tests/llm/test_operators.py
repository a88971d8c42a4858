"""The corpus operators against brute force on whole small tables."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldgeo.llm import decontaminate, jaccard_join, langid, line_dedup, lm_score, packing, quality, token_counts, topk, toxicity
from fieldgeo.llm.common import are_stars, components, gathered, table, words_of

EDGES = [(1001, "", "en", "s"), (1002, None, None, None), (None, "no id here at all", "en", "s"), (1003, "   \n\t ", "en", "s"), (1004, "word " * 30_000, "en", None), (1005, "twice the same row", "en", "s"), (1005, "twice the same row", "en", "s"), (1006, "é" * 5000, "fr", "s"), (1007, "one", None, "s"), (1008, "42 !! 17", "de", "s")]
SCHEMA = "doc_id long, text string, lang string, source string, score double, n_tokens string, class_id array<int>, rank int, keep string"


@pytest.fixture(scope="module")
def docs(spark, sf):
    return table(spark, sf, "documents").cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(*r, 0.5, "x", [1], 3, "y") for r in EDGES], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def held(doc, n, value):
    return doc is None or zlib.crc32(str(doc).encode()) % n == value


def by_row(found, *keys):
    return sorted((tuple(r[k] for k in keys) for r in found), key=repr)


def test_line_dedup_edges(spark, nothing):
    data = [(i, f"shared line of text\nown line number {i}\n shared line of text ", f"s{i % 9}") for i in range(9)] + [(50, None, "s1"), (51, "shared line of text", None), (52, "", "s2"), (53, "short\nshort", "s3")]
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(spark.createDataFrame(data, "doc_id long, text string, source string"), min_sites=9).collect()}
    assert got[3]["text"] == "own line number 3" and got[3]["n_lines"] == 3 and got[3]["n_removed"] == 2
    assert got[50]["text"] is None and got[50]["n_lines"] == 0
    assert got[51]["text"] == "" and got[52]["text"] == "" and got[53]["text"] == "short\nshort"
    assert line_dedup.dedup_lines(spark.createDataFrame(data, "doc_id long, text string, source string"), min_sites=10).where("n_removed > 0").count() == 0
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_token_counts(spark, docs, rows, edges, nothing):
    import sentencepiece
    from public_tokenizers import path

    sp = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    want = [(d, len((t or "").encode()), len(sp.encode(t or ""))) for d, t in rows + [r[:2] for r in EDGES]]
    got = token_counts.count_tokens(docs).unionAll(token_counts.count_tokens(edges)).collect()
    assert by_row(got, "doc_id", "n_bytes", "n_tokens") == sorted(want, key=repr)
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in got)
    assert token_counts.count_tokens(nothing).count() == 0


def test_part_counts_agree_with_the_library():
    rng = random.Random(3)
    own = token_counts.part_counts("piece_bpe_32k.model")
    signs = [" ", "  ", "\n", "a", "the", "The", "É", "İ", "'s", "9", ".", "!!", "<s>", "\t", "\xa0", "\x1c", "é", "中", "▁", "ing", "\U0001f600"]
    for _ in range(1500):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 12)))
        assert own.of(text) == len(own.processor.encode(text)), repr(text)


def test_word_ids_agree_with_the_library():
    rng = random.Random(4)
    own = packing.word_ids("word_bpe_49k.json")
    signs = [" ", "\n", "a", "the", "The", "É", "ß", "İ", "Σ", "'s", "'", "9", "42", ".", ",", "<|endoftext|>", "<s>", "\xa0", "\x1c", "é", "́", "中", "don't", "ﬁ", "\U0001f600", "½"]
    several = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 12))) for _ in range(1500)]
    for text, ids in zip(several, own.of(several), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_packing(spark, docs, rows, edges, nothing):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("word_bpe_49k.json"))
    ids = {d: np.array([*t.encode(x, add_special_tokens=False).ids, 1], "<u4") for d, x in rows}
    got = packing.pack(docs).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own) and r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes())
    for d, own in pieces.items():
        own = sorted((r["start"], r["length"]) for r in own)
        assert [s for s, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1]] and sum(n for _, n in own) == len(ids[d])
    assert pieces.keys() == ids.keys()
    for own in sequences.values():
        own = sorted(own)
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1]] and sum(n for _, n in own) <= 2048
    assert sum(len(x) for x in ids.values()) > 0.9 * 2048 * len(sequences)
    few = packing.pack(edges).collect()
    assert sum(r["doc_id"] == 1005 for r in few) == 2 and [r["length"] for r in few if r["doc_id"] in (1001, 1002, 1003)] == [1, 1, 1]
    assert packing.pack(nothing).count() == 0


def test_patterns_cover_all_counts():
    rng = np.random.default_rng(5)
    for size, scale in ((16, 3), (64, 200), (128, 1000)):
        counts = rng.integers(0, scale, size)
        patterns = packing.solve_patterns(counts)
        assert (sum(n * p for p, n in patterns) == counts).all()
        assert all((p * np.arange(1, size + 1)).sum() <= size for p, _ in patterns)
        assert sum(n for _, n in patterns) <= 1.02 * (counts * np.arange(1, size + 1)).sum() / size + size


def test_language(spark, docs, rows, edges, nothing):
    train = docs.where("crc32(cast(doc_id as string)) % 5 <> 0").select("text", "lang")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = langid.identify(docs.unionByName(edges.select(*docs.columns[:4]), allowMissingColumns=True), train).collect()
    own = [r for r in got if held(r["doc_id"], 5, 0) and r["doc_id"] in truth]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in own]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)
    assert all((r["lang_pred"] == "und") == (r["doc_id"] in (1001, 1002, 1003, 1008)) for r in got)
    assert {r["lang_pred"] for r in langid.identify(edges, nothing).collect()} == {"und"}
    assert langid.identify(nothing, train).count() == 0


def test_language_where_one_text_is_half_of_a_language(spark, docs):
    train = docs.where("crc32(cast(doc_id as string)) % 5 <> 0").select("text", "lang")
    hot = train.where("lang = 'en' and length(text) > 100").orderBy(F.length("text")).limit(1)
    many = train.unionAll(hot.crossJoin(spark.range(2000)).select("text", "lang"))
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = [r for r in langid.identify(docs, many, docs_each=20).collect() if held(r["doc_id"], 5, 0)]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in got]) > 0.9


def segmentations(own, p, word, column):
    """(probability, uses of each piece) of every way to cut word."""
    place = {x: i for i, x in enumerate(own.pieces)}
    if not word:
        return [(1.0, [])]
    out = []
    for n in range(1, len(word) + 1):
        one = p[place[word[:n]], column] if word[:n] in place else langid.UNKNOWN if n == 1 else 0.0
        out += [(one * rest, [place.get(word[:n]), *used]) for rest, used in segmentations(own, p, word[n:], column) if one]
    return out


def test_gathered_batches_hold_all_rows_in_order():
    batches = [pa.RecordBatch.from_arrays([pa.array(range(i, i + 7))], names=["x"]) for i in range(0, 70, 7)]
    for rows, n_bytes, sizes in [(20, 1 << 20, [21, 21, 21, 7]), (1000, 100, [14] * 5), (1000, 1 << 20, [70]), (1, 1, [7] * 10)]:
        found = list(gathered(iter(batches), rows, n_bytes))
        assert [b.num_rows for b in found] == sizes
        assert [x for b in found for x in b.column(0).to_pylist()] == list(range(70))
    assert not list(gathered(iter([]), 5))


def test_forward_sums_all_segmentations():
    own = langid.pieces_of("piece_bpe_32k.model")
    rng = np.random.default_rng(1)
    p = np.vstack([rng.dirichlet(np.ones(len(own.pieces)), 2).T, np.zeros(2)])
    words = ["▁the", "▁thereof", "▁élan", "中x", "▁"]
    ways = {w: segmentations(own, p, w, 0) for w in words}
    assert np.allclose(own.log_probabilities(words, p)[:, 0], np.log([sum(x for x, _ in ways[w]) for w in words]))
    want, counts = np.zeros(len(own.pieces)), np.array([1, 5, 2, 1, 7])
    for w, n in zip(words, counts, strict=True):
        for x, used in ways[w]:
            for i in used:
                if i is not None:
                    want[i] += n * x / sum(y for y, _ in ways[w])
    assert np.allclose(own.expected(words, counts, p[:, [0]]), want)


def test_long_words_are_scored_whole(monkeypatch):
    own = langid.pieces_of("piece_bpe_32k.model")
    rng = np.random.default_rng(1)
    p = np.vstack([rng.dirichlet(np.ones(len(own.pieces)), 2).T, np.zeros(2)])
    words = ["▁donaudampfschifffahrtsgesellschaftskapitänsmütze", "▁" + "ab" * 24, "▁" + "the" * 15]
    got, uses = own.log_probabilities(words, p), own.expected(words, np.array([1, 2, 3]), p[:, [0]])
    monkeypatch.setattr(langid, "RESCALED", 1000)
    assert np.allclose(own.log_probabilities(words, p), got) and np.allclose(own.expected(words, np.array([1, 2, 3]), p[:, [0]]), uses)
    monkeypatch.undo()
    assert np.isfinite(own.log_probabilities(["▁" + "xyzzy" * 2000], p)).all() and np.isfinite(own.expected(["▁" + "xyzzy" * 2000], np.array([1]), p[:, [0]])).all()


@pytest.mark.parametrize("spread", [lm_score.SPREAD, 100])
def test_lm_scores(spark, docs, rows, edges, nothing, spread):
    both = docs.select("doc_id", "text").unionAll(edges.select("doc_id", "text"))
    rows = rows + [r[:2] for r in EDGES]
    own = [(d, [*words_of(t), None], held(d, 10, 0)) for d, t in rows]
    c, pairs, triples = Counter(), Counter(), Counter()
    for _, tokens, out in own:
        if not out:
            c.update(tokens)
            pairs.update(zip([None, *tokens], tokens, strict=False))
            triples.update(zip([None, *tokens], tokens, tokens[1:], strict=False))
    total, kinds = sum(c.values()), len(c)
    d = (a := sum(v == 1 for v in c.values())) / (a + 2 * sum(v == 2 for v in c.values()))
    k2, k3 = len(pairs) / len(c), len(triples) / len(pairs)
    one = lambda w: (c[w] - d) / total if c[w] else d * kinds / total
    two = lambda v, w: (pairs[v, w] + k2 * one(w)) / (c[v] + k2) if c[v] else one(w)
    three = lambda u, v, w: (triples[u, v, w] + k3 * two(v, w)) / (pairs[u, v] + k3) if pairs[u, v] else two(v, w)
    score = lambda t: math.log10(two(None, t[0])) + sum(math.log10(three(*x)) for x in zip([None, *t], t, t[1:], strict=False))
    want = [(doc, out, len(t), sum(c[w] > 0 for w in t), total, round(sum(math.log10((c[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in t), 4), round(score(t), 4)) for doc, t, out in own]
    got = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4), round(r["score"], 4)) for r in lm_score.score_documents(both, block_bytes=60_000, spread=spread).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert abs(sum(one(w) for w in c) + d * kinds / total - 1) < 1e-9
    u, v, w = next(iter(triples))
    assert abs(sum(three(u, v, w) for w in c) + k3 / (pairs[u, v] + k3) * k2 / (c[v] + k2) * d * kinds / total - 1) < 1e-9
    assert lm_score.score_documents(nothing).count() == 0
    assert {r["score"] for r in lm_score.score_documents(both, held_out=F.lit(True)).collect()} == {0.0}


def test_lm_counts_are_added_up_exactly():
    rng = np.random.default_rng(2)
    requests, want = [], Counter()
    for _ in range(5):
        rows = sorted({(int(a), int(b), int(c)) for a, b, c in rng.integers(0, 6, (40, 3)) + [2**31 - 9, 2**32 - 9, 2**32 - 9]})
        counts = rng.integers(0, 4, len(rows))
        want.update(dict(zip(rows, counts.tolist(), strict=True)))
        columns = np.array(rows, np.uint64).T
        moved = lm_score.steps(columns[0])
        requests.append(lm_score.unpacked(lm_score.packed(moved, lm_score.steps_in_runs(columns[1], moved), columns[2], counts)))
    totals, places = lm_score.added_up(lm_score.TRIPLES, requests)
    for request, place in zip(requests, places, strict=True):
        rows = zip(*[x.tolist() for x in (np.cumsum(request[0]), lm_score.sums_in_runs(request[1], request[0]), request[2])], strict=True)
        assert [want[r] for r in rows] == totals[place].tolist()


def test_decontamination(spark, sf, docs, rows, edges, nothing):
    bench = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()] + [(900, None), (901, ""), (902, "no id HERE"), (903, "one"), (None, "twice the same row")]
    frame = spark.createDataFrame(bench, "item_id long, text string")
    long = spark.createDataFrame([(2000, ("filler words " * 4000) + bench[3][1] + " more of it" * 3000)], "doc_id long, text string")
    everything = docs.select("doc_id", "text").unionAll(edges.select("doc_id", "text")).unionAll(long)
    shingles = lambda w, k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    want = []
    for d, t in rows + [r[:2] for r in EDGES] + [tuple(r) for r in long.collect()]:
        w = words_of(t)
        for item, text in bench:
            q = words_of(text)
            if item is not None and q and len(w) >= (k := min(5, len(q))):
                own = shingles(q, k)
                if (c := len(own & shingles(w, k)) / len(own)) >= 0.8:
                    want.append((d, item, c))
    got = decontaminate.contained_items(everything, frame)
    assert by_row(got.collect(), "doc_id", "item_id", "containment") == sorted(want, key=repr) and (2000, bench[3][0], 1.0) in want
    blocks = decontaminate.contained_items(everything, frame, block_items=9)
    assert by_row(blocks.collect(), "doc_id", "item_id", "containment") == sorted(want, key=repr)
    left = decontaminate.decontaminate(everything, frame)
    gone = {d for d, _, _ in want}
    assert left.count() == sum(d not in gone for d, _ in rows + [r[:2] for r in EDGES] + [(2000, "")])
    assert decontaminate.contained_items(nothing, frame).count() == 0 and decontaminate.contained_items(everything, frame.limit(0)).count() == 0
    assert decontaminate.decontaminate(edges, frame.limit(0)).count() == len(EDGES)


def brute_components(rows, k, percent):
    sets = []
    for d, t in rows:
        w = words_of(t)
        sets.append((d, frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()))
    lead = list(range(len(sets)))

    def find(i):
        while lead[i] != i:
            lead[i] = lead[lead[i]]
            i = lead[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                lead[find(i)] = find(j)
    lowest = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            lowest[find(i)] = min(lowest.get(find(i), d), d)
    return [(d, len(s), lowest.get(find(i)) if s else d) for i, (d, s) in enumerate(sets)]


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_jaccard_join(spark, rows, k, percent):
    rng = random.Random(k)
    base = [f"w{rng.randrange(500)}" for _ in range(300)]
    family = []
    for i in range(150):  # copies around the threshold
        w = list(base[: rng.choice((30, 120, 300))])
        for _ in range(rng.randint(0, max(1, len(w) // 40))):
            w[rng.randrange(len(w))] = f"x{rng.randrange(9)}"
        family.append((5000 + i, " ".join(w)))
    small = [(6000 + i, " ".join(rng.choice("abc") for _ in range(rng.randint(1, 6)))) for i in range(60)]
    data = rows + family + small + [r[:2] for r in EDGES]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    got = jaccard_join.similar_groups(frame, k=k, percent=percent, chunk_rows=16).collect()
    assert by_row(got, "doc_id", "n_shingles", "component_id") == sorted(brute_components(data, k, percent), key=repr)
    kept = jaccard_join.drop_similar(frame, k=k, percent=percent)
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in brute_components(data, k, percent)}


def test_jaccard_join_of_nothing(nothing):
    assert jaccard_join.similar_groups(nothing).count() == 0


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200) if i != 100] + [(300, 300)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges, "path").collect()}
    assert got == {i: 0 if i <= 100 else 101 for i in range(201)}


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400, 400 + i) for i in range(1, 50)] * 2
    lead = {x: x for pair in pairs for x in pair if pair[0] != pair[1]}
    for _ in lead:
        for a, b in pairs:
            if a != b:
                lead[a] = lead[b] = min(lead[a], lead[b])
    got = components(spark.createDataFrame(pairs, "a long, b long"), "random").collect()
    assert len(got) == len(lead) and {r["node"]: r["component"] for r in got} == lead


def test_stars(spark):
    stars = lambda pairs: are_stars(spark.createDataFrame(pairs, "u long, v long"))
    assert stars([]) and stars([(2, 1), (3, 1), (5, 4)])
    assert not stars([(2, 1), (3, 2)]) and not stars([(3, 1), (3, 2)])


def test_topk(spark, sf):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in table(spark, sf, "embeddings").collect()][:300]
    odd = [(10_000, None), (10_020, [float("nan")] * 64), (10_040, []), (None, rows[0][1]), (10_060, rows[0][1]), (10_080, rows[0][1]), (10_100, [1.0, 2.0]), rows[5], rows[20], (10_120, [0.5, -1.0])] + [(20_001 + i // 2, rows[7][1]) for i in range(90)]
    clash = "query long, query_id string, row int, shard string, score array<int>, dim int, v string"
    frame = spark.createDataFrame([(*r, 1, "a", 2, "b", [3], 4, "c") for r in rows + odd], f"vec_id long, embedding array<double>, {clash}").repartition(3)
    clean = [(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows + odd if i is not None and v and all(map(math.isfinite, v))]
    want = []
    for at, (q, v) in enumerate(clean):
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for n, (i, w) in enumerate(clean) if n != at and len(w) == len(v))[:20]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    for sizes in ({"shard_rows": 10, "query_rows": 5}, {"shard_rows": 40}, {"shard_rows": 10, "most_shards": 3, "sample_rows": 50}, {}):
        got = topk.top_k(frame, **sizes).collect()
        assert by_row(got, "query_id", "rank", "vec_id", "score") == sorted(want, key=repr)
    assert len(got) > len({(r["query_id"], r["vec_id"]) for r in got})  # repeated rows stand twice
    assert topk.top_k(frame.limit(0)).count() == 0


def test_shards_and_boxes(spark):
    """Vectors in clusters: shards are of a bounded size, boxes hold their rows, and a query is sent to few shards."""
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 100, (40, 8))
    at = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(0, 1, (4000, 8)))
    splits = topk.Splits(at, 50)
    shard = splits.of(at)
    assert np.bincount(shard).max() <= 50 and splits.shards == len(np.unique(shard))
    names = np.arange(splits.shards)
    boxes = topk.Boxes(names, *[np.array([f(at[shard == s], axis=0) for s in names]) for f in (np.min, np.max)])
    scores = at[:200] @ at.T
    bounds = boxes.bounds(at[:200])
    assert all((bounds[:, s] >= scores[:, shard == s].max(1) - 1e-6).all() for s in names)
    kth = np.sort(scores, axis=1)[:, -20]
    q = spark.createDataFrame([(i, i, 8, at[i].astype(int).tolist(), float(kth[i])) for i in range(200)], "query long, query_id long, dim int, v array<long>, floor double")
    sent = topk.routed(q, {8: boxes}, 0, None).count()
    assert sent < 200 * splits.shards / 4


def test_only_filled_parts_are_signed():
    rng = np.random.default_rng(7)
    for percent in (80, 90):
        for n in (100, 137, 300, 777, 1200, 5000, 20_000):
            for _ in range(20):
                tokens = rng.integers(0, 2**63, n).astype(np.uint64)
                own = jaccard_join.band_of(n, percent)
                filled = 0
                for band in (own, own + 1):
                    d, parts = jaccard_join.parts_of(band, percent)
                    f = len(np.unique(jaccard_join.mix(tokens ^ np.uint64(band + 1)) % np.uint64(parts)))
                    assert f > d
                    filled += f
                assert len(jaccard_join.signatures(tokens, percent)) == filled
    # of unrelated sets of a band hardly any two share a sign
    sets = [rng.integers(0, 2**63, int(n)).astype(np.uint64) for n in rng.integers(900, 1100, 300)]
    signs = np.concatenate([jaccard_join.signatures(x, 80) for x in sets])
    assert len(np.unique(signs)) == len(signs)


def test_lm_numbers_of_any_size():
    """Numbers over 32 bits don't fall together."""
    big = np.array([5, 2**32 + 5, 2**33 + 5, 2**40 + 5], np.uint64)
    rows = np.array([(a, b) for a in big for b in big])
    request = [lm_score.steps(rows[:, 0]), lm_score.steps_in_runs(rows[:, 1], lm_score.steps(rows[:, 0])), np.ones(len(rows), np.int64)]
    totals, places = lm_score.added_up(lm_score.PAIRS, [request, request])
    assert totals.tolist() == [2] * 16 and all(sorted(p.tolist()) == list(range(16)) for p in places)


def test_long_trusted_texts_do_not_end_the_sample(spark):
    data = [(i, "a text of some words " * 15 if i != 40 else "x" * 50_000) for i in range(200)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    whole = {r["id"] for r in quality.sample_of(docs, labels, 3000, "text", "doc_id").collect()}
    some = {r["id"] for r in quality.sample_of(docs, labels, 3000, "text", "doc_id", most_bytes=60_000).collect()}
    assert some == whole - {40} and len(some) > 80


def test_rows_with_maps_inside(spark):
    docs = spark.createDataFrame([(i, f"shared line of text\nown line {i}", f"s{i}") for i in range(9)], "doc_id long, text string, source string")
    docs = docs.withColumns({"m": F.struct(F.create_map(F.lit("a"), F.col("doc_id")).alias("n")), "lang": F.lit("en")})
    assert line_dedup.dedup_lines(docs).where("n_removed = 1").count() == 9
    assert quality.classify(docs, docs.select("doc_id", F.lit(1).alias("quality"))).count() == 9


def brute_kneser_ney(samples, order):
    """p(byte | up to order - 1 before) by the textbook recursion over dictionaries."""
    counts = Counter()
    for data in samples:
        x = bytes([quality.START]) * (order - 1) + data + bytes([quality.END])
        counts.update(x[i : i + order] for i in range(len(x) - order + 1))
    levels = {order: counts}
    for n in range(order - 1, 0, -1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    followers, cuts = {}, {}
    for n, level in levels.items():
        n1, n2, n3, n4 = (sum(v == i for v in level.values()) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
        d1, d2, d3 = 1 - 2 * y * n2 / max(n1, 1), 2 - 3 * y * n3 / max(n2, 1), 3 - 4 * y * n4 / max(n3, 1)
        cuts[n] = [0, *(min(max(d, 0.05), top - 0.05) for d, top in ((d1, 1), (d2, 2), (d3, 3)))]
        followers[n] = defaultdict(list)
        for g, c in level.items():
            followers[n][g[:-1]].append(c)

    def p(g):
        n = len(g)
        if not n:
            return 1 / quality.ALPHABET
        own = followers[n].get(g[:-1])
        if not own:
            return p(g[1:])
        c, d = levels[n][g], cuts[n]
        return ((c - d[min(c, 3)]) + sum(d[min(x, 3)] for x in own) * p(g[1:])) / sum(own)

    return p


def test_quality_against_brute_force(spark, sf, docs, rows, edges, nothing):
    labels = table(spark, sf, "labels")
    both = docs.select("doc_id", "text", "lang").unionAll(edges.select("doc_id", "text", "lang"))
    sample = quality.sample_of(both, labels, 30, "text", "doc_id")
    model, marks = quality.fit(sample), quality.fit_marks(sample)
    p = brute_kneser_ney([r["text"].encode() for r in sample.collect()], quality.ORDER)
    pad = bytes([quality.START]) * (quality.ORDER - 1)
    for context in (b"the ", b"a", b"zzqx", b""):
        assert abs(sum(p((pad + context)[-4:] + bytes([b])) for b in range(256)) - 1) < 1e-9
    got = by_row(quality.perplexity(both, model, marks, block_bytes=40_000, wave_blocks=2, shard_rows=5_000).collect(), "doc_id", "log_perplexity")
    want = []
    for d, t in [*rows, *(r[:2] for r in EDGES)]:
        x = pad + (t or "").encode() + bytes([quality.END])
        want.append((d, -sum(math.log(p(x[i : i + quality.ORDER])) for i in range(len(x) - 4)) / (len(x) - 4) if t else None))
    assert len(got) == len(want)
    for (d, a), (e, b) in zip(sorted(got, key=repr), sorted(want, key=repr), strict=True):
        assert d == e and (a is None) == (b is None) and (a is None or abs(a - b) < 1e-5)
    scored = quality.classify(both, labels, size=30).collect()
    by_id = {r["doc_id"]: r for r in scored if r["doc_id"] is not None}
    own, trusted = {r["id"] for r in sample.collect()}, [by_id[r["doc_id"]] for r in labels.where("quality = 1").collect() if r["doc_id"] in by_id]
    quantile = lambda x, q: sorted(x)[max(0, math.ceil(q * len(x)) - 1)]

    def limits(column, lang):
        of = lambda lang, out: [r[column] for r in trusted if r[column] is not None and lang in (None, r["lang"]) and not (out and r["doc_id"] in own)]
        every = of(lang, False) if lang is not None and len(of(lang, False)) >= 50 else of(None, False)
        others = of(lang, True) if lang is not None and len(of(lang, False)) >= 50 and len(of(lang, True)) >= 50 else of(None, True)
        a, m, z, n = quantile(every, 0.001), quantile(every, 0.5), quantile(others, 0.995), quantile(others, 0.5)
        return a - 0.5 * (m - a), z + 0.5 * (z - n)

    for r in scored:
        low, high = limits("log_perplexity", r["lang"])
        repeats = limits("log_recurrence", r["lang"])[1]
        assert r["keep"] == (r["log_perplexity"] is not None and low <= r["log_perplexity"] <= high and (r["log_recurrence"] is None or r["log_recurrence"] <= repeats))
    got = {(r["doc_id"], r["text"]): r["keep"] for r in quality.classify(edges, labels).collect()}  # no trusted text among them
    assert not got[1001, ""] and not got[1002, None] and got[1007, "one"]
    assert quality.classify(nothing, labels).count() == 0


def test_quality_learns_from_all_trusted_rows(spark, docs):
    some = docs.select("doc_id", "text", "lang").where("text <> ''").orderBy("doc_id").limit(24)
    labels = some.select("doc_id", F.when(F.col("doc_id") % 4 < 3, 1).otherwise(0).alias("quality"))
    rows = some.withColumn("fold", quality.fold_of("doc_id")).collect()
    folds = [[r["text"].encode() for r in rows if r["fold"] == f and r["doc_id"] % 4 < 3] for f in (0, 1)]
    assert all(folds)
    models, pad = [brute_kneser_ney(texts, quality.ORDER) for texts in folds], bytes([quality.START]) * (quality.ORDER - 1)

    def log_perplexity(p, text):
        x = pad + text.encode() + bytes([quality.END])
        return -sum(math.log(p(x[i : i + quality.ORDER])) for i in range(len(x) - 4)) / (len(x) - 4)

    got = {r["doc_id"]: r for r in quality.classify(some, labels).collect()}
    values = {r["doc_id"]: [log_perplexity(p, r["text"]) for p in models] for r in rows}
    assert len(got) == len(rows) and all(abs(got[d]["log_perplexity"] - sum(v) / 2) < 1e-5 for d, v in values.items())
    trusted = [r for r in rows if r["doc_id"] % 4 < 3]
    means, unseen = (sorted(x) for x in zip(*[(sum(values[r["doc_id"]]) / 2, values[r["doc_id"]][1 - r["fold"]]) for r in trusted], strict=True))
    quantile = lambda x, q: x[max(0, math.ceil(q * len(x)) - 1)]
    low = means[0] - 0.5 * (quantile(means, 0.5) - means[0])
    high = unseen[-1] + 0.5 * (unseen[-1] - quantile(unseen, 0.5))
    assert all(low < v < high for v in (got[r["doc_id"]]["log_perplexity"] for r in trusted))
    scored = quality.perplexity(some, *[fit(quality.trusted_rows(some, quality.ids_of(labels), "doc_id").withColumn("fold", quality.fold_of("doc_id"))) for fit in (quality.fit, quality.fit_marks)], folds=2)
    assert all(abs(r["log_perplexity_gap"] - (values[r["doc_id"]][0] - values[r["doc_id"]][1]) / 2) < 1e-4 for r in scored.collect())
    named = lambda df: df.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert {r["doc_id"] for r in quality.trusted_rows(named(some), quality.ids_of(named(labels)), "doc_id").collect()} == {f"d{r['doc_id']}" for r in trusted}


def test_marks_against_words_one_by_one():
    rng = random.Random(5)
    for _ in range(50):
        words = [rng.choice("abcdefghijkl") for _ in range(rng.randint(0, 40))]
        seen = [next((back for back in range(1, min(quality.REACH, i) + 1) if words[i - back] == w), 0) for i, w in enumerate(words)]
        assert (quality.marks_of(" ".join(words)) & 0xFF).tolist() == [quality.ALPHABET // 2 + back for back in seen]


def test_quality_of_repeated_words(spark):
    rng = random.Random(1)
    words = [a + b for a in ("ba", "ke", "lo", "mi", "su") for b in ("n", "rt", "sh", "nd", "lly")]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    good = [(i, prose(rng.randint(30, 90)), "en") for i in range(300)]
    rows = good + [(1000, "ban " * 60, "en"), (1001, "kert " * 30 + "lond " * 30, "en"), (1002, prose(20) + " sully" * 60, "en"), (1003, "mish land baban " * 20, "en"), (1004, prose(60), "en"), (1005, " \n ", "en")]
    labels = spark.createDataFrame([(i, 1) for i, _, _ in good], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality.classify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), labels).collect()}
    assert not any(got[i]["keep"] for i in range(1000, 1004)) and got[1004]["keep"] and got[1005]["log_recurrence"] is None
    assert sum(got[i]["keep"] for i, _, _ in good) >= 295


def test_toxicity(spark, sf, docs, edges, nothing):
    labels = table(spark, sf, "labels").where("crc32(cast(doc_id as string)) % 4 <> 2").select("doc_id", "toxic")
    both = docs.select("doc_id", "text").unionAll(edges.select("doc_id", "text"))
    got = toxicity.score_toxicity(both, labels).collect()
    assert len(got) == docs.count() + len(EDGES) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1001, 1002, 1003)}) == 1
    assert len({r["score"] for r in toxicity.score_toxicity(edges, labels.limit(0)).collect()}) == 1
    assert toxicity.score_toxicity(nothing, labels).count() == 0


def test_clause_grammar():
    g = toxicity.Grammar({"idiot": 1.0})
    read = lambda text: {n: v > 0 for n, v in zip(toxicity.FEATURES, g.features(text), strict=True)}
    assert not any(read("a kind word. nothing else").values())
    assert read("an idiot")["insult"] and read("you idiot")["targeted"] and not read("you idiot")["insult"]
    assert read("idiot, you")["targeted"] and read("idiot you’re")["targeted"] and not read("idiot in a very long clause you")["targeted"] and not read("idiot. you")["targeted"]
    assert read("not an idiot")["negated"] and not read("not at all bad but an idiot")["negated"]
    assert read("they aren't idiot")["negated"] and read("they didn’t idiot")["negated"] and not read("they did idiot")["negated"]
    assert read("he said idiot")["reported"] and not read("he said. idiot")["reported"]
    assert read("kill you")["threat"] is False and read("you kill")["threat"]


def test_composition_is_the_cascade():
    """The composed table against running the transducers one after the other, over all short tag sequences."""
    import itertools

    parts = [toxicity.targets(), toxicity.negation(), toxicity.reported()]
    whole = toxicity.compose(toxicity.compose(*parts[:2]), parts[2])
    for tags in itertools.chain.from_iterable(itertools.product(toxicity.TAGS, repeat=n) for n in (1, 2, 3, 4, 5)):
        states, state = [0, 0, 0], 0
        for tag in tags:
            state, wrote, weight = whole.step(state, tag)
            product = 1.0
            for i, part in enumerate(parts):
                states[i], tag, w = part.step(states[i], tag)
                product *= w
            assert (wrote, weight) == (tag, product)


def test_lexicons_against_brute_force(spark):
    rng = random.Random(6)
    vocabulary = [a + b for a in "bdfgk" for b in ("an", "el", "ir", "o", "u")]
    data = []
    for i in range(120):
        toxic = int(i % 4 == 0)
        words = [rng.choice(vocabulary) for _ in range(30)]
        for _ in range(4 * toxic):
            words.insert(rng.randrange(30), rng.choice(("grub", "oaf")))
        data.append((toxic, rng.randrange(4), " ".join(words)))
    got = toxicity.learn_insults(spark.createDataFrame(data, "toxic int, part int, text string"))
    for i, lexicon in enumerate(got):
        before, rows = {0: defaultdict(set), 1: defaultdict(set)}, [r for r in data if r[1] != i]
        for toxic, _, text in rows:
            words = text.split()
            for a, b in zip(["", *words], words, strict=False):
                before[toxic][b].add(a)
        scale = (sum(not r[0] for r in rows) + 1) / (sum(r[0] for r in rows) + 1)
        odds = {w: (len(before[1][w]) + 0.5) / (len(before[0][w]) + 0.5) * scale for w in before[1] if len(before[1][w]) >= 5}
        assert lexicon == pytest.approx({w: min(math.log(x), 8) / 4 for w, x in odds.items() if x >= 12}) and set(lexicon) == {"grub", "oaf"}


def test_toxicity_of_ids_labelled_twice(spark):
    docs = spark.createDataFrame([(i, "you grub" if i % 3 == 0 else "a kind word", "x") for i in range(90)] * 2, "doc_id long, text string, part string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)] + [(0, 0)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, labels, keep=("doc_id", "part")).collect()
    assert len(got) == 180 and {r["part"] for r in got} == {"x"} and len({(r["doc_id"], r["score"]) for r in got}) == 90
