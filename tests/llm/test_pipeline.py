"""The pipeline's stages against brute force on a small table, with odd rows and columns of clashing names."""

import random
import zlib

import pytest

import corpus_pipeline
from fieldgeo.llm import quality
from fieldgeo.llm.common import table, words_of

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, part string, keep int, n_lines string, __id long, row double"


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory):
    """A small corpus folder: some of the given documents, copies, repeated rows, leaks, shared lines, and odd rows."""
    out = str(tmp_path_factory.mktemp("corpus"))
    labels, bench = table(spark, sf, "labels"), [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars").orderBy("doc_id").collect()]
    rng = random.Random(11)
    base = [r for r in rows if r[1] and len(words_of(r[1])) > 60]
    made = []
    for i, (_, text, lang, source, _) in enumerate(rng.sample(base, 20)):
        words = text.split(" ")
        words[rng.randrange(len(words))] = "changed"
        made.append((90_000 + 2 * i, " ".join(words), lang, source))
        made.append((90_001 + 2 * i, text + " " + bench[i % len(bench)][1], lang, source))
    made += [(95_000 + i, f"{base[i][1]}\nRead more of this on our site today", "en", f"site{i}") for i in range(12)]
    odd = [(99_000, None, None, None), (99_001, "", "en", "s"), (None, base[0][1] + " null", "en", "s"), (None, base[0][1] + " null", "en", "s"), (99_002, base[1][1], "en", None), (99_002, base[1][1], "en", None), (99_003, " \t\n", "fr", "s")]
    everything = [(*r, "p", 7, "own", 8, 0.5) for r in rows] + [(d, t, g, s, len(t or ""), "p", 7, "own", 8, 0.5) for d, t, g, s in made + odd]
    spark.createDataFrame(everything, COLUMNS).repartition(3).write.parquet(f"{out}/documents.parquet")
    labels.write.parquet(f"{out}/labels.parquet")
    table(spark, sf, "benchmark").write.parquet(f"{out}/benchmark.parquet")
    return out


def shingles(text, k):
    w = words_of(text)
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def without_boilerplate(rows):
    sites = {}
    for r in rows:
        for line in set((r["text"] or "").split("\n")) if r["text"] is not None else ():
            if r["source"] is not None:
                sites.setdefault(line.strip(" "), set()).add(r["source"])
    gone = {x for x, s in sites.items() if x and len(s) >= (16 if len(x) < 12 else 8)}
    out = []
    for r in rows:
        new = dict(r)
        if r["text"] is not None:
            lines = r["text"].split("\n")
            left = [x for x in lines if x.strip(" ") not in gone]
            if len(left) < len(lines):
                new |= {"text": "\n".join(left), "n_chars": len("\n".join(left))}
        out.append(new)
    return out


def one_of_each(rows):
    sets = [shingles(r["text"], 5) for r in rows]
    lead = list(range(len(rows)))

    def find(i):
        while lead[i] != i:
            i = lead[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and min(len(a), len(sets[j])) * 100 >= 80 * max(len(a), len(sets[j])) and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                lead[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i) if sets[i] else ("empty", i), []).append(r["doc_id"])
    return sorted((min((d for d in g if d is not None), default=None) for g in groups.values()), key=repr)


def without_leaks(rows, bench):
    items = [(shingles(t, min(5, len(words_of(t)))), min(5, len(words_of(t)))) for _, t in bench if words_of(t)]
    return [r for r in rows if not any(len(words_of(r["text"])) >= k and len(s & shingles(r["text"], k)) >= 0.8 * len(s) for s, k in items)]


def key(r):
    return repr((r["doc_id"], r["text"], r["n_chars"]))


def test_stages_against_brute_force(spark, folder):
    docs = table(spark, folder, "documents")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality"](spark, docs, folder)
    assert kept.columns == docs.columns
    first = [r.asDict() for r in kept.collect()]
    assert {r["keep"] for r in first} == {7} and {r["part"] for r in first} == {"p"} and all(r["text"] for r in first)
    good = {r["doc_id"] for r in table(spark, folder, "labels").where("quality = 1").collect()} & {r["doc_id"] for r in docs.collect()}
    assert len(good - {r["doc_id"] for r in first}) <= max(2, 0.03 * len(good))
    frame = spark.createDataFrame([tuple(r.values()) for r in first] + [(99_000, None, None, None, 0, "p", 7, "own", 8, 0.5), (99_003, " \t\n", "fr", "s", 3, "p", 7, "own", 8, 0.5)], docs.schema)

    lines = stages["lines"](spark, frame, folder)
    second, want = [r.asDict() for r in lines.collect()], without_boilerplate([r.asDict() for r in frame.collect()])
    assert lines.columns == docs.columns and sorted(map(key, second)) == sorted(map(key, want)) and {r["n_lines"] for r in second} == {"own"}

    frame = spark.createDataFrame([tuple(r.values()) for r in second], docs.schema)
    third = [r.asDict() for r in stages["near duplicates"](spark, frame, folder).collect()]
    assert sorted((r["doc_id"] for r in third), key=repr) == one_of_each(second)

    frame = spark.createDataFrame([tuple(r.values()) for r in third], docs.schema)
    bench = [tuple(r) for r in table(spark, folder, "benchmark").select("item_id", "text").collect()]
    fourth = [r.asDict() for r in stages["benchmark leaks"](spark, frame, folder).collect()]
    assert sorted(map(key, fourth)) == sorted(map(key, without_leaks(third, bench)))
    assert stages["lines"](spark, frame.drop("n_chars"), folder).columns == [c for c in docs.columns if c != "n_chars"]


def test_quality_stage_learns_from_all_trusted_rows(spark, tmp_path, monkeypatch):
    """Every byte of every trusted document is counted, of more documents than the sample took, and all of them set the limits."""
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(3, 12))), rng.choice(["en", "fr"])) for i in range(8_000)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 8 > 0)) for i, *_ in rows], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    trusted, counted, limited = [r for r in rows if r[0] % 8 > 0], [], []
    count, limits = quality.count_ngrams, quality.limits_of
    monkeypatch.setattr(quality, "count_ngrams", lambda *a: (counted.append(sum(r["c"] for r in count(*a).collect())), count(*a))[1])
    monkeypatch.setattr(quality, "limits_of", lambda scored, *a, **k: (limited.append((scored.count(), scored.where("own").count())), limits(scored, *a, **k))[1])
    corpus_pipeline.quality_stage(spark, table(spark, str(tmp_path), "documents"), str(tmp_path)).count()
    assert counted == [sum(len(t) + 1 for _, t, _ in trusted)]
    assert limited == [(len(trusted), 0)] * 2


def test_run_packs_what_the_stages_keep(spark, folder):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    docs = table(spark, folder, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema)
    t = Tokenizer.from_file(path("word_bpe_49k.json"))
    want = []
    for r in docs.collect():
        data = b"".join(i.to_bytes(4, "little") for i in [*t.encode(r["text"] or "", add_special_tokens=False).ids, 1])
        want += [(r["doc_id"], at, zlib.crc32(data[4 * at : 4 * at + 8192])) for at in range(0, len(data) // 4, 2048)]
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted(((r["doc_id"], r["start"], r["ids_crc32"]) for r in got), key=repr) == sorted(want, key=repr)
    assert corpus_pipeline.run(spark, folder).groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def test_stages_of_nothing(spark, folder):
    nothing = table(spark, folder, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, folder).count() == 0
