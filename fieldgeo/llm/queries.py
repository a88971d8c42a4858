"""The registered queries of the corpus operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, fim, jaccard_join, langid, line_dedup, lm_score, packing, quality, resample, token_counts, topk, toxicity
from .common import prepare, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.classify(docs, table(spark, sf_dir, "labels"), columns=["doc_id", "lang"]).select("doc_id", "lang", "log_perplexity", "keep")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(prepare(spark), sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    docs = docs.withColumn("held_out", held_out)
    return langid.identify(docs, docs.where(~F.col("held_out")).select("text", "lang"), keep=("doc_id", "held_out"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(prepare(spark), sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(table(prepare(spark), sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(prepare(spark), sf_dir, "embeddings"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = jaccard_join.similar_groups(table(prepare(spark), sf_dir, "documents"), k=3, percent=90)
    return groups.select("doc_id", "n_shingles", "component_id", "class_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    held_out = lambda: F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))
    learn = table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "toxic")
    return toxicity.score_toxicity(docs.withColumn("held_out", held_out()), learn, keep=("doc_id", "held_out"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fim.fill_in_middle(table(prepare(spark), sf_dir, "documents"))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.decode(bpe.encode(table(prepare(spark), sf_dir, "documents")))
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_line_dedup, op2_quality_classifier, op3_packing, op4_language_id, op5_token_counts, op6_lm_scoring, op7_decontamination, op8_exact_topk, op9_jaccard_join, op10_toxicity)
    found += (op11_fill_in_middle, op12_importance_resampling, op13_bpe)
    return {f.__name__: f for f in found}


LINE_DEDUP = """
with lines as (select source, unnest(list_distinct(list_transform(string_split(text, chr(10)), lambda x: trim(x)))) as line from documents),
gone as (select coalesce(list(line), []) as all_gone from (select line from lines where line <> '' group by line having count(distinct source) >= case when length(line) < 12 then 16 else 8 end)),
marked as (select doc_id, text, string_split(text, chr(10)) as parts, all_gone from documents, gone)
select doc_id,
  case when text is null then null else array_to_string(list_filter(parts, lambda x: not list_contains(all_gone, trim(x))), chr(10)) end as text,
  coalesce(len(parts), 0)::bigint as n_lines,
  coalesce(len(list_filter(parts, lambda x: list_contains(all_gone, trim(x)))), 0)::bigint as n_removed
from marked
"""

WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"

DECONTAMINATION = f"""
with d as (select doc_id, {WORDS} as w from documents), b as (select item_id, {WORDS} as w from benchmark where text is not null),
q as (select item_id, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' ')))) as s, len(w) as n from b where len(w) > 0),
sizes as (select item_id, count(*) as n from q group by item_id),
p as (select doc_id, unnest(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) as s from d where len(w) >= 5)
select doc_id, item_id, count(*)::double / any_value(sizes.n) as containment
from p join q using (s) join sizes using (item_id) group by doc_id, item_id having count(*) >= 0.8 * any_value(sizes.n)
"""

TOPK = """
with v as (select row_number() over () as row, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.row as query, q.vec_id as query_id, c.vec_id, c.row, list_inner_product(q.v::double[], c.v::double[])::bigint as score from v q join v c on q.row <> c.row and len(q.v) = len(c.v) where q.vec_id % 20 = 0)
select query_id, rank::int as rank, vec_id, score from (select *, row_number() over (partition by query order by score desc, vec_id) as rank from s) where rank <= 20
"""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

FILL_IN_MIDDLE = r"""
with d as (select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(doc_id::varchar, '')) as h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as w from documents),
k as (select *, len(w)::bigint as n, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::bigint) as r from d),
c as (select *, least(r[1] % (n + 1), r[2] % (n + 1)) as a, greatest(r[1] % (n + 1), r[2] % (n + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or r[3] % 100 >= 50 then 'plain' when r[4] % 100 < 80 then 'spm' else 'psm' end as form from k),
p as (select *, array_to_string(w[1:a], '') as pre, array_to_string(w[a + 1:b], '') as mid, array_to_string(w[b + 1:], '') as suf from c)
select doc_id, n, form, case when form <> 'plain' then length(pre) end::bigint as prefix_chars, case when form <> 'plain' then length(mid) end::bigint as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
  sha256(text) as restored_sha256 from p
"""

RESAMPLING = f"""
with crc as (select list(v order by i) as t from (select i, list_reduce(list_prepend(i::bigint, [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) as v from range(256) x(i))),
d as (select row_number() over () as row, doc_id, regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
b as (select regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
dw as (select row, x as word, count(*) as n from d, unnest(w) u(x) group by all),
bw as (select x as word, count(*) as n from b, unnest(w) u(x) group by all),
words as (select word, hex(encode(word)) as h from (select word from dw union select word from bw)),
coded as (select word, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint)),
    lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1]))) % 10000 as bucket from words, crc),
s as (select bucket, sum(n)::double as s from dw join coded using (word) group by bucket), t as (select bucket, sum(n)::double as t from bw join coded using (word) group by bucket),
gains as (select bucket, floor(1000 * ln((coalesce(t, 0) + 1) * ((select coalesce(sum(s), 0) from s) + 10000) / ((coalesce(s, 0) + 1) * ((select coalesce(sum(t), 0) from t) + 10000))))::bigint as gain from s full join t using (bucket)),
weights as (select row, sum(n * gain)::bigint as weight from dw join coded using (word) join gains using (bucket) group by row),
scored as (select row, doc_id, len(w)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296))))::bigint as score from d left join weights using (row)),
ranked as (select *, case when n_features >= 20 then row_number() over (partition by n_features >= 20 order by score desc, doc_id nulls last) end as place from scored)
select doc_id, n_features, weight, score, case when place <= (select count(*) from scored where n_features >= 20) * 10 // 100 then place end::bigint as rank from ranked
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": LINE_DEDUP, "op7_decontamination": DECONTAMINATION, "op8_exact_topk": TOPK, "op11_fill_in_middle": FILL_IN_MIDDLE, "op12_importance_resampling": RESAMPLING}
