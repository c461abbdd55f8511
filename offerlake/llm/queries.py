"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.llm import bpe_trie, embed_dedup, exact_topk, katz_lm, lang_id, line_crf, ngram_jaccard, packing, secret_scan, source_mix, spectral_whiten, token_align, url_filter
from offerlake.llm.common import crc_of_id, table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict", "score")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op4_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_trie.digests(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary("byte_bpe_50k.json"))


def op5_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return linked.select("vec_id", "n_links", "component_id", "kept")


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op7_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = katz_lm.score(docs, crc_of_id(F.col("doc_id")) % 5 != 1)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.similar(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = (crc_of_id(F.col("doc_id")) % 5 == 0).alias("held_out")
    model = lang_id.fit(docs.where(crc_of_id(F.col("doc_id")) % 5 != 0))
    labelled = lang_id.predict(docs.select("doc_id", "text"), model)
    return labelled.select("doc_id", held_out, "lang_pred", F.col("lang_score").alias("score"), F.size("lang_spans").alias("n_spans"))


def op10_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    held_out = (crc_of_id(F.col("doc_id")) % 4 == 2).alias("held_out")
    model = line_crf.fit(docs, labels, crc_of_id(F.col("id")) % 4 != 2)
    scored = line_crf.score(docs, model, out="score")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_align.align(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")).select("doc_id", *token_align.RESULTS)


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = source_mix.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op13_spectral_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectral_whiten.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_filter, op2_secret_scan, op3_packing, op4_bpe_trie, op5_embed_dedup, op6_exact_topk,
                                op7_katz_lm, op8_ngram_jaccard, op9_lang_id, op10_line_crf, op11_token_align, op12_source_mix, op13_spectral_whiten)
}
ORACLE: dict[str, str] = {
    "op5_embed_dedup": """
with recursive vectors as (
  select vec_id, row_number() over () as r, list_transform(embedding, lambda x: x::double) as v from embeddings
), good as (
  select * from vectors where vec_id is not null and len(v) > 0 and len(list_filter(v, lambda x: x is not null and isfinite(x))) = len(v)
    and list_inner_product(v, v) > 0
), links as (
  select a.r as a, b.r as b from good a join good b on a.r <> b.r
    and list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v)) / sqrt(list_inner_product(b.v, b.v)) >= 0.9
), reach(r, root, id) as (
  select r, r, vec_id from vectors union select l.b, x.root, x.id from reach x join links l on x.r = l.a
), named as (
  select r, min(id) as component_id from reach group by r
), counted as (
  select a as r, count(*) as n from links group by a
)
select v.vec_id, coalesce(c.n, 0)::bigint as n_links, n.component_id, v.vec_id = n.component_id as kept
from vectors v join named n using (r) left join counted c using (r)""",
    "op8_ngram_jaccard": """
with recursive words as (
  select doc_id, row_number() over () as r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
  from documents
), sets as (
  select doc_id, r, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
         else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) end as s
  from words
), classes as (
  select min(r) as node, min(doc_id) as least, k, any_value(s) as s, len(any_value(s)) as n
  from (select *, md5(array_to_string(list_sort(s), '|')) as k from sets where len(s) > 0) group by k
), grams as (
  select node, n, unnest(s) as g from classes
), links as (
  select a.node as a, b.node as b from grams a join grams b on a.g = b.g and a.node < b.node
    and 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
  group by a.node, b.node, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))
), edges as (
  select a, b from links union all select b, a from links
), reach(node, root) as (
  select node, node from classes union select e.b, r.root from reach r join edges e on r.node = e.a
), roots as (
  select node, min(root) as root from reach group by node
), named as (
  select c.k, min(c.least) over (partition by r.root) as component_id from classes c join roots r using (node)
)
select s.doc_id, len(s.s)::bigint as n_shingles, coalesce(n.component_id, s.doc_id) as component_id
from sets s left join named n on len(s.s) > 0 and md5(array_to_string(list_sort(s.s), '|')) = n.k""",
    "op6_exact_topk": """
with good as (
  select vec_id, row_number() over () as r, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
  where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
), pairs as (
  select q.vec_id as query_id, q.r as query_row, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
  from good q join good c on q.r <> c.r where q.vec_id % 50 = 0
), ranked as (
  select *, row_number() over (partition by query_row order by score desc, vec_id) as rank from pairs
)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 5""",
    "op12_source_mix": """
with docs as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
    greatest(coalesce(length(regexp_replace(text, '[^A-Za-z\\x{80}-\\x{10FFFF}]+', '', 'g')) / nullif(length(text), 0), 0), 0.05::double) as quality,
    (('0x' || substr(md5('mix' || coalesce(doc_id::varchar, '~' || md5(coalesce(text, '')))), 1, 13))::bigint::double + 0.5) / 4503599627370496.0::double as u
  from documents
), keyed as (
  select *, -ln(u) / quality as k from docs
), sources as (
  select source, sum(size)::bigint as source_size from keyed group by source
), weighed as (
  select *, [1.0::double, 2.0, 3.0][((row_number() over (order by source nulls last)) - 1) % 3 + 1] as weight from sources
), levels as (
  select *, row_number() over o as i,
    (sum(source_size) over () - coalesce(sum(3 * source_size) over (o rows between unbounded preceding and 1 preceding), 0))::double
    / (sum(weight) over () - coalesce(sum(weight) over (o rows between unbounded preceding and 1 preceding), 0)) as level
  from weighed window o as (order by source_size / weight, source nulls last)
), reached as (
  select arg_min(level, i) as level from levels where weight * level <= 3 * source_size
), plan as (
  select source, source_size, coalesce(least(weight * r.level, (3 * source_size)::double), (3 * source_size)::double) as target
  from levels left join reached r on true
), budgets as (
  select *, coalesce(floor(target / nullif(source_size, 0)), 0)::bigint as epochs from plan
), placed as (
  select d.doc_id, d.size, b.source_size, b.target, b.epochs, round(b.target - b.epochs * b.source_size)::bigint as budget,
    sum(d.size) over (partition by d.source order by d.k, d.doc_id nulls last, d.size rows between unbounded preceding and current row) - d.size as start
  from keyed d join budgets b on d.source is not distinct from b.source
)
select doc_id, size, source_size, target, (epochs * size + least(greatest(budget - start, 0), size))::bigint as taken from placed""",
}
