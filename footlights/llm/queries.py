"""The corpus operators as registered queries: thin, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .archive import new_archive_path, read_archive, write_archive
from .common import stash, table
from .decontaminate import contamination
from .jaccard import near_duplicates
from .language import fit_dictionaries, held_out, predict_language
from .merkle import fold, merkle_manifest, proof_digest
from .negatives import hard_negatives
from .packing import pack, token_pieces
from .pii import find_pii, fit_booster, pii_digest, propose
from .quality import fit_line_model, labelled_documents, quality
from .rules import fit_rules, labelled_statistics, quality_scores
from .substrings import remove_repeats
from .tokens import count_tokens
from .urls import judge_urls, judge_urls_sql, pattern_rules, prefix_rules


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; dictionaries learned only from documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out())
    model = fit_dictionaries(docs.where(~F.col("held_out") & F.col("doc_id").isNotNull()))
    found = predict_language(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict for every document; the line model is fitted on labelled documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_line_model(labelled_documents(docs, table(spark, sf_dir, "labels")))
    return quality(docs, model).drop("text")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces in sequences of at most 4096 tokens."""
    return pack(token_pieces(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json")))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold at least 0.8 of a benchmark item's words in tiles of five words or more."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("version")


def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to a content-addressed archive and read back."""
    path = new_archive_path(spark)
    write_archive(table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's address."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, prefix_rules(spark), pattern_rules(spark)).drop("url")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of repeated 200-byte strings."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document; the trees learn from the candidates of all documents."""
    proposed = stash(propose(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"), "candidates")
    return pii_digest(find_pii(proposed, fit_booster(proposed)))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return count_tokens(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether its row, tampered with if 5 divides crc32(doc_id), is verified."""
    docs = table(spark, sf_dir, "documents")
    capitals, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = merkle_manifest(docs, claimed={"text": F.when(tampered, F.translate("text", capitals, small)).otherwise(F.col("text"))})
    found = found.withColumn("proof_sha256", proof_digest(F.col("before"), F.col("after"))).withColumn("folded_root", fold(F.col("claimed_leaf"), F.col("before"), F.col("after")))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; the rules learn from labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_rules(*labelled_statistics(docs, table(spark, sf_dir, "labels")))
    found = quality_scores(docs.withColumn("held_out", held_out()), model)
    return found.select("doc_id", "held_out", "score", "predicted")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every row whose id 50 divides, against all rows; labels of ids that 7 divides are moved by one."""
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_language_id, op2_quality_rules, op3_best_fit_packing, op4_decontamination, op5_warc_archive, op6_url_filters, op7_suffix_dedup, op8_personal_data, op9_jaccard_join, op10_token_counts, op11_merkle_manifest, op12_quality_classifier, op13_hard_negatives)}


_WARC_SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
k as (select *, octet_length(encode(html)) as n, max(page_id) over (partition by html) as keeper from p)
select page_id, n as payload_bytes, sha1(html) as payload_digest,
  case when n >= 1000 and page_id <> keeper then 'revisit' else 'response' end as record_type,
  case when n >= 1000 and page_id <> keeper then keeper end as refers_to, true as verified
from k"""

_MERKLE_SQL = """
with recursive crc_table as (
  select list_transform(range(256), lambda n: list_reduce([n] || range(8), lambda c, i: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end)) as t),
d as (select *, coalesce(xor(list_reduce([4294967295::bigint] || list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) % 5 = 0, false) as tampered from documents, crc_table),
e as (select doc_id, source, tampered, text, 
    coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head from d),
leaves as (select doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    sha256(head || coalesce(strlen(text) || ':' || case when tampered then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end, '-')) as claimed from e),
placed as (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos from leaves),
nodes as (
  select 0 as level, source, pos, leaf as digest, count(*) over (partition by source) as n from placed
  union all
  select level + 1, source, pos // 16, sha256(string_agg(digest, '' order by pos)), ceil(any_value(n) / 16)::bigint from nodes where n > 1 group by level, source, pos // 16),
subroots as (select source, digest as subroot, row_number() over (order by source nulls first) - 1 as place from nodes where n = 1),
tops as (
  select 0 as level, place as pos, subroot as digest, count(*) over () as n from subroots
  union all
  select level + 1, pos // 16, sha256(string_agg(digest, '' order by pos)), ceil(any_value(n) / 16)::bigint from tops where n > 1 group by level, pos // 16),
steps as (
  select 0 as upper, level, a.source, a.pos as pos, coalesce(string_agg(b.digest, '' order by b.pos) filter (b.pos < a.pos), '') as before, coalesce(string_agg(b.digest, '' order by b.pos) filter (b.pos > a.pos), '') as after
  from nodes a join nodes b using (level) where a.n > 1 and a.source is not distinct from b.source and a.pos // 16 = b.pos // 16 group by level, a.source, a.pos
  union all
  select 1, level, null, a.pos, coalesce(string_agg(b.digest, '' order by b.pos) filter (b.pos < a.pos), ''), coalesce(string_agg(b.digest, '' order by b.pos) filter (b.pos > a.pos), '')
  from tops a join tops b using (level) where a.n > 1 and a.pos // 16 = b.pos // 16 group by level, a.pos),
ways as (
  select p.source, p.pos, list({'before': s.before, 'after': s.after} order by s.upper, s.level) as way
  from placed p join subroots r on p.source is not distinct from r.source
  join steps s on s.upper = 0 and s.source is not distinct from p.source and s.pos = p.pos // (16 ** s.level)::bigint or s.upper = 1 and s.pos = r.place // (16 ** s.level)::bigint
  group by p.source, p.pos),
folded as (
  select p.source, p.pos, 1 as k, p.claimed as digest, w.way from placed p left join ways w on p.source is not distinct from w.source and p.pos = w.pos
  union all
  select source, pos, k + 1, sha256(way[k].before || digest || way[k].after), way from folded where k <= len(way))
select p.doc_id, p.leaf, r.subroot, t.digest as root, sha256(array_to_string(list_transform(coalesce(f.way, []), lambda s: s.before || s.after), '')) as proof_sha256,
  f.digest as folded_root, f.digest = t.digest as verified
from placed p join subroots r on p.source is not distinct from r.source join tops t on t.n = 1
join folded f on p.source is not distinct from f.source and p.pos = f.pos and f.k = coalesce(len(f.way), 0) + 1"""


_NEGATIVES_SQL = """
with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings where vec_id is not null and label is not null and embedding is not null and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
scored as (select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score from e a join e b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
positives as (select anchor_id, other_id as positive_id, score as positive_score from scored where same qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5),
ranked as (select p.*, other_id as negative_id, score as negative_score, row_number() over (partition by anchor_id, positive_id order by score desc, other_id) as rank
  from positives p join scored s using (anchor_id) where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from ranked where rank <= 3"""


def oracle_sql() -> dict[str, str]:
    return {"op5_warc_archive": _WARC_SQL, "op6_url_filters": judge_urls_sql(), "op11_merkle_manifest": _MERKLE_SQL, "op13_hard_negatives": _NEGATIVES_SQL}
