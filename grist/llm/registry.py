"""Queries of this subpackage, ``QUERIES``, and their DuckDB SQL, ``ORACLES``.

Each query applies its operator, with the parameters used in production, to
the whole table it is meant for, and derives the digest columns that its
contract asks for from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grist.llm import (bpe, collocations, html_extract, kneser_ney, lattice_lm, licenses, mixing, mtree, quality_rules, rank_profiles, simhash,
                       substring, whitening)
from grist.llm.common import materialize, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extract.extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents", "doc_id", "text")
    # one scan of the texts; the fit and the verdicts read the counts
    stats = materialize(quality_rules.text_statistics(documents).drop("text"), "rules")
    rules = quality_rules.learn(stats, read(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality_rules.apply(stats, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


@query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    documents = read(spark, sf_dir, "documents", "doc_id", "text")
    coded = bpe.decode(bpe.encode(documents, path).drop("text"), path)
    return coded.select(
        "doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents", "doc_id", "text")
    return substring.remove_repeats(documents).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = simhash.groups(read(spark, sf_dir, "documents", "doc_id", "text"))
    return grouped.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))


@query
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lattice_lm.score_documents(read(spark, sf_dir, "documents", "doc_id", "text", "lang"), public_tokenizers.path("piece_bpe_32k.model"))
    return scored.withColumnRenamed("id", "doc_id")


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    judged = kneser_ney.judge(*kneser_ney.fit(documents, read(spark, sf_dir, "labels", "doc_id", "quality")))
    return judged.select(F.col("id").alias("doc_id"), F.col("language").alias("lang"), "perplexity", "threshold", "kept")


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.recognise(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.array_join("sentences", ",").alias("sentences"), F.array_join("licences", ",").alias("licences"),
                        F.size("sentences").cast("long").alias("n_known"))


ORACLES["op5_license_scan"] = licenses.oracle()


@query
def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("id") % 50 == 0)


ORACLES["op3_exact_top_k"] = """
    with whole as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
                   where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    scored as (select q.vec_id as query_id, w.vec_id, list_inner_product(q.v, w.v)::bigint as score
               from whole q join whole w on w.vec_id <> q.vec_id where q.vec_id % 50 = 0)
    select query_id, rank::int as rank, vec_id, score
    from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored) where rank <= 5"""

ORACLES["op7_substring_dedup"] = """
    with words as (select doc_id, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
                   from documents where text is not null),
    starts as (select doc_id, w, unnest(range(1, len(w) - 48)) as p from words),
    windows as (select doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) as h from starts),
    firsts as (select h, min(doc_id) as first from windows group by h),
    gone as (select distinct doc_id, unnest(range(p, p + 50)) as p from windows join firsts using (h) where first < doc_id),
    lists as (select doc_id, list(p) as ps from gone group by doc_id),
    kept as (select doc_id, len(w) as n, coalesce(len(ps), 0) as r,
                    case when ps is null then w else list_filter(w, lambda x, i: not list_contains(ps, i)) end as k
             from words left join lists using (doc_id))
    select d.doc_id, coalesce(n, 0)::bigint as n_words, coalesce(r, 0)::bigint as n_removed,
           sha256(coalesce(array_to_string(k, ' '), '')) as kept_sha256
    from documents d left join kept using (doc_id)"""


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(spark, sf_dir, "documents", "text", "lang")).withColumnRenamed("language", "lang")


ORACLES["op11_collocations"] = collocations.oracle()


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings", "vec_id", "embedding")).withColumnRenamed("id", "vec_id")


@query
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    out = rank_profiles.held_out("doc_id")
    profiles = rank_profiles.learn(documents.filter(~out))
    return rank_profiles.predict(documents.drop("lang"), profiles).select(
        "doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "lang_pred", "score")


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
