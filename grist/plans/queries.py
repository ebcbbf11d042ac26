"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables in full (no id subsets, prefixes or row
caps); limits appear only where they are the feature (sampling, top-k).
Column names match the SQL oracles in ``grist.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grist.functions import text as T
from grist.functions import treebank
from grist.operators import classify as C
from grist.operators import exact, linear, minhash, quality, sampling, setjoin, tokens
from grist.plans import audit as AU
from grist.plans import curate as X
from grist.session import cut_lineage, read_table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

URL_PREFIX = "https://mirror.example.org/crawl/"


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def docs(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", list(cols) or None)


# --- projections -------------------------------------------------------------

@query("mask_emails")
def q_mask_emails(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    return d.select("doc_id", T.mask_emails(F.col("text")).alias("masked"),
                    T.count_emails(F.col("text")).alias("n_emails"))


@query("mask_phones")
def q_mask_phones(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    return d.select("doc_id", T.mask_phones(F.col("text")).alias("masked"),
                    T.count_phones(F.col("text")).alias("n_phones"))


@query("mask_ips")
def q_mask_ips(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    return d.select("doc_id", T.mask_ips(F.col("text")).alias("masked"),
                    T.count_ips(F.col("text")).alias("n_ips"))


@query("mask_pii")
def q_mask_pii(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    masked, ne, np_, ni = T.mask_pii_with_counts(F.col("text"))
    return d.select("doc_id", masked.alias("masked"), ne.alias("n_emails"),
                    np_.alias("n_phones"), ni.alias("n_ips"))


@query("mask_conversations")
def q_mask_conversations(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "text"])
    masked, ne, np_, ni = T.mask_pii_with_counts(F.col("text"))
    return c.select("conv_id", "turn", masked.alias("masked"), ne.alias("n_emails"),
                    np_.alias("n_phones"), ni.alias("n_ips"))


@query("normalize_text")
def q_normalize_text(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    return d.select("doc_id", T.normalize_for_dedup(F.col("text")).alias("norm"))


@query("shingles")
def q_shingles(spark, sf_dir):
    d = T.with_shingles(docs(spark, sf_dir, "doc_id", "text"), "text", 2)
    return d.select("doc_id", F.size("shingles").cast("bigint").alias("n_shingles"), "shingles")


@query("html_to_text")
def q_html_to_text(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages", ["page_id", "html"])
    return p.select("page_id", T.html_to_text(F.col("html")).alias("text"))


@query("url_prefix")
def q_url_prefix(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages", ["page_id", "url"])
    path = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(.*)$", 1)
    return p.select("page_id", F.concat(F.lit(URL_PREFIX), F.regexp_replace(path, "^/", ""))
                    .alias("fetch_url"))


# --- rules -------------------------------------------------------------------

@query("word_stats")
def q_word_stats(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    s = quality.rule_stats(F.col("text"))
    return d.select("doc_id", s["n_words"].alias("n_words"),
                    s["n_word_chars"].alias("n_word_chars"),
                    s["n_alpha_words"].alias("n_alpha_words"))


@query("treebank_words")
def q_treebank_words(spark, sf_dir):
    """Treebank tokens of every text, blanks between them, and their counts."""
    d = docs(spark, sf_dir, "doc_id", "text").withColumn("w", F.explode(F.array(treebank.tokens(F.col("text")))))
    stats = treebank.word_stats(F.array_join("w", " "))
    return d.select("doc_id", F.array_join("w", " ").alias("words"), *[c.alias(n) for n, c in stats.items()])


@query("line_stats")
def q_line_stats(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    s = quality.rule_stats(F.col("text"))
    return d.select("doc_id", s["n_lines"].alias("n_lines"),
                    s["n_ellipsis_lines"].alias("n_ellipsis_lines"))


@query("gopher_filter")
def q_gopher_filter(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    masked = d.select("doc_id", T.mask_pii(F.col("text")).alias("text"))
    out = quality.gopher_filter(masked)
    return out.select("doc_id", "rule_failed", "passes")


@query("gopher_filter_treebank")
def q_gopher_filter_treebank(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    masked = d.select("doc_id", T.mask_pii(F.col("text")).alias("text"))
    return quality.gopher_filter(masked, tokens="treebank").select("doc_id", "n_words", "n_word_chars", "n_alpha_words", "rule_failed", "passes")


# --- exact dedup -------------------------------------------------------------

@query("line_explode")
def q_line_explode(spark, sf_dir):
    return exact.explode_lines(docs(spark, sf_dir, "doc_id", "text"))


@query("line_counts")
def q_line_counts(spark, sf_dir):
    return exact.line_counts(exact.explode_lines(docs(spark, sf_dir, "doc_id", "text")))


@query("exact_line_dedup")
def q_exact_line_dedup(spark, sf_dir):
    return exact.exact_line_dedup(docs(spark, sf_dir, "doc_id", "text"))


@query("exact_doc_dedup")
def q_exact_doc_dedup(spark, sf_dir):
    return exact.exact_doc_dedup(docs(spark, sf_dir, "doc_id", "text"))


@query("exact_doc_dedup_first")
def q_exact_doc_dedup_first(spark, sf_dir):
    return exact.exact_doc_dedup(docs(spark, sf_dir, "doc_id", "text"), keep="first")


# --- fuzzy dedup -------------------------------------------------------------

MH_DEFAULT = minhash.MinHashParams(num_hashes=10, num_bands=2, ngrams=2, jaccard_threshold=0.8)
SIMILAR_PERCENT = 80
MH_WIDE = minhash.MinHashParams(num_hashes=100, num_bands=10, ngrams=5, jaccard_threshold=0.8)


def _sigs(spark, sf_dir, params=MH_DEFAULT):
    return minhash.signatures(docs(spark, sf_dir, "doc_id", "text"), params)


@query("minhash_signature")
def q_minhash_signature(spark, sf_dir):
    return _sigs(spark, sf_dir)


@query("minhash_signature_wide")
def q_minhash_signature_wide(spark, sf_dir):
    return _sigs(spark, sf_dir, MH_WIDE)


@query("lsh_bands")
def q_lsh_bands(spark, sf_dir):
    return minhash.lsh_bands(_sigs(spark, sf_dir), MH_DEFAULT)


@query("lsh_edges")
def q_lsh_edges(spark, sf_dir):
    # signatures are read by the buckets and by the edges: written once
    return minhash.bucket_edges(minhash.lsh_bands(cut_lineage(_sigs(spark, sf_dir)), MH_DEFAULT))


@query("jaccard_pairs")
def q_jaccard_pairs(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    sets = minhash.shingle_sets(d, "doc_id", "text", MH_DEFAULT.ngrams)
    edges = cut_lineage(minhash.bucket_edges(minhash.lsh_bands(
        cut_lineage(minhash.signatures(d, MH_DEFAULT, shingles_df=sets)), MH_DEFAULT)))
    v = minhash.verify_edges(edges, minhash.sets_on_edges(edges, sets))
    return v.select("src", "dst", F.round("jaccard", 6).alias("jaccard"),
                    (F.col("jaccard") > MH_DEFAULT.jaccard_threshold).alias("verified"))


@query("minhash_dedup")
def q_minhash_dedup(spark, sf_dir):
    return minhash.fuzzy_dedup(docs(spark, sf_dir, "doc_id", "text"), MH_DEFAULT).kept.select(
        "doc_id")


@query("minhash_dedup_verified")
def q_minhash_dedup_verified(spark, sf_dir):
    return minhash.fuzzy_dedup(docs(spark, sf_dir, "doc_id", "text"), MH_DEFAULT,
                               verify=True).kept.select("doc_id")


@query("similar_documents")
def q_similar_documents(spark, sf_dir):
    return setjoin.similar_documents(docs(spark, sf_dir, "doc_id", "text"), MH_WIDE.ngrams, SIMILAR_PERCENT)


@query("similarity_dedup")
def q_similarity_dedup(spark, sf_dir):
    return setjoin.similarity_dedup(docs(spark, sf_dir, "doc_id", "text"), MH_WIDE.ngrams, SIMILAR_PERCENT).select("doc_id")


@query("lsh_recall")
def q_lsh_recall(spark, sf_dir):
    return setjoin.lsh_recall(docs(spark, sf_dir, "doc_id", "text"), MH_WIDE, SIMILAR_PERCENT)


@query("minhash_dedup_wide")
def q_minhash_dedup_wide(spark, sf_dir):
    return minhash.fuzzy_dedup(docs(spark, sf_dir, "doc_id", "text"), MH_WIDE).kept.select(
        "doc_id")


@query("duplicate_clusters")
def q_duplicate_clusters(spark, sf_dir):
    res = minhash.fuzzy_dedup(docs(spark, sf_dir, "doc_id", "text"), MH_DEFAULT)
    return minhash.cluster_sizes(res.assignment)


@query("dedup_report")
def q_dedup_report(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    res = minhash.fuzzy_dedup(d, MH_DEFAULT)
    before = d.agg(F.count(F.lit(1)).alias("n_before"))
    after = res.kept.agg(F.count(F.lit(1)).alias("n_after"))
    clusters = res.assignment.agg(F.countDistinct("component").alias("n_clusters"))
    # three one-row aggregates, put side by side by a last aggregate over three rows
    out = before.unionByName(after, True).unionByName(clusters, True).agg(
        *[F.max(c).alias(c) for c in ("n_before", "n_after", "n_clusters")])
    return out.select("n_before", "n_after", "n_clusters",
                      (F.col("n_before") - F.col("n_after")).alias("n_removed"))


# --- classifiers and filters -------------------------------------------------

def _labels(spark, sf_dir):
    return read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])


def _scored(model, d, text_col="text", prefix=None):
    out = C.score_nb(model, d, "doc_id", text_col, prefix)
    p = prefix or model.name
    return out.select("doc_id", f"{p}_label", F.round(f"{p}_score", 4).alias(f"{p}_score"))


@query("identify_language")
def q_identify_language(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "lang", "text")
    return _scored(C.train_language(d), d)


@query("classify_nsfw")
def q_classify_nsfw(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    return _scored(C.train_nsfw(d, _labels(spark, sf_dir)), d)


@query("classify_toxic")
def q_classify_toxic(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    return _scored(C.train_toxic(d, _labels(spark, sf_dir)), d)


@query("classify_quality")
def q_classify_quality(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    return _scored(C.train_quality(d, _labels(spark, sf_dir)), d)


@query("train_quality_nb")
def q_train_quality_nb(spark, sf_dir):
    m = C.train_quality(docs(spark, sf_dir, "doc_id", "text"), _labels(spark, sf_dir))
    high, low = m.cols  # classes are sorted: high_quality, low_quality
    return m.table.select("bucket", F.round(high, 6).alias("lp_high"),
                          F.round(low, 6).alias("lp_low"))


@query("filter_english")
def q_filter_english(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "lang", "text")
    s = C.score_nb(C.train_language(d), d)
    return s.filter(X.is_english(F.col("lang_label"), F.col("lang_score"))).select("doc_id")


@query("filter_harmful")
def q_filter_harmful(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    lab = _labels(spark, sf_dir)
    heads = C.train_binary_heads(d, lab, ("nsfw", "toxic"))         # one fit, one scan
    s = C.score_heads([heads["nsfw"], heads["toxic"]], d)
    harm = X.is_harmful(F.col("nsfw_label"), F.col("nsfw_score"), F.col("toxic_label"),
                        F.col("toxic_score"))
    return s.filter(~harm).select("doc_id")


@query("filter_quality")
def q_filter_quality(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    s = C.score_nb(C.train_quality(d, _labels(spark, sf_dir)), d)
    return s.filter(X.is_high_quality(F.col("quality_label"), F.col("quality_score"))).select(
        "doc_id")


def _heads(spark, sf_dir):
    return X.train_heads(docs(spark, sf_dir, "doc_id", "lang", "text"), _labels(spark, sf_dir))


@query("coarse_filter")
def q_coarse_filter(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    return X.coarse_filter(d, _heads(spark, sf_dir)).select("doc_id", "coarse_reason")


@query("curate")
def q_curate(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "source", "text")
    return X.kept(X.funnel(d, _heads(spark, sf_dir)))


@query("curate_stages")
def q_curate_stages(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "source", "text")
    return X.funnel(d, _heads(spark, sf_dir)).select("doc_id", "drop_reason")


@query("funnel_stats")
def q_funnel_stats(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "source", "text")
    return X.funnel_stats(X.funnel(d, _heads(spark, sf_dir)))


@query("curate_dedup")
def q_curate_dedup(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "source", "text")
    return X.curate_then_dedup(d, _heads(spark, sf_dir)).select("doc_id", "text")


@query("language_share")
def q_language_share(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "lang", "text")
    s = C.score_nb(C.train_language(d), d)
    # one row per language: the total over them needs no second pass over the documents
    counts = s.groupBy("lang_label").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.select("lang_label", F.col("n").cast("bigint").alias("n"),
                         F.round(F.col("n") / total, 6).alias("share"))


# --- tokens ------------------------------------------------------------------

WINDOW_BATCH, WINDOW_CTX, WINDOW_SEED = 8, 512, 0
INSPECT_PER_GROUP = 5
URL_SAMPLE = 200


def _encoded(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    return tokens.encode(d, tokens.build_vocab(d))


@query("build_vocab")
def q_build_vocab(spark, sf_dir):
    return tokens.build_vocab(docs(spark, sf_dir, "text"))


@query("encode_tokens")
def q_encode_tokens(spark, sf_dir):
    return tokens.check_uint16(_encoded(spark, sf_dir))


@query("token_count")
def q_token_count(spark, sf_dir):
    return tokens.token_count(_encoded(spark, sf_dir))


@query("pack_sequences")
def q_pack_sequences(spark, sf_dir):
    return tokens.pack(_encoded(spark, sf_dir))


@query("decode_sequences")
def q_decode_sequences(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    vocab = tokens.build_vocab(d)
    # bytes, as a sequence may end within a character
    return tokens.decode_bytes(tokens.pack(tokens.encode(d, vocab)), vocab).select("seq", F.hex("bytes").alias("hex"))


@query("token_round_trip")
def q_token_round_trip(spark, sf_dir):
    """T2 + T4: every document comes back whole from its ids."""
    d = docs(spark, sf_dir, "doc_id", "text")
    vocab = tokens.build_vocab(d)
    return tokens.decode(tokens.encode(d, vocab, add_eos=False), vocab)


@query("sample_training_windows")
def q_sample_training_windows(spark, sf_dir):
    packed = cut_lineage(tokens.pack(_encoded(spark, sf_dir)))
    n = packed.agg(F.sum(F.size("ids"))).first()[0]
    draws = tokens.draw_starts(spark, n, WINDOW_BATCH, WINDOW_CTX, WINDOW_SEED)
    return tokens.sample_windows(packed, draws, WINDOW_CTX)


# --- sampling and training sets ------------------------------------------------

@query("sample_k")
def q_sample_k(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages", ["page_id", "url"])
    return sampling.sample_k(p, URL_SAMPLE, "page_id")


def _training_set(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "lang", "text")
    lab = _labels(spark, sf_dir)
    heads = X.train_heads(d, lab)
    cand = d.select("doc_id", "text").join(lab, "doc_id")
    pos = cand.filter(F.col("quality") == 1).select("doc_id", "text")
    neg = cand.filter(F.col("quality") == 0).select("doc_id", "text")

    def usable(df):
        return X.coarse_filter(df, heads).filter(F.col("coarse_reason").isNull()).drop(
            "coarse_reason", "lang_label", "lang_score", "nsfw_label", "nsfw_score",
            "toxic_label", "toxic_score")

    return sampling.balanced_training_set(pos, neg, usable)


@query("balanced_training_set")
def q_balanced_training_set(spark, sf_dir):
    return _training_set(spark, sf_dir)


@query("training_lines")
def q_training_lines(spark, sf_dir):
    return _training_set(spark, sf_dir).select("line")


@query("class_counts")
def q_class_counts(spark, sf_dir):
    return sampling.class_counts(_training_set(spark, sf_dir))


@query("inspect_samples")
def q_inspect_samples(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "source", "text")
    f = X.funnel(d, _heads(spark, sf_dir)).select(
        "doc_id", F.coalesce("drop_reason", F.lit("kept")).alias("outcome"))
    return sampling.inspect_samples(f, "outcome", INSPECT_PER_GROUP)


# --- audits -------------------------------------------------------------------

def _pages_text(spark, sf_dir):
    return AU.page_text(read_table(spark, sf_dir, "pages", ["page_id", "html"]))


def _rounded(df, *prefixes):
    cols = [c for c in df.columns if not any(c == f"{p}_score" for p in prefixes)]
    return df.select(*cols, *[F.round(f"{p}_score", 4).alias(f"{p}_score") for p in prefixes])


@query("pii_audit")
def q_pii_audit(spark, sf_dir):
    return AU.pii_audit(docs(spark, sf_dir, "doc_id", "text"))


@query("language_audit")
def q_language_audit(spark, sf_dir):
    lang = C.train_language(docs(spark, sf_dir, "doc_id", "lang", "text"))
    return _rounded(AU.language_audit(_pages_text(spark, sf_dir), lang), "lang")


@query("harmful_audit")
def q_harmful_audit(spark, sf_dir):
    heads = C.train_binary_heads(docs(spark, sf_dir, "doc_id", "text"), _labels(spark, sf_dir),
                                 ("nsfw", "toxic"))
    out = AU.harmful_audit(_pages_text(spark, sf_dir), heads["nsfw"], heads["toxic"])
    return _rounded(out, "nsfw", "toxic")


@query("gopher_audit")
def q_gopher_audit(spark, sf_dir):
    return AU.gopher_audit(_pages_text(spark, sf_dir))


@query("validation_tokens")
def q_validation_tokens(spark, sf_dir):
    """S13 + T2: the evaluation corpus encoded with the training vocabulary."""
    vocab = tokens.build_vocab(docs(spark, sf_dir, "text"))
    bench = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    return tokens.encode(bench, vocab, id_col="item_id")


@query("classify_quality_lr")
def q_classify_quality_lr(spark, sf_dir):
    """C5 with the linear model, fitted in a fixed number of gradient steps."""
    d = docs(spark, sf_dir, "doc_id", "text")
    model = linear.train(d.join(_labels(spark, sf_dir), "doc_id"), F.col("quality"))
    return _rounded(linear.score(model, d, "high_quality", "low_quality", "quality"), "quality")


FLAGSHIP = "curate"
