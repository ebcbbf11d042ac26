"""A training corpus from raw documents: filter, dedup, mix, encode.

``STAGES`` are (name, function) pairs. A function takes (spark, docs, sf_dir)
and returns a DataFrame; ``run`` writes each result as Parquet into the shared
checkpoint folder and gives it, read again, to the next stage. All stages but
the last return the columns that they were given, among them those of
``documents``: doc_id, text, lang, source, n_chars; columns beyond these pass
through, whatever their names.

Every stage judges all rows of its predecessor; an empty input gives an empty
result. What each does with nulls, empty texts, ties and repeated rows is told
in the operator's module.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grist.llm import bpe, kneser_ney, mixing, simhash, substring
from grist.llm.common import free_name, materialize, read, tune

TOKENIZER = "byte_bpe_50k.json"
BYTES_PER_BATCH = 8 << 20    # of Arrow batches, which six workers hold beside their tables
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose character perplexity lies under their language's
    threshold; the model learns from those that ``labels`` calls good. Documents
    without text go."""
    labels = read(spark, sf_dir, "labels", "doc_id", "quality")
    renamed, back = set_aside(docs)
    return back(kneser_ney.keep(renamed, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: that of the smallest doc_id."""
    return simhash.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows of 50 words that a document of smaller doc_id
    holds too. A text that loses nothing stays as it is; of others the kept
    words are joined by single spaces. ``n_chars`` follows the text; a document
    that loses every word stays with an empty text."""
    renamed, back = set_aside(docs)
    cut = substring.remove_repeats(renamed)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    cut = cut.withColumn("text", text)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return back(cut)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it, at most 3 times;
    documents without words are taken 0 times."""
    return mixing.mixed_rows(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, n_tokens, ``ids`` (packed little-endian unsigned
    32-bit integers) and ``exact``: whether the decoded ids give the text again."""
    path = public_tokenizers.path(TOKENIZER)
    rows = docs.select("doc_id", "source", "lang", F.coalesce("text", F.lit("")).alias("text"))
    coded = bpe.decode(bpe.encode(rows, path), path)
    return coded.select("doc_id", "source", "lang", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), "ids",
                        (F.col("decoded") == F.col("text")).alias("exact"))


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("source mixing", source_mix),
    ("bpe encoding", token_ids),
]

#: A learned model, XXH64 fingerprints and the choices of a knapsack are beyond
#: SQL; tests/llm/test_llm_pipeline.py compares the pipeline with a brute-force version.
ORACLE_SQL = None


def set_aside(docs: DataFrame):
    """``docs`` with the columns beyond those of ``documents`` renamed, so that an
    operator's own columns can't meet them, and a function that undoes it."""
    extra = [c for c in docs.columns if c not in COLUMNS]
    names = dict(zip(extra, free_name(docs, *[f"_extra_{i}" for i in range(len(extra))])))

    def back(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])

    return docs.withColumnsRenamed(names), back


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
