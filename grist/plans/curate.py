"""The curation funnel (X0), its per-stage statistics (A10) and the
funnel followed by fuzzy dedup (X1).

Stage order follows the reference: English (on the raw text) -> mask PII ->
harmful (nsfw, toxic) -> rules -> learned quality. All stages run in the scan
of the records, one after the other, and work only on rows still alive, so the
cheap, very selective language stage (98.85 % of records dropped in the
reference's run) shields the others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grist.functions import text as T
from grist.operators import classify as C
from grist.operators import minhash, quality
from grist.session import cut_lineage
from grist.sources import files, warc

# --- fixed values (stage thresholds and label names of the reference) --------
ENGLISH_LABEL, ENGLISH_MIN_SCORE = "en", 0.95          # keep when score > 0.95
HARM_MIN_SCORE = 0.5                                   # drop when score < 0.5
QUALITY_LABEL, QUALITY_MIN_SCORE = "high_quality", 0.5  # keep when score >= 0.5
COARSE_MIN_SCORE = 0.8                                 # training-set filter
# ---------------------------------------------------------------------------


@dataclass
class Heads:
    lang: C.NBModel
    nsfw: C.NBModel
    toxic: C.NBModel
    quality: C.NBModel


def train_heads(documents: DataFrame, labels: DataFrame) -> Heads:
    """Language on ``documents.lang``; nsfw, toxic and quality in one pass."""
    binary = C.train_binary_heads(documents, labels)
    return Heads(lang=C.train_language(documents), nsfw=binary["nsfw"],
                 toxic=binary["toxic"], quality=binary["quality"])


def is_english(label, score):
    return (label == ENGLISH_LABEL) & (score > ENGLISH_MIN_SCORE)


def is_harmful(nsfw_label, nsfw_score, toxic_label, toxic_score):
    return ((nsfw_label == "nsfw") | (nsfw_score < HARM_MIN_SCORE)
            | (toxic_label == "toxic") | (toxic_score < HARM_MIN_SCORE))


def is_high_quality(label, score):
    return (label == QUALITY_LABEL) & (score >= QUALITY_MIN_SCORE)


def funnel(documents: DataFrame, heads: Heads, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Every input row with ``masked`` text, the scores each stage computed and
    ``drop_reason`` (null = kept).

    One narrow pass: a stage's text is null for rows that an earlier stage
    dropped, so neither masks nor heads do any work on them. No row moves. The
    masked text, and later the failed rule, go through the next head's UDF, so
    that each mask and each rule is computed once, whoever reads them.
    """
    s = C.with_scores([heads.lang], documents, text_col)
    s = s.withColumn("_en", F.coalesce(is_english(F.col("lang_label"), F.col("lang_score")), F.lit(False)))
    s = s.withColumn("masked", F.when(F.col("_en"), T.mask_pii(F.col(text_col))))
    s = C.with_scores([heads.nsfw, heads.toxic], s, "masked", carry=("masked",))
    harm = is_harmful(F.col("nsfw_label"), F.col("nsfw_score"), F.col("toxic_label"),
                      F.col("toxic_score"))
    s = s.withColumn("_ok2", F.col("_en") & ~harm)
    s = s.withColumn("rule_failed", F.when(F.col("_ok2"),
                                           quality.rule_failure_of(F.col("masked"))))
    s = s.withColumn("_last", F.when(F.col("_ok2") & F.col("rule_failed").isNull(), F.col("masked")))
    s = C.with_scores([heads.quality], s, "_last", carry=("rule_failed",))
    s = s.withColumn("_ok3", F.col("_ok2") & F.col("rule_failed").isNull())
    good = is_high_quality(F.col("quality_label"), F.col("quality_score"))
    reason = (F.when(~F.col("_en"), F.lit("non_en"))
              .when(~F.col("_ok2"), F.lit("harmful"))
              .when(~F.col("_ok3"), F.lit("rules"))
              .when(~good, F.lit("low_quality")))
    computed = {c: F.when(F.col(alive), F.col(c)) for alive, own in
                (("_en", ("nsfw_label", "nsfw_score", "toxic_label", "toxic_score")),
                 ("_ok3", ("quality_label", "quality_score"))) for c in own}
    return s.withColumn("drop_reason", reason).withColumns(computed).drop("_en", "_ok2", "_ok3", "_last")


def kept(funnel_df: DataFrame, id_col: str = "doc_id", extra: tuple[str, ...] = ()) -> DataFrame:
    """X0 output: surviving records with masked text (the JSON-lines sink shape)."""
    return funnel_df.filter(F.col("drop_reason").isNull()).select(
        id_col, *extra, F.col("masked").alias("text"))


def funnel_stats(funnel_df: DataFrame, group_col: str = "source") -> DataFrame:
    """A10: records per (source, stage outcome), with per-source and grand
    totals from ``rollup`` (``drop_reason = 'kept'`` for survivors)."""
    outcome = F.coalesce(F.col("drop_reason"), F.lit("kept"))
    return (funnel_df.select(F.col(group_col), outcome.alias("outcome"))
            .rollup(group_col, "outcome").agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def coarse_filter(documents: DataFrame, heads: Heads, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """rules -> English >= 0.8 -> non-nsfw >= 0.8 -> non-toxic >= 0.8;
    ``coarse_reason`` null means the record is usable for training. The rules are
    native and come first; a head sees the text of rows that are still alive.
    The scores of stages that a row doesn't reach are null."""
    s = documents.withColumn("_rule", quality.rule_failure_of(F.col(text_col)))
    s = C.with_scores([heads.lang], s.withColumn("_ruled", F.when(F.col("_rule").isNull(), F.col(text_col))), "_ruled", carry=("_rule",))
    fluent = F.col("_rule").isNull() & (F.col("lang_label") == ENGLISH_LABEL) & (F.col("lang_score") >= COARSE_MIN_SCORE)
    s = C.with_scores([heads.nsfw, heads.toxic], s.withColumn("_fluent", F.coalesce(fluent, F.lit(False)))
                      .withColumn("_last", F.when(F.col("_fluent"), F.col(text_col))), "_last")
    reason = (F.when(F.col("_rule").isNotNull(), F.lit("rules"))
              .when((F.col("lang_label") != ENGLISH_LABEL)
                    | (F.col("lang_score") < COARSE_MIN_SCORE), F.lit("language"))
              .when((F.col("nsfw_label") != "non-nsfw")
                    | (F.col("nsfw_score") < COARSE_MIN_SCORE), F.lit("nsfw"))
              .when((F.col("toxic_label") != "non-toxic")
                    | (F.col("toxic_score") < COARSE_MIN_SCORE), F.lit("toxic")))
    reached = {c: F.when(F.col("_rule").isNull() if c.startswith("lang") else F.col("_fluent"), F.col(c))
               for c in [f"{h}_{x}" for h in ("lang", "nsfw", "toxic") for x in ("label", "score")]}
    return s.withColumn("coarse_reason", reason).withColumns(reached).drop("_rule", "_ruled", "_fluent", "_last")


def archive_texts(spark: SparkSession, path: str, kind: str = "conversion") -> DataFrame:
    """Records of crawl archives as documents: ``doc_id`` (file and record
    number), ``file``, ``rec``, ``url``, ``text``."""
    if kind == "response":
        texts = warc.extract_responses(warc.read_archives(spark, path, types=kind, statuses="200"))
    else:
        texts = warc.extract_conversions(warc.read_archives(spark, path, types=kind))
    return texts.withColumn("doc_id", F.concat_ws(":", "file", "rec"))


def curate_archives(spark: SparkSession, path: str, heads: Heads, out_dir: str, stats_dir: str,
                    kind: str = "conversion", params: minhash.MinHashParams | None = None) -> None:
    """The whole job: archives -> funnel -> (fuzzy dedup) -> JSON lines with
    url, and a table of records per file and stage outcome.

    The outcome of every record is written once, without its text if it was
    dropped; statistics and survivors are read from there.
    """
    f = funnel(archive_texts(spark, path, kind), heads)
    done = cut_lineage(f.select("doc_id", "file", "url", F.coalesce("drop_reason", F.lit("kept")).alias("outcome"),
                                F.when(F.col("drop_reason").isNull(), F.col("masked")).alias("text")))
    (done.groupBy("file", "outcome").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
     .write.mode("overwrite").parquet(stats_dir))
    survivors = done.filter("outcome = 'kept'").select("doc_id", "file", "url", "text")
    if params is not None:
        survivors = minhash.fuzzy_dedup(survivors, params).kept
    files.write_jsonl(survivors, out_dir)


def curate_then_dedup(documents: DataFrame, heads: Heads,
                      params: minhash.MinHashParams = minhash.MinHashParams()) -> DataFrame:
    """Funnel, then fuzzy dedup of the survivors (default 10 hashes, 2
    bands, 2-word shingles, unverified)."""
    survivors = cut_lineage(kept(funnel(documents, heads)))     # read twice: written once
    return minhash.fuzzy_dedup(survivors, params).kept
