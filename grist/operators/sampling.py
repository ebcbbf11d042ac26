"""Seeded sampling and the balanced quality training set.

Draws are defined by ``md5(seed:id)`` order, so they do not depend on
partitioning, executor count or retries, and any SQL engine reproduces them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grist.operators import ordering
from grist.session import cut_lineage

# --- fixed values: training-set layout of the reference -----------------------
LABEL_PREFIX = "__label__"
POSITIVE, NEGATIVE = "high_quality", "low_quality"
NEGATIVE_POOL_FACTOR = 5
SAMPLE_SEED = 42
# ---------------------------------------------------------------------------


def sample_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def sample_k(df: DataFrame, k: int, id_col: str, seed: int = SAMPLE_SEED) -> DataFrame:
    """Exactly ``k`` rows without replacement; error when fewer exist.
    The limit is the operator (a top-k over the hash order, bounded by k)."""
    n = df.count()
    if k > n:
        raise ValueError(f"sample of {k} requested from {n} rows")
    keyed = df.withColumn("_skey", sample_key(id_col, seed))
    return ordering.first_k(keyed, ["_skey", id_col], k).drop("_skey")


def training_line(label: Column, text: Column) -> Column:
    """``__label__<label> <text with newlines as blanks>``."""
    return F.concat(F.lit(LABEL_PREFIX), label, F.lit(" "), F.replace(text, F.lit("\n"), F.lit(" ")))


def balanced_training_set(positives: DataFrame, negatives: DataFrame, usable, id_col="doc_id",
                          text_col="text", seed: int = SAMPLE_SEED) -> DataFrame:
    """``(rn, label, id, line)``, alternating high / low.

    ``positives`` / ``negatives`` hold candidate rows; ``usable`` maps a
    DataFrame to the subset passing the coarse filter (F4). As in the
    reference: N = number of positives; the negative pool is the first 5N
    negatives in id order, of which N are sampled (fewer when the pool is
    smaller — the reference would raise); both sides are filtered, then both
    are cut to the smaller count and interleaved.
    """
    n_pos = positives.count()
    # N grows with the data: both cuts use the distributed rank for large N
    # what is counted or ranked is read several times: written once, the filter's heads run once
    pool = cut_lineage(ordering.first_k(negatives, [id_col], NEGATIVE_POOL_FACTOR * n_pos))
    k = min(n_pos, pool.count())
    neg = ordering.first_k(pool.withColumn("_skey", sample_key(id_col, seed)),
                           ["_skey", id_col], k).drop("_skey")
    pos = positives.withColumn("label", F.lit(POSITIVE)).withColumn("_key", F.lit(""))
    neg = neg.withColumn("label", F.lit(NEGATIVE)).withColumn("_key", sample_key(id_col, seed))
    both = cut_lineage(usable(pos.unionByName(neg)).select(id_col, text_col, "label", "_key"))
    # positives keep id order, negatives keep sample order (_key = '' for positives)
    ranked = ordering.rank_within(both, "label", ["_key", id_col])
    sizes = ranked.groupBy("label").agg(F.count(F.lit(1)).alias("_c"))
    m = sizes.agg(F.min("_c")).first()[0] or 0
    if sizes.count() < 2:
        m = 0
    return ranked.filter(F.col("rn") <= m).select(
        "rn", "label", id_col, training_line(F.col("label"), F.col(text_col)).alias("line"))


def class_counts(training: DataFrame) -> DataFrame:
    """A13."""
    return training.groupBy("label").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def inspect_samples(df: DataFrame, group_col: str, k: int, id_col: str = "doc_id",
                    seed: int = SAMPLE_SEED) -> DataFrame:
    """``k`` rows per group in hash order (the per-group cap is the feature)."""
    # ranking reads its rows several times; what made them (the funnel) runs once
    keyed = cut_lineage(df.withColumn("_key", sample_key(id_col, seed)))
    ranked = ordering.rank_within(keyed, group_col, ["_key", id_col])
    return ranked.filter(F.col("rn") <= k).drop("_key")
