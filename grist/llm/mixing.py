"""Mixing sources to target weights by subset-sum budget fitting (operator 9).

A document's size is its number of words. The sources, in code point order
with null last, weigh ``weights`` in turn and share all words of the corpus by
weight; a target stops at ``cap`` times its source's words and the excess goes
to the other sources by weight, until no target is above its cap.

Within a source every document is taken ``floor(target / words)`` times. The
remaining budget, less than the source once more, is met by whole documents:

* documents are counted by exact size, so a source is a short list of
  (size, count), however many documents it has;
* most of the budget is spread evenly: of each size the same share is taken;
* what is left is fitted by a bounded-knapsack dynamic program over sizes and
  counts still free, which finds the subset sum nearest to the budget. Its
  budget is at most ``KNAPSACK`` words; larger rests are first met by whole
  documents, larger sizes first;
* the plan says how many documents of each size to take once more. Which ones
  follows from a seeded hash of id and text: those of the smallest hashes.

Documents are never gathered by source: sizes are counted with partial
aggregates, and a (source, size) class of many documents is ranked in hash
bins that hold about ``BIN`` rows each; only the bin in which the count ends is
ranked document by document.

Defined cases: null text has size 0; a document without words is taken 0
times; a source without words has target 0; rows alike in id and text are told
apart by nothing and share their class's count; repeated runs agree.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grist.llm.common import WORD, free_name, materialize
from grist.operators.ordering import prefix_sum

WEIGHTS = (1, 2, 3)
CAP = 3
SEED = 42
KNAPSACK = 1 << 16
BIN = 1024


def targets(counts: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(name, no_source, source_size, target) from (name, no_source, size, n)."""
    per_source = counts.groupBy("name", "no_source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    # null last and bytewise, which for UTF-8 is code point order; ranks come from a distributed sort
    ranked = prefix_sum(per_source, ["no_source", "name"], None, "rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    shares = materialize(ranked.withColumn("weight", weight.cast("long")), "sources")
    total, all_weight = (x or 0 for x in shares.agg(F.sum("source_size"), F.sum("weight")).first())
    capped_words = capped_weight = 0
    while True:
        # words for one unit of weight, if the sources capped so far stay so
        free = all_weight - capped_weight
        level = (total - cap * capped_words) / free if free else 0.0
        over = F.col("weight") * F.lit(float(level)) >= cap * F.col("source_size")
        words, weight_over = shares.filter(over).agg(F.sum("source_size"), F.sum("weight")).first()
        if (weight_over or 0) <= capped_weight:
            break
        capped_words, capped_weight = words, weight_over
    target = F.when(over, (cap * F.col("source_size")).cast("double")).otherwise(F.col("weight") * F.lit(float(level)))
    return shares.select("name", "no_source", "source_size", target.alias("target"))


def knapsack(budget: int, sizes: Sequence[int], counts: Sequence[int]) -> list[int]:
    """How many of each size (at most its count) add up nearest to ``budget``:
    the largest reachable sum not above it, or the smallest above it if that is
    nearer. Reachable sums are the bits of one integer; counts are cut into
    powers of two."""
    top = budget + (max(sizes) if sizes else 0)      # a least sum above the budget isn't above this
    full = (1 << (top + 1)) - 1
    reach, steps = 1, []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        left, k = min(counts[i], top // sizes[i]), 1
        while left > 0 and not reach >> budget & 1:
            k = min(k, left)
            steps.append((i, k, reach))
            reach |= reach << (k * sizes[i]) & full
            left -= k
            k *= 2
        if reach >> budget & 1:
            break
    below = (reach & (1 << (budget + 1)) - 1).bit_length() - 1
    above = reach >> (budget + 1)
    at = below
    if above:
        first_above = budget + 1 + (above & -above).bit_length() - 1
        at = first_above if first_above - budget < budget - below else below
    taken = [0] * len(sizes)
    for i, k, before in reversed(steps):
        if not before >> at & 1:            # the sum needs this step
            taken[i] += k
            at -= k * sizes[i]
    return taken


def fit(sizes: np.ndarray, counts: np.ndarray, target: float) -> tuple[int, np.ndarray]:
    """Full rounds of a source, and how many documents of each size once more."""
    total = int((sizes * counts).sum())
    budget = int(round(target))
    if not total:
        return 0, np.zeros(len(sizes), np.int64)
    rounds, rest = divmod(budget, total)
    extra = np.where(sizes > 0, counts * (rest / total), 0).astype(np.int64)      # the same share of each size
    left = rest - int((extra * sizes).sum())
    for i in np.argsort(-sizes, kind="stable"):             # whole documents, until the knapsack can do the rest
        if left <= KNAPSACK or not sizes[i]:
            break
        k = min(int(counts[i] - extra[i]), (left - KNAPSACK) // int(sizes[i]) + 1, left // int(sizes[i]))
        extra[i] += k
        left -= k * int(sizes[i])
    free = np.nonzero((counts > extra) & (sizes > 0) & (sizes < 2 * left))[0]        # larger ones would miss by more than nothing does
    if left > 0 and len(free):
        extra[free] += knapsack(left, sizes[free].tolist(), (counts - extra)[free].tolist())
    return int(rounds), extra


CLASS = ["name", "no_source", "size"]
PLAN = "name string, no_source boolean, size long, n long, rounds long, extra long, source_size long, target double"


def fit_source(table: pa.Table) -> pa.Table:
    """The plan of one source, from a row for each size and its target."""
    sizes, counts = (table[c].to_numpy().astype(np.int64) for c in ("size", "n"))
    rounds, extra = fit(sizes, counts, table["target"][0].as_py())
    made = {"rounds": pa.array(np.full(len(sizes), rounds)), "extra": pa.array(extra)}
    return pa.table({c: made.get(c, table[c] if c in table.column_names else None)
                     for c in ("name", "no_source", "size", "n", "rounds", "extra", "source_size", "target")})


def times_taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with its class's plan and ``times``: the full rounds, and one
    more for the ``extra`` rows of the smallest (bin, pick) in each class."""
    bins = F.ceil(F.col("n") / BIN).cast("long")
    dealt = (rows.join(plan, CLASS).withColumn("bin", F.pmod(F.col("pick"), bins))
             .withColumn("some", (F.col("extra") > 0) & (F.col("extra") < F.col("n"))))
    before = Window.partitionBy(*CLASS).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.filter("some").groupBy(*CLASS, "bin").agg(F.count(F.lit(1)).alias("in_bin"))
              .withColumn("start", F.coalesce(F.sum("in_bin").over(before), F.lit(0))))
    placed = dealt.filter("some").join(starts, [*CLASS, "bin"])
    inside = (F.col("start") < F.col("extra")) & (F.col("start") + F.col("in_bin") > F.col("extra"))
    rank = F.row_number().over(Window.partitionBy(*CLASS, "bin").orderBy("pick"))
    once_more = [dealt.filter("not some").withColumn("more", F.col("extra") > 0),
                 placed.filter(~inside).withColumn("more", F.col("start") < F.col("extra")).drop("in_bin", "start"),
                 placed.filter(inside).withColumn("more", F.col("start") + rank <= F.col("extra")).drop("in_bin", "start")]
    every = once_more[0].unionByName(once_more[1]).unionByName(once_more[2])
    times = F.when(F.col("size") > 0, F.col("rounds") + F.col("more").cast("long")).otherwise(F.lit(0).cast("long"))
    return every.withColumn("times", times).drop("bin", "some", "more")


def mix(df: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id",
        weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """For each row of ``df``: ``id``, ``text_hash``, ``source``, ``size``,
    ``source_size``, ``target`` (its source's) and ``times``, how often the mix
    takes the document."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = materialize(df.select(
        F.col(id_col).alias("id"), F.xxhash64(body).alias("text_hash"), F.col(source).cast("string").alias("source"),
        F.regexp_count(body, F.lit(WORD)).cast("long").alias("size"))
        .withColumns({"name": F.coalesce("source", F.lit("")), "no_source": F.col("source").isNull(),
                      "pick": F.xxhash64(F.lit(seed), "id", "text_hash")}), "sizes")
    counts = materialize(rows.groupBy(*CLASS).agg(F.count(F.lit(1)).alias("n")), "size-counts")
    goals = materialize(targets(counts, weights, cap), "targets")
    plan = materialize(counts.join(goals, ["name", "no_source"]).groupBy("name", "no_source").applyInArrow(fit_source, PLAN), "plan")
    return times_taken(rows, plan).select("id", "text_hash", "source", "size", "source_size", "target", "times")


def mixed_rows(df: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id", **options) -> DataFrame:
    """The mix itself: the rows of ``df``, each as often as the mix takes it."""
    i, h, many, total, rank, copy = free_name(df, "_id", "_hash", "_many", "_total", "_rank", "_copy")
    # rows alike in id and text share what their number is taken together
    taken = (mix(df, text, source, id_col, **options).groupBy("id", "text_hash")
             .agg(F.count(F.lit(1)).alias(many), F.sum("times").alias(total)).filter(F.col(total) > 0)
             .select(F.col("id").alias(i), F.col("text_hash").alias(h), many, total))
    keyed = df.withColumn(h, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    both = keyed.join(taken, keyed[id_col].eqNullSafe(taken[i]) & (keyed[h] == taken[h]))
    single = both.filter(F.col(many) == 1).select(*[F.col(c) for c in df.columns], F.col(total).alias(copy))
    place = F.row_number().over(Window.partitionBy(i, taken[h]).orderBy(F.xxhash64(*df.columns)))
    alike = both.filter(F.col(many) > 1).withColumn(rank, place).select(
        *[F.col(c) for c in df.columns], (F.floor(F.col(total) / F.col(many)) + (F.col(rank) <= F.col(total) % F.col(many)).cast("long")).alias(copy))
    return (single.unionByName(alike).filter(F.col(copy) > 0)
            .withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copy)))).drop(copy))
