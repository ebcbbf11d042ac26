"""A linear text classifier fitted by distributed gradient steps.

Logistic regression on hashed word runs and word pairs (the features of the other
heads, :mod:`grist.operators.classify`), each document's counts scaled to unit
length, plus a constant. The features of the training rows are written once, as two
arrays a document. The fit takes ``STEPS`` full gradient steps, whatever the data: a
step is one pass over that table. The weights, at most ``BUCKETS`` numbers, are
broadcast; a task sums its documents' gradients in an array of that fixed size and
sends the buckets that it has seen; ``groupBy(bucket)`` adds them. No text and no
feature is shuffled.

All quantities between steps are whole numbers (features in 2^-15, weights and
residuals in 2^-20), so sums are the same in any order and on any engine, and so
is the model. Both classes weigh the same, whatever their shares. As the longest
row has length sqrt(2), a step of up to 4 never diverges.

Bounds: about ``max_train_rows`` labelled rows at most are used, those of the smallest
hashes of id and text. Null labels and labels other than 0 and 1 aren't used; null
and empty texts count as texts without features; with one class only, or none, the
constant alone decides or every score is 1/2. Ties (a score of exactly 1/2) are negative.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from grist.operators.classify import BUCKETS, COUNTED_ROWS, HARM_FEATURES, Featurizer, features_of
from grist.session import cut_lineage

STEPS = 40
RATE = 3.0
MAX_TRAIN_ROWS = 500_000    # labelled rows that a fit uses, about, at most
FEATURE = 1 << 15           # features are multiples of 1 / FEATURE
WEIGHT = 1 << 20            # weights and residuals are multiples of 1 / WEIGHT


@dataclass
class LinearModel:
    weights: np.ndarray     # of the buckets, then of the constant
    featurizer: Featurizer


def scaled_features(words: pa.Array, bigrams: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, value) of a batch's distinct features."""
    buckets, sizes = features_of(words, bigrams)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    pairs, n = np.unique(owner * BUCKETS + buckets, return_counts=True)
    owner, buckets = np.divmod(pairs, BUCKETS)
    length = np.sqrt(np.bincount(owner, n * n, minlength=len(sizes)))
    return owner, buckets, np.floor(n / length[owner] * FEATURE + 0.5).astype(np.int64)


def probabilities(weights: np.ndarray, owner: np.ndarray, buckets: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Probability of the positive class for each of ``n`` documents."""
    sums = np.full(n, weights[BUCKETS] * FEATURE, np.int64)
    np.add.at(sums, owner, weights[buckets] * values)
    return 1.0 / (1.0 + np.exp(-(sums / (float(FEATURE) * WEIGHT))))


def parts(batch: pa.RecordBatch):
    return (batch.slice(i, COUNTED_ROWS) for i in range(0, batch.num_rows, COUNTED_ROWS))


def with_features(rows: DataFrame, bigrams: bool) -> DataFrame:
    """(buckets, features, y) of rows (words, y)."""
    def run(batches):
        for batch in batches:
            for part in parts(batch):
                owner, buckets, values = scaled_features(part.column(0), bigrams)
                offsets = pa.array(np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (buckets, values)]
                yield pa.RecordBatch.from_arrays([*lists, part.column(1)], names=["buckets", "features", "y"])

    return rows.mapInArrow(run, "buckets array<int>, features array<int>, y int")


def gradient(rows: DataFrame, weights: np.ndarray, balance: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, sum): the gradient over the rows (buckets, features, y), bucket ``BUCKETS`` for the constant."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        total = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for part in parts(batch):
                owner = np.repeat(np.arange(part.num_rows), np.diff(part.column(0).offsets.to_numpy()))
                buckets, values = (part.column(i).flatten().to_numpy().astype(np.int64) for i in (0, 1))
                y = part.column(2).to_numpy(zero_copy_only=False)
                p = probabilities(shared.value, owner, buckets, values, len(y))
                rest = np.floor((p - y) * np.where(y == 1, balance[1], balance[0]) * WEIGHT + 0.5).astype(np.int64)
                np.add.at(total, buckets, rest[owner] * values)
                total[BUCKETS] += rest.sum() * FEATURE
        seen = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["bucket", "g"])

    found = rows.mapInArrow(run, "bucket int, g long").groupBy("bucket").agg(F.sum("g").alias("g")).toArrow()   # at most BUCKETS + 1 rows
    shared.unpersist()
    return found["bucket"].to_numpy(), found["g"].to_numpy()


def train(df: DataFrame, label: Column, text_col: str = "text", id_col: str = "doc_id", featurizer: Featurizer = HARM_FEATURES,
          steps: int = STEPS, rate: float = RATE, max_train_rows: int = MAX_TRAIN_ROWS) -> LinearModel:
    """Fit on the rows whose ``label`` is 0 or 1."""
    key = [c for c in (id_col, text_col) if c in df.columns]
    rows = df.select(*key, label.cast("int").alias("_y")).filter("_y in (0, 1)")
    share = min(1.0, max_train_rows / max(rows.count(), 1))
    rows = rows.filter(F.pmod(F.xxhash64(*key), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = cut_lineage(with_features(rows.select(featurizer.words(F.col(text_col)).alias("words"), "_y"), featurizer.bigrams))
    size = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(size.values())
    balance = tuple(n / (2.0 * size[y]) if size.get(y) else 0.0 for y in (0, 1))
    weights = np.zeros(BUCKETS + 1, np.int64)
    for _ in range(steps if n else 0):
        at, g = gradient(rows, weights, balance)
        weights[at] -= np.floor(g * rate / n / FEATURE + 0.5).astype(np.int64)
    return LinearModel(weights, featurizer)


def score(model: LinearModel, df: DataFrame, positive: str, negative: str, prefix: str,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, <prefix>_label, <prefix>_score)`` for every row of ``df``, where it is
    read: the score is the probability of the label."""
    shared, bigrams = df.sparkSession.sparkContext.broadcast(model.weights), model.featurizer.bigrams

    @F.arrow_udf(DoubleType())
    def positive_share(words: pa.Array) -> pa.Array:
        found = [np.zeros(0)]
        for at in range(0, len(words), COUNTED_ROWS):
            part = words.slice(at, COUNTED_ROWS)
            found.append(probabilities(shared.value, *scaled_features(part, bigrams), len(part)))
        return pa.array(np.concatenate(found))

    p = F.col("_p")
    scored = df.select(id_col, positive_share.asNondeterministic()(model.featurizer.words(F.col(text_col))).alias("_p"))
    return scored.select(id_col, F.when(p > 0.5, F.lit(positive)).otherwise(F.lit(negative)).alias(f"{prefix}_label"),
                         F.greatest(p, 1 - p).alias(f"{prefix}_score"))
