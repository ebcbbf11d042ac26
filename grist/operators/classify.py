"""Train-and-score text classifiers as Spark jobs.

The reference calls pre-trained models that are not available; here each head
is a multinomial naive Bayes model trained on a labelled DataFrame with
aggregates and applied inside the scan:

* features: lower-cased word runs, optionally plus word bigrams, each hashed
  to one of ``BUCKETS`` buckets (the first 20 bits of its md5, which any engine
  computes alike). No feature is dropped; the width of the model is fixed;
* training: each task counts its rows by bucket, head and class in arrays of the
  model's size, ``groupBy(bucket)`` sums them; Laplace-smoothed log-probabilities. All
  labelled rows are used to fit, however many; a bucket that no training row fills says nothing and is skipped;
* scoring: the log-probabilities are a matrix with a row for each seen bucket (at
  most 8 MB a class), broadcast once; a row is scored where it is read, by an
  Arrow UDF over its words: a batch's distinct words and word pairs are hashed
  once, and its documents summed in numpy. No explode, join, shuffle or
  checkpoint, so texts never move. The UDF is marked as not deterministic, which
  keeps Spark from running it again for a filter on its result.

Score: length-normalised log joint ``z_c = (log prior_c + sum log p(f|c)) /
(m + 1)`` over the ``m`` feature occurrences with a seen bucket, turned into a
probability with a softmax at temperature ``TEMPERATURE``. The label is the
arg-max (ties: the smallest class name). A null text scores by the priors.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from grist.functions import text as T
from grist.session import cut_lineage, release_memory

TEMPERATURE = 10.0
BUCKET_DIGITS = 5                       # hexadecimal digits of a feature's md5
BUCKETS = 16 ** BUCKET_DIGITS
CACHED_FEATURES = 200_000
COUNTED_ROWS = 1000                     # documents whose features a training task holds at once
BYTES = (BUCKET_DIGITS + 1) // 2        # of the md5 that hold these digits


@dataclass(frozen=True)
class Featurizer:
    newline: str = " "      # '' fuses lines (language ID), ' ' for the other heads
    bigrams: bool = False

    def words(self, text: Column) -> Column:
        return T.word_runs(F.lower(T.flatten_newlines(text, self.newline)))

    def with_features(self, df: DataFrame, text_col: str, out: str = "_feats") -> DataFrame:
        """Adds the feature array (unigrams, then bigrams) of ``text_col``."""
        w = "_fw"
        df = df.withColumn(w, self.words(F.col(text_col)))
        if self.bigrams:
            m = F.greatest(F.size(w) - 1, F.lit(0))
            bi = F.zip_with(F.slice(w, 1, m), F.slice(w, 2, m),
                            lambda x, y: F.concat(x, F.lit(" "), y))
            return df.withColumn(out, F.concat(F.col(w), bi)).drop(w)
        return df.withColumnRenamed(w, out)


LANGUAGE_FEATURES = Featurizer(newline="", bigrams=False)
HARM_FEATURES = Featurizer(newline=" ", bigrams=True)
QUALITY_FEATURES = Featurizer(newline=" ", bigrams=True)


def bucket(feature: Column) -> Column:
    digits = F.substring(F.md5(feature.cast("binary")), 1, BUCKET_DIGITS)
    return F.conv(digits, 16, 10).cast("int")


class BucketCache(dict):
    """Bucket by feature, for a worker."""

    def __missing__(self, feature: str) -> int:
        if len(self) >= CACHED_FEATURES:
            self.clear()
        digest = md5(feature.encode(), usedforsecurity=False).digest()
        value = self[feature] = int.from_bytes(digest[:BYTES], "big") >> 8 * BYTES - 4 * BUCKET_DIGITS
        return value


BUCKET_OF = BucketCache()


@dataclass
class NBModel:
    name: str
    classes: list[str]            # sorted
    log_priors: list[float]
    table: DataFrame              # bucket + log-probability columns (may hold other heads)
    featurizer: Featurizer
    cols: list[str]               # this head's log-probability columns, class order
    dense: object                 # broadcast (columns, rows, matrix) shared by the heads of a table


def _dense(table: DataFrame):
    """Broadcast the model: its columns, the matrix row of each bucket (-1: not
    seen) and the matrix; at most ``BUCKETS`` rows are fetched."""
    cols = [c for c in table.columns if c != "bucket"]
    found = table.toArrow()
    row = np.full(BUCKETS, -1, np.int32)
    row[found["bucket"].to_numpy()] = np.arange(found.num_rows)
    matrix = np.stack([found[c].to_numpy() for c in cols], axis=1)
    return table.sparkSession.sparkContext.broadcast((cols, row, matrix))


def train_heads(df: DataFrame, text_col: str, featurizer: Featurizer,
                heads: dict[str, tuple[Column, list[str]]], alpha: float = 1.0) -> dict[str, NBModel]:
    """Fit several naive Bayes heads that share features and training rows in
    one pass: ``heads`` maps a name to ``(label column, class names)``.

    One pass over the texts: a task counts its documents' features by bucket,
    head and class (arrays of a fixed size) and sends the buckets that it has
    seen; bucket -1 counts documents.
    """
    names = list(heads)
    ycols = {h: f"_y{i}" for i, h in enumerate(names)}
    classes = {h: sorted(heads[h][1]) for h in names}
    rows = df.select(text_col, *[heads[h][0].alias(ycols[h]) for h in names])
    class_of = [F.coalesce(F.array_position(F.array(*[F.lit(c) for c in classes[h]]), F.col(ycols[h])), F.lit(0)).cast("int")
                .alias(ycols[h]) for h in names]
    coded = rows.select(featurizer.words(F.col(text_col)).alias("words"), *class_of)
    ncols = [f"n_{ycols[h]}_{i}" for h in names for i in range(len(classes[h]))]
    widths, bigrams = [len(classes[h]) for h in names], featurizer.bigrams

    def count(batches):
        totals, documents = np.zeros((len(ncols), BUCKETS), np.int64), np.zeros(len(ncols), np.int64)
        flat = totals.reshape(-1)
        for batch in batches:
            for part in (batch.slice(i, COUNTED_ROWS) for i in range(0, batch.num_rows, COUNTED_ROWS)):
                buckets, sizes = features_of(part.column(0), bigrams)
                at = 0
                for k, width in enumerate(widths, 1):
                    own = part.column(k).to_numpy(zero_copy_only=False)
                    owner = np.repeat(own, sizes).astype(np.int64)
                    labelled = owner > 0
                    np.add.at(flat, (at - 1 + owner[labelled]) * BUCKETS + buckets[labelled], 1)
                    documents[at:at + width] += np.bincount(own, minlength=width + 1)[1:]
                    at += width
            release_memory()
        seen = np.nonzero(totals.any(axis=0))[0]
        columns = [np.append(c[seen], n) for c, n in zip(totals, documents)]
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1), pa.int32()), *map(pa.array, columns)], names=["bucket", *ncols])

    schema = "bucket int, " + ", ".join(f"{c} long" for c in ncols)
    wide = cut_lineage(coded.mapInArrow(count, schema).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ncols]))
    doc_counts = wide.filter("bucket < 0").first()
    wide = wide.filter("bucket >= 0")
    totals = wide.agg(F.count(F.lit(1)).alias("v"), *[F.sum(c).alias(c) for c in ncols]).first()
    v = totals["v"]
    lp = [F.log((F.col(c) + alpha) / F.lit(float((totals[c] or 0) + alpha * v))).alias("lp" + c[1:])
          for c in ncols]
    table = cut_lineage(wide.select("bucket", *lp))
    dense = _dense(table)
    models = {}
    for h in names:
        k = len(classes[h])
        docs = [doc_counts[f"n_{ycols[h]}_{i}"] or 0 if doc_counts else 0 for i in range(k)]
        total = sum(docs)
        priors = [math.log(n / total) if n else -1e30 for n in docs]
        models[h] = NBModel(h, classes[h], priors, table, featurizer,
                            [f"lp_{ycols[h]}_{i}" for i in range(k)], dense)
    return models


def train_nb(df: DataFrame, label_col: str, text_col: str, featurizer: Featurizer,
             name: str, alpha: float = 1.0) -> NBModel:
    """Fit one head on ``(label, text)`` rows (classes = distinct labels)."""
    classes = [r[0] for r in df.select(label_col).distinct().collect()]  # one row per class
    return train_heads(df, text_col, featurizer, {name: (F.col(label_col), classes)}, alpha)[name]


def save_models(models: list[NBModel], path: str) -> None:
    """Write heads that share a table: the table as Parquet, the rest as JSON."""
    first = models[0]
    if any(m.table is not first.table for m in models):
        raise ValueError("heads saved together must share their table")
    about = [{"name": m.name, "classes": m.classes, "log_priors": m.log_priors, "cols": m.cols,
              "newline": m.featurizer.newline, "bigrams": m.featurizer.bigrams} for m in models]
    first.table.write.mode("overwrite").parquet(f"{path}/table")
    first.table.sparkSession.createDataFrame([(json.dumps(about),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}/heads")


def load_models(spark: SparkSession, path: str) -> dict[str, NBModel]:
    """Heads written by :func:`save_models`, by name; nothing is trained anew."""
    table = spark.read.parquet(f"{path}/table")
    dense = _dense(table)
    about = json.loads(spark.read.text(f"{path}/heads", wholetext=True).first()[0])
    return {a["name"]: NBModel(a["name"], a["classes"], a["log_priors"], table,
                               Featurizer(a["newline"], a["bigrams"]), a["cols"], dense) for a in about}


def features_of(words: pa.Array, bigrams: bool) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of a batch's documents, one document after the
    other (words, then word pairs), and each document's number of features."""
    sizes = np.fromiter((len(w) if w.is_valid else 0 for w in words), np.int64, len(words)) if words.null_count else \
        np.diff(words.offsets.to_numpy()).astype(np.int64)
    coded = words.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    single = np.fromiter(map(BUCKET_OF.__getitem__, names), np.int64, len(names))[codes]
    if not bigrams:
        return single, sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    inside = owner[1:] == owner[:-1]
    pairs, place = np.unique(codes[:-1][inside] * max(len(names), 1) + codes[1:][inside], return_inverse=True)
    first, second = np.divmod(pairs, max(len(names), 1))
    of = BUCKET_OF.__getitem__
    hashed = np.fromiter((of(f"{names[i]} {names[j]}") for i, j in zip(first.tolist(), second.tolist())), np.int64, len(pairs))
    both = np.concatenate((single, hashed[place]))
    order = np.argsort(np.concatenate((owner, owner[1:][inside])), kind="stable")
    return both[order], sizes + np.maximum(sizes - 1, 0)


def sums_of(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of each document's rows; a document without rows has 0."""
    out = np.zeros((len(sizes), rows.shape[1]))
    some = sizes > 0
    if some.any():
        starts = (np.cumsum(sizes) - sizes)[some]
        out[some] = np.add.reduceat(rows, starts, axis=0)
    return out


def with_scores(models: list[NBModel], df: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``<name>_label`` and ``<name>_score`` for heads that share
    one table and featurizer. Narrow: each row is scored where it is. Columns of
    ``carry`` go through the UDF with the words: what follows reads their values
    instead of computing their expressions again."""
    feat, shared = models[0].featurizer, models[0].dense
    if any(m.table is not models[0].table or m.featurizer != feat for m in models):
        raise ValueError("heads scored together must share their table and featurizer")
    about = [(m.classes, np.array(m.log_priors), m.cols) for m in models]
    names = [f"{m.name}_{x}" for m in models for x in ("label", "score")]
    bigrams = feat.bigrams
    fields = [Ty.StructField(n, Ty.StringType() if n.endswith("_label") else Ty.DoubleType()) for n in names]
    kept = [c for c in df.columns if c not in names and c not in carry]
    carried = [f for f in df.schema.fields if f.name in carry]

    @F.arrow_udf(Ty.StructType(fields + [Ty.StructField(f.name, f.dataType) for f in carried]))
    def scores(words: pa.Array, *values: pa.Array) -> pa.Array:
        cols, row, matrix = shared.value
        buckets, sizes = features_of(words, bigrams)
        seen = row[buckets]
        hit = seen >= 0
        known = sums_of(hit[:, None].astype(np.int64), sizes)[:, 0]
        sums = sums_of(matrix[seen[hit]], known.astype(np.int64))
        found = []
        for classes, priors, own in about:
            z = (priors + sums[:, [cols.index(c) for c in own]]) / (known + 1)[:, None]
            best = z.argmax(axis=1) if len(z) else np.zeros(0, np.int64)
            top = z[np.arange(len(z)), best]
            found.append(pa.array(classes, pa.string()).take(pa.array(best)))
            found.append(pa.array(1.0 / np.exp((z - top[:, None]) * TEMPERATURE).sum(axis=1)))
        release_memory()
        return pa.StructArray.from_arrays([*found, *values], names=[*names, *[f.name for f in carried]])

    run = scores.asNondeterministic()
    out = df.withColumn("_scores", run(feat.words(F.col(text_col)), *[F.col(f.name) for f in carried]))
    return out.select(*kept, *[F.col("_scores")[n].alias(n) for n in [*[f.name for f in carried], *names]])


def score_heads(models: list[NBModel], df: DataFrame, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``(id, <name>_label, <name>_score ...)`` for every row of ``df``."""
    scored = with_scores(models, df.select(id_col, text_col), text_col)
    return scored.select(id_col, *[f"{m.name}_{x}" for m in models for x in ("label", "score")])


def score_nb(model: NBModel, df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             prefix: str | None = None) -> DataFrame:
    """``(id, <prefix>_label, <prefix>_score)`` for every row of ``df``."""
    out = score_heads([model], df, id_col, text_col)
    if prefix and prefix != model.name:
        out = (out.withColumnRenamed(f"{model.name}_label", f"{prefix}_label")
               .withColumnRenamed(f"{model.name}_score", f"{prefix}_score"))
    return out


# --- training sets from the driver tables ------------------------------------

def binary_labels(flag: Column, positive: str, negative: str) -> Column:
    return F.when(flag == 1, F.lit(positive)).otherwise(F.lit(negative))


def train_language(documents: DataFrame) -> NBModel:
    """Language head trained on ``documents.lang``."""
    return train_nb(documents.select("doc_id", "lang", "text"), "lang", "text", LANGUAGE_FEATURES,
                    "lang")


# name -> (flag column in ``labels``, positive label, negative label). The
# driver tables have no nsfw column; the nsfw head is trained on ``toxic``
# (the operator takes any 0/1 column).
BINARY_HEADS = {
    "nsfw": ("toxic", "nsfw", "non-nsfw"),
    "toxic": ("toxic", "toxic", "non-toxic"),
    "quality": ("quality", "high_quality", "low_quality"),
}


def train_binary_heads(documents: DataFrame, labels: DataFrame, names=("nsfw", "toxic", "quality")) -> dict[str, NBModel]:
    """C2-C5 in one pass over ``documents JOIN labels`` (shared features)."""
    train = documents.select("doc_id", "text").join(labels, "doc_id", "inner")
    heads = {}
    for n in names:
        flag, pos, neg = BINARY_HEADS[n]
        heads[n] = (binary_labels(F.col(flag), pos, neg), [pos, neg])
    return train_heads(train, "text", HARM_FEATURES, heads)


def train_nsfw(documents, labels) -> NBModel:
    return train_binary_heads(documents, labels, ("nsfw",))["nsfw"]


def train_toxic(documents, labels) -> NBModel:
    return train_binary_heads(documents, labels, ("toxic",))["toxic"]


def train_quality(documents, labels) -> NBModel:
    return train_binary_heads(documents, labels, ("quality",))["quality"]
