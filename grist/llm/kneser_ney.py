"""Quality classifier by an interpolated modified Kneser-Ney model (operator 8).

An n-gram model over characters is trained on trusted text (labelled good);
a document's quality measure is its perplexity per character, and a document is
rejected if that lies above the threshold of its language, a quantile of the
perplexities of trusted documents in that language.

An n-gram is three whole code points packed in one number of 63 bits: any
script, nothing lumped together, no collisions. Two more symbols stand for a
text's start and for the blank between two equal words. Counts stay sharded by
n-gram from the first to the last step:

* training: every map task sends partial counts to the n-gram's shard. There
  the count tables of the orders are joined: number of n-grams of count 1 to 4
  (which give the three discounts of each order), contexts with their totals and
  numbers of followers, lower orders with continuation counts, interpolated
  order by order into probabilities;
* scoring: the scan counts each text's n-grams (a partial sum) and scores those
  among the model's ``HOT`` most frequent, a table of fixed size that is
  broadcast. All others, seen in training or not, go as (text, n-gram, count)
  to the n-gram's shard; each distinct one is joined once with the orders of
  the model, unseen ones backing off, and the sums return to the texts. Copies
  of a text are one text there. No text is shuffled.

Log probabilities are whole multiples of 2**-24, so sums are the same in any order.

The model learns from all rows of one half of the trusted ids; the thresholds come
from all rows of the other half, texts that the model hasn't seen: ``SLACK`` times
their quantile. A language with
fewer than ``MIN_TRUSTED`` of them takes the threshold of all languages.

Defined cases: null or empty text has no perplexity and is rejected; without
trusted rows nothing else is rejected; null languages are a language of their
own; repeated rows get equal results; a very long text is counted in pieces and
its counts added; label rows of unknown ids are ignored and an id that is
labelled good and bad isn't trusted; an empty table gives an empty result;
columns of ``df`` named as a result are replaced, all others stay.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from grist.llm.common import free_name, key_filter, materialize, release_memory, text_key
from grist.operators import skew

ORDER = 3
BITS = 21                   # of a symbol: a code point or one of the two below
START, REPEAT = 0x110000, 0x110001      # a text's start, a blank between equal words
HOT = 1 << 19               # n-grams whose scores are broadcast: 8 MB
PIECE = 1 << 20             # characters counted at a time
UNIT = float(1 << 24)       # log10 probabilities are kept in multiples of 1 / UNIT
QUANTILE = 0.995            # of the perplexities of trusted documents that the model hasn't seen
SLACK = 1.25                # times that quantile
MIN_TRUSTED = 30
REPEAT_CHARACTER = "\ue000"         # stands for REPEAT within this module; in a text it is U+FFFD
REPEATED = re.compile(r"(?<!\S)(\S++)\s++(?=\1(?!\S))")


def symbols(text: str) -> np.ndarray:
    """Symbols of a text, after ``ORDER - 1`` starts."""
    text = REPEATED.sub(rf"\1{REPEAT_CHARACTER}", text.replace(REPEAT_CHARACTER, "\ufffd"))
    own = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    own = np.where(own == ord(REPEAT_CHARACTER), np.uint32(REPEAT), own)
    return np.concatenate((np.full(ORDER - 1, START, np.uint32), own))


def grams(symbols: np.ndarray) -> np.ndarray:
    """The n-gram that ends at each character, as one number."""
    n = len(symbols) - ORDER + 1
    return reduce(lambda g, i: (g << BITS) | symbols[i:n + i].astype(np.int64), range(1, ORDER), symbols[:n].astype(np.int64))


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A text's distinct n-grams and their counts."""
    own = symbols(text)
    parts = [np.unique(grams(own[i:i + PIECE + ORDER - 1]), return_counts=True) for i in range(0, len(own) - ORDER + 1, PIECE)]
    return parts[0] if len(parts) == 1 else added(parts)


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sum of several tables of counts."""
    found, place = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return found, np.bincount(place, np.concatenate([n for _, n in parts]), len(found)).astype(np.int64)


def gram_counts(trusted: DataFrame) -> DataFrame:
    """(g, n): counts of the full-order n-grams of the texts ``t``."""
    def run(batches):
        for batch in batches:
            parts = [counted(t) for t in batch.column("t").to_pylist() if t]
            if parts:
                found, n = added(parts)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["g", "n"])

    return trusted.mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """The three discounts of modified Kneser-Ney from the numbers of n-grams
    of count 1 to 4 (1/2, 1, 3/2 where one of these is missing)."""
    n = {r["n"]: r["m"] for r in counts.filter("n between 1 and 4").groupBy("n").agg(F.count(F.lit(1)).alias("m")).collect()}
    if any(not n.get(i) for i in (1, 2, 3, 4)):
        return 0.5, 1.0, 1.5
    y = n[1] / (n[1] + 2 * n[2])
    return tuple(min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.0), float(i)) for i in (1, 2, 3))


def last(g: str, k: int) -> Column:
    """The n-gram of the last ``k`` symbols of ``g``."""
    return F.col(g).bitwiseAND(F.lit((1 << BITS * k) - 1))


def units(p: Column) -> Column:
    return F.round(F.log10(F.greatest(p, F.lit(1e-30))) * UNIT).cast("long")


class Model:
    """Tables sharded by n-gram. ``seen[k]``: (g, n, p), the probability of the last
    symbol of n-gram g after the others. ``rest[k]``: (h, rest), the share that the
    context h leaves to the order below. ``nowhere``: probability of an unseen character."""

    def __init__(self, counts: DataFrame):
        by_order = {ORDER: counts}
        for k in range(ORDER - 1, 0, -1):
            # continuation counts: in how many different longer n-grams it ends
            by_order[k] = materialize(by_order[k + 1].groupBy(last("g", k).alias("g")).agg(F.count(F.lit(1)).alias("n")), f"counts-{k}")
        self.seen, self.rest = {}, {}
        for k in range(1, ORDER + 1):
            d1, d2, d3 = discounts(by_order[k])
            rows = by_order[k].withColumn("h", F.shiftright("g", BITS))
            cut = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
            contexts = materialize(rows.groupBy("h").agg(F.sum("n").alias("total"), (F.sum(cut) / F.sum("n")).alias("rest")), f"contexts-{k}")
            own = rows.join(contexts, "h").withColumn("own", (F.col("n") - cut) / F.col("total"))
            if k == 1:
                left = contexts.select("rest").first()
                self.nowhere = (left["rest"] if left else 1.0) / (by_order[1].count() + 1)
                made = own.withColumn("p", F.col("own") + F.lit(self.nowhere))
            else:
                # the same symbol after the context without its first symbol
                shorter = self.seen[k - 1].select(F.col("g").alias("short"), F.col("p").alias("lower"))
                made = own.withColumn("short", last("g", k - 1)).join(shorter, "short").withColumn("p", F.col("own") + F.col("rest") * F.col("lower"))
            self.seen[k] = materialize(made.select("g", "n", "p"), f"order-{k}")
            self.rest[k] = contexts.select("h", "rest")
        top = self.seen[ORDER].orderBy(F.desc("n"), "g").limit(HOT).select("g", units(F.col("p")).alias("u")).orderBy("g").toArrow()
        self.hot = counts.sparkSession.sparkContext.broadcast((top["g"].to_numpy(), top["u"].to_numpy()))

    def scores(self, wanted: DataFrame) -> DataFrame:
        """(g, u) for distinct n-grams ``g``, seen or not. The tables that are
        broadcast have a row a code point at most."""
        full, context = self.seen[ORDER], self.rest[ORDER]
        out = wanted.select("g", F.shiftright("g", BITS).alias("_ab"), last("g", 2).alias("_bc"))
        out = (out.join(full.select("g", F.col("p").alias("_p3")), "g", "left")
               .join(context.select(F.col("h").alias("_ab"), F.col("rest").alias("_r3")), "_ab", "left")
               .join(self.seen[2].select(F.col("g").alias("_bc"), F.col("p").alias("_p2")), "_bc", "left")
               .withColumns({"_b": F.shiftright("_bc", BITS), "_c": last("_bc", 1)})
               .join(F.broadcast(self.rest[2].select(F.col("h").alias("_b"), F.col("rest").alias("_r2"))), "_b", "left")
               .join(F.broadcast(self.seen[1].select(F.col("g").alias("_c"), F.col("p").alias("_p1"))), "_c", "left"))
        one = F.lit(1.0)
        p2 = F.coalesce("_p2", F.coalesce("_r2", one) * F.coalesce("_p1", F.lit(self.nowhere)))
        return out.select("g", units(F.coalesce("_p3", F.coalesce("_r3", one) * p2)).alias("u"))

    def profile(self, text: Column) -> Column:
        """(n, hot, g, m): a text's characters, the log probability of its hot
        n-grams, and the other n-grams with their counts."""
        shared = self.hot
        longs = ArrayType(LongType(), False)

        @F.arrow_udf(StructType([StructField("n", LongType()), StructField("hot", LongType()), StructField("g", longs), StructField("m", longs)]))
        def run(texts: pa.Array) -> pa.Array:
            keys, scores = shared.value
            size, total, cold = [], [], []
            for t in texts.to_pylist():
                found, n = counted(t) if t else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                place = np.minimum(np.searchsorted(keys, found), max(len(keys) - 1, 0))
                hit = keys[place] == found if len(keys) else np.zeros(len(found), bool)
                size.append(int(n.sum()))
                total.append(int((scores[place[hit]] * n[hit]).sum()))
                cold.append((found[~hit], n[~hit]))
            offsets = np.concatenate(([0], np.cumsum([len(g) for g, _ in cold]))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([c[i] for c in cold] or [np.zeros(0, np.int64)])))
                     for i in (0, 1)]
            release_memory()
            return pa.StructArray.from_arrays([pa.array(size, pa.int64()), pa.array(total, pa.int64()), *lists], names=["n", "hot", "g", "m"])

        return run(text)

    def measure(self, rows: DataFrame, text: str = "t", out: str = "perplexity") -> DataFrame:
        """``rows`` with ``perplexity`` and the key ``text_key`` in place of the text."""
        kept = [c for c in rows.columns if c != text]
        profiles = materialize(rows.select(*kept, text_key(F.col(text)).alias("text_key"), self.profile(F.col(text)).alias("_own")), "profiles")
        # one row a text, however many copies it has; map tasks send one each
        texts = materialize(profiles.filter("_own.n > 0").groupBy("text_key").agg(F.first("_own").alias("_own"), F.count(F.lit(1)).alias("rows")), "texts")
        entries = texts.select("text_key", F.explode(F.arrays_zip("_own.g", "_own.m")).alias("e")).select("text_key", "e.g", "e.m")
        wanted = materialize(entries.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "wanted")
        cold = (skew.split_join(entries, materialize(self.scores(wanted), "scores"), ["g"], key_counts=wanted)
                .groupBy("text_key").agg(F.sum(F.col("m") * F.col("u")).alias("cold")))
        logs = (F.col("_own.hot") + F.coalesce("cold", F.lit(0))) / UNIT / F.col("_own.n")
        done = materialize(texts.join(cold, "text_key", "left").select("text_key", F.pow(F.lit(10.0), -logs).alias(out), "rows"), "perplexities")
        return skew.split_join(profiles.drop("_own"), done.drop("rows"), ["text_key"], "left", key_counts=done, count_col="rows").select(*kept, "text_key", out)


def train(trusted: DataFrame, text: str = "text") -> Model:
    """Train on all rows of ``trusted``."""
    texts = trusted.select(F.col(text).alias("t")).filter("t is not null and t <> ''")
    return Model(materialize(gram_counts(texts), "grams"))


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", label: str = "quality") -> DataFrame:
    """(trusted_id, learns): ids labelled good and never bad, half of them for the model."""
    return (labels.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(label).alias("least")).filter("least = 1")
            .select(F.col(id_col).alias("trusted_id"), (F.pmod(F.xxhash64(F.lit("half"), id_col), F.lit(2)) == 0).alias("learns")))


def rows_of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """All ``rows`` whose ``trusted_id`` is in ``ids``, however many these are. Texts are
    shuffled only if a filter of fixed size can't tell their ids from those."""
    if rows.schema["trusted_id"].dataType == ids.schema["trusted_id"].dataType:
        suspect = key_filter(ids.select(F.xxhash64("trusted_id").alias("h")), "h")
        rows = rows.withColumn("h", F.xxhash64("trusted_id")).filter(suspect("h")).drop("h")
    return skew.split_join(rows, ids, ["trusted_id"], "left_semi")


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", language: str = "lang",
        quantile: float = QUANTILE, slack: float = SLACK, least: int = MIN_TRUSTED):
    """(measured, limits, limit): all rows' id, ``language``, ``text_key`` and
    ``perplexity``; (language, no_language, threshold) rows; the threshold of
    languages that have too few trusted rows."""
    trusted = materialize(trusted_ids(labels, id_col), "trusted")
    model = train(rows_of(df.select(F.col(id_col).alias("trusted_id"), F.col(text).alias("t")), trusted.filter("learns").select("trusted_id")), "t")
    rows = df.select(F.col(id_col).alias("id"), F.col(language).cast("string").alias("language"), F.col(text).alias("t"))
    measured = materialize(model.measure(rows), "measured")
    others = trusted.filter("not learns")
    good = (measured.join(others, measured["id"] == others["trusted_id"], "left_semi").filter("perplexity is not null")
            .select(F.coalesce("language", F.lit("")).alias("language"), F.col("language").isNull().alias("no_language"), "perplexity"))
    value = (F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000)) * F.lit(slack)).alias("threshold")
    limits = materialize(good.groupBy("language", "no_language").agg(F.count(F.lit(1)).alias("n"), value)
                         .filter(F.col("n") >= least).drop("n"), "thresholds")
    return measured, limits, good.agg(value).first()["threshold"]


def judge(measured: DataFrame, limits: DataFrame, limit: float | None, language: str = "language") -> DataFrame:
    """``measured`` with ``threshold`` and ``kept``."""
    code, missing, own = free_name(measured, "_language", "_no_language", "_own")
    limits = limits.select(F.col("language").alias(code), F.col("no_language").alias(missing), F.col("threshold").alias(own))
    keyed = measured.withColumns({code: F.coalesce(F.col(language).cast("string"), F.lit("")), missing: F.col(language).isNull()})
    judged = keyed.join(limits, [code, missing], "left").withColumn("threshold", F.coalesce(F.col(own), F.lit(limit).cast("double")))
    return (judged.withColumn("kept", F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))
            .drop(code, missing, own))


def row_key(text: str, language: str) -> Column:
    """What a verdict depends on: the text and the language."""
    code = F.col(language).cast("string")
    return F.struct(text_key(F.col(text)).alias("text"), F.coalesce(code, F.lit("")).alias("language"), code.isNull().alias("no_language"))


def verdicts(judged: DataFrame) -> DataFrame:
    """(key, rows, perplexity, threshold, kept), a row for each text and language."""
    key = F.struct(F.col("text_key").alias("text"), F.coalesce("language", F.lit("")).alias("language"), F.col("language").isNull().alias("no_language"))
    return materialize(judged.groupBy(key.alias("key")).agg(
        F.count(F.lit(1)).alias("rows"), *[F.first(c).alias(c) for c in ("perplexity", "threshold", "kept")]), "verdicts")


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", language: str = "lang", **options) -> DataFrame:
    """``df`` with ``perplexity``, ``threshold`` and ``kept`` (replaced if they exist)."""
    found = verdicts(judge(*fit(df, labels, id_col, text, language, **options)))
    base = df.drop("perplexity", "threshold", "kept")
    key, = free_name(base, "_key")
    found = found.withColumnRenamed("key", key)
    rows = base.withColumn(key, row_key(text, language))
    return (skew.split_join(rows, found.drop("rows"), [key], "left", key_counts=found, count_col="rows")
            .select(*base.columns, "perplexity", "threshold", "kept"))


def keep(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", language: str = "lang", **options) -> DataFrame:
    """The rows of ``df`` that :func:`classify` keeps. Only rows that a filter of
    fixed size can't tell from rejected ones are shuffled; an anti-join decides on them."""
    key, hashed = free_name(df, "_key", "_hash")
    bad = verdicts(judge(*fit(df, labels, id_col, text, language, **options))).filter("not kept").select(F.col("key").alias(key), "rows")
    suspect = key_filter(bad.select(F.xxhash64(key).alias(hashed)), hashed)
    rows = df.withColumn(key, row_key(text, language)).withColumn(hashed, F.xxhash64(key)).withColumn("_suspect" + key, suspect(hashed))
    clear = rows.filter(~F.col("_suspect" + key)).select(*df.columns)
    asked = skew.split_join(rows.filter(F.col("_suspect" + key)), bad.select(key), [key], "left_anti", key_counts=bad, count_col="rows")
    return clear.unionByName(asked.select(*df.columns))
