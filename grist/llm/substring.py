"""Removal of repeated word sequences by window hashes (operator 7).

A window is ``window`` consecutive words of one document. Its word sequence is
hashed by Rabin-Karp to 128 bits, so that all windows of a document cost one
pass. A word goes if it lies in a window whose sequence also starts in a
document of smaller id; overlapping windows merge into maximal intervals.

Counting every window's hash in a shuffle would move a multiple of the corpus,
so the count has two levels, and both see every window:

1. Each window is represented by its anchor, the smallest hash of the
   ``ANCHOR``-word sequences in it. Equal windows have equal anchors, and
   neighbouring windows share theirs, so there is one anchor for about 18
   words. Anchors are counted over all texts.
2. Only a window whose anchor lies in two or more different texts can repeat.
   The hashes of these windows are counted with the smallest id of each, and
   windows found in a smaller document give the intervals.

Copies of a whole text need no windows: the smallest id of each text stands
for it in both levels, and in every other copy all windows repeat.

Defined cases: null text has no words; a text shorter than a window loses
nothing; rows with the same id are the same document, none smaller than the
other; a null id counts as larger than every other; windows are judged on the
input; extra columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from grist.llm.common import free_name, key_filter, materialize, release_memory

WINDOW = 50
ANCHOR = 16
LAST_ID = (1 << 63) - 1
BASES = tuple(np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64))


POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (an odd number has an inverse)."""
    have = POWERS.get(int(base))
    if have is None or len(have[0]) < n:
        m = max(1 << 14, 1 << (n - 1).bit_length())
        make = lambda b: np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(m - 1, b, np.uint64))))
        have = POWERS[int(base)] = make(base), make(np.uint64(pow(int(base), -1, 1 << 64)))
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def rolled(h: np.ndarray, length: int, base: np.uint64) -> np.ndarray:
    """Rabin-Karp hashes, modulo 2**64, of all runs of ``length`` hashes: sums
    of h[i + j] * base**-j, from the differences of one running sum."""
    up, down = powers(base, len(h))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * down)))
    return mix((total[length:] - total[:-length]) * up[:len(h) - length + 1])


def anchors(h: np.ndarray, window: int) -> np.ndarray:
    """The anchor of each window: a sliding minimum, by doubling its width."""
    short = min(ANCHOR, window)
    low, width, span = rolled(h, short, BASES[0]), 1, window - short + 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = span - width
    return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low


ANCHOR_ROWS = StructType([StructField("anchor", LongType()), StructField("a", LongType())])


def anchor_rows(window: int):
    def run(batches):
        for batch in batches:
            found, keys, counts = [], [], []
            for text, a in zip(batch.column("t").cast(pa.binary()).to_pylist(), batch.column("a").to_pylist()):
                words = text.split() if text else []
                if len(words) >= window:
                    found.append(np.unique(anchors(word_hashes(words), window)))
                    keys.append(a)
                    counts.append(len(found[-1]))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), pa.array(np.repeat(np.array(keys, np.int64), counts))],
                    names=["anchor", "a"])
        release_memory()
    return run


WINDOW_ROWS = StructType([StructField(c, LongType()) for c in ("h1", "h2", "owner", "a")] + [StructField("pos", IntegerType())])


def window_rows(window: int):
    """Hashes of the windows whose anchors are in the row's list."""
    def run(batches):
        for batch in batches:
            out = []
            for text, own, owner, a in zip(batch.column("t").cast(pa.binary()).to_pylist(), batch.column("anchors"),
                                           batch.column("owner").to_pylist(), batch.column("a").to_pylist()):
                h = word_hashes(text.split())
                at = np.nonzero(np.isin(anchors(h, window), own.values.to_numpy().view(np.uint64)))[0]
                first, second = rolled(h, window, BASES[0])[at], rolled(mix(h), window, BASES[1])[at]
                out.append((first.view(np.int64), second.view(np.int64), np.full(len(at), owner), np.full(len(at), a), at.astype(np.int32)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=WINDOW_ROWS.names)
        release_memory()
    return run


CUT = StructType([
    StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType()),
    StructField("spans", ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])))])


def cut(text: bytes | None, starts: list[int] | None, whole: bool | None, window: int) -> dict:
    """What is left of a text without the windows at ``starts`` (all of them if ``whole``)."""
    words = text.split() if text else []
    spans: list[list[int]] = []
    if whole and len(words) >= window:
        spans = [[0, len(words)]]
    elif starts:
        for s in sorted(starts):
            if spans and s <= spans[-1][1]:
                spans[-1][1] = s + window
            else:
                spans.append([s, s + window])
    removed, at, kept = 0, 0, []
    for s, e in spans:
        kept += words[at:s]
        removed += e - s
        at = e
    left = b" ".join(kept + words[at:] if spans else words)
    return {"n_words": len(words), "n_removed": removed, "kept": left.decode("utf-8", "replace"),
            "spans": [{"start": s, "end": e} for s, e in spans]}


def cutter(window: int):
    @F.arrow_udf(CUT)
    def run(texts: pa.Array, starts: pa.Array, whole: pa.Array) -> pa.Array:
        release_memory()
        return pa.array([cut(*x, window) for x in zip(texts.cast(pa.binary()).to_pylist(), starts.to_pylist(), whole.to_pylist())],
                        pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()),
                                   ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]))
    return run


def removals(rows: DataFrame, window: int) -> DataFrame:
    """(owner, a, starts, whole) of each text that loses words; ``rows`` has
    owner (id), a and b (128 bits of the text) and t (the text)."""
    texts = materialize(rows.groupBy("a", "b").agg(F.min("owner").alias("first"), F.max("owner").alias("last"),
                                                   F.count(F.lit(1)).alias("n")), "texts")
    marks = materialize(rows.mapInArrow(anchor_rows(window), ANCHOR_ROWS), "anchors")
    # written out, so that the joins below read two plain shuffles, whose hot keys adaptive execution can split
    shared = materialize(marks.groupBy("anchor").agg(F.min("a").alias("x"), F.max("a").alias("y")).filter("x < y").select("anchor"), "shared")
    lists = marks.join(shared, "anchor").groupBy("a").agg(F.collect_set("anchor").alias("anchors"))
    # one row for each different text stands for it: that of the smallest id
    lists = materialize(lists.join(texts.select("a", F.col("first").alias("owner")), "a")
                        .withColumn("key", F.xxhash64("owner", "a")), "candidates")
    may_repeat = key_filter(lists, "key")
    candidates = (rows.filter(F.col("t").isNotNull()).select("t", "owner", "a", F.xxhash64("owner", "a").alias("key"))
                  .filter(may_repeat("key")).join(lists.select("owner", "a", "anchors"), ["owner", "a"]))
    windows = materialize(candidates.select("t", "owner", "a", "anchors").mapInArrow(window_rows(window), WINDOW_ROWS), "windows")
    firsts = materialize(windows.groupBy("h1", "h2").agg(F.min("owner").alias("first"), F.max("owner").alias("last"))
                         .filter("first < last").select("h1", "h2", "first"), "firsts")
    hits = windows.join(firsts, ["h1", "h2"]).filter("owner > first").groupBy("owner", "a").agg(F.collect_set("pos").alias("starts"))
    copies = (rows.select("owner", "a", "b").join(texts.filter("first < last").select("a", "b", "first"), ["a", "b"])
              .filter("owner > first").groupBy("owner", "a").agg(F.lit(True).alias("whole")))
    out = hits.select("owner", "a", "starts", F.lit(False).alias("whole")).unionByName(
        copies.select("owner", "a", F.lit(None).cast("array<int>").alias("starts"), "whole"))
    # a text can be in both parts only if hashes of two texts of one id collide; one row each in any case
    return materialize(out.groupBy("owner", "a").agg(F.max("starts").alias("starts"), F.max("whole").alias("whole"))
                       .withColumn("key", F.xxhash64("owner", "a")), "removals")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW,
                   out: str = "kept") -> DataFrame:
    """``df`` with ``n_words``, ``n_removed``, ``spans`` (word indices, end
    exclusive) and ``out``, the remaining words joined by single spaces; columns
    of these names are replaced. ``id_col`` holds integers.

    Texts are shuffled only where they may lose words; the rest pass straight
    from the scan to the cut.
    """
    owner, a, key = free_name(df, "_owner", "_a", "_key")
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = df.withColumns({owner: F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)), a: F.xxhash64(body)})
    light = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("owner"), F.xxhash64(body).alias("a"),
                      F.xxhash64(F.lit("second"), body).alias("b"), F.col(text).alias("t"))
    gone = removals(light, window)
    keyed = keyed.withColumn(key, F.xxhash64(owner, a))
    marked = key_filter(gone, "key")(key)
    test, starts, whole, made = free_name(keyed, "_test", "_starts", "_whole", "_made")
    tested = keyed.withColumn(test, marked)
    gone = gone.select(F.col("owner").alias(owner), F.col("a").alias(a), F.col("starts").alias(starts), F.col("whole").alias(whole))
    hit = tested.filter(F.col(test)).join(gone, [owner, a], "left")
    rest = tested.filter(~F.col(test)).withColumns({starts: F.lit(None).cast("array<int>"), whole: F.lit(None).cast("boolean")})
    both = hit.unionByName(rest)
    done = both.withColumn(made, cutter(window)(F.col(text), F.col(starts), F.col(whole)))
    results = {"n_words": "n_words", "n_removed": "n_removed", "spans": "spans", out: "kept"}
    taken = {c.lower() for c in results}                 # Spark compares names without case
    keep = [F.col(c) for c in df.columns if c.lower() not in taken]
    return done.select(*keep, *[F.col(made)[v].alias(k) for k, v in results.items()])
