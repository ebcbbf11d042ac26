"""Language identification by rank-order profiles (operator 13).

A language's profile is the list of its ``PROFILE`` most frequent character
n-grams (1 to 3 characters) over all training documents, by rank. A document's
own list is made in the same way from its whole text and compared with each
profile: an n-gram adds the difference of its two ranks, or ``PROFILE`` where
the profile lacks it. The language of the smallest sum (the out-of-place
distance) is predicted.

An n-gram consists of letters and marks in lower case; one gap symbol stands
for everything between two words and at both ends, and no n-gram has it in the
middle. Three symbols of 21 bits fit a 64-bit number, so n-grams are exact
numbers for every script. Equal counts share the mean of their ranks, since the
n-grams of a short text mostly occur once; where equal counts meet the end of a
list, those of smaller code points stay.

* training: map tasks count n-grams by language in numpy and send partial
  counts, so a language that holds most rows costs no more than others; a
  window with a row limit keeps each language's first ``PROFILE`` (every task
  cuts its own rows before the shuffle);
* prediction: the profiles (``PROFILE`` rows a language, their number is
  checked) are broadcast as arrays and read by an Arrow UDF in the scan.

Defined cases: null text, or text without a letter, gives ``und`` and score 0;
so does everything where nothing was learned. Rows of null language are not
learned from. Equal distances: the language of smaller code points. Repeated
rows count as often as they occur and get equal results; empty tables give
empty results; long texts are counted in slices. Columns that the operator adds
replace those of the same name, whatever the case of the letters.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from grist.llm.common import free_name, release_memory

PROFILE = 300
MAX_LANGUAGES = 5_000       # profiles that may be broadcast: 1.5 M rows, 24 MB
UNKNOWN = "und"
GAP, BITS = 1, 21
SLICE = 1 << 20             # symbols whose n-grams are counted at once
PENDING = 1 << 21           # counted n-grams that a training task holds before it sends them
NOTHING = np.zeros(0, np.int64), np.zeros(0, np.int64)


@lru_cache(1)
def classes() -> np.ndarray:
    """By code point: 2 for letters, 1 for marks, 0 for the rest."""
    kind = {"L": 2, "M": 1}
    return np.fromiter((kind.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)), np.uint8, 0x110000)


def symbols(text: str | None) -> np.ndarray | None:
    """Words of letters and marks with one ``GAP`` between and around them; None without a letter."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    kind = classes()[points]
    if not (kind == 2).any():
        return None
    word = kind > 0
    keep = word.copy()
    keep[1:] |= word[:-1]                   # with the first character after a word
    own = np.where(word, points, GAP)[keep]
    return np.concatenate(([GAP], own, [GAP] if own[-1] != GAP else [])).astype(np.uint32)


def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of counts by n-gram, in the order of the n-grams."""
    if len(parts) < 2:
        return parts[0] if parts else NOTHING
    grams, counts = (np.concatenate(x) for x in zip(*parts))
    found, place = np.unique(grams, return_inverse=True)
    return found, np.bincount(place, weights=counts, minlength=len(found)).astype(np.int64)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a whole text and their counts."""
    own = symbols(text)
    parts = []
    for start in range(0, 0 if own is None else len(own), SLICE):
        s = own[start:start + SLICE + 2].astype(np.int64)
        first, second, third = s[:SLICE], s[1:SLICE + 1], s[2:]
        two = first[:len(second)] << BITS | second
        three = (two[:len(third)] << BITS | third)[second[:len(third)] != GAP]
        found, n = np.unique(np.concatenate((first[first != GAP], two, three)), return_counts=True)
        parts.append((found, n.astype(np.int64)))
    return merge(parts)


def ranked(grams: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``size`` most frequent n-grams and their ranks from 0; equal counts share their mean rank."""
    order = np.lexsort((grams, -counts))[:size]
    _, first, n = np.unique(-counts[order], return_index=True, return_counts=True)
    return grams[order], np.repeat(first + (n - 1) / 2, n)


def language_counts(df: DataFrame, text: str = "text", language: str = "lang") -> DataFrame:
    """(language, gram, n) over all rows of ``df`` that have a language."""
    def run(batches):
        pending: dict[str, list] = {}
        held = 0

        def rows():
            for name, parts in pending.items():
                grams, n = merge(parts)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams), pa.string()), pa.array(grams), pa.array(n)],
                                                 names=["language", "gram", "n"])
            pending.clear()
            release_memory()

        for batch in batches:
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counted = gram_counts(t)
                if len(counted[0]):
                    parts = pending.setdefault(name, [])
                    parts.append(counted)
                    held += len(counted[0])
                    if held >= PENDING:
                        yield from rows()
                        held = 0
        yield from rows()

    rows = df.select(F.col(language).cast("string").alias("language"), F.col(text).alias("t")).filter("language is not null and t is not null")
    return rows.mapInArrow(run, "language string, gram long, n long").groupBy("language", "gram").agg(F.sum("n").alias("n"))


class Profiles:
    """Profiles of all learned languages, as one sorted list of (n-gram, language, rank)."""

    def __init__(self, languages: list[str], grams: np.ndarray, owners: np.ndarray, ranks: np.ndarray, size: int):
        order = np.lexsort((owners, grams))
        self.languages, self.size = languages, size
        self.grams, self.owners, self.ranks = grams[order], owners[order].astype(np.int32), ranks[order]

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language, and 1 less its distance as a share of the largest possible."""
        grams, counts = gram_counts(text)
        if not len(grams) or not self.languages:
            return UNKNOWN, 0.0
        grams, ranks = ranked(grams, counts, self.size)
        low, high = np.searchsorted(self.grams, grams, "left"), np.searchsorted(self.grams, grams, "right")
        n = high - low
        at = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)      # all entries of all found n-grams
        gained = self.size - np.abs(self.ranks[at] - np.repeat(ranks, n))
        nearness = np.bincount(self.owners[at], weights=gained, minlength=len(self.languages))
        best = int(nearness.argmax())                                         # the first of equal ones
        return self.languages[best], float(min(nearness[best] / (self.size * len(grams)), 1.0))


def learn(df: DataFrame, text: str = "text", language: str = "lang", size: int = PROFILE) -> Profiles:
    """Profiles from all rows of ``df``; ``size`` n-grams a language reach the driver."""
    order = Window.partitionBy("language").orderBy(F.desc("n"), "gram")
    first = language_counts(df, text, language).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= size).drop("place")
    found = first.limit(MAX_LANGUAGES * size + 1).toArrow()
    if found.num_rows > MAX_LANGUAGES * size:
        raise ValueError(f"profiles of more than {MAX_LANGUAGES} languages aren't broadcast; is {language!r} a language column?")
    names = np.array(found["language"].to_pylist(), dtype=object)
    grams, counts = found["gram"].to_numpy(), found["n"].to_numpy()
    languages = sorted(set(names))
    lists = [ranked(grams[names == name], counts[names == name], size) for name in languages]
    if not lists:
        return Profiles([], *NOTHING, np.zeros(0), size)
    owners = np.repeat(np.arange(len(lists)), [len(g) for g, _ in lists])
    return Profiles(languages, np.concatenate([g for g, _ in lists]), owners, np.concatenate([r for _, r in lists]), size)


PREDICTED = StructType([StructField("lang_pred", StringType(), False), StructField("score", DoubleType(), False)])


def predict(df: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``. Narrow."""
    shared = df.sparkSession.sparkContext.broadcast(profiles)

    @F.arrow_udf(PREDICTED)
    def run(texts: pa.Array) -> pa.Array:
        found = [shared.value.predict(t) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                                          names=["lang_pred", "score"])

    own, = free_name(df, "_predicted")
    return df.withColumn(own, run(F.col(text))).withColumns({c: F.col(own)[c] for c in ("lang_pred", "score")}).drop(own)


def held_out(id_col: str = "doc_id", folds: int = 5):
    """Whether crc32 of the id as text is a multiple of ``folds``; a null id is neither held out nor learned from."""
    return F.crc32(F.col(id_col).cast("string")) % folds == 0
