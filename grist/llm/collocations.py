"""Phrase collocation mining by top-order marginalisation (operator 11).

Texts are cut into pieces at punctuation and line ends, pieces into words. Every
word starts one window: the word and up to four words after it in its piece (its
leads), padded with nulls. Only these longest windows are counted; Spark
ROLLUPs over (language, word 1, ..., word 5) then sum them to the count of every
shorter prefix, that is of every phrase, so no order of n-grams is exploded by
itself. Windows of one length before the padding share a ROLLUP over just their
words, as levels of padding would only repeat rows in the shuffle.

A phrase can only reach ``min_count`` if each of its words, adjacent word pairs
and runs of three words does, so a window ends before the first pair or run that
can't, and the window of a word that can't is padding alone (it still counts as
a word of its language):

* map tasks send counts of hashed words and pairs; those that reach ``min_count``
  set bits in a filter of a fixed 8 MB. Runs of three words whose pairs pass are
  counted likewise, for a second filter: pairs get frequent with the size of a
  corpus long before longer runs do, and by pairs alone windows would grow with it.
  The filters have no false negatives, and what passes by chance only makes
  windows longer: all counts stay exact. With more frequent hashes than bits,
  windows are simply cut less;
* map tasks form windows in blocks of words, with words numbered within the
  block, and send each distinct window of a block once with its count.

Every shuffle follows partial counts, so a word or phrase that fills a third of
the corpus is one row a block. Candidates are cut at each place and both parts
looked up among the counted phrases (hot parts split, ``skew.split_join``);
containment compares each candidate with the largest count of the longer
candidates that hold it, an aggregate of their sub-phrases. Scores use decimals
of 38 digits.

Defined cases: null or empty text has no words, null language is ``und``;
repeated rows count each time; ties are ordered as the contract says; empty
tables give empty results; extra columns are not read. Very long texts are
worked on in slices that end at a piece's end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grist.llm.common import materialize, release_memory
from grist.operators.skew import split_join

LONGEST = 5                 # words of a phrase, at most
MIN_COUNT = 100
TOP = 2000                  # phrases reported for each language
CONTAINED_PERCENT = 100     # a phrase goes if a longer one that holds it has this share of its count
UNKNOWN = "und"
BLOCK = 1 << 18             # words that are counted together before they are sent
SLICE = 1 << 22             # bytes of a text that are split at once
HASH_BITS = 40              # of a word, pair or run; equal hashes only let more pass, and shorter ones make smaller shuffles
FILTER_BITS = 1 << 26
SHIFTS = (0, 14)            # of a hash, for its two places in the filter
SHARES = 32                 # groups of a language's phrases that are ranked apart first
WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]

END = b"\xff"               # piece end; no byte of UTF-8
PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", END * 10)


def tokens(text: bytes | None):
    """Lists of a text's words with ``END`` after each piece; cut only at piece ends."""
    if not text:
        return
    text = text.lower().translate(PIECES)       # of bytes: A-Z alone
    start = 0
    while start < len(text):
        stop = text.find(END, start + SLICE) if len(text) - start > SLICE else -1
        stop = len(text) if stop < 0 else stop + 1
        yield (text[start:stop].replace(END, b" \xff ") + b" \xff").split()
        start = stop


class Block:
    """Words in a row, numbered within the block; 0 is a piece's end."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {END: 0}
        self.languages: dict[str, int] = {}
        self.words: list[np.ndarray] = []
        self.owners: list[tuple[int, int]] = []
        self.size = 0

    def add(self, language: str, words: list[bytes]):
        numbers = self.numbers
        for w in set(words):
            numbers.setdefault(w, len(numbers))
        self.words.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        self.owners.append((self.languages.setdefault(language, len(self.languages)), len(words)))
        self.size += len(words)

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """Word and language numbers at each place."""
        owners, n = zip(*self.owners)
        return np.concatenate(self.words), np.repeat(np.array(owners), n)

    def hashes(self, words: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``HASH_BITS`` bits of (language, word) at each place, of (language, word, next word) at each
        but the last, and of the word and the next two at each but the last two."""
        own = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.numbers), np.uint64, len(self.numbers))[words]
        name = np.fromiter((xxhash.xxh64_intdigest(x) for x in self.languages), np.uint64, len(self.languages))[owners]
        single = (own + name) * np.uint64(0x9E3779B185EBCA87)
        single ^= single >> np.uint64(29)
        pair = (single[:-1] + own[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
        three = ((pair[:-1] ^ (pair[:-1] >> np.uint64(31))) + own[2:]) * np.uint64(0xD6E8FEB86659FD93)
        return single >> np.uint64(64 - HASH_BITS), pair >> np.uint64(64 - HASH_BITS), three >> np.uint64(64 - HASH_BITS)


def blocks(batches):
    """Blocks of about ``BLOCK`` words from batches of (language, text); texts are whole within a block's words."""
    block = Block()
    for batch in batches:
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            for words in tokens(text):
                block.add(language, words)
                if block.size >= BLOCK:
                    yield block
                    block = Block()
                    release_memory()
    if block.size:
        yield block


def hash_counts(rows: DataFrame, pairs: np.ndarray | None = None) -> DataFrame:
    """(h, n): counts of hashed words and of hashed pairs of adjacent words, partial ones summed;
    with the filter ``pairs``, of hashed runs of three words whose pairs pass it."""
    shared = None if pairs is None else rows.sparkSession.sparkContext.broadcast(pairs)

    def run(batches):
        for block in blocks(batches):
            words, owners = block.rows()
            inside = (words[:-1] > 0) & (words[1:] > 0)
            single, pair, three = block.hashes(words, owners)
            if shared is None:
                found = np.concatenate((single[words > 0], pair[inside]))
            else:
                inside[inside] = passes(shared.value, pair[inside])
                found = three[inside[:-1] & inside[1:]]
            h, n = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

    return rows.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def frequent_filter(counts: DataFrame, min_count: int) -> np.ndarray:
    """Bits of the hashes that reach ``min_count``, two each; at most ``FILTER_BITS`` bits reach the driver."""
    places = F.array(*[F.shiftrightunsigned("h", s).bitwiseAND(FILTER_BITS - 1) for s in SHIFTS])
    bits = (counts.filter(F.col("n") >= min_count).select(F.explode(places).alias("bit"))
            .groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")))
    table = np.zeros(FILTER_BITS >> 6, np.uint64)
    found = bits.toArrow()
    table[found["word"].to_numpy().astype(np.int64)] = found["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return table


def passes(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    hit = np.ones(len(h), bool)
    for shift in SHIFTS:
        bit = h >> np.uint64(shift) & np.uint64(FILTER_BITS - 1)
        hit &= (table[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
    return hit


def distinct_rows(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first of each distinct row, and how often it occurs; exact, two columns at a time."""
    code = columns[0]
    for c in columns[1:]:
        _, code = np.unique(code * (int(c.max(initial=0)) + 1) + c, return_inverse=True)
    _, first, n = np.unique(code, return_index=True, return_counts=True)
    return first, n.astype(np.int64)


def window_counts(rows: DataFrame, pairs: np.ndarray, runs: np.ndarray | None = None) -> DataFrame:
    """(language, w1..w5, n): partial counts of the padded longest windows; ``pairs`` is the filter
    of words and pairs, ``runs`` that of runs of three words (none: all pass)."""
    shared, shared_runs = (x if x is None else rows.sparkSession.sparkContext.broadcast(x) for x in (pairs, runs))
    names = ["language", *WORDS, "n"]

    def run(batches):
        for block in blocks(batches):
            words, owners = block.rows()
            goes_on = (words[:-1] > 0) & (words[1:] > 0)
            single, pair, three = block.hashes(words, owners)
            goes_on[goes_on] = passes(shared.value, pair[goes_on])
            run_on = goes_on[:-1] & goes_on[1:]
            if shared_runs is not None:
                run_on[run_on] = passes(shared_runs.value, three[run_on])
            frequent = words > 0
            frequent[frequent] = passes(shared.value, single[frequent])
            padded = np.concatenate((words, np.zeros(LONGEST, np.int64)))
            open_ = np.concatenate((goes_on, np.zeros(LONGEST, bool)))
            open_runs = np.concatenate((run_on, np.zeros(LONGEST + 1, bool)))
            leads, alive = [np.where(frequent, words, 0)], frequent
            for k in range(1, LONGEST):
                alive = alive & open_[k - 1:k - 1 + len(words)]
                if k > 1:
                    alive = alive & open_runs[k - 2:k - 2 + len(words)]
                leads.append(np.where(alive, padded[k:k + len(words)], 0))
            starts = words > 0
            columns = [owners[starts], *[c[starts] for c in leads]]
            first, n = distinct_rows(columns)
            vocabulary = pa.array(list(block.numbers), pa.binary()).view(pa.string())
            picked = [pa.array(c[first], mask=c[first] == 0) for c in columns[1:]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(block.languages), pa.string()).take(pa.array(columns[0][first])), *[vocabulary.take(i) for i in picked], pa.array(n)],
                names=names)

    return rows.mapInArrow(run, "language string, " + ", ".join(f"{w} string" for w in WORDS) + ", n long")


def phrase_counts(windows: DataFrame, min_count: int) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to 5 words that occur ``min_count`` times: (language, k,
    phrase, f); and all word occurrences by language: (language, total)."""
    rolled = None
    for size in range(LONGEST + 1):
        # windows of this many words before the padding: their prefixes are real phrases, so no level is summed in vain
        own, after = WORDS[:size], WORDS[size:]
        part = windows.filter(F.lit(True) if not own else F.col(own[-1]).isNotNull()).filter(F.lit(True) if not after else F.col(after[0]).isNull())
        levels = {2 ** (size - k) - 1: k for k in range(size + 1)}        # bits of the words rolled up -> words left
        k = F.create_map(*[F.lit(x) for pair in levels.items() for x in pair])[F.col("level").cast("int")]
        summed = (part.rollup("language", *own).agg(F.sum("n").alias("f"), F.grouping_id().alias("level")).withColumn("k", k).filter("k is not null")
                  .select("language", "k", F.concat_ws(" ", *own).alias("phrase") if own else F.lit("").alias("phrase"), "f"))
        rolled = summed if rolled is None else rolled.unionByName(summed)
    counted = (rolled.groupBy("language", "k", "phrase").agg(F.sum("f").alias("f"))
               .filter((F.col("k") == 0) | (F.col("f") >= min_count)))
    counted = materialize(counted, "phrases")
    return counted.filter("k > 0"), counted.filter("k = 0").select("language", F.col("f").alias("total"))


def scored(counted: DataFrame, totals: DataFrame) -> DataFrame:
    """(language, phrase, k, a, l, r, n, score): candidates with their lowest-scoring cut."""
    candidates = counted.filter("k >= 2").withColumn("words", F.split("phrase", " "))
    cuts = (candidates.join(F.broadcast(totals), "language")                # one row a language
            .select("language", "phrase", "k", F.col("f").alias("a"), F.col("total").alias("n"), "words",
                    F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
            .withColumns({"head": F.array_join(F.slice("words", F.lit(1), F.col("cut")), " "),
                          "tail": F.array_join(F.slice("words", F.col("cut") + 1, F.col("k")), " ")}).drop("words"))
    cuts = materialize(cuts, "cuts")
    for part, count in (("head", "l"), ("tail", "r")):
        cuts = split_join(cuts, counted.select("language", F.col("phrase").alias(part), F.col("f").alias(count)), ["language", part])
    wide = "decimal(19,0)"
    top = F.lit(1000).cast("decimal(4,0)") * F.col("a").cast(wide) * F.col("n").cast(wide)
    cuts = cuts.withColumn("top", top.cast("decimal(38,0)")).withColumn("bottom", (F.col("l").cast(wide) * F.col("r").cast(wide)).cast("decimal(38,0)"))
    lowest = cuts.groupBy("language", "phrase", "k", "a", "n").agg(
        F.min(F.struct(F.expr("top div bottom").alias("score"), "cut", "l", "r")).alias("low"))
    return lowest.select("language", "phrase", "k", "a", "low.l", "low.r", "n", "low.score")


def not_contained(candidates: DataFrame, percent: int) -> DataFrame:
    """``candidates`` without those that a longer one holds with at least ``percent`` % of their count."""
    inner = (candidates.filter("k > 2").select("language", "a", "k", F.split("phrase", " ").alias("words"))
             .withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
             .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
             .groupBy("language", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("phrase"))
             .agg(F.max("a").alias("longer")))
    held = F.coalesce(100 * F.col("longer").cast("decimal(20,0)") >= percent * F.col("a").cast("decimal(20,0)"), F.lit(False))
    return candidates.join(inner, ["language", "phrase"], "left").filter(~held).drop("longer")


def mine(df: DataFrame, text: str = "text", language: str = "lang", min_count: int = MIN_COUNT, top: int = TOP,
         contained_percent: int = CONTAINED_PERCENT) -> DataFrame:
    """Each language's first ``top`` collocations: language, rank, phrase, a, l, r, n, score."""
    rows = df.select(F.coalesce(F.col(language).cast("string"), F.lit(UNKNOWN)).alias("language"), F.col(text).alias("t"))
    pairs = frequent_filter(hash_counts(rows), min_count)
    runs = frequent_filter(hash_counts(rows, pairs), min_count)
    windows = materialize(window_counts(rows, pairs, runs), "windows")        # partial counts, read once for each length
    counted, totals = phrase_counts(windows, min_count)
    candidates = materialize(scored(counted, totals), "candidates")
    best = not_contained(candidates, contained_percent).withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    for group in (["language", "share"], ["language"]):         # the first of each share, then the first of those: a bounded group
        order = Window.partitionBy(*group).orderBy(F.desc("score"), F.desc("a"), "phrase")
        best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.select("language", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle(min_count: int = MIN_COUNT, top: int = TOP, percent: int = CONTAINED_PERCENT) -> str:
    """DuckDB SQL: every order of n-grams counted by itself."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
    with pieces as (select coalesce(lang, 'und') as lang,
                           unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]')) as piece
                    from documents),
    lists as (select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') as w from pieces),
    totals as (select lang, sum(len(w))::bigint as n from lists group by lang having sum(len(w)) > 0),
    places as (select lang, w, unnest(range(1, len(w) + 1)) as p from lists),
    grams as (select lang, unnest(range(1, least({LONGEST}, len(w) - p + 1) + 1)) as k, w, p from places),
    counted as (select lang, k, array_to_string(w[p:p + k - 1], ' ') as phrase, count(*) as f from grams group by all having count(*) >= {min_count}),
    candidates as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from counted where k >= 2),
    cuts as (select *, unnest(range(1, k)) as c from candidates),
    cut_scores as (select x.lang, x.k, x.phrase, x.a, x.c, h.f as l, t.f as r, totals.n as n,
                          ((1000::hugeint * x.a * totals.n) // (h.f::hugeint * t.f))::bigint as score
                   from cuts x join totals using (lang)
                   join counted h on h.lang = x.lang and h.phrase = array_to_string(x.w[1:x.c], ' ')
                   join counted t on t.lang = x.lang and t.phrase = array_to_string(x.w[x.c + 1:x.k], ' ')),
    lowest as (select * from cut_scores qualify row_number() over (partition by lang, phrase order by score, c) = 1),
    sizes as (select lang, a, w, k, unnest(range(2, k)) as s from candidates),
    inner_places as (select *, unnest(range(1, k - s + 2)) as p from sizes),
    longer as (select lang, array_to_string(w[p:p + s - 1], ' ') as phrase, max(a) as most from inner_places group by all)
    select lang, rank::int as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score
    from (select x.*, row_number() over (partition by x.lang order by x.score desc, x.a desc, x.phrase) as rank
          from lowest x left join longer y using (lang, phrase) where y.most is null or 100 * y.most < {percent} * x.a)
    where rank <= {top}"""
