"""Language model over subword lattices (operator 10).

A word's lattice has an edge for each piece of an existing vocabulary that its
bytes hold, and edges over the whole word for its counts among the training
words. The word's probability is the sum over all paths: over all
segmentations, each the product of its pieces' weights, found by a forward
recursion in log space. No piece runs over a blank, so the sum over a text's
segmentations is a product over its words and an end mark, and words of equal
length are recursed together as one array.

How much of the mass spells words by pieces follows from the training counts,
by absolute discounting: in each class of documents (their language, a column)
a known word gives up D = n1 / (n1 + 2 n2) of its count (n1, n2: words that
occur once, twice). What they give up together goes to words that are new to the
class: by the same rule to words of other classes, each counted by the classes
that hold it, and the rest to the spelled paths. A text's probability is the sum
over the classes, so its class is not given away. There may be any number of
classes: counts and sums are kept for the pairs of word and class that occur.

Piece weights start from the vocabulary's own scores (log probabilities of a
unigram vocabulary; ranks of a merge vocabulary become 1 / (rank + 10)) and are
re-estimated ``ITERATIONS`` times by expected counts (forward-backward over the
same lattices) from the table of all training words, so each distinct word is
recursed once. Every byte is a piece, so every text has a probability; the
probabilities of all texts add up to one.

Beside the score stands a base score: counts of whole words with one added.
Its counts must be exact over the corpus, and some words are in every document:

* the ``COMMON`` most frequent words at most (fewer with many classes) are
  taken from the table of all training words and broadcast (a bounded table);
* all other words are dealt by hash into buckets, whose number follows the bytes
  of all texts (``BUCKET_BYTES``). Each batch of documents, of about
  ``BATCH_BYTES``, sends a bucket its different words and, for each, the
  documents it is in and how often, packed in arrays. A bucket adds up the
  counts, scores each of its words once, and returns sums by document (and
  class, where a word of the document has one), which are added by batch.

The driver holds a row for each piece, common word and class; the classes'
table, some 50 bytes each, is broadcast.

Defined cases: null text is empty (one end mark); a null id counts as the empty
text for the split; repeated rows are scored and, if not held out, counted row
by row; very long texts are handled whole; without training documents, as in an
empty table, counts are 0 and the pieces keep the vocabulary's weights; null
classes form a class; the class column may be missing; extra columns, whatever
their names, are not read; ties between common words go to the smaller word.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache
from itertools import islice
from math import log, log10

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grist.llm.common import materialize, partitions, release_memory

ITERATIONS = 2
COMMON = 20_000             # words scored from a broadcast table, at most
ENTRIES = 1 << 21           # pairs of word and class in that table, at most
FLUSH = 300_000             # different words a task gathers before it sends their counts
RECURSED = 1 << 17          # words a task gathers for one forward-backward recursion
LEAST_BUCKETS = 64          # more with more shuffle partitions or more text
BUCKET_BYTES = 32 << 20     # of text for each bucket of words, on average at most
BATCH_BYTES = 8 << 20       # of text whose words are dealt together, about
BATCH_ROWS = 1 << 15        # documents that are dealt together, at most; their numbers have 16 bits
CELLS = 1 << 22             # of a dense table of sums, at most
CHUNK = 8192                # words of one length recursed together
PRIOR = 0.1                 # added to each piece's expected count
SPACE = "▁"


def held_out(id_col: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2


class Pieces:
    """The vocabulary as a byte trie: ``step[node, byte]`` is the next node (0:
    none, 1: root), ``piece[node]`` the piece that ends there (-1: none).
    Pieces that hold A-Z or a blank inside can't match and are left out."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        weights: dict[bytes, float] = {bytes([b]): 0.0 for b in range(256)}
        scores = [model.get_score(i) for i in range(model.get_piece_size())]
        ranked = min(scores[-1000:]) < -1000       # merge vocabularies score a piece by its rank
        for i, score in enumerate(scores):
            text = model.id_to_piece(i)
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
                continue
            body = text.replace(SPACE, " ").encode()
            if b" " in body[1:] or any(65 <= b <= 90 for b in body) or score < -1e8:
                continue
            weights[body] = weights.get(body, 0.0) + (1.0 / (10.0 - score) if ranked else float(np.exp(score)))
        least = min(w for w in weights.values() if w > 0)
        self.bytes = sorted(weights)
        self.start = np.array([weights[b] or least / 10 for b in self.bytes])
        children: list[dict[int, int]] = [{}, {}]
        ends = [-1, -1]
        for i, body in enumerate(self.bytes):
            node = 1
            for b in body:
                if b not in children[node]:
                    children[node][b] = len(children)
                    children.append({})
                    ends.append(-1)
                node = children[node][b]
            ends[node] = i
        self.step = np.zeros((len(children), 256), np.uint16 if len(children) < 1 << 16 else np.uint32)
        for node, own in enumerate(children):
            for b, child in own.items():
                self.step[node, b] = child
        self.piece = np.array(ends)

    def edges(self, words: np.ndarray):
        """(start, end, rows, pieces) of all pieces in the rows of a byte matrix."""
        n, length = words.shape
        for s in range(length):
            rows, node = np.arange(n), np.ones(n, self.step.dtype)
            for e in range(s, length):
                node = self.step[node, words[rows, e]]
                alive = node > 0
                if not alive.all():
                    rows, node = rows[alive], node[alive]
                if not len(rows):
                    break
                found = self.piece[node]
                here = found >= 0
                yield (s, e + 1, rows, found) if here.all() else (s, e + 1, rows[here], found[here])

    def forward(self, words: np.ndarray, logp: np.ndarray) -> tuple[np.ndarray, list]:
        """Log probability of each prefix of each row, and the edges."""
        alpha = np.full((words.shape[1] + 1, len(words)), -np.inf)
        alpha[0] = 0.0
        edges = []
        for s, e, rows, pieces in self.edges(words):
            weight = logp[pieces]
            alpha[e, rows] = np.logaddexp(alpha[e, rows], alpha[s, rows] + weight)
            edges.append((s, e, rows, pieces, weight))
        return alpha, edges

    def expected(self, words: np.ndarray, counts: np.ndarray, logp: np.ndarray, total: np.ndarray) -> None:
        """Add to ``total`` how often each piece is expected in the rows."""
        alpha, edges = self.forward(words, logp)
        beta = np.full_like(alpha, -np.inf)
        beta[-1] = 0.0
        for s, e, rows, pieces, weight in reversed(edges):
            beta[s, rows] = np.logaddexp(beta[s, rows], beta[e, rows] + weight)
        for s, e, rows, pieces, weight in edges:
            share = np.exp(alpha[s, rows] + weight + beta[e, rows] - alpha[-1, rows]) * counts[rows]
            total += np.bincount(pieces, share, len(total))


def by_length(words: list[bytes]):
    """(indices, byte matrix) of words of one length, a blank before each, ``CHUNK`` at most."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    cuts = np.nonzero(np.diff(sizes[order]))[0] + 1
    for own in np.split(order, cuts):
        if not len(own):
            continue
        size = int(sizes[own[0]])
        most = max(1, min(CHUNK, (1 << 20) // (size + 1)))
        for i in range(0, len(own), most):
            some = own[i:i + most]
            flat = np.frombuffer(b" ".join([b"", *[words[j] for j in some.tolist()]]), np.uint8)
            yield some, flat.reshape(len(some), size + 1)


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def log_scores(words: list[bytes], path: str, logp: np.ndarray) -> np.ndarray:
    """Log10 probability of each word."""
    out = np.zeros(len(words))
    for rows, matrix in by_length(words):
        out[rows] = pieces_of(path).forward(matrix, logp)[0][-1]
    return out / log(10)


def split(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []         # bytes: lowers A-Z, splits at the six ASCII blanks


# --- what is learned -------------------------------------------------------------

def count_words(batches):
    """(cls, word, n) of one task's texts, a word once for each ``FLUSH`` different ones."""
    counted: dict[int, Counter] = {}

    def rows():
        for cls, own in counted.items():
            for i in range(0, len(own), CHUNK):
                some = list(islice(own.items(), i, i + CHUNK))
                yield pa.RecordBatch.from_arrays([pa.array([cls] * len(some), pa.int64()), pa.array([w for w, _ in some], pa.binary()),
                                                  pa.array([c for _, c in some], pa.int64())], names=["cls", "word", "n"])
        counted.clear()

    for batch in batches:
        for text, cls in zip(batch.column("t").cast(pa.binary()).to_pylist(), batch.column("cls").to_pylist()):
            counted.setdefault(cls, Counter()).update(split(text))
        if sum(map(len, counted.values())) > FLUSH:
            yield from rows()
    yield from rows()


def expectation(path: str, logp):
    """(key, n): how often each piece is expected in the distinct words of a task."""
    def run(batches):
        own, weights = pieces_of(path), np.frombuffer(logp.value)
        total = np.zeros(len(own.bytes))
        words, counts = [], []

        def recurse():
            n = np.array(counts, np.float64)
            for at, matrix in by_length(words):
                own.expected(matrix, n[at], weights, total)
            words.clear()
            counts.clear()

        for batch in batches:
            words += batch.column("word").to_pylist()
            counts += batch.column("n").to_pylist()
            if len(words) > RECURSED:
                recurse()
        recurse()
        used = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["key", "n"])
    return run


def discount(n1, n2):
    """Part of a count that is given up; above 0 and below 1 whatever the counts."""
    return (n1 + 0.5) / (n1 + 2 * n2 + 1)


class Learned:
    """What is learned from the training documents, but for words beyond the common ones."""

    def __init__(self, pieces: int):
        self.logp = np.zeros(pieces)                    # log weight by piece
        self.vocabulary, self.n = 0, 0                  # distinct words, words
        self.pairs, self.given = 0, (0.5, 1.0)          # pairs of word and class; discount of a word's classes and its share
        self.keys = np.zeros(1, np.int64)               # classes, ascending; at least one
        self.texts, self.class_n = np.zeros(1), np.zeros(1)         # training texts and their words, by class
        self.class_given = (np.full(1, 0.5), np.ones(1))
        self.common: dict[bytes, int] = {}              # row of each common word in ``table``
        self.table: Scores | None = None

    def class_of(self, keys: np.ndarray) -> np.ndarray:
        """Places of classes of training documents; any place for others."""
        return np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)

    def text_scores(self, scores: np.ndarray, n_words: np.ndarray, doc: np.ndarray, cls: np.ndarray, extra: np.ndarray) -> np.ndarray:
        """Log10 probability of texts from their words' sums, with what (doc, cls) pairs add to them."""
        n, texts = self.n, self.texts.sum()
        end = (texts + 1) / (n + texts + 2)
        prior = np.log10((self.texts + 0.5) / (texts + 0.5 * len(self.texts)))
        left = np.log10(self.class_given[1])
        out = np.zeros(len(scores))
        step = max(1, CELLS // len(self.keys))
        for i in range(0, len(scores), step):
            own = prior + n_words[i:i + step, None] * left
            some = (doc >= i) & (doc < i + step)
            own[doc[some] - i, cls[some]] += extra[some]
            out[i:i + step] = np.logaddexp.reduce(own * log(10), axis=1) / log(10)
        return out + scores + log10(end) + n_words * log10(1 - end)


class Scores:
    """Counts and scores of words: for all classes, and what each class adds.
    ``start[i]`` to ``start[i + 1]`` are word i's places in ``cls`` and ``extra``."""

    def __init__(self, learned: Learned, word: np.ndarray, cls: np.ndarray, counts: np.ndarray, spelled: np.ndarray):
        """From counts by (word, cls), ascending, and each word's log10 probability of its spelling."""
        self.total = np.bincount(word, counts, len(spelled))
        d, left = learned.given
        with np.errstate(divide="ignore"):
            known = np.log(np.maximum(np.bincount(word, minlength=len(spelled)) - d, 0) / max(learned.pairs, 1))
        # natural logs; a word without counts is spelled alone
        score = np.logaddexp(known, log(left) + spelled * log(10))
        d, left = learned.class_given
        with np.errstate(divide="ignore"):
            own = np.log(np.maximum(counts - d[cls], 0) / np.maximum(learned.class_n[cls], 1)) - np.log(left[cls])
        self.score = score / log(10)
        self.extra = np.logaddexp(0, own - score[word]) / log(10)
        self.cls = cls.astype(np.int64)
        self.start = np.searchsorted(word, np.arange(len(spelled) + 1))

    def sums(self, entry_word, entry_doc, entry_n, n_docs: int, classes: int):
        """Known tokens, base sum and score of each document, and (pair, sum) of
        what classes add; a pair is document * ``classes`` + class."""
        total = self.total[entry_word]
        known = np.bincount(entry_doc, entry_n * (total > 0), n_docs)
        base = np.bincount(entry_doc, entry_n * np.log10(total + 1.0), n_docs)
        score = np.bincount(entry_doc, entry_n * self.score[entry_word], n_docs)
        start = self.start[entry_word]
        n = self.start[entry_word + 1] - start
        at = np.arange(n.sum()) + np.repeat(start - np.cumsum(n) + n, n)
        pair = np.repeat(entry_doc.astype(np.int64) * classes, n) + self.cls[at]
        return known, base, score, *pair_sums(pair, np.repeat(entry_n, n) * self.extra[at], n_docs * classes)


def pair_sums(pair: np.ndarray, x: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, ascending, and the sums of ``x`` by pair."""
    if cells <= CELLS:
        found = np.nonzero(np.bincount(pair, minlength=cells))[0]
        return found, np.bincount(pair, x, cells)[found]
    found, at = np.unique(pair, return_inverse=True)
    return found, np.bincount(at, x, len(found))


def word_table(train: DataFrame, buckets: int) -> DataFrame:
    """(word, n, by): each training word with its count and its (cls, n). One
    shuffle of the tasks' partial counts, by word."""
    parts = train.mapInArrow(count_words, "cls long, word binary, n long").repartition(buckets, "word")
    by_class = parts.groupBy("word", "cls").agg(F.sum("n").alias("n"))
    return materialize(by_class.groupBy("word").agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("cls", "n"))).alias("by")), "words")


def learn(train: DataFrame, path: str, buckets: int, iterations: int = ITERATIONS, common: int = COMMON) -> Learned:
    """From the rows (t, cls) of the training documents."""
    spark = train.sparkSession
    own = pieces_of(path)
    out = Learned(len(own.bytes))
    words = word_table(train, buckets)
    once_twice = lambda c: (F.count_if(c == 1).alias("n1"), F.count_if(c == 2).alias("n2"))      # noqa: E731
    every = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.size("by")).alias("pairs"), *once_twice(F.size("by"))).first()
    out.vocabulary, out.n, out.pairs = every["v"], every["n"] or 0, every["pairs"] or 0
    d = discount(every["n1"], every["n2"])
    out.given = d, d * out.vocabulary / out.pairs if out.pairs else 1.0
    texts = {r["cls"]: r["n"] for r in train.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).collect()}
    if texts:
        by = {r["cls"]: r for r in words.select(F.explode("by").alias("x")).select("x.*").groupBy("cls")
              .agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("v"), *once_twice(F.col("n"))).collect()}
        out.keys = np.array(sorted(texts), np.int64)
        of = lambda c: np.array([by[k][c] if k in by else 0 for k in out.keys.tolist()], np.float64)      # noqa: E731
        out.texts, out.class_n = np.array([texts[k] for k in out.keys.tolist()], np.float64), of("total")
        d = discount(of("n1"), of("n2"))
        out.class_given = d, np.where(out.class_n > 0, d * of("v") / np.maximum(out.class_n, 1), 1.0)
    out.logp = np.log(own.start / own.start.sum())
    for _ in range(iterations if out.n else 0):
        logp = spark.sparkContext.broadcast(out.logp.tobytes())
        expected = np.full(len(own.bytes), PRIOR)
        for r in words.select("word", "n").mapInArrow(expectation(path, logp), "key long, n double").groupBy("key").agg(F.sum("n").alias("n")).collect():
            expected[r["key"]] += r["n"]
        out.logp = np.log(expected / expected.sum())
    top = words.orderBy(F.desc("n"), "word").limit(max(1, min(common, ENTRIES // len(out.keys)))).select("word", "by").collect()
    out.common = {bytes(r["word"]): i for i, r in enumerate(top)}
    flat = [(i, x["cls"], x["n"]) for i, r in enumerate(top) for x in r["by"]]
    word, cls, counts = np.array(flat, np.int64).reshape(-1, 3).T
    out.table = Scores(out, word, out.class_of(cls), counts, log_scores(list(out.common), path, out.logp))
    return out


# --- the scan that scores --------------------------------------------------------

DEALT = "bucket int, part long, batch long, words binary, sizes binary, train binary, cls binary, entry_word binary, entry_doc binary, entry_n binary, docs long"
SUMS = "batch long, docs binary, known binary, base binary, score binary, pairs binary, extra binary, sizes binary, ids binary, valid binary"
SCORED = "id long, n_words long, n_known long, base double, score double"


def gathered(batches):
    """Batches put together to about ``BATCH_BYTES`` and at most ``BATCH_ROWS`` rows."""
    held, size, n = [], 0, 0
    for whole in batches:
        for i in range(0, whole.num_rows, BATCH_ROWS):
            batch = whole.slice(i, BATCH_ROWS)
            if held and (size + batch.nbytes > BATCH_BYTES or n + batch.num_rows > BATCH_ROWS):
                yield pa.Table.from_batches(held)
                held, size, n = [], 0, 0
            held.append(batch)
            size, n = size + batch.nbytes, n + batch.num_rows
    if n:
        yield pa.Table.from_batches(held)


def pack_batch(texts: list[bytes | None], buckets: int, table: dict[bytes, int]):
    """Words in each text, and (bucket, words, entries' word, doc and count) of
    one batch: bucket -1 has the common words, and always comes."""
    ids: dict[bytes, int] = {}
    word, times, per_doc, sizes = [], [], [], []
    for text in texts:
        own = Counter(split(text))
        for w in own:
            ids.setdefault(w, len(ids))
        word.append(np.fromiter(map(ids.__getitem__, own), np.int64, len(own)))
        times.append(np.fromiter(own.values(), np.int64, len(own)))
        per_doc.append(len(own))
        sizes.append(own.total())
    word, times, doc = np.concatenate(word), np.concatenate(times), np.repeat(np.arange(len(texts)), per_doc)
    words, digest = list(ids), xxhash.xxh3_64_intdigest
    bucket = np.fromiter((-1 if w in table else digest(w) % buckets for w in words), np.int64, len(words))
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    entries = np.argsort(place[word], kind="stable")
    edges = np.arange(-1, buckets + 1)
    starts, entry_starts = np.searchsorted(bucket[order], edges), np.searchsorted(bucket[word[entries]], edges)

    def rows():
        for b in range(-1, buckets):
            lo, hi = starts[b + 1], starts[b + 2]
            if lo < hi or b < 0:
                some = entries[entry_starts[b + 1]:entry_starts[b + 2]]
                yield b, [words[i] for i in order[lo:hi].tolist()], place[word[some]] - lo, doc[some], times[some]
    return np.array(sizes, np.int64), rows()


def dealer(path: str, buckets: int, shared):
    """Packed rows for the buckets. Bucket -1 answers at once: a batch's ids,
    sizes and sums over the common words, as rows that stand alone."""
    def run(batches):
        learned = shared.value
        task = TaskContext.get().partitionId()
        for k, batch in enumerate(gathered(batches)):
            n_docs, number, out = batch.num_rows, (task << 32) + k, []
            train = np.asarray(batch.column("train"))
            cls = learned.class_of(np.asarray(batch.column("cls"))).astype(np.uint32)
            sizes, dealt = pack_batch(batch.column("t").cast(pa.binary()).to_pylist(), buckets, learned.common)
            for b, words, word, doc, times in dealt:
                if b < 0:
                    own = np.fromiter((learned.common[w] for w in words), np.int64, len(words))
                    known, base, score, pairs, extra = learned.table.sums(own[word], doc, times, n_docs, len(learned.keys))
                    ids = batch.column("id").combine_chunks()
                    packed = [known, base, score, pairs, extra, sizes, np.asarray(ids.fill_null(0)).astype(np.int64), np.asarray(ids.is_valid()).astype(np.uint8)]
                    # under the names of DEALT; ``bucket_sums`` knows them by bucket -1
                    known, base, score, pairs, extra, sizes_, own_ids, valid = (x.tobytes() for x in packed)
                    out.append((b, number, number, known, base, score, pairs, extra, sizes_, own_ids + valid, n_docs))
                else:
                    # entries are in the order of the words: a number for each word tells them apart
                    packed = [np.fromiter(map(len, words), np.uint32, len(words)), np.packbits(train), cls,
                              np.bincount(word, minlength=len(words)).astype(np.uint16), doc.astype(np.uint16),
                              times.astype(np.uint16 if times.max() < 1 << 16 else np.uint32)]
                    out.append((b, 0, number, b"".join(words), *(x.tobytes() for x in packed), n_docs))
                if len(out) >= 64:
                    yield dealt_rows(out)
                    out = []
            yield dealt_rows(out)
            release_memory()
    return run


def dealt_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64()] + [pa.binary()] * 7 + [pa.int64()]
    names = ["bucket", "part", "batch", "words", "sizes", "train", "cls", "entry_word", "entry_doc", "entry_n", "docs"]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def sums_table(rows: list[dict]) -> pa.Table:
    binary = ("docs", "known", "base", "score", "pairs", "extra", "sizes", "ids", "valid")
    return pa.table({"batch": pa.array([r["batch"] for r in rows], pa.int64())} | {c: pa.array([r.get(c) for r in rows], pa.binary()) for c in binary})


def bucket_sums(path: str, shared):
    """One bucket: exact counts and one score for each word, then sums by
    document and batch. The rows of bucket -1 only change their columns' names."""
    def run(table: pa.Table) -> pa.Table:
        learned, rows = shared.value, table.to_pylist()
        if rows[0]["bucket"] < 0:
            return sums_table([{"batch": r["batch"], "known": r["words"], "base": r["sizes"], "score": r["train"], "pairs": r["cls"], "extra": r["entry_word"],
                                "sizes": r["entry_doc"], "ids": r["entry_n"][:8 * r["docs"]], "valid": r["entry_n"][8 * r["docs"]:]} for r in rows])
        ids: dict[bytes, int] = {}
        classes, entries, keys, counts = len(learned.keys), [], [], []
        for r in rows:
            blob, at, own = r["words"], 0, []
            for size in np.frombuffer(r["sizes"], np.uint32).tolist():
                own.append(ids.setdefault(blob[at:at + size], len(ids)))
                at += size
            word = np.repeat(np.array(own, np.int64), np.frombuffer(r["entry_word"], np.uint16))
            doc = np.frombuffer(r["entry_doc"], np.uint16)
            times = np.frombuffer(r["entry_n"], np.uint16 if len(r["entry_n"]) == 2 * len(doc) else np.uint32)
            train = np.unpackbits(np.frombuffer(r["train"], np.uint8), count=r["docs"])[doc] > 0
            key, n = pair_sums(word[train] * classes + np.frombuffer(r["cls"], np.uint32)[doc[train]], times[train], CELLS + 1)
            keys.append(key)
            counts.append(n)
            entries.append((word.astype(np.uint32), doc, times, r["docs"]))
        key, n = pair_sums(np.concatenate(keys), np.concatenate(counts), CELLS + 1)
        scores = Scores(learned, *np.divmod(key, classes), n, log_scores(list(ids), path, learned.logp))
        out = []
        for r, own in zip(rows, entries):
            known, base, score, pairs, extra = scores.sums(*own, classes)
            some = np.unique(own[1])
            out.append({"batch": r["batch"], "docs": some.tobytes(), "known": known[some].astype(np.uint32).tobytes(), "base": base[some].tobytes(),
                        "score": score[some].astype(np.float32).tobytes(), "extra": extra.astype(np.float32).tobytes(),
                        "pairs": pairs.astype(np.uint32 if r["docs"] * classes < 1 << 32 else np.int64).tobytes()})
        return sums_table(out)
    return run


def batch_sums(shared):
    """One batch: the sums of all buckets, a row for each document."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        learned, info = shared.value, next(r for r in rows if r["ids"] is not None)
        sizes, ids, valid = np.frombuffer(info["sizes"], np.int64), np.frombuffer(info["ids"], np.int64), np.frombuffer(info["valid"], np.uint8)
        known, base, score = (np.frombuffer(info[c], np.float64).copy() for c in ("known", "base", "score"))
        pairs, extra, classes = [np.frombuffer(info["pairs"], np.int64)], [np.frombuffer(info["extra"], np.float64)], len(learned.keys)
        # always in the same order, so that sums round alike in every run
        for r in sorted((r for r in rows if r["ids"] is None), key=lambda r: (r["docs"], r["base"])):
            doc = np.frombuffer(r["docs"], np.uint16)
            known[doc] += np.frombuffer(r["known"], np.uint32)
            base[doc] += np.frombuffer(r["base"], np.float64)
            score[doc] += np.frombuffer(r["score"], np.float32)
            own = np.frombuffer(r["extra"], np.float32)
            pairs.append(np.frombuffer(r["pairs"], np.uint32 if len(r["pairs"]) == 4 * len(own) else np.int64).astype(np.int64))
            extra.append(own.astype(np.float64))
        pair, added = pair_sums(np.concatenate(pairs), np.concatenate(extra), len(ids) * classes)
        score = learned.text_scores(score, sizes, *np.divmod(pair, classes), added)
        return pa.table({"id": pa.array(ids, mask=valid == 0), "n_words": pa.array(sizes), "n_known": pa.array(np.rint(known).astype(np.int64)),
                         "base": pa.array(base), "score": pa.array(score)})
    return run


def bucket_count(rows: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for the words of the texts ``t``: a bucket is held by one task, so
    their number follows the bytes of all texts, held out or not."""
    size = rows.agg(F.sum(F.octet_length("t").cast("long"))).first()[0] or 0
    return max(partitions(rows.sparkSession), LEAST_BUCKETS, -(-size // bucket_bytes))


def score_documents(df: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", class_col: str | None = "lang",
                    iterations: int = ITERATIONS) -> DataFrame:
    """A row for each row of ``df``: ``id`` (an integer column), ``held_out``,
    ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    spark = df.sparkSession
    cls = F.xxhash64(F.col(class_col).cast("string")) if class_col in df.columns else F.lit(0).cast("long")
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("t"), (~held_out(F.col(id_col))).alias("train"), cls.alias("cls"))
    buckets = bucket_count(rows)
    learned = learn(rows.filter("train").select("t", "cls"), path, buckets, iterations)
    shared = spark.sparkContext.broadcast(learned)
    # partitions follow the buckets; twice as many, so that few buckets share one
    dealt = rows.mapInArrow(dealer(path, buckets, shared), DEALT).repartition(2 * buckets, "bucket", "part")
    sums = dealt.groupBy("bucket", "part").applyInArrow(bucket_sums(path, shared), SUMS)
    scored = sums.groupBy("batch").applyInArrow(batch_sums(shared), SCORED).withColumn("held_out", held_out(F.col("id")))
    texts = int(learned.texts.sum())
    train_tokens = learned.n + texts
    unit = log10(train_tokens + learned.vocabulary + (texts > 0) + 1)
    return materialize(scored.select(
        "id", "held_out", (F.col("n_words") + 1).alias("n_tokens"), (F.col("n_known") + int(texts > 0)).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.lit(log10(texts + 1)) - (F.col("n_words") + 1) * F.lit(unit)).alias("base_score"), "score"), "scored")
