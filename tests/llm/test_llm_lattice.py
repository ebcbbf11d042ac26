"""Lattice scores against all segmentations, counts against a plain version."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from grist.llm import lattice_lm as L

PATH = public_tokenizers.path("piece_bpe_32k.model")


def plain_score(word, weights):
    """Log probability of a word over all segmentations of its bytes, one by one."""
    sums = [0.0] * (len(word) + 1)
    sums[0] = 1.0
    for e in range(1, len(word) + 1):
        sums[e] = sum(sums[s] * weights.get(word[s:e], 0.0) for s in range(e))
    return math.log(sums[-1])


def test_forward_recursion():
    own = L.pieces_of(PATH)
    p = own.start / own.start.sum()
    weights = dict(zip(own.bytes, p))
    words = ["the", "unbelievable", "x", "straße", "漢字", "a,b", "\x85", "zzzzqqq", "tion" * 5]
    words = [w.encode() for w in words]
    got = L.log_scores(words, PATH, np.log(p)) * math.log(10)
    assert got == pytest.approx([plain_score(b" " + w, weights) for w in words], rel=1e-9)
    assert L.log_scores([b"q" * 5000], PATH, np.log(p))[0] < -1000          # far below the smallest float


def test_expected_counts_are_those_of_all_paths():
    own = L.pieces_of(PATH)
    logp = np.log(own.start / own.start.sum())
    total = np.zeros(len(own.bytes))
    word = np.frombuffer(b" ther", np.uint8)[None, :]
    own.expected(word, np.array([3.0]), logp, total)
    # each piece by the share of the paths through it, from a walk over all paths
    paths = []

    def walk(at, used, weight):
        if at == 5:
            paths.append((used, weight))
        for e in range(at + 1, 6):
            if (piece := bytes(word[0][at:e])) in own.bytes:
                walk(e, [*used, piece], weight + logp[own.bytes.index(piece)])

    walk(0, [], 0.0)
    whole = sum(math.exp(w) for _, w in paths)
    expected = Counter()
    for used, w in paths:
        for piece in used:
            expected[piece] += 3 * math.exp(w) / whole
    assert {own.bytes[i]: total[i] for i in np.nonzero(total)[0]} == pytest.approx(dict(expected), rel=1e-9)


def test_spelled_words_share_all_probability():
    """Probabilities of all words over a two-letter vocabulary add up to one."""
    own = L.pieces_of(PATH)
    keep = {b" ", b"a", b" a", b"aa", b" aa"} & set(own.bytes)
    logp = np.array([math.log(1 / len(keep)) if b in keep else -np.inf for b in own.bytes])
    words = [b"a" * n for n in range(1, 400)]
    share = sum(1 for b in keep if b.startswith(b" ")) / len(keep)
    total = (10.0 ** L.log_scores(words, PATH, logp)).sum() + (1 / len(keep) if b" " in keep else 0)
    # first a piece with a blank, then others without until the next word's first piece
    assert total == pytest.approx(share / (1 - (1 - share)), rel=1e-6)


def plain(rows):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))      # noqa: E731
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    counts, texts, n = Counter(), 0, 0
    for (_, t), h in zip(rows, held):
        if not h:
            counts.update(words(t))
            texts += 1
            n += len(words(t)) + 1
    v = len(counts) + (texts > 0)
    out = []
    for (i, t), h in zip(rows, held):
        own = [counts[w] for w in words(t)] + [texts]
        out.append((i, h, len(own), sum(c > 0 for c in own), n, sum(math.log10((c + 1) / (n + v + 1)) for c in own)))
    return out


@pytest.fixture
def rows():
    rng = random.Random(2)
    vocab = ["the", "cat", "Sat", "on", "é", "漢"] + [f"w{i}" for i in range(300)]
    out = [(i, " ".join(rng.choice(vocab[:20] if rng.random() < 0.7 else vocab) for _ in range(rng.randint(0, 60))), rng.choice(["en", "de", None])) for i in range(200)]
    return out + [(None, "the cat", "en"), (None, None, None), (7, "the", "en"), (7, "the", "en"), (900, "", "fr"), (901, "q" * 3000, "fr"), (902, "new\x85word \x1c", "xx")]


def test_counts_and_scores(spark, rows):
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, lang string, score string").repartition(5)
    got = L.score_documents(docs, PATH).collect()
    mine = sorted(((r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str)
    assert mine == sorted(((*x[:5], round(x[5], 6)) for x in plain([r[:2] for r in rows])), key=str)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    again = L.score_documents(docs.repartition(3), PATH).collect()
    key = lambda rs: sorted((r.id or -1, r.n_tokens, r.score) for r in rs)      # noqa: E731
    assert [x[:2] for x in key(again)] == [x[:2] for x in key(got)]
    assert [x[2] for x in key(again)] == pytest.approx([x[2] for x in key(got)], rel=1e-5)         # sums travel in single precision


def test_defined_cases(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert L.score_documents(docs.limit(0), PATH).count() == 0
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2]
    only = L.score_documents(docs.filter(F.col("doc_id").isin(held)).drop("lang"), PATH).collect()
    assert only and all(r.held_out and r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 and math.isfinite(r.score) for r in only)


def training(docs, cls=None):
    cls = F.xxhash64("lang") if cls is None else cls
    return docs.filter(~L.held_out(F.col("doc_id"))).select(F.col("text").alias("t"), cls.alias("cls"))


def test_learned_weights_beat_the_vocabularys_own(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = [r.text.encode().lower().split() for r in docs.filter(L.held_out(F.col("doc_id"))).collect()]
    learned = L.learn(training(docs, F.lit(0).cast("long")), PATH, 4)
    own = L.pieces_of(PATH)
    words = [w for t in texts for w in t]
    assert L.log_scores(words, PATH, learned.logp).sum() > 0.9 * L.log_scores(words, PATH, np.log(own.start / own.start.sum())).sum()


def plain_scores(rows, logp):
    """Log10 probability of each text: every class by itself, word by word."""
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, *_ in rows]
    counts, texts = {}, Counter()
    for (_, t, lang), h in zip(rows, held):
        if not h:
            counts.setdefault(lang, Counter()).update(L.split((t or "").encode()))
            texts[lang] += 1

    def shares(c):
        """Discounted shares and what is left, from counts."""
        n1, n2 = (sum(x == k for x in c.values()) for k in (1, 2))
        d = (n1 + 0.5) / (n1 + 2 * n2 + 1)
        return ({w: (x - d) / c.total() for w, x in c.items()}, d * len(c) / c.total()) if c else ({}, 1.0)

    by_class = {lang: shares(c) for lang, c in counts.items()}
    new, spelled_share = shares(Counter(w for c in counts.values() for w in c))
    n, n_texts = sum(c.total() for c in counts.values()), texts.total()
    end = (n_texts + 1) / (n + n_texts + 2)
    spelled = dict(zip(words := sorted({w for _, t, _ in rows for w in L.split((t or "").encode())}), L.log_scores(words, PATH, logp)))
    out = []
    for i, t, _ in rows:
        terms = []
        for lang, (own, left) in by_class.items():
            score = math.log10((texts[lang] + 0.5) / (n_texts + 0.5 * len(by_class)))
            for w in L.split((t or "").encode()):
                score += np.logaddexp(math.log(own.get(w, 0) + left * new.get(w, 0) + 1e-320), math.log(left * spelled_share) + spelled[w] * math.log(10)) / math.log(10)
                score += math.log10(1 - end)
            terms.append(score * math.log(10))
        out.append((i, np.logaddexp.reduce(terms) / math.log(10) + math.log10(end)))
    return out


@pytest.mark.parametrize("common", [20_000, 5])
def test_scores_are_those_of_a_plain_model(spark, rows, monkeypatch, common):
    rows = rows + [(1000 + i, f"the cat w{i} x{i % 9}", f"lang{i % 40}") for i in range(150)]       # many classes
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    learned = L.learn(training(docs), PATH, 4)
    monkeypatch.setattr(L, "learn", lambda train, path, buckets, iterations, learn=L.learn: learn(train, path, buckets, iterations, common))
    got = L.score_documents(docs, PATH).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])      # noqa: E731
    mine, plain_ones = sorted(((r.id, r.score) for r in got), key=key), sorted(plain_scores(rows, learned.logp), key=key)
    assert [x[0] for x in mine] == [x[0] for x in plain_ones]
    assert [x[1] for x in mine] == pytest.approx([x[1] for x in plain_ones], rel=1e-5)


def test_batches_are_bounded_and_sums_alike_in_both_ways(monkeypatch):
    pair, x = np.array([5, 1, 5, 9]), np.array([1.0, 2.0, 3.0, 4.0])
    assert all((a == b).all() for a, b in zip(L.pair_sums(pair, x, 10), L.pair_sums(pair, x, L.CELLS + 1)))
    batches = [pa.record_batch({"t": ["x" * 100] * 50}) for _ in range(9)]
    assert sum(t.num_rows for t in L.gathered(batches)) == 450 and len(list(L.gathered(batches))) == 1
    monkeypatch.setattr(L, "BATCH_BYTES", 9000)
    assert [t.num_rows for t in L.gathered(batches)] == [50] * 9
    monkeypatch.setattr(L, "BATCH_ROWS", 20)
    assert [t.num_rows for t in L.gathered(batches)] == [20, 20, 10] * 9


def test_held_out_documents_score_above_the_base(spark):
    from grist.llm.registry import QUERIES

    got = QUERIES["op10_lm_scoring"](spark, "/root/testdata/sf0.1").filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_buckets_follow_the_text(spark, monkeypatch):
    texts = spark.createDataFrame([("é" * 500,)] * 400 + [(None,)], "t string")
    assert L.bucket_count(texts) == L.bucket_count(texts.limit(0)) == max(L.LEAST_BUCKETS, L.partitions(spark))
    assert L.bucket_count(texts, 1000) == 400 and L.bucket_count(texts, 1001) == 400
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, " ".join(f"w{rng.randrange(300)}" for _ in range(40)), "en") for i in range(60)], "doc_id long, text string, lang string")
    few = sorted(map(tuple, L.score_documents(docs, PATH).collect()))
    monkeypatch.setattr(L, "bucket_count", lambda rows: 700)
    many = sorted(map(tuple, L.score_documents(docs, PATH).collect()))
    assert [r[:5] for r in many] == [r[:5] for r in few]
    assert [x for r in many for x in r[5:]] == pytest.approx([x for r in few for x in r[5:]], rel=1e-5)
