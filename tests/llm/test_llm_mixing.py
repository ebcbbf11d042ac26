"""Targets, the knapsack and the mix against plain versions."""

import random
import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from grist.llm import mixing as M


def plain_targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[t] for t in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: float(cap * sizes[s]) for s in over}


@pytest.mark.parametrize("seed", range(30))
def test_knapsack_finds_the_nearest_sum(seed):
    rng = random.Random(seed)
    sizes = rng.sample(range(2, 30), rng.randint(1, 5))
    counts = [rng.randint(1, 3) for _ in sizes]
    budget = rng.randint(1, 120)
    taken = M.knapsack(budget, sizes, counts)
    assert all(0 <= t <= c for t, c in zip(taken, counts))
    best = min(abs(sum(a * b for a, b in zip(t, sizes)) - budget) for t in product(*[range(c + 1) for c in counts]))
    assert abs(sum(a * b for a, b in zip(taken, sizes)) - budget) == best


@pytest.mark.parametrize("seed", range(10))
def test_fit_meets_targets(seed):
    rng = np.random.default_rng(seed)
    sizes = np.unique(rng.integers(1, 5000, 300))
    counts = rng.integers(1, 400, len(sizes))
    total = int((sizes * counts).sum())
    for share in (0.0, 0.013, 0.5, 1.0, 1.7, 2.999, 3.0):
        rounds, extra = M.fit(sizes, counts, share * total)
        assert (extra >= 0).all() and (extra <= counts).all() and rounds + (extra > 0).max() <= 3
        assert abs(rounds * total + int((extra * sizes).sum()) - share * total) <= 1


def make(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 2, 3, 5, 8, 40])), rng.choice(["b", "a", "ä", "Z", None, "tiny"] + ["b"] * 8)) for i in range(3000)]
    rows = [r for r in rows if r[2] != "tiny"] + [(9001, "x y", "tiny"), (9002, None, "tiny"), (None, "n n n", "a"), (None, "n n n", "a"), (77, "s s", "b"), (77, "s s", "b"),
                                                  (9003, " \n", "blank"), (9003, "\x85 é", "a")]
    return rows, spark.createDataFrame([(i, t, s, 7, "c") for i, t, s in rows], "doc_id long, text string, source string, size int, name string")


def test_mix(spark):
    rows, docs = make(spark)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))      # noqa: E731
    got = M.mix(docs).collect()
    assert Counter((r.id, r.source, r.size) for r in got) == Counter((i, s, size(t)) for i, t, s in rows)
    sizes, taken, targets = defaultdict(int), defaultdict(int), {}
    for _, t, s in rows:
        sizes[s] += size(t)
    for r in got:
        taken[r.source] += r.times * r.size
        targets[r.source] = r.target
        assert r.source_size == sizes[r.source] and 0 <= r.times <= 3
    expected = plain_targets(sizes)
    for s in sizes:
        assert targets[s] == pytest.approx(expected[s], rel=1e-9) and abs(taken[s] - expected[s]) <= 1, s
    assert targets["blank"] == 0.0
    again = M.mix(docs.repartition(7)).collect()
    key = lambda rs: sorted(((r.id, r.source or "", r.size, r.times, r.text_hash) for r in rs), key=str)      # noqa: E731
    assert key(again) == key(got)


def test_large_classes_are_ranked_in_bins(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.when(F.col("id") < 15_000, "x").otherwise("y").alias("source"))
    got = {r.source: (r.t, r.n) for r in M.mix(docs).groupBy("source").agg(F.sum(F.col("times") * 3).alias("t"), F.count("*").alias("n")).collect()}
    assert got == {"x": (20_001, 15_000), "y": (39_999, 5_000)} or (abs(got["x"][0] - 20_000) <= 2 and abs(got["y"][0] - 40_000) <= 2)


def test_rows_of_the_mix(spark):
    rows, docs = make(spark)
    mixed = M.mixed_rows(docs)
    assert mixed.columns == docs.columns
    times = Counter()
    for r in M.mix(docs).collect():
        times[(r.id, r.source)] += r.times
    got = Counter((r.doc_id, r.source) for r in mixed.collect())
    assert got == Counter({k: v for k, v in times.items() if v})


def test_empty(spark):
    _, docs = make(spark)
    assert M.mix(docs.limit(0)).count() == 0 and M.mixed_rows(docs.limit(0)).count() == 0
    blank = docs.withColumn("text", F.lit(" "))
    assert {r.times for r in M.mix(blank).select("times").distinct().collect()} == {0}
