"""The exact similarity join against all pairs, and its defined cases."""

import random

import pytest

from grist.functions import text as T
from grist.operators import setjoin as S


def shingles(text, n):
    w = (text or "").split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def plain(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows}
    links, cls = {i: 0 for i in sets}, {}
    for i, a in sets.items():
        cls[i] = min([j for j, b in sets.items() if a and a == b], default=i)
        for j, b in sets.items():
            if i != j and a and b and len(a & b) * 100 >= len(a | b) * percent:
                links[i] += 1
    return sorted((i, cls[i], links[i]) for i in sets)


def made(seed, n=120):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    base = [[r.choice(words) for _ in range(r.randint(3, 40))] for _ in range(8)]
    rows = []
    for i in range(n):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 6])):
            w[r.randrange(len(w))] = r.choice(words)
        rows.append((i, " ".join(w[:r.choice([len(w)] * 4 + [len(w) - 1])])))
    return rows + [(1000, None), (1001, ""), (1002, "one"), (1003, "one")]


@pytest.mark.parametrize("seed,n,percent", [(1, 2, 80), (2, 1, 50), (3, 3, 95)])
def test_equals_all_pairs(spark, monkeypatch, seed, n, percent):
    monkeypatch.setattr(S, "CELL", 7)
    rows = made(seed)
    got = S.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), n, percent).collect()
    assert sorted(map(tuple, got)) == plain(rows, n, percent)


def test_hot_shingles_are_split_alike(spark):
    rows = made(4, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.similar_documents(df, 2, 80, hot_rows=5, max_broadcast_rows=3, salts=3).collect()
    assert sorted(map(tuple, got)) == plain(rows, 2, 80)


def test_one_copy_of_each_group_stays(spark):
    text = " ".join(f"a{i}" for i in range(60))
    rows = [(5, text), (6, text + " end"), (7, text), (8, "quite another text with other words in it"), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in S.similarity_dedup(df).collect()) == [5, 8, 9]
    assert S.similarity_dedup(df.filter("false")).collect() == []
    with pytest.raises(ValueError):
        S.similar_pairs(df, 0)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_shingles_are_hashed_as_arrays(spark, n):
    texts = ["É a-b  C　d ΟΔΟΣ. x", "e a b c d οδος x", "e a b c d", " ", "", None, "!?", "x​y ́z\x85Ⅷ İ İ", "a a a a a a a a",
             "a b c d e f", "f e d c b a", "\U0001d400 K k ß ≮"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = S.shingle_hashes(df, "doc_id", "text", n)
    assert "ArrowEvalPython" in got._jdf.queryExecution().executedPlan().toString()
    hashed = {r.id: r.set for r in got.collect()}
    named = {r.doc_id: set(r.s or []) for r in T.with_shingles(df, "text", n, "s").collect()}
    assert all(x == sorted(set(x)) and len(x) == len(named[i]) for i, x in hashed.items())
    assert all(len(set(hashed[i]) & set(hashed[j])) == len(named[i] & named[j]) for i in named for j in named)


def test_shared_shingles_are_counted_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "COUNTED", 3)
    r = random.Random(5)
    sets = [sorted(r.sample(range(-20, 20), r.randint(1, 9))) for _ in range(30)]
    df = spark.createDataFrame([(i, 1, s) for i, s in enumerate(sets)], "id long, n long, set array<long>").repartition(3)
    want = {t: sum(t in s for s in sets) for t in range(-20, 20)}
    assert {x.token: x.df for x in S.shared_shingles(df).collect()} == {t: c for t, c in want.items() if c > 1}
    assert S.shared_shingles(df.filter("false")).collect() == []


@pytest.mark.parametrize("percent", [50, 80])
def test_prefixes_are_ordered_on_arrays(spark, monkeypatch, percent):
    monkeypatch.setattr(S, "COUNTED", 7)
    r = random.Random(6)
    sets = {i: sorted(r.sample(range(-2**62, 2**62, 2**57), r.randint(0, 9))) for i in range(40)}
    df = spark.createDataFrame([(f"d{i:02}", s) for i, s in sets.items()], "id string, set array<long>").repartition(3)
    found = S.prefixes(df, percent)
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()        # no row for each shingle
    count = {t: sum(t in s for s in sets.values()) for s in sets.values() for t in s}
    want = set()
    for i, s in sets.items():
        order = sorted((count[t], t) for t in s)
        shared = [t for c, t in order if c > 1]
        for at, (c, t) in enumerate(order[:len(s) + (-len(s) * percent // 100) + 1]):
            if c > 1:
                want.add((f"d{i:02}", len(s), min(shared), t, at, order[at - 1][1] if at and order[at - 1][0] > 1 else None))
    got = [tuple(x) for x in found.collect()]
    assert len(got) == len(want) and set(got) == want
    assert S.prefixes(df.filter("size(set) = 0"), percent).collect() == []


def test_near_copies_share_cells(spark, monkeypatch):
    monkeypatch.setattr(S, "CELL", 30)
    r = random.Random(7)
    sets = []
    for k in range(40):
        base = [r.randrange(-2**62, 2**62) for _ in range(120)]
        sets += [sorted({*base} - {r.choice(base[2:]), r.choice(base[2:])}) for _ in range(12)]
    df = spark.createDataFrame(list(enumerate(sets)), "id long, set array<long>")
    pairs = S.cells(S.candidates(df, 80))
    ids = pairs.selectExpr("x", "y", "explode(array(a, b)) as id")
    assert pairs.count() == 40 * 66 and ids.select("id").distinct().count() == len(sets)
    # dealt by their ids, each would go to about ten
    assert ids.distinct().count() < 3 * len(sets)
    assert max(x["count"] for x in ids.distinct().groupBy("x", "y").count().collect()) <= 8 * 30
