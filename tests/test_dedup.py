"""Exact and fuzzy dedup (A1-A9), skew-split joins and components."""

import os
import random

import pytest
from pyspark.sql import functions as F

from grist.operators import components as CC
from grist.operators import exact, minhash, skew
from grist.sources import files

NOTICE = "This page was archived by the crawler on a rainy day."
DOCS = {
    "doc1.txt": NOTICE + "\n",
    "doc2.txt": NOTICE + "\n",
    "doc3.txt": "- home\n- menu\n- back\nA quiet valley with a single mill.\n",
    "doc4.txt": "- home\n- menu\nTrains leave the station every hour.\n",
    "doc5.txt": "Nothing here repeats anywhere else.",
}


def write_files(root, docs):
    os.makedirs(root, exist_ok=True)
    for name, body in docs.items():
        with open(os.path.join(root, name), "w", encoding="utf-8") as fh:
            fh.write(body)
    return root


def test_line_dedup_on_files(spark, tmp_dir):
    root = write_files(os.path.join(tmp_dir, "in"), DOCS)
    out = {r["name"]: r["text"] for r in files.dedup_files(spark, root).collect()}
    assert out == {
        "doc1.txt": "",
        "doc2.txt": "",
        "doc3.txt": "- back\nA quiet valley with a single mill.\n",
        "doc4.txt": "Trains leave the station every hour.\n",
        "doc5.txt": "Nothing here repeats anywhere else.",
    }


def test_line_dedup_crlf_and_blank_lines(spark, tmp_dir):
    root = write_files(os.path.join(tmp_dir, "crlf"), {
        "a.txt": "x\r\n\r\ny\r\n", "b.txt": "\nz"})
    out = {r["name"]: r["text"] for r in files.dedup_files(spark, root).collect()}
    # the blank line occurs in both files, so it is dropped everywhere
    assert out == {"a.txt": "x\ny\n", "b.txt": "z"}


def test_line_dedup_is_idempotent(spark):
    df = spark.createDataFrame([(1, "a\nb\nc"), (2, "b\nd"), (3, "e")], "doc_id long, text string")
    once = exact.exact_line_dedup(df)
    twice = exact.exact_line_dedup(once)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_doc_dedup_drop_all_and_keep_first(spark):
    df = spark.createDataFrame([(1, "same\n"), (2, "same"), (3, "other")], "doc_id long, text string")
    assert [r["doc_id"] for r in exact.exact_doc_dedup(df).collect()] == [3]
    kept = sorted(r["doc_id"] for r in exact.exact_doc_dedup(df, keep="first").collect())
    assert kept == [1, 3]


def _license(name):
    return (f"Copyright (c) {name} contributors\n"
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files, to deal in the Software without "
            "restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and sell copies of the Software, subject to the "
            "following conditions: the above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software. The software is "
            "provided as is, without warranty of any kind, express or implied.")


def test_fuzzy_pair_removed_both_modes(spark):
    other = ("A completely different notice about a research library, its maintainers, the "
             "funding bodies that supported it and the many students who wrote its tests. " * 3)
    df = spark.createDataFrame([(1, _license("Alpha Project")), (2, _license("Beta Framework")),
                                (3, other)], "doc_id long, text string")
    p = minhash.MinHashParams(num_hashes=500, num_bands=50, ngrams=5, jaccard_threshold=0.8)
    for verify in (False, True):
        kept = sorted(r["doc_id"] for r in minhash.fuzzy_dedup(df, p, verify=verify).kept.collect())
        assert kept == [1, 3]


def test_exact_copies_removed_by_minhash(spark):
    rows = [(i, t) for i, t in enumerate(DOCS.values())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    p = minhash.MinHashParams(num_hashes=100, num_bands=10, ngrams=5)
    kept = minhash.fuzzy_dedup(df, p).kept.count()
    assert kept == 4


def test_native_and_arrow_signatures_agree(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    p = minhash.MinHashParams(num_hashes=40, num_bands=4, ngrams=2)
    sets = minhash.shingle_sets(df, "doc_id", "text", 2)
    coeffs = minhash.hash_coefficients(40)
    arrow = {r["doc_id"]: list(r["sig"]) for r in
             minhash._signatures_arrow(sets, "doc_id", coeffs).collect()}
    old = minhash.NATIVE_MAX_HASHES
    minhash.NATIVE_MAX_HASHES = 64
    try:
        native = {r["doc_id"]: list(r["sig"]) for r in minhash.signatures(df, p).collect()}
    finally:
        minhash.NATIVE_MAX_HASHES = old
    assert native == arrow


def test_params_validation():
    with pytest.raises(ValueError):
        minhash.MinHashParams(num_hashes=10, num_bands=3)
    with pytest.raises(ValueError):
        minhash.MinHashParams(num_hashes=2, num_bands=4)


def union_find(edges, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}


def test_components_match_union_find(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    edges += [(i, i + 1) for i in range(300, 330)]  # a long chain
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r["vertex"]: r["component"] for r in CC.connected_components(df).collect()}
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    uf = union_find([e for e in edges if e[0] != e[1]], nodes)
    assert got == {n: uf[n] for n in nodes}


@pytest.mark.parametrize("seed, hot_rows", [(1, 1 << 17), (2, 4), (3, 4)])
def test_components_of_random_shapes(spark, seed, hot_rows):
    """Chains of shuffled ids, hubs, self-loops, repeated and null edges."""
    rng = random.Random(seed)
    ids = rng.sample(range(10_000), 400)
    edges = [(a, b) for a, b in zip(ids[:150], ids[1:151])] + [(ids[200], x) for x in ids[201:280]]
    edges += [(rng.choice(ids[300:]), rng.choice(ids[300:])) for _ in range(60)] + [(ids[0], ids[0])] + [(ids[3], ids[2])] * 3
    df = spark.createDataFrame(edges + [(None, 1), (2, None)], "src long, dst long")
    got = [(r["vertex"], r["component"]) for r in CC.connected_components(df, hot_rows=hot_rows).collect()]
    real = [e for e in edges if e[0] != e[1]]
    assert sorted(got) == sorted(union_find(real, {x for e in real for x in e}).items())
    assert CC.connected_components(df.limit(0)).count() == 0


def test_rounds_of_a_long_chain(spark, monkeypatch):
    """Contraction shortens a chain geometrically: few rounds, no limit of them."""
    ids = list(range(1 << 13))
    random.Random(5).shuffle(ids)
    rounds = []
    forest = CC.is_star_forest
    monkeypatch.setattr(CC, "is_star_forest", lambda pairs: rounds.append(1) or forest(pairs))
    df = spark.createDataFrame(list(zip(ids, ids[1:])), "src long, dst long")
    got = CC.connected_components(df)
    assert got.filter("component = 0").count() == len(ids) == got.count()
    assert len(rounds) <= 14


@pytest.mark.parametrize("mode", ["broadcast", "salted", "salted_all"])
def test_split_join_paths_agree(spark, mode):
    big = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(300)], "k long, v long")
    small = spark.createDataFrame([(k, f"p{k}") for k in range(0, 300, 2)] + [(1, "hot")],
                                  "k long, p string")
    plain = sorted(big.join(small, "k").collect())
    opts = {"hot_rows": 50}
    if mode == "salted":
        opts["max_broadcast_rows"] = 0
    if mode == "salted_all":
        opts["max_broadcast_keys"] = 0
    got = sorted(skew.split_join(big, small, ["k"], "inner", **opts).collect())
    assert got == plain


def test_hot_bucket_star_edges_linear(spark):
    # 400 copies of one text: one bucket per band, star edges only
    df = spark.createDataFrame([(i, "the same words in every one of these rows") for i in range(400)],
                               "doc_id long, text string")
    p = minhash.MinHashParams(num_hashes=4, num_bands=2, ngrams=2)
    res = minhash.fuzzy_dedup(df, p, hot_rows=100)
    assert res.edges.count() == 399
    assert [r["doc_id"] for r in res.kept.collect()] == [0]


def test_hot_line_never_reaches_a_join(spark):
    # one boilerplate line in every document: dropped everywhere, and the plan
    # removes it inside the aggregate (no join is keyed on the line)
    rows = [(i, f"Home | About | Contact\nunique line number {i}") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = exact.exact_line_dedup(df)
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got == {i: f"unique line number {i}" for i in range(500)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Join" in line:
            assert "line" not in line.split("Join", 1)[1]


def test_verified_dedup_compares_beyond_the_smallest_id(spark):
    """1 shares buckets with 2 and 3 but is unlike them; 2 and 3 are alike."""
    bands = spark.createDataFrame([(i, 0, [7]) for i in (1, 2, 3)], "doc_id long, band int, key array<long>")
    words = [f"s{i}" for i in range(60)]
    sets = spark.createDataFrame([(1, words[:2] + [f"x{i}" for i in range(30)]), (2, words[:41]), (3, words[:42])], "doc_id long, shingles array<string>")
    got = minhash.verified_edges(bands, sets, minhash.MinHashParams(), "doc_id").collect()
    assert [(r["src"], r["dst"]) for r in got] == [(2, 3)]


def test_verified_dedup_follows_chains_of_near_copies(spark):
    """1 is like 2 and 2 like 3, but 1 is unlike 3."""
    bands = spark.createDataFrame([(i, 0, [7]) for i in (1, 2, 3)], "doc_id long, band int, key array<long>")
    words = [f"s{i}" for i in range(60)]
    sets = spark.createDataFrame([(1, words[:40]), (2, words[4:44]), (3, words[8:48])], "doc_id long, shingles array<string>")
    got = minhash.verified_edges(bands, sets, minhash.MinHashParams(), "doc_id").collect()
    assert sorted((r["src"], r["dst"]) for r in got) == [(1, 2), (2, 3)]


def test_verified_components_equal_those_of_all_pairs(spark):
    rng = random.Random(3)
    sets, buckets = {}, {}
    for i in range(150):
        base, shift = rng.randrange(6) * 1000, rng.randrange(30)
        sets[i] = frozenset(f"w{base + shift + j}" for j in range(rng.randint(18, 24)))
        if i % 5 == 4:
            sets[i] = sets[i - 1]
        buckets.setdefault(sets[i], (i % 3, rng.randrange(8)))      # equal sets share all buckets
    linked = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) > 0.8
              and any(x == y for x, y in zip(buckets[sets[a]], buckets[sets[b]]))}
    bands = spark.createDataFrame([(i, b, [k]) for i, s in sets.items() for b, k in enumerate(buckets[s])], "doc_id long, band int, key array<long>")
    rows = spark.createDataFrame([(i, rng.sample(sorted(s), len(s))) for i, s in sets.items()], "doc_id long, shingles array<string>")
    edges = minhash.verified_edges(bands, rows, minhash.MinHashParams(), block=3, hot_rows=20)
    got = {(r["src"], r["dst"]) for r in edges.collect()}
    assert got <= linked
    assert union_find(got, sets) == union_find(linked, sets)
