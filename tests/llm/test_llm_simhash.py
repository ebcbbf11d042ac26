"""Fingerprints and groups against plain versions."""

import random
import re
from itertools import product

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from grist.llm import simhash as S


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, max_bits=3):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in product(parent, parent):
        if a < b and (a ^ b).bit_count() <= max_bits:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {p: find(p) for p in parent}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abAÉé \n\t\x85\x1c漢", max_size=50))
def test_fingerprint(text):
    assert S.fingerprint(text.encode()) == plain_print(text)


def near(rng, base, n):
    return [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(n)]


@pytest.mark.parametrize("block", [4, 8192])
def test_links_give_all_components(spark, block):
    rng = random.Random(block)
    prints = {0, (1 << 64) - 1} | {rng.getrandbits(64) for _ in range(300)}
    for base in rng.sample(sorted(prints), 12):
        prints |= set(near(rng, base, 40))
    df = spark.createDataFrame([(S.signed(p),) for p in prints], "fp long")
    found = {(r.src % 2**64, r.dst % 2**64) for r in S.links(df, block=block).collect()}
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    expected = plain_groups(prints)
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in found:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    assert {p: find(p) for p in prints} == expected


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3, 5])
def test_any_allocation_finds_every_pair(max_bits):
    rng = random.Random(max_bits)
    for m in range(2, 6):
        parts = np.array_split(rng.sample(range(64), 64), m)
        costs = [[rng.random() * 10 for _ in range(max_bits + 2)] for _ in parts]
        _, thresholds = S.allocate(costs, max_bits)
        assert sum(thresholds) == max_bits - m + 1 and min(thresholds) >= -1
        best = min(sum(c[t + 1] for c, t in zip(costs, ts)) for ts in product(range(-1, max_bits + 1), repeat=m) if sum(ts) == max_bits - m + 1)
        assert abs(sum(c[t + 1] for c, t in zip(costs, thresholds)) - best) < 1e-9
        kept = S.masks([(list(map(int, p)), t) for p, t in zip(parts, thresholds) if t >= 0])
        for _ in range(300):
            x = rng.getrandbits(64)
            y = x ^ sum(1 << b for b in rng.sample(range(64), max_bits))
            assert any(x & k == y & k for k in kept)


def test_sorted_runs_may_span_batches():
    import pyarrow as pa

    rng = random.Random(5)
    keys = np.sort(np.array([rng.randint(0, 6) for _ in range(120)]))
    fps = np.array(near(rng, rng.getrandbits(64), 120), np.uint64)
    whole = set(zip(*(x.tolist() for x in S.links_of(keys[:, None], fps, 3))))
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i:i + 7]), pa.array(fps[i:i + 7].view(np.int64))], names=["k", "fp"]) for i in range(0, 120, 7)]
    got = set()
    for out in S.linker(3)(iter(batches)):
        got |= set(zip(*(c.to_numpy().view(np.uint64).tolist() for c in out.columns)))
    assert got == whole


def docs(spark):
    base = "one two three four five six seven eight nine ten eleven twelve " * 20
    rows = [(5, base, "x"), (3, base + "end", "x"), (4, base, "x"), (4, base, "x"), (9, None, "x"), (8, "", "x"), (None, " \n", "x"), (None, base, "x"),
            (1, "quite another text of its own", "x"), (None, "lonely words here", "x"), (None, "lonely words here", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")


def test_groups_and_survivors(spark):
    got = S.groups(docs(spark)).collect()
    assert len(got) == 11
    ids = {(r.doc_id, r.component_id) for r in got}
    near_id = 3 if (plain_print(("one two three four five six seven eight nine ten eleven twelve " * 20)) ^
                    plain_print("one two three four five six seven eight nine ten eleven twelve " * 20 + "end")).bit_count() <= 3 else 4
    assert {(9, 8), (8, 8), (None, 8), (1, 1), (5, near_id), (4, near_id), (None, near_id), (None, None)} <= ids
    assert {r.fingerprint for r in got if r.component_id == 8} == {0}
    kept = sorted(((r.doc_id is None, r.doc_id or 0, r.fingerprint) for r in S.keep_first(docs(spark)).collect()))
    expected = sorted([(False, 1, "x"), (False, 8, "x"), (False, 3, "x"), (True, 0, "x")] + ([(False, 4, "x")] if near_id == 4 else []))
    assert kept == expected


def test_empty_table(spark):
    assert S.groups(docs(spark).limit(0)).count() == 0
    assert S.keep_first(docs(spark).limit(0)).count() == 0


def test_query_on_documents(spark):
    from grist.llm.registry import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: plain_print(r.text) for r in rows}
    group = plain_groups(set(prints.values()))
    first = {}
    for i, p in prints.items():
        first[group[p]] = min(i, first.get(group[p], i))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op6_simhash_near_dedup"](spark, sf).collect()}
    assert got == {i: (f"{p:016x}", first[group[p]]) for i, p in prints.items()}
