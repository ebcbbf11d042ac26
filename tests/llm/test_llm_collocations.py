"""Collocations against a plain version; the filter and the blocks change nothing."""

import random
import re
from collections import Counter

import duckdb
import pytest

from grist.llm import collocations as C
from grist.llm.registry import ORACLES, QUERIES


def plain(rows, min_count, top=2000, percent=100):
    total, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            total[lang] += len(w)
            for k in range(1, 6):
                f.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    f = {p: n for p, n in f.items() if n >= min_count}
    out = {}
    for p, a in f.items():
        lang, w = p[0], p[1:]
        if len(w) < 2:
            continue
        longer = [b for q, b in f.items() if q[0] == lang and len(q) > len(p) and any(q[i:i + len(w)] == w for i in range(1, len(q)))]
        if any(100 * b >= percent * a for b in longer):
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = f[(lang, *w[:k])], f[(lang, *w[k:])]
            cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i, p.decode(), -a, left, right, total[lang], -s)
                  for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1))


def collected(df):
    return sorted((r.language, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def made_rows(seed, n=300):
    r = random.Random(seed)
    words = ["the", "THE", "of", "new", "york", "city", "été", "İ", "a\x00b", "x y", "東京", "#1", "hall"]
    def text():
        parts = []
        for _ in range(r.randint(0, 30)):
            parts.append(r.choice(["new york city hall", "of the", r.choice(words), r.choice(words)]))
            parts.append(r.choice([" ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "; ", " "]))
        return "".join(parts)
    return [(text(), r.choice(["en", "en", "en", "fr", None, "und"])) for _ in range(n)] + [(None, "en"), ("", None), ("...", "xx"), ("new york", "zz")]


@pytest.mark.parametrize("seed,min_count", [(1, 5), (2, 20), (3, 1)])
def test_equals_plain_version(spark, seed, min_count):
    rows = made_rows(seed, 120 if min_count == 1 else 300)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = collected(C.mine(df, min_count=min_count))
    assert got == plain(rows, min_count) and got


def test_small_blocks_and_a_full_filter_change_nothing(spark):
    rows = made_rows(4)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(2)
    expected = plain(rows, 8)
    import numpy as np
    rows_ = df.selectExpr("coalesce(lang, 'und') as language", "text as t")
    full = np.full(C.FILTER_BITS >> 6, 2 ** 64 - 1, np.uint64)      # every pair passes: the windows are not cut
    counted, totals = C.phrase_counts(C.window_counts(rows_, full), 8)
    got = {(r.language, r.phrase): r.a for r in C.scored(counted, totals).collect()}
    assert {(x[0], x[2]): x[3] for x in expected}.items() <= got.items()


def test_slices_end_at_pieces(monkeypatch):
    text = ("one two three, four. " * 20).encode()
    whole = [w for part in C.tokens(text) for w in part]
    monkeypatch.setattr(C, "SLICE", 16)
    parts = list(C.tokens(text))
    assert len(parts) > 5 and all(p[-1] == C.END for p in parts)
    pieces = lambda ws: [p.split() for p in b" ".join(ws).split(C.END) if p.strip()]
    assert pieces([w for p in parts for w in p]) == pieces(whole)


def test_contained_share_top_and_products_beyond_64_bits(spark):
    rows = [("new york city", "en")] * 9 + [("new york", "en")] + [("big city", "en")] * 5
    df = spark.createDataFrame(rows, "text string, lang string")
    assert [r.phrase for r in C.mine(df, min_count=3).orderBy("rank").collect()] == [x[2] for x in plain(rows, 3)]
    assert [r.phrase for r in C.mine(df, min_count=3, contained_percent=90).orderBy("rank").collect()] == [x[2] for x in plain(rows, 3, percent=90)]
    assert len(C.mine(df, min_count=3, top=1).collect()) == 1
    assert C.mine(df.filter("false")).collect() == []
    counted = spark.createDataFrame([("en", 1, "a", 4 * 10 ** 12), ("en", 1, "b", 5 * 10 ** 12), ("en", 2, "a b", 3 * 10 ** 12)], "language string, k int, phrase string, f long")
    totals = spark.createDataFrame([("en", 9 * 10 ** 12 + 1)], "language string, total long")
    row = C.scored(counted, totals).first()
    assert row.score == 1000 * 3 * 10 ** 12 * (9 * 10 ** 12 + 1) // (20 * 10 ** 24)


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    got = sorted(tuple(r) for r in QUERIES["op11_collocations"](spark, sf).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == sorted(con.sql(ORACLES["op11_collocations"]).fetchall()) and got


def test_windows_end_before_runs_that_are_not_frequent(spark, monkeypatch):
    # every pair of neighbours is frequent, no run of three is
    rng = random.Random(4)
    words = [f"w{i}" for i in range(6)]
    texts = [(" ".join(rng.choices(words, k=40)), "en") for _ in range(40)] + [("a b c d e f", "fr")] * 30
    kept = []
    monkeypatch.setattr(C, "materialize", lambda df, tag, write=C.materialize: kept.append((tag, write(df, tag))) or kept[-1][1])
    got = C.mine(spark.createDataFrame(texts, "text string, lang string"), min_count=25).collect()
    assert sorted(map(tuple, got)) == plain(texts, 25)
    windows = dict(kept)["windows"].filter("w3 is not null")
    assert {r.language for r in windows.select("language").distinct().collect()} == {"fr"}
