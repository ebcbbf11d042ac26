"""Removed words against a plain version."""

import random
import re

import numpy as np
import pytest

from grist.llm import substring as S


def plain(rows, window):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            owner = S.LAST_ID if i is None else i
            first[key] = min(first.get(key, owner), owner)
    out = []
    for i, w in words:
        gone = {j for k in range(len(w) - window + 1) if first[tuple(w[k:k + window])] < (S.LAST_ID if i is None else i) for j in range(k, k + window)}
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def test_rolled_hashes_depend_on_the_window_only():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    h[200:300] = h[20:120]
    r = S.rolled(h, 50, S.BASES[0])
    assert len(r) == 351 and (r[200:251] == r[20:71]).all() and len(np.unique(r)) == 351 - 51
    a = S.anchors(h, 50)
    short = S.rolled(h, S.ANCHOR, S.BASES[0])
    assert a.tolist() == [int(short[i:i + 50 - S.ANCHOR + 1].min()) for i in range(351)]


@pytest.mark.parametrize("window", [1, 5, 20, 50])
def test_against_plain(spark, window):
    rng = random.Random(window)
    vocab = [f"w{i}" for i in range(40)] + ["é", "漢"]
    word = lambda n: " ".join(rng.choice(vocab) for _ in range(n))      # noqa: E731
    passages = [word(n) for n in (window, window + 1, 3 * window, max(1, window - 1), 70)]
    rows = []
    for i in range(60):
        text = rng.choice(["\n", " ", "  \t"]).join(rng.choice([word(rng.randint(0, 30)), rng.choice(passages)]) for _ in range(rng.randint(0, 6)))
        rows.append((rng.randint(0, 45), text))
    rows += [(None, passages[2]), (None, passages[2]), (7, None), (50, rows[3][1]), (51, rows[3][1]), (52, ""), (53, " \n ")]
    docs = spark.createDataFrame([(i, t, "keep", 1) for i, t in rows], "doc_id long, text string, spans string, _owner int")
    got = S.remove_repeats(docs, window=window).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == plain(rows, window)
    for r in got:
        words = S.cut(r.text.encode() if r.text else None, None, None, window)["kept"].split(" ")
        assert r.n_removed == sum(s.end - s.start for s in r.spans) and r._owner == 1
        at = {j for s in r.spans for j in range(s.start, s.end)}
        assert r.kept == " ".join(w for j, w in enumerate(words) if j not in at)
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_empty_table_and_long_text(spark):
    docs = spark.createDataFrame([(1, "a b " * 60_000), (2, "b a " * 30_000)], "doc_id long, text string")
    assert {(r.doc_id, r.n_words, r.n_removed) for r in S.remove_repeats(docs).collect()} == {(1, 120_000, 0), (2, 60_000, 60_000)}
    assert S.remove_repeats(docs.limit(0)).count() == 0
