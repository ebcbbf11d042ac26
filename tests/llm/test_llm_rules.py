"""Statistics against a plain count, and the decision list on made rows."""

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from grist.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            len(re.findall("[A-Z]", text)), len(re.findall("[!?]", text)))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é#|<!\n\t\r\x0b\x1c\x85A漢", max_size=60))
def test_counts(text):
    assert Q.count_text(text.encode()) == plain(text)


def rows(n, seed=0):
    rng = np.random.default_rng(seed)
    bad = rng.random(n) < 0.3
    words = rng.integers(50, 500, n)
    chars = words * rng.integers(4, 7, n)
    symbols = np.where(bad & (rng.random(n) < 0.6), chars // 4, rng.integers(0, 3, n))
    repeats = np.where(bad & (symbols < 3), words // 3, 0)
    zero = np.zeros(n, int)
    return np.stack([words, chars, symbols, zero, repeats, zero, zero], axis=1), bad


def test_list_finds_the_planted_rules_and_holds_on_new_rows():
    counts, bad = rows(3000)
    found = Q.learn_rows(counts, bad)
    assert 1 <= len(found.rules) <= 4
    new, bad = rows(2000, seed=9)
    ratios = np.stack([np.divide(new[:, Q.COUNTS.index(a)], new[:, Q.COUNTS.index(b)]) for a, b in Q.RATIOS], axis=1)
    assert (found.covered(ratios) == bad).mean() > 0.98


def test_one_class_or_no_rows_give_no_rules():
    counts, bad = rows(200)
    for c, b in ((counts, bad & False), (counts, bad | True), (counts[:0], bad[:0])):
        assert Q.learn_rows(c, b).rules == []


def test_columns_agree_with_the_fit(spark):
    counts, bad = rows(800)
    found = Q.learn_rows(counts, bad)
    stats = spark.createDataFrame([tuple(map(int, r)) for r in counts], [*Q.COUNTS])
    ratios = np.stack([counts[:, Q.COUNTS.index(a)] / counts[:, Q.COUNTS.index(b)] for a, b in Q.RATIOS], axis=1)
    kept = [r.kept for r in Q.apply(stats, found).select("kept").collect()]
    base = (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])
    assert kept == [bool(x) for x in ~found.covered(ratios) & ~base]


def test_defined_cases(spark):
    text = "word " * 60
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, text, "c"), (3, text, "c"), (None, "x", None)], "doc_id long, text string, n_words string")
    stats = Q.text_statistics(docs)
    got = {(r.doc_id, r.n_words, r.n_repeat_words) for r in stats.collect()}
    assert got == {(1, 0, 0), (2, 0, 0), (3, 60, 60), (None, 1, 0)}
    labels = spark.createDataFrame([(3, 1), (3, 0), (None, 1), (9, 0), (1, None)], "doc_id long, quality int")
    rules = Q.learn(stats, labels)
    assert {(r.doc_id, r.kept) for r in Q.apply(stats, rules).collect()} == {(1, False), (2, False), (3, False), (None, False)}
    assert Q.apply(stats.limit(0), Q.learn(stats.limit(0), labels.limit(0))).count() == 0


def test_few_labelled_rows_suffice_and_noise_gives_no_rule():
    for seed in range(5):
        counts, bad = rows(90, seed=seed)
        found = Q.learn_rows(counts, bad)
        new, new_bad = rows(2000, seed=100 + seed)
        ratios = np.stack([np.divide(new[:, Q.COUNTS.index(a)], new[:, Q.COUNTS.index(b)]) for a, b in Q.RATIOS], axis=1)
        hit = found.covered(ratios)
        assert found.rules and (hit & new_bad).sum() > 0.5 * new_bad.sum() and (hit & ~new_bad).sum() < 0.05 * (~new_bad).sum()
        assert Q.learn_rows(counts, np.random.default_rng(seed + 50).random(len(bad)) < 0.3).rules == []


def test_cuts_lie_midway_between_the_classes():
    values, bad = np.array([0.0, 0.0, 1.0, 2.0, 2.0, 4.0]), np.array([False, False, False, True, False, True])
    assert Q.cuts_between(values, bad).tolist() == [1.5, 3.0]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_query_rejects_labelled_junk_and_keeps_the_rest(spark, sf):
    from grist.llm.registry import QUERIES

    got = QUERIES["op2_quality_rules"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("not base_failed").collect()
    bad = [r for r in got if r.quality == 0]
    good = [r for r in got if r.quality == 1]
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad) and sum(r.kept for r in good) >= 0.98 * len(good)
