"""Rank-order profiles against a plain version with dictionaries."""

import unicodedata
import zlib
from collections import Counter

import pytest

from grist.llm import rank_profiles as R
from grist.llm.registry import QUERIES

SF = "/root/testdata/sf0.01"


def plain_grams(text):
    word = lambda c: unicodedata.category(c)[0] in "LM"
    words = "".join(c if word(c) else " " for c in (text or "").lower()).split()
    if not any(unicodedata.category(c)[0] == "L" for w in words for c in w):
        return Counter()
    out = Counter()
    for i, w in enumerate(words):
        out.update(w)
        out.update(a + b for a, b in zip(w, w[1:]))
        out[w[-1] + " "] += 1               # a gap stands once between two words, and at both ends
        out[" " + w[0]] += 1
        padded = f" {w} "
        out.update(padded[j:j + 3] for j in range(len(padded) - 2))
    return out


def plain_ranks(counts, size):
    first = sorted(counts.items(), key=lambda x: (-x[1], len(x[0]), x[0].replace(" ", "\x01")))[:size]
    places = {}
    for i, (_, n) in enumerate(first):
        places.setdefault(n, []).append(i)
    return {g: sum(places[n]) / len(places[n]) for g, n in first}


def plain_predict(text, profiles, size):
    own = plain_ranks(plain_grams(text), size)
    if not own or not profiles:
        return "und", 0.0
    distance = {name: sum(abs(p[g] - r) if g in p else size for g, r in own.items()) for name, p in profiles.items()}
    best = min(sorted(distance), key=distance.get)
    return best, 1 - distance[best] / (size * len(own))


def test_query_equals_a_plain_version(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    out = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows}
    total = {}
    for r in rows:
        if not out[r.doc_id] and r.lang is not None:
            total.setdefault(r.lang, Counter()).update(plain_grams(r.text))
    profiles = {k: plain_ranks(v, R.PROFILE) for k, v in total.items()}
    got = {r.doc_id: r for r in QUERIES["op13_language_id"](spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        name, score = plain_predict(r.text, profiles, R.PROFILE)
        assert (got[r.doc_id].lang_pred, got[r.doc_id].held_out) == (name, out[r.doc_id])
        assert got[r.doc_id].score == pytest.approx(score, abs=1e-9) and 0 <= got[r.doc_id].score <= 1


def test_held_out_accuracy(spark):
    got = QUERIES["op13_language_id"](spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out and lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.99 * len(held) > 1000


def test_scripts_slices_and_defined_cases(spark, monkeypatch):
    rows = [("the cat sat on the mat and the dog", "en"), ("le chat est sur la table et le chien", "fr"), ("猫在垫子上面睡觉", "zh"), ("кошка спит на ковре", "ru"),
            (None, "en"), ("12 34 !", "en"), ("the the the", None)]
    train = spark.createDataFrame(rows, "text string, lang string")
    model = R.learn(train)
    assert model.languages == ["en", "fr", "ru", "zh"]
    for text, name in (("the mat", "en"), ("la table", "fr"), ("猫睡觉", "zh"), ("кошка", "ru"), (None, "und"), ("", "und"), ("1 + 2", "und"), ("́", "und")):
        assert model.predict(text)[0] == name
    assert model.predict("")[1] == 0.0
    # columns of the same names in another case are replaced; repeated rows get equal results
    df = spark.createDataFrame([("the mat", "x", 1), ("the mat", "x", 1), (None, "y", 2)], "text string, LANG_PRED string, _predicted int")
    got = R.predict(df, model).collect()
    assert [r.lang_pred for r in got] == ["en", "en", "und"] and len(got[0]) == 4
    assert R.predict(df.filter("false"), model).collect() == []
    empty = R.learn(train.filter("false"))
    assert empty.predict("the mat") == ("und", 0.0)
    # slices give the counts of the whole
    text = "Ünder the ice, the sea; " * 50
    whole = [x.tolist() for x in R.gram_counts(text)]
    monkeypatch.setattr(R, "SLICE", 7)
    assert [x.tolist() for x in R.gram_counts(text)] == whole
    assert dict(zip(*whole))[(ord("t") << 42) | (ord("h") << 21) | ord("e")] == 100


def test_language_that_holds_all_rows_and_ties(spark):
    df = spark.createDataFrame([("ab", "b"), ("ab", "a")], "text string, lang string")
    assert R.learn(df).predict("ab")[0] == "a"
    hot = spark.createDataFrame([("ab cd", "a")] * 500, "text string, lang string").repartition(4)
    counts = {r.gram: r.n for r in R.language_counts(hot).collect()}
    assert counts[ord("a")] == 500 and set(counts.values()) == {500}
