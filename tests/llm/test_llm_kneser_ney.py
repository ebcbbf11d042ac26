"""The model against a plain version, and the verdicts on labelled rows."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from grist.llm import kneser_ney as K


def plain_model(sequences, size, order):
    """Interpolated modified Kneser-Ney by dictionaries: p(history, symbol)."""
    counts = {order: Counter(tuple(s[i:i + order]) for s in sequences for i in range(len(s) - order + 1))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cuts, totals, followers = {}, {}, {}
    for k, own in counts.items():
        n = Counter(own.values())
        if all(n[i] for i in (1, 2, 3, 4)):
            y = n[1] / (n[1] + 2 * n[2])
            d = [0] + [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0), i) for i in (1, 2, 3)]
        else:
            d = [0, 0.5, 1.0, 1.5]
        cuts[k], totals[k], followers[k] = d, Counter(), defaultdict(float)
        for g, c in own.items():
            totals[k][g[:-1]] += c
            followers[k][g[:-1]] += d[min(c, 3)]

    def p(history, w):
        k = len(history) + 1
        if not k > 1:
            lower = 1 / size
        else:
            lower = p(history[1:], w)
        if not totals[k][history]:
            return lower
        c = counts[k][(*history, w)]
        return (max(c - cuts[k][min(c, 3)], 0) + followers[k][history] * lower) / totals[k][history]

    return p


def test_scores_equal_the_plain_model(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["the", "cat", "sat", "on", "a", "mat", "\u00e9", "\u7684\u662f"]) for _ in range(rng.randint(1, 12))) for _ in range(60)]
    model = K.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    sequences = [K.symbols(t).tolist() for t in texts]
    seen = sorted({x for s in sequences for x in s[K.ORDER - 1:]})
    p = plain_model(sequences, len(seen) + 1, K.ORDER)
    wanted = {tuple(rng.choice([K.START, 0x1F642, *seen]) for _ in range(K.ORDER)) for _ in range(600)}
    wanted |= {tuple(s[i:i + K.ORDER]) for s in sequences for i in range(len(s) - K.ORDER + 1)}
    pack = {sum(x << K.BITS * (K.ORDER - 1 - i) for i, x in enumerate(g)): g for g in wanted}
    got = model.scores(spark.createDataFrame([(g,) for g in pack], "g long")).collect()
    assert len(got) == len(pack)
    for r in got:
        assert 10.0 ** (r.u / K.UNIT) == pytest.approx(p(pack[r.g][:-1], pack[r.g][-1]), rel=1e-5)
    assert sum(p((START := K.START, START), w) for w in seen) + p((START, START), 0x1F642) == pytest.approx(1.0, abs=1e-6)


@pytest.mark.parametrize("hot", [0, 5, 1 << 19])
def test_perplexity_equals_the_plain_model_whatever_is_broadcast(spark, monkeypatch, hot):
    monkeypatch.setattr(K, "HOT", hot)
    monkeypatch.setattr(K, "PIECE", 7)
    rng = random.Random(2)
    known = [" ".join(rng.choice(["le", "chat", "la", "\u732b"]) for _ in range(rng.randint(1, 9))) for _ in range(30)]
    model = K.train(spark.createDataFrame([(t,) for t in known], "text string"))
    sequences = [K.symbols(t).tolist() for t in known]
    p = plain_model(sequences, len({x for s in sequences for x in s[2:]}) + 1, K.ORDER)
    texts = known[:5] + ["qx \u732b\u732b le le", "", None, "chat la"] + ["zz top"] * 4
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = {r.id: r.perplexity for r in model.measure(rows).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        if not t:
            assert got[i] is None
            continue
        s = K.symbols(t).tolist()
        logs = [np.log10(p(tuple(s[j:j + 2]), s[j + 2])) for j in range(len(s) - 2)]
        assert got[i] == pytest.approx(10 ** -np.mean(logs), rel=1e-5)


def test_repeated_words_have_a_symbol_of_their_own():
    a, blank, b = (ord(c) for c in "a b")
    assert K.symbols("a a  a b").tolist() == [K.START, K.START, a, K.REPEAT, a, K.REPEAT, a, blank, b]
    assert K.symbols("ab a").tolist() == [K.START, K.START, a, b, blank, a]
    assert K.symbols("z\U0001f642").tolist()[2:] == [ord("z"), 0x1F642]


def test_junk_of_a_rare_script_is_rejected(spark):
    """Many trusted documents in one script, few in another."""
    rng = random.Random(3)
    latin = ["".join(rng.choice("abcdefghijklmnoprstuv") for _ in range(rng.randint(2, 8))) for _ in range(150)]
    signs = [chr(0x4E00 + i) for i in range(300)]
    chinese = ["".join(rng.choice(signs) for _ in range(2)) for _ in range(120)]
    rows = [(" ".join(rng.choices(latin, k=120)), "en", True) for _ in range(200)]
    rows += [("".join(rng.choices(chinese, k=120)), "zh", True) for _ in range(140)]
    rows += [("".join(rng.choices(signs, k=240)), "zh", False) for _ in range(40)]
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang, _) in enumerate(rows)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(200)] + [(i, 1) for i in range(200, 300)], "doc_id long, quality int")
    kept = {r.doc_id for r in K.classify(docs, labels).filter("kept").collect()}
    assert kept == {i for i, r in enumerate(rows) if r[2]}
    assert {r.doc_id for r in K.keep(docs, labels).collect()} == kept


def test_defined_cases(spark):
    good = "the cat sat on the mat and the dog lay on a rug"
    rows = [(i, good, "en", "x") for i in range(40)] + [(40, "## %% @@ !!" * 5, "en", "x"), (41, None, "en", "x"), (42, "", None, "x"), (43, good, None, "x"), (43, good, None, "x"), (None, good, "xx", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, perplexity string")
    labels = spark.createDataFrame([(i, 1) for i in range(41)] + [(40, 0), (999, 1), (None, 1), (1, None)], "doc_id long, quality int")
    got = {(r.doc_id, r.kept) for r in K.classify(docs, labels).collect()}
    assert got == {(i, True) for i in range(40)} | {(40, False), (41, False), (42, False), (43, True), (None, True)}
    assert sorted(map(str, K.keep(docs, labels).select("doc_id").collect())) == sorted(map(str, K.classify(docs, labels).filter("kept").select("doc_id").collect()))
    assert K.keep(docs, labels).columns == docs.columns and K.keep(docs.limit(0), labels).count() == 0
    assert K.classify(docs, labels.limit(0)).filter("kept").count() == 44         # all with a text
    assert K.classify(docs.limit(0), labels).count() == 0


def test_query_rejects_junk_and_keeps_clean_documents(spark):
    from grist.llm.registry import QUERIES

    sf = "/root/testdata/sf0.01"
    judged = QUERIES["op8_quality_classifier"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    bad, good = [r for r in judged if r.quality == 0], [r for r in judged if r.quality == 1]
    assert sum(not r.kept for r in bad) >= 0.95 * len(bad) and sum(r.kept for r in good) >= 0.99 * len(good)


def test_the_model_learns_from_every_trusted_id_of_its_half(spark, monkeypatch):
    """More ids than any fixed number of rows: none is left out, repeated rows included."""
    n = 42_000
    docs = spark.range(n).selectExpr("id as doc_id", "concat('t', id) as text", "'en' as lang")
    docs = docs.unionByName(docs.filter("doc_id < 10"))
    labels = spark.range(n).selectExpr("id as doc_id", "1 as quality")

    class Stop(Exception):
        pass

    def train(trusted, text):
        raise Stop(trusted.count())

    monkeypatch.setattr(K, "train", train)
    with pytest.raises(Stop) as e:
        K.fit(docs, labels)
    learns = K.trusted_ids(labels).filter("learns")
    assert e.value.args[0] == docs.join(learns, docs.doc_id == learns.trusted_id, "left_semi").count() > 20_000
