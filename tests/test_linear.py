"""The linear classifier: whole-number steps, held-out accuracy, defined cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from grist.operators import linear as L

SF = "/root/testdata/sf0.1"


def plain_fit(rows, steps, rate):
    """The same steps over dictionaries, features by name instead of bucket."""
    def features(text):
        words = text.lower().split()
        names = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        n = {x: names.count(x) for x in names}
        length = sum(c * c for c in n.values()) ** 0.5
        return {x: int(np.floor(c / length * L.FEATURE + 0.5)) for x, c in n.items()} | {"": L.FEATURE}

    data = [(features(t), y) for t, y in rows]
    share = {y: len(rows) / (2 * sum(b == y for _, b in rows)) for y in (0, 1)}
    w = {x: 0 for f, _ in data for x in f}

    def p(f):
        return 1 / (1 + np.exp(-(sum(w.get(x, 0) * v for x, v in f.items()) / (L.FEATURE * float(L.WEIGHT)))))

    for _ in range(steps):
        rest = [int(np.floor((p(f) - y) * share[y] * L.WEIGHT + 0.5)) for f, y in data]
        g = {x: sum(r * f.get(x, 0) for r, (f, _) in zip(rest, data)) for x in w}
        w = {x: v - int(np.floor(g[x] * rate / len(rows) / L.FEATURE + 0.5)) for x, v in w.items()}
    return lambda text: p(features(text))


def test_equals_plain_steps_in_any_partitioning(spark):
    rows = [("good clear helpful article about boats", 1), ("clear article article boats and harbours", 1), ("buy cheap pills now", 0),
            ("buy now now now", 0), ("an article about pills", 1)] * 3
    df = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(rows)], "doc_id long, text string, y int")
    model = L.train(df.repartition(5), F.col("y"), steps=6)
    assert np.array_equal(model.weights, L.train(df.coalesce(1), F.col("y"), steps=6).weights)
    p = plain_fit(rows, 6, L.RATE)
    texts = [t for t, _ in rows[:5]] + ["cheap boats", "words never seen"]
    probe = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in L.score(model, probe, "high", "low", "q").collect():
        want = p(texts[r.doc_id])
        assert r.q_label == ("high" if want > 0.5 else "low") and r.q_score == pytest.approx(max(want, 1 - want), abs=1e-9)


def test_defined_cases(spark):
    df = spark.createDataFrame([(1, "a b", 1), (2, None, 1), (3, "", 0), (4, "c", None), (5, "c", 7), (None, "a b", 1), (None, "a b", 1)],
                               "doc_id long, text string, y int")
    model = L.train(df, F.col("y"))
    got = L.score(model, df, "high", "low", "q").collect()
    assert len(got) == 7 and all(0.5 <= r.q_score <= 1 for r in got)
    assert L.score(model, df.limit(0), "high", "low", "q").count() == 0
    empty = L.train(df.limit(0), F.col("y"))
    assert {(r.q_label, r.q_score) for r in L.score(empty, df, "high", "low", "q").collect()} == {("low", 0.5)}
    one = L.train(df.filter("y = 1"), F.col("y"))
    assert {r.q_label for r in L.score(one, df, "high", "low", "q").collect()} == {"high"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = docs.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 0
    model = L.train(rows.filter(~held), F.col("quality"))
    got = L.score(model, rows.filter(held), "1", "0", "q").join(rows, "doc_id").select("q_label", "quality").collect()
    right = {y: [int(r.q_label) == y for r in got if r.quality == y] for y in (0, 1)}
    # measured: 0.76 of the low and 0.85 of the high ones
    assert len(got) > 900 and sum(right[0]) >= 0.7 * len(right[0]) and sum(right[1]) >= 0.8 * len(right[1]), {y: (sum(v), len(v)) for y, v in right.items()}
