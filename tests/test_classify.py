"""Naive Bayes heads (C1-C5) and the funnel."""

import math

from pyspark.sql import functions as F

from grist.operators import classify as C
from grist.plans import curate as X

SF = "/root/testdata/sf0.001"


def test_language_head_on_driver_data(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    m = C.train_language(d)
    s = C.score_nb(m, d).join(d.select("doc_id", "lang"), "doc_id")
    acc = s.filter(F.col("lang_label") == F.col("lang")).count() / s.count()
    assert acc > 0.95
    assert s.filter((F.col("lang_score") <= 0) | (F.col("lang_score") > 1)).count() == 0


def test_binary_head_labels(spark):
    rows = [(i, ("great clear helpful article " * 5) if i % 2 else ("spam spam buy now cheap " * 5), i % 2)
            for i in range(40)]
    d = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")
    lab = spark.createDataFrame([(r[0], r[2], 1 - r[2]) for r in rows],
                                "doc_id long, quality int, toxic int")
    heads = C.train_binary_heads(d, lab)
    probe = spark.createDataFrame([(100, "a clear and helpful article"), (101, "buy now, cheap spam")],
                                  "doc_id long, text string")
    got = {r["doc_id"]: (r["quality_label"], r["toxic_label"])
           for r in C.score_heads([heads["quality"], heads["toxic"]], probe).collect()}
    assert got[100] == ("high_quality", "non-toxic")
    assert got[101] == ("low_quality", "toxic")


def test_funnel_accounts_for_every_record(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    lab = spark.read.parquet(f"{SF}/labels.parquet")
    f = X.funnel(d, X.train_heads(d, lab))
    stats = X.funnel_stats(f).filter(F.col("source").isNull() & F.col("outcome").isNull())
    assert stats.first()["n"] == d.count()
    kept = X.kept(f)
    assert kept.filter(F.col("text").rlike("[a-z0-9._%+-]+@[a-z0-9-]+\\.[a-z]+")).count() == 0


def test_no_feature_is_dropped_and_models_come_back_from_disk(spark, tmp_dir):
    # 70,000 different words, each in one document of its class only
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(700)), "a" if i % 2 else "b") for i in range(100)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    m = C.train_language(d)
    assert m.table.count() > 65_536
    probe = spark.createDataFrame([(i, f"w{i}x{j}") for i in range(100) for j in (0, 699)], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_label"] for r in C.score_nb(m, probe).collect()}
    assert sum(got[i] == ("a" if i % 2 else "b") for i in range(100)) >= 97     # buckets may collide
    C.save_models([m], tmp_dir + "/model")
    again = C.load_models(spark, tmp_dir + "/model")["lang"]
    key = lambda model: sorted((r["doc_id"], r["lang_label"], round(r["lang_score"], 9)) for r in C.score_nb(model, d).collect())
    assert key(again) == key(m)


def test_funnel_moves_no_rows(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    heads = X.train_heads(d, spark.read.parquet(f"{SF}/labels.parquet"))
    for df in (X.funnel(d, heads), X.coarse_filter(d, heads)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan


def test_null_and_empty_texts_score_by_the_priors(spark):
    d = spark.createDataFrame([(1, "a b", "x"), (2, "c d", "y"), (3, "c d", "y")], "doc_id long, text string, lang string")
    probe = spark.createDataFrame([(1, None), (2, ""), (3, "zz")], "doc_id long, text string")
    got = {(r["lang_label"], round(r["lang_score"], 6)) for r in C.score_nb(C.train_language(d), probe).collect()}
    assert len(got) == 1 and next(iter(got))[0] == "y"


def test_a_fit_counts_every_labelled_row(spark):
    # more rows than a fit used before; the log-probabilities show each row's count
    n = 600_000
    d = spark.range(0, n, 1, 8).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("lang"),
                                       F.concat(F.lit("w"), F.col("id") % 3).alias("text"))
    m = C.train_language(d)
    assert [round(math.exp(p) * n) for p in m.log_priors] == [n // 3, 2 * n // 3]
    got = {tuple(round(math.exp(r[c]) * (size + 3)) - 1 for c, size in zip(m.cols, (n // 3, 2 * n // 3))) for r in m.table.collect()}
    assert got == {(n // 3, 0), (0, n // 3)} and m.table.count() == 3
