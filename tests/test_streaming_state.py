"""Streaming plans with state: outcomes (V1), running counts (V2), keyed dedup (V3)."""

import glob
import os

import pytest

from grist.operators import minhash
from grist.plans import curate as X
from grist.streaming import incremental as S

SF = "/root/testdata/sf0.001"


def test_outcomes_and_running_counts_equal_the_batch(spark, tmp_dir):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    heads = X.train_heads(d, spark.read.parquet(f"{SF}/labels.parquet"))
    src, out, stats, a, b = (os.path.join(tmp_dir, x) for x in ("src", "out", "stats", "a", "b"))
    parts = d.randomSplit([0.5, 0.5], seed=3)
    total = {}
    for part in parts:                                  # the second round restarts both queries
        part.coalesce(1).write.mode("append").parquet(src)
        S.start_outcomes(S.stream_documents(spark, src, d.schema), heads, out, a).awaitTermination()
        S.start_stage_counts(spark, out, stats, b).awaitTermination()
        counts = {r.outcome: r.n for r in spark.read.parquet(stats).collect()}
        assert sum(counts.values()) > sum(total.values())
        total = counts
    whole = S.outcomes(d, heads).collect()
    assert sorted(map(tuple, spark.read.parquet(out).collect()), key=str) == sorted(map(tuple, whole), key=str)
    assert total == {o: sum(r.outcome == o for r in whole) for o in {r.outcome for r in whole}}
    assert not glob.glob(os.path.join(stats, "batch=*"))


def test_funnel_evaluates_each_head_and_mask_once(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    heads = X.train_heads(d, spark.read.parquet(f"{SF}/labels.parquet"))
    plan = X.kept(X.funnel(d, heads))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 3
    assert [plan.count(x) for x in ("EMAIL_ADDRESS", "PHONE_NUMBER", "IP_ADDRESS")] == [1, 1, 1]


@pytest.mark.parametrize("band", [5])
def test_keyed_dedup_over_batches_and_restarts(spark, tmp_dir, band):
    text = "the river runs past the old mill and the bridge " * 4
    other = "entirely unrelated words about stars and the sea " * 4
    third = "a third text with its own words " * 5
    src, out, mark = (os.path.join(tmp_dir, x) for x in ("s", "o", "c"))
    params = minhash.MinHashParams(num_hashes=20, num_bands=band)

    def arrive(rows):
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.mode("append").parquet(src)
        S.start_keyed_dedup(spark.readStream.schema("doc_id long, text string").parquet(src), params, out, mark).awaitTermination()
        return sorted(r.doc_id for r in spark.read.parquet(out).collect())

    assert arrive([(5, text), (6, other), (7, text), (8, ""), (9, None)]) == [5, 6, 8, 9]
    # 1 repeats an earlier document, 2 and 3 are copies of each other
    assert arrive([(1, text), (2, third), (3, third)]) == [2, 5, 6, 8, 9]
    # copies of one that went earlier go too
    assert arrive([(0, third), (4, text), (10, "quite new words here and there " * 4)]) == [2, 5, 6, 8, 9, 10]
