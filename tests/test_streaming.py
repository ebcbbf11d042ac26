"""Streaming curation equals batch curation (V1, V2) and incremental dedup (V3)."""

import os

from pyspark.sql import functions as F

from grist.operators import minhash
from grist.plans import curate as X
from grist.streaming import incremental as S

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark, tmp_dir):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    lab = spark.read.parquet(f"{SF}/labels.parquet")
    heads = X.train_heads(d, lab)
    src = os.path.join(tmp_dir, "src")
    d.repartition(3, "doc_id").write.parquet(src)
    q = S.start_curation(S.stream_documents(spark, src, d.schema), heads,
                         os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "stats"),
                         os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination()
    streamed = sorted(spark.read.parquet(os.path.join(tmp_dir, "out")).select("doc_id", "text").collect())
    batch = sorted(X.kept(X.funnel(d, heads)).collect())
    assert streamed == batch
    total = S.running_stats(spark, os.path.join(tmp_dir, "stats")).agg(F.sum("n")).first()[0]
    assert total == d.count()


def test_incremental_fuzzy_dedup(spark, tmp_dir):
    text = "the river runs past the old mill and the bridge " * 4
    src = os.path.join(tmp_dir, "s")
    spark.createDataFrame([(1, text), (2, "entirely unrelated words about stars " * 4)],
                          "doc_id long, text string").write.parquet(os.path.join(src, "a"))
    q = S.start_fuzzy_dedup(
        spark.readStream.schema("doc_id long, text string").option("maxFilesPerTrigger", 1)
        .parquet(os.path.join(src, "a")), minhash.MinHashParams(num_hashes=20, num_bands=5),
        os.path.join(tmp_dir, "o"), os.path.join(tmp_dir, "b"), os.path.join(tmp_dir, "c"))
    q.awaitTermination()
    first = sorted(r["doc_id"] for r in spark.read.parquet(os.path.join(tmp_dir, "o")).collect())
    assert first == [1, 2]


def test_duplicates_of_earlier_batches_are_found(spark, tmp_dir):
    text = "the river runs past the old mill and the bridge " * 4
    other = "entirely unrelated words about stars and the sea " * 4
    src = os.path.join(tmp_dir, "s")
    params = minhash.MinHashParams(num_hashes=20, num_bands=5)

    def arrive(name, rows):
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(os.path.join(src, name))
        q = S.start_fuzzy_dedup(
            spark.readStream.schema("doc_id long, text string").option("recursiveFileLookup", "true").parquet(src), params,
            os.path.join(tmp_dir, "o"), os.path.join(tmp_dir, "b"), os.path.join(tmp_dir, "c"))
        q.awaitTermination()
        return sorted(r["doc_id"] for r in spark.read.parquet(os.path.join(tmp_dir, "o")).collect())

    assert arrive("a", [(5, text), (6, other), (7, text)]) == [5, 6]
    # 1 repeats an earlier survivor, 2 and 3 are copies of each other
    assert arrive("b", [(1, text), (2, "a third text with its own words " * 5), (3, "a third text with its own words " * 5)]) == [2, 5, 6]
