"""What the findings on memory and time asked for: bounded batches, and work done once."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from grist.functions import text as T
from grist.functions import treebank
from grist.operators import minhash, sampling, tokens
from grist.session import BYTES_PER_BATCH, ROWS_PER_BATCH, tune


def counted(df, counter):
    """``df`` with a column that counts the rows that were computed."""
    @F.udf("int")
    def one():
        counter.add(1)
        return 1

    return df.withColumn("_seen", one.asNondeterministic()()).filter("_seen = 1").drop("_seen")


def test_arrow_batches_stay_small(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    tune(spark)
    rows = spark.range(0, 3 * ROWS_PER_BATCH, 1, 1).selectExpr("repeat('x', 10) as t")
    sizes = rows.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in batches), "n long").collect()
    assert max(r.n for r in sizes) <= ROWS_PER_BATCH and sum(r.n for r in sizes) == 3 * ROWS_PER_BATCH
    long = spark.range(0, 40, 1, 1).selectExpr("repeat('x', 1000000) as t")
    sizes = long.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in batches), "n long").collect()
    assert max(r.n for r in sizes) <= 2 * BYTES_PER_BATCH


def test_inspected_rows_are_made_once(spark):
    counter = spark.sparkContext.accumulator(0)
    rows = counted(spark.range(0, 500, 1, 3).selectExpr("id as doc_id", "concat('g', id % 3) as outcome"), counter)
    assert sampling.inspect_samples(rows, "outcome", 5).count() == 15
    assert counter.value == 500


def test_usable_rows_of_a_training_set_are_made_once(spark):
    counter = spark.sparkContext.accumulator(0)
    rows = spark.range(0, 600, 1, 3).selectExpr("id as doc_id", "concat('t', id) as text")
    got = sampling.balanced_training_set(rows.filter("doc_id < 100"), rows.filter("doc_id >= 100"), lambda df: counted(df, counter))
    assert got.count() == 200
    assert counter.value == 200


def test_wide_signatures_equal_the_definition(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("a b c d e f é g".split()) for _ in range(rng.randint(0, 60))) for _ in range(50)] + [None, "", "one two"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(0, texts[0])], "doc_id long, text string")
    params = minhash.MinHashParams(100, 10, 5)
    sets = minhash.shingle_sets(df, "doc_id", "text", 5)
    hashed = sets.filter("size(shingles) > 0").select("doc_id", F.transform("shingles", minhash.base_hash).alias("h")).collect()
    coeffs = minhash.hash_coefficients(100)
    want = sorted((r.doc_id, [min((a * h + b) % minhash.PRIME for h in r.h) for a, b in coeffs]) for r in hashed)
    wide = minhash.signatures(df, params)
    assert sorted((r.doc_id, r.sig) for r in wide.collect()) == want
    assert wide._jdf.queryExecution().optimizedPlan().toString().count("translate(") == sets._jdf.queryExecution().optimizedPlan().toString().count("translate(")


def test_treebank_steps_run_in_arrow_and_keep_nulls(spark):
    df = spark.createDataFrame([("He can't pay $3.50. \"Why?\" John's",), (None,), ("",)], "t string")
    out = df.select(treebank.tokens(F.col("t")).alias("w"))
    assert [r.w for r in out.collect()] == ["He ca n't pay $ 3.50 . `` Why ? '' John 's".split(), None, []]
    assert "ArrowEvalPython" in out._jdf.queryExecution().executedPlan().toString()


def test_only_sets_on_edges_are_written(spark):
    sets = spark.createDataFrame([(i, ["a", f"b{i}"]) for i in range(6)], "doc_id long, shingles array<string>")
    edges = spark.createDataFrame([(0, 1), (0, 3)], "src long, dst long")
    few = minhash.sets_on_edges(edges, sets)
    assert sorted(r.doc_id for r in few.collect()) == [0, 1, 3]
    assert [(r.src, r.dst, r.jaccard) for r in minhash.verify_edges(edges, few).orderBy("dst").collect()] == [(0, 1, 1 / 3), (0, 3, 1 / 3)]


def test_runs_of_a_worker_equal_the_column(spark):
    texts = ["a  b\tc d e\x1cf​g\x85h\n", "", None, " x ", "　\U0001f642"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert tokens.runs_of(pa.array(texts, pa.string())).to_pylist() == [r[0] for r in df.select(tokens.tokens(F.col("t"))).collect()]
    counts = {r.token: r.n for r in tokens.run_counts(df, "t").collect()}
    assert counts == {r.token: r.n for r in df.select(F.explode(tokens.tokens(F.col("t"))).alias("token")).groupBy("token").agg(F.count("*").alias("n")).collect()}
