"""Vocabulary, encode, pack, windows and prefix sums."""

from pyspark.sql import functions as F

from grist.operators import ordering, sampling, tokens


def test_prefix_sum_matches_cumsum(spark):
    rows = [(i, (i * 7) % 5) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, w long")
    got = {r["k"]: r["offset"] for r in ordering.prefix_sum(df, ["k"], "w").collect()}
    acc, exp = 0, {}
    for k, w in rows:
        exp[k] = acc
        acc += w
    assert got == exp


def test_pack_equals_flatten(spark):
    df = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i % 13 + 1))) for i in range(60)],
                               "doc_id long, text string")
    vocab = tokens.build_vocab(df)
    enc = tokens.encode(df, vocab)
    flat = [x for r in sorted(enc.collect()) for x in r["ids"]]
    packed = sorted(tokens.pack(enc, ctx=16).collect())
    assert [x for r in packed for x in r["ids"]] == flat
    assert all(len(r["ids"]) == 16 for r in packed[:-1])
    text = {r["seq"]: r["text"] for r in tokens.decode(tokens.pack(enc, ctx=16), vocab).collect()}
    assert text[0].startswith("w0<eos>w0 w1<eos>")


def test_vocab_specials_and_uint16(spark):
    df = spark.createDataFrame([(1, "b a b c b a")], "doc_id long, text string")
    vocab = {r["token"]: r["id"] for r in tokens.build_vocab(df).collect()}
    assert {t: i for t, i in vocab.items() if not t.startswith("<0x")} == {"<eos>": 0, " ": 257, "b": 258, "a": 259, "c": 260}
    assert vocab["<0x00>"] == 1 and vocab["<0xFF>"] == 256
    enc = tokens.check_uint16(tokens.encode(df, tokens.build_vocab(df, size=260)))
    assert enc.first()["ids"] == [258, 257, 259, 257, 258, 257, 1 + ord("c"), 257, 258, 257, 259, 0]


def test_texts_come_back_whole(spark):
    texts = [None, "", " ", "a\n\n b\t", "é漢🙂\x85x", "<eos> <0x41> <unk>", "rare " * 3 + "x" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for size in (258, 262, 65536):
        vocab = tokens.build_vocab(df, size=size)
        got = {r["doc_id"]: r["text"] for r in tokens.decode(tokens.encode(df, vocab, add_eos=False), vocab).collect()}
        assert got == {i: t or "" for i, t in enumerate(texts)}


def test_windows_shift_by_one(spark):
    df = spark.createDataFrame([(i, " ".join(f"t{i}_{j}" for j in range(40))) for i in range(30)],
                               "doc_id long, text string")
    packed = tokens.pack(tokens.encode(df, tokens.build_vocab(df)), ctx=32)
    n = packed.agg(F.sum(F.size("ids"))).first()[0]
    draws = tokens.draw_starts(spark, n, 6, 20)
    flat = [x for r in sorted(packed.collect()) for x in r["ids"]]
    for r in tokens.sample_windows(packed, draws, 20, seq_len=32).collect():
        s = r["start"]
        assert r["x"] == flat[s:s + 20]
        assert r["y"] == flat[s + 1:s + 21]


def test_sample_k_is_exact_and_partition_independent(spark):
    df = spark.range(100).withColumnRenamed("id", "doc_id")
    a = [r["doc_id"] for r in sampling.sample_k(df, 10, "doc_id").collect()]
    b = [r["doc_id"] for r in sampling.sample_k(df.repartition(7), 10, "doc_id").collect()]
    assert a == b and len(set(a)) == 10


def test_first_k_distributed_path_matches_limit(spark, monkeypatch):
    df = spark.range(300).withColumn("key", F.md5(F.col("id").cast("string")))
    direct = [r["id"] for r in ordering.first_k(df, ["key", "id"], 120).collect()]
    monkeypatch.setattr(ordering, "TOP_K_DIRECT", 10)
    ranked = [r["id"] for r in ordering.first_k(df, ["key", "id"], 120).collect()]
    assert sorted(direct) == sorted(ranked) and len(ranked) == 120
