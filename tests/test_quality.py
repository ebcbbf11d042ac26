"""Rule filter boundaries."""

from pyspark.sql import functions as F

from grist.operators import quality as Q


def verdict(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(Q.passes_rules(F.col("t"))).first()[0]


def test_valid_text(spark):
    assert verdict(spark, "Every morning the quiet harbour fills with fishing boats. " * 30)


def test_word_count_bounds(spark):
    assert not verdict(spark, "Far too short to be useful text.")
    assert verdict(spark, "A sentence long enough when repeated many times. " * 20)
    assert not verdict(spark, "word " * 100001)
    assert verdict(spark, "Plain words make a fine sample here. " * 2000)


def test_exact_boundaries(spark):
    # 50 words pass, 49 fail
    assert verdict(spark, " ".join(["house"] * 50))
    assert not verdict(spark, " ".join(["house"] * 49))


def test_mean_word_length(spark):
    assert not verdict(spark, "an be " * 60)
    assert verdict(spark, "the and " * 60)
    assert not verdict(spark, "we " + "incomprehensibilities uncharacteristically " * 60)
    assert verdict(spark, "this is all quite fine " * 60)


def test_ellipsis_lines(spark):
    bad = "\n".join(["An unfinished thought trails away..."] * 40 + ["A full line ends here."] * 20)
    assert not verdict(spark, bad)
    ok = "\n".join(["An unfinished thought trails away..."] * 30 + ["A full line ends here."] * 70)
    assert verdict(spark, ok)


def test_alphabetic_ratio(spark):
    words = ["777"] * 11 + ["cat"] * 39  # 0.78 < 0.8
    assert not verdict(spark, " ".join(words))
    words = ["777"] * 10 + ["cat"] * 40
    assert verdict(spark, " ".join(words))  # exactly 0.8 passes


def test_empty_text_fails_first_rule(spark):
    df = spark.createDataFrame([("",)], "text string")
    assert Q.gopher_filter(df).first()["rule_failed"] == "word_count"
