"""Treebank tokens against hand-written sentences, and the rules on them."""

import pytest
from pyspark.sql import functions as F

from grist.functions import treebank as B
from grist.operators import quality as Q

SENTENCES = [
    ("They'll save and invest more.", "They 'll save and invest more ."),
    ("hi, my name can't hello,", "hi , my name ca n't hello ,"),
    ("Good muffins cost $3.88 in New York.  Please buy me two of them.",
     "Good muffins cost $ 3.88 in New York . Please buy me two of them ."),
    ("\"We beat some pretty good teams to get here,\" Slocum said.",
     "`` We beat some pretty good teams to get here , '' Slocum said ."),
    ("Well, we couldn't have this predictable, cliche-ridden, \"Touched by an Angel\" wannabe if she didn't.",
     "Well , we could n't have this predictable , cliche-ridden , `` Touched by an Angel '' wannabe if she did n't ."),
    ("I cannot cannot work under these conditions!", "I can not can not work under these conditions !"),
    ("The company spent about 10,000,000.00 (or more) at 9:30 -- twice...", "The company spent about 10,000,000.00 ( or more ) at 9:30 -- twice ..."),
    ("Mr. Smith's dogs' bones are J. R. Brown's; e.g. all of them.",
     "Mr. Smith 's dogs ' bones are J. R. Brown 's ; e.g. all of them ."),
    ("It ended. (Then it began again.) 'Twas gonna be fine, gimme more'n that.",
     "It ended . ( Then it began again . ) 'T was gon na be fine , gim me more 'n that ."),
    ("Made in the U.S. by A&B [Ltd.] at 50% off?!", "Made in the U.S. by A & B [ Ltd. ] at 50 % off ? !"),
    ("“Curly quotes,” she said; don’t stop…", "“ Curly quotes , ” she said ; don ’ t stop…"),
    ("", ""),
    (" \t\n", ""),
    ("...", "..."),
    ("a\x01b\x02c", "a b c"),
]


@pytest.mark.parametrize("text,expected", SENTENCES)
def test_sentences(spark, text, expected):
    row = spark.createDataFrame([(text,)], "t string").select(B.tokens(F.col("t")).alias("w")).first()
    assert row["w"] == expected.split()


def test_counts_are_those_of_the_tokens(spark):
    df = spark.createDataFrame([(t,) for t, _ in SENTENCES] + [(None,)], "t string")
    stats = B.word_stats(B.spaced(F.col("t")))
    for r in df.select(B.tokens(F.col("t")).alias("w"), *[c.alias(n) for n, c in stats.items()]).collect():
        if r["w"] is None:
            assert r["n_words"] is None and r["n_word_chars"] is None and r["n_alpha_words"] is None
        else:
            assert r["n_words"] == len(r["w"])
            assert r["n_word_chars"] == sum(map(len, r["w"]))
            assert r["n_alpha_words"] == sum(any(c.isalpha() for c in w) for w in r["w"])


def test_rules_by_treebank_words(spark):
    # 26 contractions are 52 words, 24 are 48; the plain rules see 78 and 72
    texts = ["don't " * 26, "don't " * 24, None, "house " * 50, "house " * 49]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r["id"]: r["rule_failed"] for r in Q.gopher_filter(df, tokens="treebank").collect()}
    assert got == {0: "mean_word_length", 1: "word_count", 2: None, 3: None, 4: "word_count"}


def test_long_texts_stay_linear(spark):
    df = spark.range(4).select(F.expr("repeat(element_at(array('.', '\\' ', '12345', 'don\\'t. A '), cast(id as int) + 1), 300000)").alias("t"))
    got = [r["n"] for r in df.select(B.word_stats(B.spaced(F.col("t")))["n_words"].alias("n")).collect()]
    assert got[0] == 1 and got[2] == 1 and got[3] == 4 * 300000 and got[1] >= 299999
