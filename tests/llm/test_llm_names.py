"""Extra columns whose names clash with those that the operators use."""

from grist.llm import simhash, substring


def test_clashing_names(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, 7, "x"), (2, text, 8, "y"), (3, "another text", 9, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _mark_h int, N_Words string")
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]
    cut = substring.remove_repeats(df)
    assert sum(c.lower() == "n_words" for c in cut.columns) == 1
    assert {r.doc_id: (r.n_words, r.n_removed) for r in cut.select("doc_id", "n_words", "n_removed").collect()} == {1: (60, 0), 2: (60, 60), 3: (2, 0)}
