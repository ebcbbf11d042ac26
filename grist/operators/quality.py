"""Heuristic quality rules (G1-G6) and the record predicates built on them.

The rule statistics are integer counts computed with native regular
expressions (no arrays of words are materialised per row), and every
threshold test is an exact integer comparison, so Spark and the SQL oracle
agree bit for bit:

* mean word length ``c/n`` outside ``[3, 10]``  <=>  ``c < 3n or c > 10n``
* ellipsis lines ``e/l > 0.3``                   <=>  ``10e > 3l``
* alphabetic words ``a/n < 0.8``                 <=>  ``5a < 4n``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grist.functions import text as T
from grist.functions import treebank

# Words containing at least one letter: a word run is one token, and any other
# token is a single non-letter character, so counting letter-bearing runs
# counts alphabetic words.
ALPHA_WORD_PATTERN = "[" + T.WORD_CHARS + "]*" + T.LETTER_PATTERN + "[" + T.WORD_CHARS + "]*"
ELLIPSIS_LINE_PATTERN = r"\.\.\.(?=\n|\z)"

RULE_REASONS = ("word_count", "mean_word_length", "ellipsis_lines", "alphabetic_words")


def rule_stats(text: Column, spaced: Column | None = None) -> dict[str, Column]:
    """Integer statistics behind the rules, as named columns; of Treebank words
    where ``spaced`` gives the text with blanks between them."""
    stats = _rule_stats(text)
    return stats if spaced is None else stats | treebank.word_stats(spaced)


def _rule_stats(text: Column) -> dict[str, Column]:
    return {
        "n_words": F.regexp_count(text, F.lit(T.WORD_TOKEN_PATTERN)).cast("bigint"),
        # every non-blank character belongs to exactly one token
        "n_word_chars": F.length(F.regexp_replace(text, T.WS, "")).cast("bigint"),
        "n_alpha_words": F.regexp_count(text, F.lit(ALPHA_WORD_PATTERN)).cast("bigint"),
        "n_lines": (F.regexp_count(text, F.lit("\n")) + 1).cast("bigint"),
        "n_ellipsis_lines": F.regexp_count(text, F.lit(ELLIPSIS_LINE_PATTERN)).cast("bigint"),
    }


def rule_failure(n_words: Column, n_word_chars: Column, n_alpha: Column, n_lines: Column,
                 n_ellipsis: Column) -> Column:
    """First failing rule in the reference order, or null when all pass."""
    return (
        F.when((n_words < T.MIN_WORDS) | (n_words > T.MAX_WORDS), F.lit("word_count"))
        .when((n_word_chars < n_words * T.MIN_MEAN_LEN)
              | (n_word_chars > n_words * T.MAX_MEAN_LEN), F.lit("mean_word_length"))
        .when(n_ellipsis * 10 > n_lines * 3, F.lit("ellipsis_lines"))
        .when(n_alpha * 5 < n_words * 4, F.lit("alphabetic_words"))
    )


def with_rule_stats(df: DataFrame, text_col: str = "text", prefix: str = "", tokens: str = "plain") -> DataFrame:
    """``df`` with the statistics; ``tokens`` is ``plain`` (``T.words``) or ``treebank``."""
    if tokens not in ("plain", "treebank"):
        raise ValueError(f"no such tokens: {tokens}")
    if tokens == "plain":
        return df.withColumns({prefix + k: v for k, v in rule_stats(F.col(text_col)).items()})
    # explode of one element: the optimizer doesn't merge projections across it, so the cascade runs once a row
    spaced = "_spaced"
    while spaced in {c.lower() for c in df.columns}:
        spaced = "_" + spaced
    df = df.withColumn(spaced, F.explode(F.array(treebank.spaced(F.col(text_col)))))
    stats = rule_stats(F.col(text_col), F.col(spaced))
    return df.withColumns({prefix + k: v for k, v in stats.items()}).drop(spaced)


def rule_failure_of(text: Column) -> Column:
    s = rule_stats(text)
    return rule_failure(s["n_words"], s["n_word_chars"], s["n_alpha_words"], s["n_lines"],
                        s["n_ellipsis_lines"])


def passes_rules(text: Column) -> Column:
    """G6 as a boolean column (True = keep)."""
    return rule_failure_of(text).isNull()


def gopher_filter(df: DataFrame, text_col: str = "text", tokens: str = "plain") -> DataFrame:
    """Adds the statistics, ``rule_failed`` and ``passes``; keeps every row."""
    out = with_rule_stats(df, text_col, tokens=tokens)
    out = out.withColumn("rule_failed", rule_failure(
        F.col("n_words"), F.col("n_word_chars"), F.col("n_alpha_words"), F.col("n_lines"),
        F.col("n_ellipsis_lines")))
    return out.withColumn("passes", F.col("rule_failed").isNull())


def keep_passing(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.filter(passes_rules(F.col(text_col)))
