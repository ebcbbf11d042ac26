"""Exact deduplication of lines and documents.

Drop-all semantics: a line (or document) seen more than once anywhere in the
corpus is removed everywhere. Both operators are *aggregate-first*: one
``groupBy`` on the exact value with map-side partial aggregation collapses a
hot value (a boilerplate line present in a third of all documents) to one row
per map task before the shuffle, and the surviving occurrence is carried out
of the aggregate itself (the minima of a group of one *are* that
occurrence). No join ever probes the hot key, so there is nothing to
salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grist.functions import text as T


def explode_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line: ``(id, pos, line, has_nl)``, 1-based ``pos``.

    Lines follow file iteration: every ``\\n``-terminated piece is a line and a
    final unterminated piece is a line if it is not empty.
    """
    parts = df.select(F.col(id_col), F.split(F.col(text_col), "\n", -1).alias("_p"))
    out = parts.select(
        id_col, F.size("_p").alias("_k"), F.posexplode("_p").alias("_i", "line"))
    out = out.filter(~((F.col("_i") == F.col("_k") - 1) & (F.col("line") == "")))
    return out.select(
        id_col,
        (F.col("_i") + 1).alias("pos"),
        "line",
        (F.col("_i") < F.col("_k") - 1).alias("has_nl"),
    )


def line_counts(lines: DataFrame) -> DataFrame:
    """A1: occurrences per distinct line over all documents (repeats in one
    document count)."""
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))


def unique_lines(lines: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Occurrences of lines that appear exactly once in the corpus."""
    agg = lines.groupBy("line").agg(
        F.count(F.lit(1)).alias("n"),
        # the minima of a group of one are its row; primitive ones keep this a hash aggregate
        F.min(id_col).alias(id_col), F.min("pos").alias("pos"), F.min("has_nl").alias("has_nl"),
    )
    return agg.filter(F.col("n") == 1).select(id_col, "pos", "line", "has_nl")


def exact_line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A2: rewrite every document keeping only corpus-unique lines, in order.

    Emptied documents stay, with ``text = ''`` (the reference still writes the
    file). Extra columns of ``df`` are carried by a join on the unique id.
    """
    kept = unique_lines(explode_lines(df, id_col, text_col), id_col)
    piece = F.when(F.col("has_nl"), F.concat("line", F.lit("\n"))).otherwise(F.col("line"))
    rebuilt = kept.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("pos", piece.alias("piece")))).alias("_ps"))
    rebuilt = rebuilt.select(
        id_col, F.array_join(F.transform("_ps", lambda p: p["piece"]), "").alias("_dedup"))
    others = [c for c in df.columns if c != text_col]
    out = df.select(*others).join(rebuilt, id_col, "left")
    return out.select(*others, F.coalesce("_dedup", F.lit("")).alias(text_col))


def exact_doc_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    keep: str = "none") -> DataFrame:
    """A3: documents keyed by their text minus trailing newlines.

    ``keep='none'`` drops every copy of a repeated text (reference); ``keep='first'``
    keeps the smallest id of each group. Output text is newline-stripped.
    """
    keyed = df.select(F.col(id_col), T.strip_trailing_newlines(F.col(text_col)).alias("_key"))
    agg = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.min(id_col).alias(id_col))
    if keep == "none":
        agg = agg.filter(F.col("_n") == 1)
    elif keep != "first":
        raise ValueError("keep must be 'none' or 'first'")
    return agg.select(id_col, F.col("_key").alias(text_col))


def exact_doc_dedup_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         keep: str = "none") -> DataFrame:
    """Same survivors as :func:`exact_doc_dedup`, with all other columns kept
    (a join on the unique id, so no key is skewed)."""
    ids = exact_doc_dedup(df, id_col, text_col, keep).select(id_col, F.col(text_col).alias("_t"))
    others = [c for c in df.columns if c != text_col]
    return df.select(*others).join(ids, id_col, "inner").select(
        *others, F.col("_t").alias(text_col))
