"""Audits (X2-X5): per-record verdicts over extracted page text.

The reference prints verdicts for the first few records of one archive; here
each audit is a DataFrame over every page (the extracted text of ``pages``
stands in for archive responses), and ``first_records`` / ``limit`` can be
applied by the caller when only a look is wanted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grist.functions import text as T
from grist.operators import classify as C
from grist.operators import quality


def page_text(pages: DataFrame) -> DataFrame:
    """``(page_id, text)`` extracted from ``pages.html``."""
    return pages.select("page_id", T.html_to_text(F.col("html")).alias("text"))


def pii_audit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Records with at least one mask, with the masked text and counts."""
    masked, ne, np_, ni = T.mask_pii_with_counts(F.col(text_col))
    out = df.select(id_col, masked.alias("masked"), ne.alias("n_emails"), np_.alias("n_phones"),
                    ni.alias("n_ips"))
    return out.filter((F.col("n_emails") + F.col("n_phones") + F.col("n_ips")) > 0)


def language_audit(texts: DataFrame, lang: C.NBModel, id_col: str = "page_id") -> DataFrame:
    """Language label and score of every record."""
    return C.score_nb(lang, texts, id_col, "text")


def harmful_audit(texts: DataFrame, nsfw: C.NBModel, toxic: C.NBModel,
                  id_col: str = "page_id") -> DataFrame:
    """Both harm heads, newlines deleted first (as the reference's audit)."""
    flat = texts.select(id_col, T.flatten_newlines(F.col("text"), "").alias("text"))
    return C.score_heads([nsfw, toxic], flat, id_col, "text")


def gopher_audit(texts: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Rule verdict of every record."""
    failed = quality.rule_failure_of(F.col("text"))
    return texts.select(id_col, failed.alias("rule_failed"), failed.isNull().alias("passes"))
