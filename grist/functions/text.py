"""Column expressions over text: masking, normalisation, words, lines, HTML.

Every function here returns a ``Column`` built from native Spark SQL
expressions, so it stays inside whole-stage code generation and can be used
from ``select``, ``withColumn`` or ``filter``. Two steps are Arrow UDFs, since
no built-in function has their tables: character references and charsets.

Patterns are written once and shared with the DuckDB oracles
(``grist.plans.oracle``): where Java and RE2 disagree on a class (``\\d``,
``\\s``, ``\\w``) we spell the class out explicitly so both engines read the
same characters.
"""

from __future__ import annotations

import codecs
import html as html_lib
import re
import string
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# --- fixed values (must equal the reference's for identical results) -------
# masking patterns, in the order e-mail, phone, IP, and their replacements
EMAIL_PATTERN = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9-]+(\.[a-zA-Z0-9-]+)*\.[a-zA-Z]+"
PHONE_PATTERN = r"(\(\d{3}\)|\d{3})[.\- ]?\d{3}[.\- ]?\d{4}"
IP_PATTERN = r"(25[0-9]|2[0-4]\d|[01]?\d\d?\.){3}(25[0-9]|2[0-4]\d|[01]?\d\d?)"
EMAIL_TOKEN = "|||EMAIL_ADDRESS|||"
PHONE_TOKEN = "|||PHONE_NUMBER|||"
IP_TOKEN = "|||IP_ADDRESS|||"
# (the e-mail pattern is run in the form of SAFE_EMAIL_PATTERN below)
# rule thresholds: words in [50, 100000], mean word length in [3, 10],
# ellipsis lines <= 0.3, alphabetic words >= 0.8
MIN_WORDS, MAX_WORDS = 50, 100000
MIN_MEAN_LEN, MAX_MEAN_LEN = 3, 10
MAX_ELLIPSIS_RATIO = 0.3
MIN_ALPHA_RATIO = 0.8
ELLIPSIS = "..."
# ASCII punctuation folded to spaces before dedup (Python's string.punctuation)
PUNCTUATION = string.punctuation
# ---------------------------------------------------------------------------

# Characters Python's str.split() treats as blanks. Java's (?U)\s misses
# U+001C..U+001F and RE2's \s is ASCII only, so the class is explicit.
WS_CLASS_BODY = (r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                 r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WS = "[" + WS_CLASS_BODY + "]"
# ASCII blanks for HTML (Java's default \s; RE2's \s lacks \x0B)
HTML_WS = r"[ \t\n\x{0B}\f\r]"
# Unicode word characters; equals Java (?U)\w on letters, marks, digits, Pc
WORD_CHARS = r"\p{L}\p{M}\p{Nd}\p{Pc}"
# an ellipsis is one token, as in the treebank tokenizer the reference uses
WORD_TOKEN_PATTERN = "[" + WORD_CHARS + r"]+|\.\.\.|[^" + WORD_CHARS + WS_CLASS_BODY + "]"
WORD_RUN_PATTERN = "[" + WORD_CHARS + "]+"
LETTER_PATTERN = r"\p{L}"


def _java(pattern: str) -> str:
    """Java reads \\d as ASCII unless UNICODE_CHARACTER_CLASS is on; Python does not."""
    return "(?U)" + pattern


# --- PII masking (P4-P7) ----------------------------------------------------

# The same matches as EMAIL_PATTERN, without its two traps for Java's engine:
# a repeated group of variable length recurses (a long dotted run overflows the
# stack), and a run without '@' is scanned again from each of its characters.
# So the local part starts where a run starts or where the last match ended, and
# never gives back; the domain is a run of single characters without two dots
# in a row, cut back to its last dot that letters follow.
SAFE_EMAIL_PATTERN = (r"(?:(?<![a-zA-Z0-9._%+-])|\G)[a-zA-Z0-9._%+-]++@[a-zA-Z0-9-]"
                      r"(?:(?!\.\.)[a-zA-Z0-9.-])*\.[a-zA-Z]+")


def mask_emails(text: Column) -> Column:
    return F.regexp_replace(text, SAFE_EMAIL_PATTERN, EMAIL_TOKEN)


def count_emails(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SAFE_EMAIL_PATTERN)).cast("bigint")


def mask_phones(text: Column) -> Column:
    return F.regexp_replace(text, _java(PHONE_PATTERN), PHONE_TOKEN)


def count_phones(text: Column) -> Column:
    return F.regexp_count(text, F.lit(_java(PHONE_PATTERN))).cast("bigint")


STRICT_IP_PATTERN = (r"\b(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}"
                     r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\b")


def mask_ips(text: Column, mode: str = "compat") -> Column:
    """``compat`` keeps the reference pattern (and its octet quirk); ``strict``
    masks only well-formed dotted quads on word boundaries."""
    pattern = _java(IP_PATTERN) if mode == "compat" else STRICT_IP_PATTERN
    return F.regexp_replace(text, pattern, IP_TOKEN)


def count_ips(text: Column, mode: str = "compat") -> Column:
    pattern = _java(IP_PATTERN) if mode == "compat" else STRICT_IP_PATTERN
    return F.regexp_count(text, F.lit(pattern)).cast("bigint")


def mask_pii(text: Column) -> Column:
    """E-mail, then phone, then IP; each runs on the previous output."""
    return mask_ips(mask_phones(mask_emails(text)))


def mask_pii_with_counts(text: Column) -> tuple[Column, Column, Column, Column]:
    """(masked, emails, phones, ips) with counts taken in masking order."""
    e = mask_emails(text)
    p = mask_phones(e)
    return mask_ips(p), count_emails(text), count_phones(e), count_ips(p)


# --- newline handling (P9) -------------------------------------------------

def flatten_newlines(text: Column, sep: str = " ") -> Column:
    """Language ID deletes newlines (sep=''); the other heads use a space."""
    return F.replace(text, F.lit("\n"), F.lit(sep))


# --- words and lines (G1, S4) ----------------------------------------------

def words(text: Column) -> Column:
    """Rule tokenizer: runs of word characters, or one other non-blank char."""
    return F.regexp_extract_all(text, F.lit(WORD_TOKEN_PATTERN), 0)


def word_runs(text: Column) -> Column:
    """Runs of word characters only (classifier features): the non-empty
    pieces between runs of other characters, i.e. the matches of
    ``WORD_RUN_PATTERN``, found by splitting (cheaper than extracting)."""
    return F.array_remove(F.split(text, "[^" + WORD_CHARS + "]+", -1), "")


def lines(text: Column) -> Column:
    """``text.split('\\n')``: never empty, keeps a trailing empty piece."""
    return F.split(text, "\n", -1)


def strip_trailing_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\n+\z", "")


# --- dedup normalisation (P8) and shingles (P11) -----------------------------

_FOLD_RANGES = ((0x00C0, 0xD800), (0xF900, 0x30000))        # all letters; no surrogates, no private use


@lru_cache(maxsize=1)
def accent_fold_table() -> tuple[str, str]:
    """(source, target) for ``translate``: NFD then drop Mn, per code point.

    Built from the Unicode database rather than listed: every precomposed code
    point whose canonical decomposition minus non-spacing marks is one character
    maps to it; those that reduce to nothing are deleted (they go last, past the
    target length). What decomposes into several base characters (Hangul
    syllables) stays composed.
    """
    mapped_src, mapped_dst, deleted = [], [], []
    for lo, hi in _FOLD_RANGES:
        for cp in range(lo, hi):
            ch = chr(cp)
            decomposed = unicodedata.normalize("NFD", ch)
            if decomposed == ch:
                continue
            base = "".join(c for c in decomposed if unicodedata.category(c) != "Mn")
            if len(base) == 1:
                mapped_src.append(ch)
                mapped_dst.append(base)
            elif not base:
                deleted.append(ch)
    return "".join(mapped_src) + "".join(deleted), "".join(mapped_dst)


def normalize_for_dedup(text: Column) -> Column:
    """NFD, drop non-spacing marks, lower-case, ASCII punctuation to blanks,
    collapse blanks and trim."""
    src, dst = accent_fold_table()
    s = F.translate(text, src, dst)
    s = F.regexp_replace(s, r"\p{Mn}", "")
    s = F.lower(s)
    s = F.translate(s, PUNCTUATION, " " * len(PUNCTUATION))
    s = F.regexp_replace(s, WS + "+", " ")
    return F.trim(s)


def shingle_list(w: Column, n: int) -> Column:
    """All n-word windows (with repeats), in order; empty when fewer words.

    Built by zipping ``n`` shifted slices, so no lambda closes over ``w``:
    Catalyst may inline ``w`` (e.g. into an inferred filter), and a lambda
    that referenced it would re-evaluate the whole split per element.
    """
    m = F.greatest(F.size(w) - n + 1, F.lit(0))
    acc = F.slice(w, 1, m)
    for k in range(2, n + 1):
        acc = F.zip_with(acc, F.slice(w, k, m), lambda x, y: F.concat(x, F.lit(" "), y))
    return acc


def shingles(w: Column, n: int) -> Column:
    """The shingle set, as a sorted distinct array (engine-independent order)."""
    return F.array_sort(F.array_distinct(shingle_list(w, n)))


def dedup_words(text: Column) -> Column:
    """Words of the normalised text, ``split(' ')`` as in the reference."""
    return F.split(normalize_for_dedup(text), " ", -1)


def with_shingles(df, text_col: str, n: int, out: str = "shingles", distinct: bool = True):
    """Adds ``out``: the shingle set (or list) of ``text_col``'s normalised words."""
    tmp = "_w_" + out
    df = df.withColumn(tmp, dedup_words(F.col(text_col)))
    fn = shingles if distinct else shingle_list
    return df.withColumn(out, fn(F.col(tmp), n)).drop(tmp)


# --- HTML to text (P3) -----------------------------------------------------

BLOCK_TAGS = "p|div|h[1-6]|ul|ol|article|nav|section|table|tr|header|footer|body|html"

# (pattern, replacement) applied in order; identical text for Java and RE2
HTML_STEPS: tuple[tuple[str, str], ...] = (
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<script" + HTML_WS + r"?[^>]*>.*?</script" + HTML_WS + r"*>", ""),
    (r"(?is)<style" + HTML_WS + r"?[^>]*>.*?</style" + HTML_WS + r"*>", ""),
    (r"(?is)<head(?:" + HTML_WS + r"[^>]*)?>.*?</head" + HTML_WS + r"*>", ""),
    (r"(?i)<!doctype[^>]*>", ""),
    (HTML_WS + "+", " "),
    (r"(?i)<li(?:[ \t\n\x{0B}\f\r/][^>]*)?>", "\n\x01"),
    (r"(?i)<br(?:[ \t\n\x{0B}\f\r/][^>]*)?>", "\n"),
    (r"(?i)</?(?:" + BLOCK_TAGS + r")(?:[ \t\n\x{0B}\f\r/][^>]*)?>", "\n\n"),
    (r"<[^>]*>", ""),
)
HTML_TAIL_STEPS: tuple[tuple[str, str], ...] = (
    (r" *\n *", "\n"),
    (r"\n{3,}", "\n\n"),
    (r"\A[ \n]+|[ \n]+\z", ""),
)
BULLET = "  • "


@F.arrow_udf(StringType())
def unescape(texts: pa.Array) -> pa.Array:
    """Character references, numeric and named, as HTML5 defines them."""
    return pa.array([html_lib.unescape(t) if t and "&" in t else t for t in texts.to_pylist()], pa.string())


def html_to_text(html: Column) -> Column:
    """Drop head, scripts, styles and comments; blocks become blank-line
    separated paragraphs, list items become ``  • item`` lines."""
    s = html
    for pattern, repl in HTML_STEPS:
        s = F.regexp_replace(s, pattern, repl)
    s = unescape(F.replace(s, F.lit("&nbsp;"), F.lit(" ")))
    for pattern, repl in HTML_TAIL_STEPS:
        s = F.regexp_replace(s, pattern, repl)
    return F.replace(s, F.lit("\x01"), F.lit(BULLET))


def decode_utf8_lenient(body: Column) -> Column:
    """bytes -> text, invalid sequences replaced by U+FFFD."""
    return F.make_valid_utf8(body.cast("string"))


CHARSET = re.compile(rb"""charset\s*=\s*["']?\s*([A-Za-z0-9_\-:.]+)""", re.I)
BOMS = ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))
# labels that pages use for the larger Windows sets (fixed values of the web's encoding list)
WIDER = {"iso8859-1": "cp1252", "ascii": "cp1252", "iso8859-9": "cp1254", "gb2312": "gb18030", "gbk": "gb18030",
         "euc_kr": "cp949", "shift_jis": "cp932"}


def decode_page(body: bytes, header: str | None = None) -> str:
    """The text of a page's bytes: by its byte order mark, else the charset of
    the HTTP header, else one declared anywhere in the page, else UTF-8 if the
    bytes are valid UTF-8, else windows-1252. Never raises: bytes that the charset
    doesn't know become U+FFFD, an unknown charset counts as not declared."""
    for mark, name in BOMS:
        if body.startswith(mark):
            return body[len(mark):].decode(name, "replace")
    declared = CHARSET.search(body)
    for label in (header, declared and declared.group(1).decode("ascii")):
        try:
            name = codecs.lookup((label or "").strip().lower()).name
            if not codecs.lookup(name)._is_text_encoding:
                continue
            # a page that could be searched byte by byte isn't in UTF-16
            name = "utf-8" if name.startswith("utf-16") and label is not header else WIDER.get(name, name)
            return body.decode(name, "replace")
        except (LookupError, ValueError):
            continue
    try:
        return body.decode("utf-8")
    except UnicodeDecodeError as e:
        # cut off in the middle of a character, or another charset
        return body.decode("utf-8" if e.start >= len(body) - 3 else "cp1252", "replace")


@F.arrow_udf(StringType())
def _decode_pages(bodies: pa.Array, headers: pa.Array) -> pa.Array:
    return pa.array([None if b is None else decode_page(b, h) for b, h in zip(bodies.to_pylist(), headers.to_pylist())],
                    pa.string())


def decode_html_bytes(body: Column, header_charset: Column | None = None) -> Column:
    """Page bytes to text (P1): see :func:`decode_page`."""
    header = F.lit(None).cast("string") if header_charset is None else header_charset
    return _decode_pages(body, header)
