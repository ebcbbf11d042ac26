"""Treebank word tokens (G1) as an ordered cascade of regular expressions.

``T.words`` splits at every change between word characters and others. The
Penn Treebank conventions differ where quality rules notice it: ``don't`` is
``do`` + ``n't``, ``John's`` is ``John`` + ``'s``, ``3.14`` and ``10,000`` and
``well-known`` stay whole, quotes become ``` `` ``` and ``''``, and a dot is a
token only where a sentence ends.

``STEPS`` holds (pattern, replacement) pairs that Java and RE2 read alike: no
look-around, no back-references, group numbers up to 9, ASCII case spelled out.
Spark runs them in an Arrow UDF, each over a whole batch by Arrow's own
``replace_substring_regex`` (RE2); the SQL oracle is generated from the same
list. Every pattern is linear in the text.

A sentence ends at a dot, and closing quotes or brackets after it, before
blanks and an upper-case letter or digit, or at the end of the text; but not
after an abbreviation of ``ABBREVIATIONS``, nor after initials (``J.``,
``U.S.``) inside the text. That list stands for a trained sentence splitter.

Defined cases: null stays null, an empty text has no tokens; U+0001 and U+0002,
which mark places within the cascade, count as blanks; texts of any length are
handled whole.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from grist.functions import text as T

# fixed values: titles and short forms that are written with a dot inside a sentence
ABBREVIATIONS = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Sen", "Rep", "Gov", "Gen", "Capt", "Lt", "Col", "Sgt", "Rev", "Hon",
                 "St", "Jr", "Sr", "Inc", "Ltd", "Co", "Corp", "vs", "etc", "cf", "al", "No", "Fig", "Vol", "pp",
                 "Jan", "Feb", "Mar", "Apr", "Jun", "Jul", "Aug", "Sep", "Sept", "Oct", "Nov", "Dec")

_WS, _NOT_WS = T.WS, "[^" + T.WS_CLASS_BODY + "]"
_CLOSE = r"[\])}>\"'»”’]*"
_EDGE = r"([^\p{L}\p{Nd}_])"            # a character that ends a word
GROUP = re.compile(r"\$(\d)")            # in a replacement
CAPITAL, DOT = "\x01", "\x02"           # marks: a sentence may start here; a dot that ends none


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _halves(*pairs: tuple[str, str]) -> tuple[str, str]:
    """A rule that parts words at a fixed place: each pair is (first, second half), ``|`` between choices."""
    each = ["(" + "|".join(map(_any_case, a.split("|"))) + ")(" + "|".join(map(_any_case, b.split("|"))) + ")" for a, b in pairs]
    firsts = "".join(f"${2 + 2 * i}" for i in range(len(pairs)))
    seconds = "".join(f"${3 + 2 * i}" for i in range(len(pairs)))
    return _EDGE + "(?:" + "|".join(each) + ")" + _EDGE, f"$1{firsts} {seconds}${2 + 2 * len(pairs)}"


STEPS: list[tuple[str, str]] = [
    (f"[{CAPITAL}{DOT}]", " "),
    # sentence ends
    (r"(^|[^\p{L}])(" + "|".join(ABBREVIATIONS) + r")\.", "$1$2" + DOT),
    (r"(^|[^\p{L}\p{N}])((?:[A-Z]\.)*[A-Z])\.", "$1$2" + DOT),
    (f"({_WS})" + r"([\[({<\"'`«“‘„]*[\p{Lu}\p{Lt}\p{Nd}])", "$1" + CAPITAL + "$2"),
    (r"([^.])\.(" + _CLOSE + f")({_WS}+){CAPITAL}", "$1 . $2 $3"),
    (CAPITAL, ""),
    (DOT, "."),
    (r"([^.])\.(" + _CLOSE + f"){_WS}*" + r"\z", "$1 . $2 "),
    # opening quotes
    ("([«“‘„»”’]|`+)", " $1 "),
    (r"(^|[\[({<" + T.WS_CLASS_BODY + r"])(?:\"|'')", "$1 `` "),
    # punctuation, brackets, dashes
    (r"([:,])([^\p{Nd}])", " $1 $2"),
    (r"([:,])\z", " $1 "),
    (r"(\.\.+)", " $1 "),
    (r"([;@#$%&*?!\[\](){}<>])", " $1 "),
    (r"([^'])'(" + _WS + "|" + r"\z)", "$1 ' $2"),
    ("--", " -- "),
    # closing quotes; two blanks everywhere, so that neighbouring words don't share one
    # (a blank taken for a character before an ending only adds a blank; leaving blanks out costs time)
    (r"''|\"", " '' "),
    (_WS + "+", "  "),
    (r"\A", "  "),
    (r"\z", "  "),
    (r"([^'])('[sSmMdD])(" + _WS + ")", "$1 $2$3"),
    (r"([^'])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T)(" + _WS + ")", "$1 $2$3"),
    # words that stand for two
    _halves(("can", "not"), ("gim|lem", "me"), ("gon|wan", "na")),
    _halves(("got", "ta"), ("d", "'ye"), ("more", "'n")),
    _halves(("'t", "is|was")),
]


@F.arrow_udf(StringType())
def spaced(texts: pa.Array) -> pa.Array:
    """The text with blanks between its tokens."""
    for pattern, replacement in STEPS:
        texts = pc.replace_substring_regex(texts, pattern, GROUP.sub(r"\\\1", replacement))
    return texts


def tokens(text: Column) -> Column:
    """The tokens, in order."""
    return F.array_remove(F.split(spaced(text), _WS + "+", -1), "")


def word_stats(spaced_text: Column) -> dict[str, Column]:
    """Counts behind the quality rules, from the output of ``spaced``."""
    letters = F.regexp_replace(spaced_text, r"[^\p{L}" + T.WS_CLASS_BODY + "]+", "")
    return {
        "n_words": F.regexp_count(spaced_text, F.lit(_NOT_WS + "+")).cast("bigint"),
        "n_word_chars": F.length(F.regexp_replace(spaced_text, _WS, "")).cast("bigint"),
        "n_alpha_words": F.regexp_count(letters, F.lit(r"\p{L}+")).cast("bigint"),
    }
