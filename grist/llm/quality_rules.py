"""Quality rules: a learned decision list over text statistics (operator 2).

``text_statistics`` counts, per document, what the rules look at.
``learn`` finds the list by sequential covering on labelled rows: a rule is a
conjunction of thresholds on ratios of counts, grown one condition at a time by
information gain and pruned from its end by folds: rules grown without a fold
are judged on it. The bad rows that a rule covers leave and the next is sought,
until one doesn't pay: its precision on unseen rows must reach
``MIN_PRECISION``, and the bits that it saves in describing the labels must
exceed its own. Thresholds lie midway between neighbouring values of the two
classes. ``DecisionList.verdict`` emits the rules, in order, as one
Spark conditional expression, so applying them is a narrow native projection.

Only the fit is bounded: it uses at most ``MAX_LABELLED`` labelled rows, those
with the smallest hashes of their ids. Statistics and verdicts cover every row.

Defined cases: null or blank text has all counts 0 and fails the base rule; a
label table that is empty or has one class gives a list without rules, which
keeps every row, an empty table of texts gives an empty result; very long texts
are counted whole, like others; columns named like a count are replaced; null labels and labels of unknown ids are ignored; an id that
is labelled twice takes the smaller label; repeated rows get equal results.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from grist.llm.common import free_name

MAX_LABELLED = 20_000       # labelled rows that the fit uses at most
MIN_WORDS = 50              # base rule: fewer words fail
MAX_REPEAT_PERCENT = 50     # base rule: a larger share of words in repeated windows fails
MAX_RULES, MAX_CONDITIONS, FOLDS = 12, 4, 5
MIN_PRECISION = 0.9         # of a rule, on rows that didn't grow it
CONDITION_BITS = 12.0       # to name a ratio, a side and a threshold

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks")
#: Ratios that conditions compare: (numerator, denominator).
RATIOS = (("word_chars", "n_words"), ("n_symbols", "word_chars"), ("n_dup_lines", "n_words"),
          ("n_repeat_words", "n_words"), ("n_upper", "word_chars"), ("n_marks", "n_words"))

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
MARKS = b"!?"


def repeated(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    covered, until = 0, 0
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered += i + 3 - max(i, until)
            until = i + 3
    return covered


def count_text(text: bytes) -> tuple[int, ...]:
    """``COUNTS`` of one UTF-8 text; ``bytes.split`` cuts at the six ASCII blanks."""
    words = text.split()
    joined = b"".join(words)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    less = lambda chars: len(joined) - len(joined.translate(None, chars))
    return (len(words), len(joined.decode("utf-8", "replace")), less(SYMBOLS), len(lines) - len(set(lines)), repeated(words),
            less(UPPER), less(MARKS))


@F.arrow_udf(StructType([StructField(c, LongType(), False) for c in COUNTS]))
def _count_text(texts: pa.Array) -> pa.Array:
    rows = [count_text(t or b"") for t in texts.cast(pa.binary()).to_pylist()]
    columns = zip(*rows) if rows else [[] for _ in COUNTS]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(COUNTS))


def text_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the columns ``COUNTS`` (replaced if they exist). Narrow."""
    stats, = free_name(df, "_stats")
    counted = df.withColumn(stats, _count_text(F.col(text)))
    return counted.withColumns({c: F.col(stats)[c] for c in COUNTS}).drop(stats)


def base_failed() -> Column:
    """The fixed rule that comes before the learned ones."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass
class Condition:
    """numerator > cut * denominator, or <=."""
    ratio: int
    above: bool
    cut: float

    def holds(self, ratios: np.ndarray) -> np.ndarray:
        x = ratios[:, self.ratio]
        return x > self.cut if self.above else x <= self.cut

    def column(self) -> Column:
        top, bottom = RATIOS[self.ratio]
        # the same double division that the fit has seen; 0 words or characters give ratio 0
        ratio = F.when(F.col(bottom) > 0, F.col(top).cast("double") / F.col(bottom).cast("double")).otherwise(0.0)
        return ratio > F.lit(self.cut) if self.above else ratio <= F.lit(self.cut)

    def __str__(self):
        return f"{'/'.join(RATIOS[self.ratio])} {'>' if self.above else '<='} {self.cut:.6g}"


@dataclass
class DecisionList:
    """Rules in the order of their use; a row that none covers is kept."""
    rules: list[list[Condition]] = field(default_factory=list)

    def covered(self, ratios: np.ndarray) -> np.ndarray:
        return np.any([covers(r, ratios) for r in self.rules], axis=0) if self.rules else np.zeros(len(ratios), bool)

    def rule_number(self) -> Column:
        """1-based number of the first rule that covers a row, 0 if none does."""
        out = None
        for i, rule in enumerate(self.rules, 1):
            test = rule[0].column()
            for c in rule[1:]:
                test = test & c.column()
            out = F.when(test, F.lit(i)) if out is None else out.when(test, F.lit(i))
        return F.lit(0) if out is None else out.otherwise(F.lit(0))

    def verdict(self) -> Column:
        """Whether a row is kept by the learned rules."""
        return self.rule_number() == 0

    def __str__(self):
        return "\n".join(f"{i}: reject if " + " and ".join(map(str, r)) for i, r in enumerate(self.rules, 1))


def covers(rule: list[Condition], ratios: np.ndarray) -> np.ndarray:
    hit = np.ones(len(ratios), bool)
    for c in rule:
        hit &= c.holds(ratios)
    return hit


def cuts_between(values: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Midpoints between neighbouring values, where the classes of the two differ."""
    distinct, place = np.unique(values, return_inverse=True)
    has_bad = np.bincount(place, bad, len(distinct)) > 0
    has_good = np.bincount(place, ~bad, len(distinct)) > 0
    same = (has_bad[1:] == has_bad[:-1]) & (has_good[1:] == has_good[:-1]) & (has_bad[1:] != has_good[1:])
    return ((distinct[1:] + distinct[:-1]) / 2)[~same]


def grow(ratios: np.ndarray, bad: np.ndarray) -> list[Condition]:
    """Add the condition of the highest information gain until no good row is covered."""
    rule: list[Condition] = []
    hit = np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS and (hit & ~bad).any():
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        best, best_gain = None, 1e-9
        for k in range(ratios.shape[1]):
            values = cuts_between(ratios[hit, k], bad[hit])
            if not len(values):
                continue
            # covered rows up to each cut, for both classes, in two searches
            x_bad, x_good = np.sort(ratios[hit & bad, k]), np.sort(ratios[hit & ~bad, k])
            low = np.searchsorted(x_bad, values, "right"), np.searchsorted(x_good, values, "right")
            for above in (True, False):
                pp, nn = (p - low[0], n - low[1]) if above else low
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pp > 0, pp * (np.log2(pp / (pp + nn)) - np.log2(p / (p + n))), -1.0)
                i = int(gain.argmax())
                if gain[i] > best_gain:
                    best, best_gain = Condition(k, above, float(values[i])), gain[i]
        if best is None:
            break
        rule.append(best)
        hit &= best.holds(ratios)
    return rule


def prune(ratios: np.ndarray, bad: np.ndarray, folds: np.ndarray) -> tuple[int, int, int]:
    """(conditions, bad, good): the length at which rules are worth most on rows
    that didn't grow them, and the rows covered there. Each fold is judged by a
    rule grown on the others, so that every row grows rules and judges one."""
    seen = np.zeros((MAX_CONDITIONS + 1, 2), int)
    for f in range(FOLDS):
        own = folds == f
        if not (bad & ~own).any() or not (~bad & ~own).any():
            continue
        rule = grow(ratios[~own], bad[~own])
        for k in range(1, MAX_CONDITIONS + 1):
            hit = covers(rule[:k], ratios[own]) if rule else np.zeros(own.sum(), bool)
            seen[k] += (hit & bad[own]).sum(), (hit & ~bad[own]).sum()
    worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in seen[1:]]
    best = int(np.argmax(worth)) + 1
    return best, *map(int, seen[best])


def pays(p: int, n: int, bad: int, good: int, conditions: int) -> bool:
    """Whether a rule that covers ``p`` bad and ``n`` good rows of so many shortens
    the description of the labels by more than the bits it takes itself."""
    if p < MIN_PRECISION * (p + n) or not p:
        return False
    share, base = (p + 0.5) / (p + n + 1), bad / (bad + good)
    saved = p * np.log2(share / base) + n * np.log2((1 - share) / (1 - base))
    return saved > conditions * CONDITION_BITS


def learn_rows(counts: np.ndarray, bad: np.ndarray, seed: int = 42) -> DecisionList:
    """The list for labelled rows: ``counts`` by ``COUNTS``, ``bad`` boolean."""
    column = {c: counts[:, i].astype(float) for i, c in enumerate(COUNTS)}
    ratios = np.stack([np.divide(column[a], column[b], out=np.zeros(len(counts)), where=column[b] > 0)
                       for a, b in RATIOS], axis=1) if len(counts) else np.zeros((0, len(RATIOS)))
    # folds dealt apart in each class, so that few bad rows are in all of them
    folds, rng = np.zeros(len(bad), int), np.random.default_rng(seed)
    for m in (bad, ~bad):
        folds[m] = rng.permutation(np.arange(m.sum()) % FOLDS)
    left = np.ones(len(bad), bool)
    found = DecisionList()
    while len(found.rules) < MAX_RULES and (left & bad).any() and (left & ~bad).any():
        length, p, n = prune(ratios[left], bad[left], folds[left])
        rule = grow(ratios[left], bad[left])[:length]
        if not rule or not pays(p, n, int((left & bad).sum()), int((left & ~bad).sum()), len(rule)):
            break
        found.rules.append(rule)
        left &= ~covers(rule, ratios)
    return found


def learn(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality",
          max_labelled: int = MAX_LABELLED) -> DecisionList:
    """Fit on the rows of ``stats`` (with ``COUNTS``) that ``labels`` marks good
    (1) or bad (0) and the base rule passes; at most ``max_labelled`` of them
    reach the driver, seven numbers each."""
    chosen = (labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
              .groupBy(id_col).agg(F.min(label).alias("_label"))
              .orderBy(F.xxhash64(id_col), id_col).limit(max_labelled))
    rows = (stats.filter(~base_failed()).select(id_col, *COUNTS).join(F.broadcast(chosen), id_col)
            .orderBy(F.xxhash64(id_col, *COUNTS), id_col).limit(max_labelled).select(*COUNTS, "_label").collect())
    table = np.array([tuple(r) for r in rows], dtype=np.int64).reshape(-1, len(COUNTS) + 1)
    return learn_rows(table[:, :-1], table[:, -1] == 0)


def apply(stats: DataFrame, rules: DecisionList) -> DataFrame:
    """``stats`` with ``base_failed``, ``rule`` (the first rule that covers the row, else 0) and ``kept``."""
    return (stats.withColumn("base_failed", base_failed()).withColumn("rule", rules.rule_number())
            .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)))
