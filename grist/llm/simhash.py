"""SimHash near-duplicates by the generalised pigeonhole principle (operator 6).

A fingerprint bit is set if it is set in over half of the XXH64 hashes of a
text's shingles, repeats included. Two texts are linked if their fingerprints
differ in at most ``max_bits`` bits; components of links are the groups.

Candidate search: the 64 bits are dealt into ``m`` parts, correlated bits into
the same part. If part i has a threshold t_i and the thresholds add up to
max_bits - m + 1, two fingerprints within max_bits agree up to t_i bits in at
least one part i (else they differ in t_i + 1 bits or more everywhere, which
adds up to max_bits + 1). A threshold of -1 leaves a part out. The number of
parts and the thresholds come from a dynamic program over estimated costs:
keys to write (all choices of t_i bits masked out of part i) and candidate
pairs (from the pairs of a bounded sample). The choice changes costs only;
every choice finds every link.

Each fingerprint probes with its masked part values; those with an equal key
meet, and all of them are verified by their full distance. A task grows
a spanning forest over each group (a found member is not compared again), so a
group gives fewer links than members, never all pairs. A key with more than
``BLOCK`` members is dealt into blocks, and pairs of blocks meet in tasks of
their own, so no task holds more than two blocks of one key.

Exact copies collapse to one fingerprint before any of this.

Defined cases: null, empty and blank texts have fingerprint zero, which links
like any other; a text of fewer words than a shingle is one shingle; a null id
never is the smallest (a component of only null ids has a null id).
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from grist.llm.common import free_name, key_filter, materialize, partitions, release_memory
from grist.operators.components import connected_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
SAMPLE = 2048               # fingerprints whose pairs estimate candidate counts; changes costs only
BLOCK = 8192                # members of a key that one task compares at once
KEY_COST, PAIR_COST = 2000.0, 4.0        # nanoseconds
MAX_PARTS = 6
SMALL_GROUP = 12


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a UTF-8 text, unsigned."""
    words = text.lower().split() if text else []        # bytes: lowers A-Z, splits at the six ASCII blanks
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())),
                         np.uint64, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[i:i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(((2 * ones > len(hashes)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """``df`` with ``out``: the fingerprint of each text as a signed long. Narrow."""
    @F.arrow_udf(LongType())
    def run(texts: pa.Array) -> pa.Array:
        found = np.array([fingerprint(t, shingle) for t in texts.cast(pa.binary()).to_pylist()], np.uint64)
        release_memory()
        return pa.array(found.view(np.int64))

    return df.withColumn(out, run(F.col(text)))


# --- the plan: parts and thresholds ------------------------------------------

def bit_counts(prints: DataFrame) -> np.ndarray:
    """How often each pair of bits is set together, over all fingerprints; the
    tasks' counts are added in a shuffle of 4,096 keys."""
    def partial(batches):
        total = np.zeros((64, 64), np.int64)
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint8).reshape(-1, 8)
            for i in range(0, len(values), 1 << 15):
                bits = np.unpackbits(values[i:i + (1 << 15)], axis=1, bitorder="little").astype(np.float32)
                total += (bits.T @ bits).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4096)), pa.array(total.ravel())], names=["k", "n"])

    rows = (prints.select("fp").mapInArrow(partial, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(4096, np.int64)
    for r in rows:
        out[r["k"]] = r["n"]
    return out.reshape(64, 64)


def deal_bits(together: np.ndarray, n: int, m: int) -> list[list[int]]:
    """``m`` parts of nearly equal size; each takes, one by one, the free bit
    most correlated with what it holds."""
    p = together / max(n, 1)
    one = np.diag(p)
    spread = np.sqrt(np.maximum(one * (1 - one), 1e-12))
    corr = np.abs(p - np.outer(one, one)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    free, parts = set(range(64)), []
    for i in range(m):
        size = 64 // m + (i < 64 % m)
        some = sorted(free)
        part = [max(some, key=lambda b: (corr[b, some].max(), -b))]
        free.discard(part[0])
        while len(part) < size:
            nxt = max(sorted(free), key=lambda b: (corr[b, part].sum(), -b))
            part.append(nxt)
            free.discard(nxt)
        parts.append(part)
    return parts


def allocate(costs: list[list[float]], max_bits: int) -> tuple[float, list[int]]:
    """Thresholds, from -1 to max_bits, that add up to max_bits - m + 1 at the
    least cost; costs[i][t + 1] is the cost of threshold t in part i."""
    m = len(costs)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}      # by the sum of t + 1
    for own in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for total, (cost, chosen) in best.items():
            for t1, c in enumerate(own):
                new = total + t1
                if new <= max_bits + 1 and (new not in after or cost + c < after[new][0]):
                    after[new] = cost + c, [*chosen, t1 - 1]
        best = after
    return best[max_bits + 1] if m else (0.0, [])


def plan(prints: DataFrame, n: int, max_bits: int = MAX_BITS) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each part that is used."""
    together = bit_counts(prints)
    sample = np.array([r[0] for r in prints.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], np.int64).view(np.uint64)
    best, found = float("inf"), []
    i, j = np.triu_indices(len(sample), 1)
    differ = sample[i] ^ sample[j]
    for m in range(2, min(MAX_PARTS, max_bits + 2) + 1):
        parts = deal_bits(together, n, m)
        costs = []
        for bits in parts:
            mask = np.uint64(sum(1 << b for b in bits))
            distance = np.bitwise_count(differ & mask)
            own = [0.0]
            for t in range(max_bits + 1):
                # pairs seen, but no fewer than uniform bits would give
                share = max((distance <= t).mean() if len(differ) else 0.0, sum(comb(len(bits), k) for k in range(t + 1)) / 2.0 ** len(bits))
                own.append(comb(len(bits), t) * n * KEY_COST + share * n * n / 2 * PAIR_COST)
            costs.append(own)
        cost, thresholds = allocate(costs, max_bits)
        if cost < best:
            best, found = cost, [(b, t) for b, t in zip(parts, thresholds) if t >= 0]
    return found


# --- probing and verifying ----------------------------------------------------

def masks(parts: list[tuple[list[int], int]]) -> list[int]:
    """What each key keeps of a fingerprint: a part's bits without t of them."""
    return [sum(1 << b for b in bits) & ~sum(1 << b for b in hole) for bits, t in parts for hole in combinations(bits, t)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(x: np.ndarray, max_bits: int) -> tuple[list[int], list[np.ndarray]]:
    """Edges of a spanning forest of the links among different fingerprints:
    each reached member is compared with those not reached yet."""
    sources, targets = [], []
    left = x
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            here = todo.pop()
            near = np.bitwise_count(left ^ here) <= max_bits
            if near.any():
                hits = left[near]
                sources.append(np.full(len(hits), here))
                targets.append(hits)
                left = left[~near]
                todo.extend(hits)
    return sources, targets


def links_of(key: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the runs of equal ``key`` rows (columns) of sorted rows."""
    new = np.ones(len(fp), bool)
    new[1:] = (key[1:] != key[:-1]).any(axis=1)
    group = np.cumsum(new) - 1
    starts = np.nonzero(new)[0]
    sizes = np.diff(np.append(starts, len(fp)))
    sources, targets = [], []
    small = sizes[group] <= SMALL_GROUP
    g, x = group[small], fp[small]
    for lag in range(1, min(SMALL_GROUP, int(sizes.max(initial=1)))):
        if lag >= len(x):
            break
        hit = (g[lag:] == g[:-lag]) & (np.bitwise_count(x[lag:] ^ x[:-lag]) <= max_bits) & (x[lag:] != x[:-lag])
        sources.append(x[:-lag][hit])
        targets.append(x[lag:][hit])
    for s, size in zip(starts[sizes > SMALL_GROUP].tolist(), sizes[sizes > SMALL_GROUP].tolist()):
        a, b = forest(np.unique(fp[s:s + size]), max_bits)
        sources += a
        targets += b
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *sources]), np.concatenate([none, *targets])


def linker(max_bits: int):
    """Links of rows (key columns..., fp) sorted by key, a run may span batches."""
    def run(batches):
        held = None
        names = ["src", "dst"]

        def emit(rows):
            a, b = links_of(rows[:, :-1], rows[:, -1].view(np.uint64), max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=names)

        for batch in batches:
            rows = np.stack([c.to_numpy() for c in batch.columns], axis=1)
            rows = rows if held is None else np.concatenate((held, rows))
            if not len(rows):
                continue
            cut = len(rows) - 1                  # the last run may go on
            while cut and (rows[cut - 1, :-1] == rows[-1, :-1]).all():
                cut = int(np.nonzero((rows[:cut, :-1] != rows[-1, :-1]).any(axis=1))[0][-1] + 1) if (rows[:cut, :-1] != rows[-1, :-1]).any() else 0
            held = rows[cut:]
            if cut:
                yield emit(rows[:cut])
        if held is not None and len(held):
            yield emit(np.ascontiguousarray(held))
        release_memory()
    return run


def links(prints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(src, dst) links among the different fingerprints ``fp``; their
    components are those of all links."""
    n = prints.count()
    kept = masks(plan(prints, max(n, 1), max_bits))
    probes = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(signed(k))) for k in kept])).alias("v", "value"))
    hot = materialize(probes.groupBy("v", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
                      .select("v", "value", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "hot-keys")
    dealt = probes.join(hot, ["v", "value"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("long")
    met = (dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
           .select(F.col("v").cast("long").alias("v"), "value", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp"))
    key = ["v", "value", "lo", "hi"]
    return (met.repartition(partitions(prints.sparkSession), *key).sortWithinPartitions(*key, "fp")
            .mapInArrow(linker(max_bits), "src long, dst long"))


def groups(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """A row for each row of ``df``: ``id_col``, ``text_hash``, ``fingerprint``,
    ``component`` (one of its fingerprints), ``component_id`` (its smallest id)
    and ``best``: the text hash of its first row by id, null ids last."""
    rows = materialize(fingerprints(df.select(id_col, text), text, "fingerprint", shingle).select(
        id_col, "fingerprint", F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash")), "prints")
    first = F.min(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col("text_hash").alias("hash")))
    prints = materialize(rows.groupBy(F.col("fingerprint").alias("fp")).agg(first.alias("first")), "distinct-prints")
    found = materialize(links(prints, max_bits).distinct(), "links")
    component = connected_components(found).select(F.col("vertex").alias("fp"), "component")
    labelled = prints.join(component, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = materialize(labelled.groupBy("component").agg(F.min("first").alias("first")), "firsts")
    by_print = materialize(labelled.drop("first").join(smallest, "component").select(
        F.col("fp").alias("fingerprint"), "component", F.col("first.id").alias("component_id"), F.col("first.hash").alias("best")), "groups")
    return rows.join(by_print, "fingerprint").select(id_col, "text_hash", "fingerprint", "component", "component_id", "best")


def keep_first(df: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that come first in their groups: smallest id, null
    ids last, one row if several are alike in id and text.

    Texts are shuffled only for rows that go or may go.
    """
    grouped = groups(df, id_col, text, **options)
    stays = F.col(id_col).eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("best"))
    marks = (grouped.groupBy(F.col(id_col).alias("i"), F.col("text_hash").alias("h")).agg(F.min(stays).alias("stays"), F.count(F.lit(1)).alias("n"))
             .filter(~F.col("stays") | (F.col("n") > 1)).withColumn("key", F.xxhash64("i", "h")))
    marks = materialize(marks, "marks")
    key, h, i, marked, stay, mark_h = free_name(df, "_key", "_h", "_i", "_marked", "_stay", "_mark_h")
    keyed = df.withColumn(h, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    keyed = keyed.withColumn(key, F.xxhash64(id_col, h))
    tested = keyed.withColumn(marked, key_filter(marks, "key")(key))
    named = marks.select(F.col("i").alias(i), F.col("h").alias(mark_h), F.col("stays").alias(stay))
    met = tested.filter(F.col(marked)).join(named, F.col(id_col).eqNullSafe(F.col(i)) & (F.col(h) == F.col(mark_h)), "left")
    unmarked = met.filter(F.col(stay).isNull())
    alike = met.filter(F.col(stay)).dropDuplicates([id_col, h])
    rest = tested.filter(~F.col(marked))
    return rest.select(*df.columns).unionByName(unmarked.select(*df.columns)).unionByName(alike.select(*df.columns))
