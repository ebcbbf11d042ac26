"""MinHash + LSH fuzzy deduplication.

Plan shape (per call of :func:`fuzzy_dedup`):

1. narrow stage: normalise -> shingles -> explode -> base hash -> partial
   ``min`` of every hash function per document (codegen'd hash aggregate);
   the shuffle carries one row of ``H`` longs per document;
2. bands: ``explode`` of ``B`` (band, key) structs per document;
3. buckets: ``groupBy(band, key)`` with partial aggregation gives each
   bucket's smallest id and size (skew-proof), joined back through
   :func:`grist.operators.skew.split_join` so a bucket holding a third of the
   corpus is handled by broadcast or salting instead of one task;
4. edges: each document links to its bucket minimum (a star, linear in bucket
   size; same connected components as all pairs, which are never emitted);
5. components: :func:`grist.operators.components.connected_components`;
6. survivors: anti-join on the unique document id.

Verified mode links documents only when the exact Jaccard similarity of the two
shingle sets exceeds the threshold (strict ``>``); its components are those of
all such pairs that share a bucket (:func:`verified_edges`).
"""

from __future__ import annotations

import random
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from grist.functions import text as T
from grist.operators import components as CC
from grist.operators import skew
from grist.session import cut_lineage, release_memory

# Mersenne prime 2^31 - 1: (a*h + b) stays below 2^62 for 31-bit a, b, h.
PRIME = 2147483647
NATIVE_MAX_HASHES = 32
BLOCK = 512                 # members of a large bucket that are compared as one block


@dataclass(frozen=True)
class MinHashParams:
    num_hashes: int = 10
    num_bands: int = 2
    ngrams: int = 2
    jaccard_threshold: float = 0.8
    seed: int = 0

    def __post_init__(self):
        if self.num_bands <= 0 or self.num_bands > self.num_hashes:
            raise ValueError("need 0 < num_bands <= num_hashes")
        if self.num_hashes % self.num_bands:
            raise ValueError("num_hashes must be divisible by num_bands")
        if self.ngrams < 1:
            raise ValueError("ngrams must be positive")

    @property
    def rows_per_band(self) -> int:
        return self.num_hashes // self.num_bands


def hash_coefficients(num_hashes: int, seed: int = 0) -> list[tuple[int, int]]:
    """Universal hash family ``(a*x + b) mod p``: ``a`` in [1, p), ``b`` in [0, p)."""
    rng = random.Random(seed)
    out = []
    for _ in range(num_hashes):
        a = rng.randrange(1, PRIME)
        b = rng.randrange(PRIME)
        out.append((a, b))
    return out


def base_hash(shingle) -> F.Column:
    """First 32 bits of the shingle's MD5, reduced mod p (same in DuckDB)."""
    hexed = F.substring(F.md5(shingle), 1, 8)
    return F.pmod(F.conv(hexed, 16, 10).cast("bigint"), F.lit(PRIME))


def shingle_sets(df: DataFrame, id_col: str, text_col: str, ngrams: int) -> DataFrame:
    """``(id, shingles)`` with the distinct shingle array of every document."""
    out = T.with_shingles(df.select(id_col, text_col), text_col, ngrams, "shingles")
    return out.select(id_col, "shingles")


def signatures(df: DataFrame, params: MinHashParams, id_col: str = "doc_id",
               text_col: str = "text", shingles_df: DataFrame | None = None) -> DataFrame:
    """``(id, sig array<bigint>)``. Documents with no shingle have no signature
    (and so no bucket): they are kept as singletons."""
    sets = shingles_df if shingles_df is not None else shingle_sets(df, id_col, text_col,
                                                                     params.ngrams)
    coeffs = hash_coefficients(params.num_hashes, params.seed)
    if params.num_hashes > NATIVE_MAX_HASHES:
        return _signatures_arrow(sets, id_col, coeffs)
    # explode_outer: a plain explode makes Catalyst infer size(shingles) > 0
    # and push it below the projection, computing every shingle set twice.
    hashed = (sets.select(id_col, F.explode_outer("shingles").alias("_s"))
              .filter(F.col("_s").isNotNull())
              .select(id_col, base_hash(F.col("_s")).alias("_h")))
    mins = [F.min((F.col("_h") * a + b) % PRIME).alias(f"_m{i}") for i, (a, b) in enumerate(coeffs)]
    agg = hashed.groupBy(id_col).agg(*mins)
    return agg.select(id_col, F.array(*[f"_m{i}" for i in range(len(coeffs))]).alias("sig"))


def _signatures_arrow(sets: DataFrame, id_col: str, coeffs: list[tuple[int, int]]) -> DataFrame:
    """Many hash functions, in an Arrow-batched UDF: one pass over all base
    hashes of a batch for each function, with a minimum for each document. The
    remainder by the Mersenne prime is a shift, an addition and a minimum.
    Documents without shingles leave by the result: a filter on the sets would be
    pushed below them, where every use of the words normalises the text anew."""
    prime = np.uint64(PRIME)

    @F.arrow_udf(Ty.ArrayType(Ty.LongType()))
    def minhash(shingles: pa.Array) -> pa.Array:
        release_memory()
        sizes = pc.fill_null(pc.list_value_length(shingles), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        digests = b"".join([md5(s, usedforsecurity=False).digest()[:4] for s in shingles.flatten().cast(pa.binary()).to_pylist()])
        h = np.frombuffer(digests, ">u4").astype(np.uint64) % prime
        some = sizes > 0
        starts = (np.cumsum(sizes) - sizes)[some]
        out = np.empty((len(starts), len(coeffs)), np.int64)
        for i, (a, b) in enumerate(coeffs if len(starts) else ()):
            v = h * np.uint64(a) + np.uint64(b)                 # below PRIME * PRIME
            v = (v & prime) + (v >> np.uint64(31))              # the same remainder, below 2 * PRIME
            out[:, i] = np.minimum.reduceat(np.minimum(v, v - prime), starts)
        offsets = np.concatenate(([0], np.cumsum(some * len(coeffs)))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()), mask=pa.array(~some))

    return sets.select(id_col, minhash.asNondeterministic()("shingles").alias("sig")).filter(F.col("sig").isNotNull())


def lsh_bands(sigs: DataFrame, params: MinHashParams, id_col: str = "doc_id") -> DataFrame:
    """``(id, band, key)``: band ``j`` holds hashes ``j*r .. j*r + r - 1``."""
    r = params.rows_per_band
    parts = [F.struct(F.lit(j).alias("band"), F.slice("sig", j * r + 1, r).alias("key"))
             for j in range(params.num_bands)]
    return sigs.select(id_col, F.explode(F.array(*parts)).alias("_b")).select(
        id_col, F.col("_b.band").alias("band"), F.col("_b.key").alias("key"))


def bucket_edges(bands: DataFrame, id_col: str = "doc_id", **skew_opts) -> DataFrame:
    """Star edges ``(src, dst)``: every member of a bucket links to the bucket's
    smallest id. Linear in bucket size; connects exactly what all pairs would."""
    roots = bands.groupBy("band", "key").agg(
        F.min(id_col).alias("root"), F.count(F.lit(1)).alias("n"))
    roots = cut_lineage(roots.filter(F.col("n") > 1))          # read by the hot keys and by the join
    joined = skew.split_join(bands, roots.select("band", "key", "root"), ["band", "key"],
                             "inner", key_counts=roots, count_col="n", **skew_opts)
    return (joined.filter(F.col(id_col) != F.col("root"))
            .select(F.col("root").alias("src"), F.col(id_col).alias("dst")).distinct())


def jaccard(a, b) -> F.Column:
    """|a ∩ b| / |a ∪ b| of two distinct arrays; null when both are empty."""
    inter = F.size(F.array_intersect(a, b)).cast("double")
    union = (F.size(a) + F.size(b)).cast("double") - inter
    return F.when(union > 0, inter / union)


def verify_edges(edges: DataFrame, sets: DataFrame, id_col: str = "doc_id",
                 **skew_opts) -> DataFrame:
    """``(src, dst, jaccard)`` for every edge; the ``src`` side is a bucket root
    and may be a hub, so its shingle sets come through ``split_join``."""
    s_dst = sets.select(F.col(id_col).alias("dst"), F.col("shingles").alias("_sd"))
    s_src = sets.select(F.col(id_col).alias("src"), F.col("shingles").alias("_ss"))
    with_dst = edges.join(s_dst, "dst", "inner")
    degree = edges.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    both = skew.split_join(with_dst, s_src, ["src"], "inner", key_counts=degree,
                           count_col="n", **skew_opts)
    return both.select("src", "dst", jaccard(F.col("_ss"), F.col("_sd")).alias("jaccard"))


def sets_on_edges(edges: DataFrame, sets: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``sets`` that an edge needs, written once; the others needn't be shuffled."""
    needed = cut_lineage(edges.select(F.explode(F.array("src", "dst")).alias(id_col)).distinct())
    few = needed.count() <= skew.DEFAULT_MAX_BROADCAST_ROWS
    return cut_lineage(sets.join(F.broadcast(needed) if few else needed, id_col, "left_semi"))


def _block_forest(batch: pa.Table) -> pa.Table:
    """Edges that join the components (column ``c``) of one block pair's members
    (``id``, ``shingles``) as all similar pairs would: each reached member is
    compared with those not reached yet; a component is reached as a whole."""
    threshold = batch["threshold"][0].as_py()
    values = batch["shingles"].combine_chunks()
    sizes = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = values.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    component = batch["c"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    mark = np.zeros(int(codes.max(initial=-1)) + 1, bool)
    left = np.argsort(-np.bincount(component)[component], kind="stable")     # the largest component goes first
    sources, targets, todo, stale = [], [], [], True
    while len(left):
        if not todo:
            own = component[left] == component[left[0]]
            todo, left, stale = left[own].tolist(), left[~own], True
            continue
        if stale:
            left_codes = np.concatenate([codes[starts[i]:starts[i + 1]] for i in left.tolist()])
            left_starts, stale = np.concatenate(([0], np.cumsum(sizes[left])[:-1])), False
        here = todo.pop()
        mine = codes[starts[here]:starts[here + 1]]
        mark[mine] = True
        common = np.add.reduceat(mark[left_codes], left_starts, dtype=np.int64)
        mark[mine] = False
        near = common / (sizes[here] + sizes[left] - common) > threshold
        if near.any():
            sources += [here] * int(near.sum())
            targets += left[near].tolist()
            reached = np.isin(component[left], component[left[near]])
            todo += left[reached].tolist()
            left, stale = left[~reached], True
    ids = batch["id"].combine_chunks()
    return pa.table({"src": ids.take(pa.array(sources, pa.int64())), "dst": ids.take(pa.array(targets, pa.int64()))})


def verified_edges(bands: DataFrame, sets: DataFrame, params: MinHashParams, id_col: str = "doc_id",
                   block: int = BLOCK, **skew_opts) -> DataFrame:
    """Edges of sufficient similarity whose components are those of all similar
    pairs that share a bucket.

    Documents of equal shingle sets stand for each other. A bucket's other members
    are compared with its smallest id, linear in its size. Only buckets whose
    members then still lie in several components go on: members outside their
    largest component meet all the others, in pairs of blocks of about ``block``
    members, of which each finds the links between different components."""
    kind = bands.schema[id_col].dataType
    ordered = F.array_sort("shingles")
    prints = cut_lineage(sets.filter(F.size("shingles") > 0).select(
        F.col(id_col).alias("id"), F.xxhash64(ordered).alias("h1"), F.xxhash64(F.lit("second"), ordered).alias("h2")))
    first = cut_lineage(prints.groupBy("h1", "h2").agg(F.min("id").alias("src"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))
    copies = cut_lineage(skew.split_join(prints, first.select("h1", "h2", "src"), ["h1", "h2"], "inner", key_counts=first, count_col="n", **skew_opts)
                         .filter(F.col("id") != F.col("src")).select("src", F.col("id").alias("dst")))

    active = cut_lineage(bands.select(F.col(id_col).alias("dst"), "band", "key").join(copies.select("dst"), "dst", "left_anti"))
    roots = cut_lineage(active.groupBy("band", "key").agg(F.min("dst").alias("src"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))
    members = cut_lineage(skew.split_join(active, roots.select("band", "key", "src"), ["band", "key"], "inner",
                                          key_counts=roots, count_col="n", **skew_opts).filter(F.col("dst") != F.col("src")))
    # texts that share no bucket needn't be shuffled, as far as the ids of the others may be broadcast
    needed = cut_lineage(members.select("dst").unionByName(members.select(F.col("src").alias("dst"))).distinct().withColumnRenamed("dst", id_col))
    if needed.count() <= skew.DEFAULT_MAX_BROADCAST_ROWS:
        sets = sets.join(F.broadcast(needed), id_col, "left_semi")
    stars = cut_lineage(verify_edges(members.select("src", "dst").distinct(), sets, id_col, **skew_opts)
                        .filter(F.col("jaccard") > params.jaccard_threshold).select("src", "dst"))
    found = stars.unionByName(copies) if params.jaccard_threshold < 1 else stars

    # every pair with a smallest id is settled; what is left are pairs of the other members
    label = CC.connected_components(stars, **skew_opts).select(F.col("vertex").alias("dst"), "component")
    labelled = cut_lineage(members.join(label, "dst", "left").select("band", "key", F.col("dst").alias("id"), F.coalesce("component", "dst").alias("c")))
    parts = labelled.groupBy("band", "key", "c").agg(F.count(F.lit(1)).alias("n"))
    unsettled = cut_lineage(parts.groupBy("band", "key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "c")).alias("most"), F.count(F.lit(1)).alias("parts"))
                            .filter(F.col("parts") > 1)
                            .select("band", "key", "n", F.col("most.c").alias("largest"),
                                    F.ceil(F.col("most.n") / block).alias("m"), F.ceil((F.col("n") - F.col("most.n")) / block).alias("k")))
    met = skew.split_join(labelled, unsettled.drop("n"), ["band", "key"], "inner", key_counts=unsettled, count_col="n", **skew_opts)
    # blocks 0 to k - 1: members outside the largest component; k to k + m - 1: the largest, which needs no comparison with itself
    inner = F.col("c") == F.col("largest")
    at = F.xxhash64("id", F.lit(7))
    own = F.when(inner, F.col("k") + F.pmod(at, F.col("m"))).otherwise(F.pmod(at, F.col("k")))
    others = F.sequence(F.lit(0).cast("long"), F.when(inner, F.col("k")).otherwise(F.col("k") + F.col("m")) - 1)
    dealt = (met.withColumns({"own": own, "others": others}).join(sets.select(F.col(id_col).alias("id"), "shingles"), "id")
             .withColumn("other", F.explode("others"))
             .select("band", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "id", "c", "shingles",
                     F.lit(float(params.jaccard_threshold)).alias("threshold")))
    schema = Ty.StructType([Ty.StructField("src", kind), Ty.StructField("dst", kind)])
    linked = dealt.groupBy("band", "key", "lo", "hi").applyInArrow(_block_forest, schema)
    return cut_lineage(found.unionByName(linked.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))).distinct())


@dataclass
class FuzzyResult:
    kept: DataFrame          # input rows that survive
    assignment: DataFrame    # (doc_id, component) for documents in a cluster
    edges: DataFrame         # (src, dst) edges used for the components


def fuzzy_dedup(df: DataFrame, params: MinHashParams = MinHashParams(), verify: bool = False,
                id_col: str = "doc_id", text_col: str = "text", **skew_opts) -> FuzzyResult:
    """Keep one document (the smallest id) per duplicate cluster."""
    sets = shingle_sets(df, id_col, text_col, params.ngrams)
    if verify:
        # read twice (signatures, then both ends of every edge): write it once
        sets = cut_lineage(sets)
    # H longs per document, read by the bucket aggregate, the hot-key count
    # and the edge join: write it once rather than re-derive it from the text
    sigs = cut_lineage(signatures(df, params, id_col, text_col, shingles_df=sets))
    bands = lsh_bands(sigs, params, id_col)
    if verify:
        edges = verified_edges(bands, sets, params, id_col, **skew_opts)
    else:
        edges = cut_lineage(bucket_edges(bands, id_col, **skew_opts))
    comp = CC.connected_components(edges, **skew_opts)
    assignment = comp.select(F.col("vertex").alias(id_col), "component")
    dropped = assignment.filter(F.col(id_col) != F.col("component")).select(id_col)
    kept = df.join(dropped, id_col, "left_anti")
    return FuzzyResult(kept=kept, assignment=assignment, edges=edges)


def cluster_sizes(assignment: DataFrame) -> DataFrame:
    """A9 without collecting members: ``(component, n_members)``."""
    return assignment.groupBy("component").agg(F.count(F.lit(1)).cast("bigint").alias("n_members"))
