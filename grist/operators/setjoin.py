"""Exact set-similarity join: all pairs of documents whose shingle sets have a
Jaccard similarity of at least ``percent`` / 100, without buckets (J4, A7).

The MinHash path finds most such pairs, this one finds all of them, so it also
measures that path's recall (:func:`lsh_recall`). Steps:

1. words become 64-bit hashes and n of them a shingle's, on arrays of a batch
   (Spark folds accents and case before); documents of equal sets form a class, whose
   smallest id stands for all of them from here on (copies are never paired);
2. document frequencies of the shingles, counted in blocks of about ``COUNTED``
   of them, to which each batch of sets sends every shingle once, with the places of its
   sets; those that two or more sets have come back to the batch, as arrays. A shingle of
   a single class can't link anything and only counts as a place at the front of its
   set's order; the others are ordered by (frequency, hash), rare ones first;
3. prefix filter: two sets of sufficient similarity share a shingle within the
   first ``size - ceil(percent * size / 100) + 1`` places of both, so only these
   prefixes are joined on the shingle (hot shingles split), with the length
   filter and the positional filter as the join's condition. A pair that shares
   a run of shingles is emitted at the run's start alone: each prefix row
   carries the shingle before it, and where these agree the pair is known;
4. verification: pairs are dealt to cells by the smallest shared shingle of both
   sets, mostly the same in near copies, and each cell gets the sets it needs once,
   however many pairs they are in. Cells hold about ``CELL`` sets a side;
   similarity is compared in integers.

Defined cases: null texts, and texts of fewer words than a shingle, have no
shingles, are classes of their own and link to nothing; repeated ids count as
one document (that with the smaller set hash); an empty table gives empty
results.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from grist.functions import text as T
from grist.operators import components as CC
from grist.operators import minhash, skew
from grist.session import cut_lineage, release_memory

CELL = 2000
COUNTED = 1 << 20           # shingles that are counted as one block


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers over all bits, one to one."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h


@lru_cache(1)
def _byte_numbers() -> np.ndarray:
    """The number of each byte at each of a word's first 63 places."""
    return _mixed(_mixed(np.arange(64 * 256, dtype=np.uint64)))


def _word_hashes(words: pa.Array) -> np.ndarray:
    """The 64-bit hash of every word (none is empty): the sum of a number for
    each byte at its place in the word."""
    if not len(words):
        return np.zeros(0, np.uint64)
    whole = pa.concat_arrays([words])
    ends = np.frombuffer(whole.buffers()[1], np.int32)[whole.offset:whole.offset + len(whole) + 1].astype(np.int64)
    letters = np.frombuffer(whole.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    starts = ends[:-1] - ends[0]
    key = np.arange(256, 256 * len(letters) + 256, 256) - np.repeat(starts * 256, np.diff(ends))     # 256 times the place in the word, from 1
    key += letters
    known = _byte_numbers()
    numbers = known.take(key, mode="clip")
    late = key >= len(known)                # of the rare long words
    if late.any():
        numbers[late] = _mixed(_mixed(key[late].view(np.uint64)))
    return np.add.reduceat(numbers, starts)


def _distinct(x: np.ndarray) -> np.ndarray:
    """Sorted; by sorting, which is quicker than numpy's unique on short arrays."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def _shingle_sets(ngrams: int):
    """A function of lower-case texts: each one's sorted distinct shingle hashes.
    Words are those of :func:`grist.functions.text.dedup_words`."""
    blanks = bytes(32 if chr(c) in T.PUNCTUATION else c for c in range(256))

    @F.arrow_udf(Ty.ArrayType(Ty.LongType()))
    def sets(texts: pa.Array) -> pa.Array:
        release_memory()
        null = texts.is_null().to_numpy(zero_copy_only=False)
        whole = pa.concat_arrays([texts.cast(pa.string()).fill_null("")])
        offsets, data = whole.buffers()[1:]
        plain = pa.StringArray.from_buffers(len(whole), offsets, pa.py_buffer((data.to_pybytes() if data else b"").translate(blanks)), offset=whole.offset)
        pieces = pc.utf8_split_whitespace(plain)
        words, parents = pieces.flatten(), pc.list_parent_indices(pieces)
        some = pc.greater(pc.binary_length(words), 0)
        sizes = np.bincount(parents.filter(some).to_numpy(zero_copy_only=False), minlength=len(texts))
        h = _word_hashes(words.filter(some))
        windows = max(len(h) - ngrams + 1, 0)
        shingles = _mixed(h[:windows])
        for k in range(1, ngrams):
            shingles = _mixed(shingles + h[k:k + windows])
        shingles, starts = shingles.view(np.int64), np.cumsum(sizes) - sizes
        # a text without words has one empty word, as split() has
        blank = np.zeros(1 if ngrams == 1 else 0, np.int64)
        found = [blank[:0] if none else _distinct(shingles[at:max(at, at + n - ngrams + 1)]) if n else blank
                 for none, at, n in zip(null, starts, sizes)]
        ends = np.cumsum([0] + [len(x) for x in found]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([blank[:0], *found])))

    return sets


def shingle_hashes(df: DataFrame, id_col: str, text_col: str, ngrams: int) -> DataFrame:
    """(id, set): the sorted distinct 64-bit hashes of a document's shingles."""
    src, dst = T.accent_fold_table()
    text = F.col("t")
    folded = F.regexp_replace(F.translate(text, src, dst), r"\p{Mn}", "")
    ascii_only = F.octet_length(text) == F.length(text)         # has no accents
    lowered = F.lower(F.when(ascii_only, text).otherwise(folded))
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return texts.select("id", _shingle_sets(ngrams)(lowered).alias("set"))


@dataclass
class Classes:
    members: DataFrame       # (id, class_id) of every document
    sets: DataFrame          # (id, n, set): the class id, its number of documents, its shingles (non-empty)


def classes(df: DataFrame, ngrams: int, id_col: str = "doc_id", text_col: str = "text") -> Classes:
    """Documents of equal shingle sets share a class, named by its smallest id."""
    # both read twice: written once
    own = cut_lineage(shingle_hashes(df, id_col, text_col, ngrams)
                      .select("id", "set", F.xxhash64("set").alias("h1"), F.xxhash64(F.lit("second"), "set").alias("h2")))
    one = cut_lineage(own.groupBy("id").agg(F.min(F.struct("h1", "h2", F.size("set").alias("m"))).alias("k")).select("id", "k.h1", "k.h2", "k.m"))
    found = cut_lineage(one.filter("m > 0").groupBy("h1", "h2").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n")))
    members = skew.split_join(one, found.select("h1", "h2", "class_id"), ["h1", "h2"], "left", key_counts=found)
    members = cut_lineage(members.select("id", F.coalesce("class_id", "id").alias("class_id")))
    # joined on the id alone, so that the sets are shuffled once
    named = found.select(F.col("class_id").alias("id"), F.col("h1").alias("c1"), F.col("h2").alias("c2"), "n")
    sets = own.join(named, "id").filter("(h1 ^ c1 | h2 ^ c2) = 0").dropDuplicates(["id"]).select("id", "n", "set")
    return Classes(members, cut_lineage(sets))


def _needed(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Shared shingles that two sets of ``sizes`` shingles need at least (of the larger)."""
    return (sizes * percent + 99) // 100


def _counted(kind: Ty.DataType):
    """Two functions: of batches of sets, their rows of :func:`shared_places` by block,
    still with every shingle; and of a block's rows, what remains of them."""
    rows = Ty.StructType([Ty.StructField("block", Ty.LongType()), Ty.StructField("batch", kind), Ty.StructField("ids", Ty.ArrayType(kind)),
                          *(Ty.StructField(c, Ty.ArrayType(Ty.LongType())) for c in ("sizes", "tokens", "n")), Ty.StructField("at", Ty.ArrayType(Ty.IntegerType()))])
    found = Ty.StructType([f for f in rows.fields[1:]] + [Ty.StructField("df", Ty.ArrayType(Ty.LongType()))])
    lists = lambda ends, x: pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), x)

    def dealt(batches, blocks: int, least: int):
        for part in _gathered(batches, least):
            ids, sets = part["id"].combine_chunks(), part["set"].combine_chunks()
            sizes = pc.list_value_length(sets).to_numpy(zero_copy_only=False).astype(np.int64)
            values = sets.flatten().to_numpy(zero_copy_only=False)
            order = np.argsort(values.view(np.uint64))
            values, at = values[order], np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order]
            block = ((values.view(np.uint64) >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)     # equal ranges of hashes
            heads = np.flatnonzero(np.append(True, values[1:] != values[:-1]))             # a shingle is sent once, then its sets
            n = np.diff(np.append(heads, len(values)))
            tokens, block = values[heads], block[heads]
            cuts = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(block))
            own = block[cuts[:-1]]
            first = np.minimum(np.arange(len(own) + 1), 1) * len(ids)                       # ids and sizes go with the first row
            yield pa.RecordBatch.from_arrays(
                [pa.array(own), pa.array([ids[0].as_py()] * len(own), ids.type), lists(first, ids), lists(first, pa.array(sizes)),
                 lists(cuts, pa.array(tokens)), lists(cuts, pa.array(n)), lists(np.append(heads, len(values))[cuts], pa.array(at))],
                names=rows.names)

    def counted(block: pa.Table) -> pa.Table:
        tokens, n, at = (block[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("tokens", "n", "at"))
        order = np.argsort(tokens)
        heads = np.flatnonzero(np.append(True, tokens[order][1:] != tokens[order][:-1]))
        total = np.add.reduceat(n[order], heads)
        df = np.empty(len(tokens), np.int64)
        df[order] = np.repeat(total, np.diff(np.append(heads, len(tokens))))
        keep = df > 1
        starts = np.append(0, np.cumsum(pc.list_value_length(block["tokens"].combine_chunks()).to_numpy(zero_copy_only=False)))
        places = np.append(0, np.cumsum(keep))[starts]
        kept = lists(places, pa.array(tokens[keep])), lists(places, pa.array(n[keep])), lists(np.append(0, np.cumsum(n[keep]))[places], pa.array(at[np.repeat(keep, n)]))
        out = pa.table([block["batch"], block["ids"], block["sizes"], *kept, lists(places, pa.array(df[keep]))], names=found.names)
        some = pa.array(np.diff(places) > 0)
        return out.filter(pc.or_(some, pc.greater(pc.list_value_length(out["ids"]), 0)))

    return dealt, counted, rows, found


def _gathered(batches, least: int):
    """Batches put together until they have ``least`` shingles."""
    parts, held = [], 0
    for batch in batches:
        if batch.num_rows:
            parts.append(batch)
            held += len(batch["set"].flatten())
        if held >= least:
            yield pa.Table.from_batches(parts)
            parts, held = [], 0
    if parts:
        yield pa.Table.from_batches(parts)


def shared_places(sets: DataFrame) -> DataFrame:
    """The shingles that two or more sets have, several rows for each batch of
    sets (named by its first id): ``tokens``, ``df`` sets have each of them, ``n`` of
    this batch, whose numbers follow each other in ``at``. One row of a batch
    lists its ``ids`` and ``sizes``; in the others these are empty."""
    sets = sets.filter(F.size("set") > 0).select("id", "set")
    total = sets.agg(F.sum(F.size("set"))).first()[0] or 0
    blocks, least = max(1, -(-total // COUNTED)), COUNTED
    dealt, counted, rows, found = _counted(sets.schema["id"].dataType)
    return (sets.mapInArrow(lambda batches: dealt(batches, blocks, least), rows)
            .groupBy("block").applyInArrow(counted, found))


def shared_shingles(sets: DataFrame) -> DataFrame:
    """(token, df): the shingles that two or more sets have, and how many have them."""
    listed = shared_places(sets).select(F.explode(F.arrays_zip("tokens", "df")).alias("x"))
    return cut_lineage(listed.select(F.col("x.tokens").alias("token"), "x.df").distinct())


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(id, size, lead, token, place, before): the places of each set's order that can
    start a link, ``place`` from 0, ``before`` the shingle one place earlier, ``lead``
    the smallest shingle that other sets have too."""
    kind = sets.schema["id"].dataType
    schema = Ty.StructType([Ty.StructField("id", kind), *(Ty.StructField(c, Ty.LongType()) for c in ("size", "lead", "token", "place", "before"))])

    def ordered(batch: pa.Table) -> pa.Table:
        ids, sizes, tokens, df, n, at = (batch[c].combine_chunks().flatten() for c in ("ids", "sizes", "tokens", "df", "n", "at"))
        sizes, tokens, df, n, at = (x.to_numpy(zero_copy_only=False) for x in (sizes, tokens, df, n, at))
        tokens, df = np.repeat(tokens, n), np.repeat(df, n)
        lead = np.full(len(sizes), np.iinfo(np.int64).max)
        np.minimum.at(lead, at, tokens)
        order = np.lexsort((tokens, df, at))
        tokens, at = tokens[order], at[order]
        shared = np.bincount(at, minlength=len(sizes))
        alone = sizes - shared
        nth = np.arange(len(at)) - (np.cumsum(shared) - shared)[at]
        take = sizes - _needed(sizes, percent) + 1 - alone
        keep = nth < take[at]
        before = pa.array(np.append(0, tokens[:-1])[keep] if len(tokens) else tokens, mask=(nth == 0)[keep])
        own = at[keep]
        return pa.table([ids.take(pa.array(own)), pa.array(sizes[own]), pa.array(lead[own]), pa.array(tokens[keep]), pa.array((alone[at] + nth)[keep]), before],
                        names=schema.names)

    return shared_places(sets).groupBy("batch").applyInArrow(ordered, schema)


def candidates(sets: DataFrame, percent: int, **skew_opts) -> DataFrame:
    """(a, b, lead_a, lead_b): pairs of ids, a of the smaller set, that pass the prefix,
    length and positional filters, and the leads of both (:func:`prefixes`)."""
    rows = cut_lineage(prefixes(sets, percent))
    left = rows.select("token", *[F.col(c).alias(f"{c}_a") for c in ("id", "size", "lead", "place", "before")])
    right = rows.select("token", *[F.col(c).alias(f"{c}_b") for c in ("id", "size", "lead", "place", "before")])
    met = skew.split_join(left, right, ["token"], "inner", **skew_opts)
    first = F.struct("size_a", "id_a") < F.struct("size_b", "id_b")
    length = F.col("size_a") * 100 >= F.col("size_b") * percent
    most = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))      # shingles that may still be shared
    enough = most * (100 + percent) >= (F.col("size_a") + F.col("size_b")) * percent
    new = F.col("before_a").isNull() | F.col("before_b").isNull() | (F.col("before_a") != F.col("before_b"))
    return met.filter(first & length & enough & new).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), "lead_a", "lead_b").distinct()


def _verified(percent: int):
    """A function of one cell's pairs and sets: those pairs that are similar enough."""
    def run(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        ids = sets["id"].combine_chunks()
        values = sets["set"].combine_chunks()
        codes = values.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        sizes = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        a, b = (pc.index_in(pairs[c], ids).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("a", "b"))
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        common = np.zeros(len(a), np.int64)
        mark = np.zeros(int(codes.max(initial=-1)) + 1, bool)
        cuts = np.concatenate(([0], np.nonzero(np.diff(a))[0] + 1, [len(a)])) if len(a) else np.zeros(1, np.int64)
        for low, high in zip(cuts[:-1], cuts[1:]):
            mine = codes[starts[a[low]]:starts[a[low] + 1]]
            mark[mine] = True
            for i in range(low, high):
                common[i] = np.count_nonzero(mark[codes[starts[b[i]]:starts[b[i] + 1]]])
            mark[mine] = False
        union = sizes[a] + sizes[b] - common
        keep = common * 100 >= union * percent
        low_id = ids.take(pa.array(a[keep]))
        high_id = ids.take(pa.array(b[keep]))
        return pa.table({"src": pc.min_element_wise(low_id, high_id), "dst": pc.max_element_wise(low_id, high_id),
                         "common": pa.array(common[keep]), "total": pa.array(union[keep])})
    return run


def cells(pairs: DataFrame) -> DataFrame:
    """(a, b, x, y): the pairs and their cells, so many that each gets about ``CELL``
    sets a side, whatever the number of documents in pairs. Sets of one lead, mostly
    near copies, share a side, unless they are more than ``CELL``: so a set goes to
    few cells, however many its near copies are."""
    ends = (pairs.select("a", F.col("lead_a").alias("lead")).unionByName(pairs.select(F.col("b").alias("a"), F.col("lead_b").alias("lead")))
            .distinct().groupBy("lead").agg(F.count(F.lit(1)).alias("n")))
    led = cut_lineage(ends.withColumn("parts", F.ceil(F.col("n") / CELL)))
    blocks = max(1, -(-(led.agg(F.sum("n")).first()[0] or 0) // CELL))
    large = led.filter("parts > 1")             # at most one for CELL documents
    dealt = pairs
    for c, at in (("a", "x"), ("b", "y")):
        parts = F.broadcast(large.select(F.col("lead").alias(f"lead_{c}"), F.col("parts").alias("parts")))
        part = F.coalesce(F.pmod(F.xxhash64(c), F.col("parts")), F.lit(0))
        dealt = (dealt.join(parts, f"lead_{c}", "left")
                 .withColumn(at, F.pmod(F.xxhash64(f"lead_{c}", part), F.lit(blocks))).drop("parts"))
    return dealt.select("a", "b", "x", "y")


def similar_pairs(sets: DataFrame, percent: int = 80, **skew_opts) -> DataFrame:
    """(src, dst, common, total): every pair of ``sets`` whose similarity
    common / total is at least ``percent`` / 100; src is the smaller id."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be in 1..100")
    pairs = cut_lineage(candidates(sets, percent, **skew_opts))
    dealt = cells(pairs)
    wanted = dealt.select("x", "y", F.explode(F.array("a", "b")).alias("id")).distinct()
    sent = (skew.split_join(wanted, sets.select("id", "set"), ["id"], "inner", **skew_opts)
            .select(F.col("x").alias("to_x"), F.col("y").alias("to_y"), "id", "set"))
    kind = pairs.schema["a"].dataType
    schema = Ty.StructType([Ty.StructField("src", kind), Ty.StructField("dst", kind),
                            Ty.StructField("common", Ty.LongType()), Ty.StructField("total", Ty.LongType())])
    return cut_lineage(dealt.groupBy("x", "y").cogroup(sent.groupBy("to_x", "to_y")).applyInArrow(
        lambda p, s: _verified(percent)(p.select(["a", "b"]), s.select(["id", "set"])), schema))


def similar_documents(df: DataFrame, ngrams: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **skew_opts) -> DataFrame:
    """One row a document: ``id_col``, ``class_id`` and ``n_links``, the number of
    other documents (copies included) that are similar enough."""
    known = classes(df, ngrams, id_col, text_col)
    pairs = similar_pairs(known.sets, percent, **skew_opts)
    both = pairs.select("src", "dst").unionByName(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    weight = known.sets.select(F.col("id").alias("dst"), "n")
    others = (skew.split_join(both, weight, ["dst"], "inner", **skew_opts).groupBy(F.col("src").alias("class_id")).agg(F.sum("n").alias("others")))
    links = (known.sets.select(F.col("id").alias("class_id"), "n").join(others, "class_id", "left")
             .select("class_id", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "n"))
    out = skew.split_join(known.members, links.select("class_id", "n_links"), ["class_id"], "left", key_counts=links, **skew_opts)
    return out.select(F.col("id").alias(id_col), "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def similarity_dedup(df: DataFrame, ngrams: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **skew_opts) -> DataFrame:
    """Rows of ``df`` whose id is the smallest of its component of similar documents."""
    known = classes(df, ngrams, id_col, text_col)
    linked = CC.connected_components(similar_pairs(known.sets, percent, **skew_opts).select("src", "dst"))
    gone = (known.members.filter(F.col("id") != F.col("class_id")).select("id")
            .unionByName(linked.filter(F.col("vertex") != F.col("component")).select(F.col("vertex").alias("id"))))
    return df.join(gone.withColumnRenamed("id", id_col), id_col, "left_anti")


def lsh_recall(df: DataFrame, params: minhash.MinHashParams, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row: ``n_pairs`` similar pairs of classes, and ``n_found`` of them
    whose documents share a bucket under ``params``."""
    known = classes(df, params.ngrams, id_col, text_col)
    pairs = similar_pairs(known.sets, percent).select("src", "dst")
    texts = df.join(known.sets.select(F.col("id").alias(id_col)), id_col, "left_semi").dropDuplicates([id_col])
    bands = cut_lineage(minhash.lsh_bands(minhash.signatures(texts, params, id_col, text_col), params, id_col)
                        .select(F.col(id_col).alias("id"), F.xxhash64("band", "key").alias("bucket")))
    # a pair is found if any band agrees: both ends' buckets, side by side
    own = bands.groupBy("id").agg(F.collect_list("bucket").alias("buckets"))          # one document's bands
    src, dst = (own.select(F.col("id").alias(c), F.col("buckets").alias(f"b_{c}")) for c in ("src", "dst"))
    met = skew.split_join(skew.split_join(pairs, src, ["src"], "left"), dst, ["dst"], "left")
    return met.agg(F.count(F.lit(1)).alias("n_pairs"),
                   F.coalesce(F.sum(F.arrays_overlap("b_src", "b_dst").cast("long")), F.lit(0)).alias("n_found"))
