"""Vocabulary, encoding, packing and window sampling of token ids.

The reference encodes with a fixed byte-pair table, without loss. Here the
vocabulary is built from the corpus: a text is cut into runs of blanks and runs
of other characters, ``<eos>`` is 0, the 256 bytes follow, then the most
frequent runs (ties by run). A run outside the vocabulary becomes its UTF-8
bytes, so every text comes back whole, and ids fit the uint16 stream that the
reference writes.

* build: partially aggregated counts, then a bounded top-k (TakeOrderedAndProject);
* encode and decode: narrow, by an Arrow UDF with the broadcast vocabulary (at
  most 65,536 rows, a proven bound); texts never move;
* pack: document offsets from :func:`grist.operators.ordering.prefix_sum`
  (no single-partition window), then each document is cut where sequences begin
  and one piece per (document, sequence) is shuffled.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from grist.functions import text as T
from grist.operators import ordering
from grist.session import cut_lineage, release_memory

EOS, EOS_TOKEN = 0, "<eos>"
FIRST_BYTE, FIRST_RUN = 1, 257
MAX_VOCAB = 1 << 16
CONTEXT = 512
TOKEN_PATTERN = "[" + T.WS_CLASS_BODY + "]+|[^" + T.WS_CLASS_BODY + "]+"
# the same for Python, which writes code points in another way
RUNS = re.compile(re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: f"\\u{int(m[1], 16):04x}", TOKEN_PATTERN))


def tokens(text) -> F.Column:
    """Runs of blanks and of other characters, in order: the whole text."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 0)


def runs_of(texts: pa.Array) -> pa.Array:
    """:func:`tokens` of a batch, where it is needed within a worker."""
    return pa.array([None if t is None else RUNS.findall(t) for t in texts.to_pylist()], pa.list_(pa.string()))


def run_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, n): each task counts its batches' runs, then the counts are added."""
    def count(batches):
        for batch in batches:
            found = runs_of(batch.column(0)).flatten().value_counts()
            yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], names=["token", "n"])
            release_memory()

    return df.select(text_col).mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def byte_name(b: int) -> str:
    return f"<0x{b:02X}>"


def build_vocab(df: DataFrame, text_col: str = "text", size: int = MAX_VOCAB) -> DataFrame:
    """``(token, id)``: ``<eos>``, the bytes, then runs by (count desc, run).
    Ids from ``FIRST_RUN`` on are runs, whatever they look like."""
    if not FIRST_RUN < size <= MAX_VOCAB:
        raise ValueError(f"vocabulary size must be in [{FIRST_RUN + 1}, {MAX_VOCAB}]")
    top = run_counts(df, text_col).orderBy(F.desc("n"), F.asc("token")).limit(size - FIRST_RUN)
    # at most size - FIRST_RUN rows: numbering them in one window is bounded work
    ranked = top.withColumn("id", (F.row_number().over(
        Window.orderBy(F.desc("n"), F.asc("token"))) + FIRST_RUN - 1).cast("int")).select("token", "id")
    fixed = df.sparkSession.createDataFrame(
        [(EOS_TOKEN, EOS)] + [(byte_name(b), FIRST_BYTE + b) for b in range(256)], "token string, id int")
    return cut_lineage(fixed.unionByName(ranked))


def _shared(vocab: DataFrame):
    """Broadcast bytes by id; the vocabulary has at most ``MAX_VOCAB`` rows."""
    rows = vocab.filter(F.col("id") >= FIRST_RUN).orderBy("id").collect()
    known = [EOS_TOKEN.encode(), *(bytes([b]) for b in range(256)), *(r["token"].encode() for r in rows)]
    return vocab.sparkSession.sparkContext.broadcast(known)


_LAST: list = [None, None]          # of a worker: the vocabulary that it used last, and its ids by run


def _ids_by_run(known: list[bytes]) -> dict[bytes, int]:
    if _LAST[0] is not known:
        _LAST[:] = known, {b: i for i, b in enumerate(known) if i >= FIRST_RUN}
    return _LAST[1]


def ids_of(runs: pa.Array, table: dict[bytes, int], end: list[int]) -> pa.Array:
    """Ids of each list of runs, then ``end``; each distinct run is looked up once."""
    sizes = pc.fill_null(pc.list_value_length(runs), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = runs.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    found = []
    for run in coded.dictionary.cast(pa.binary()).to_pylist():
        i = table.get(run)
        found.append([i] if i is not None else [FIRST_BYTE + b for b in run])
    found.append(end)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    flat = np.fromiter((i for own in found for i in own), np.int32, lengths.sum())
    # the runs of each document, and after them its end
    code = np.insert(code, np.cumsum(sizes), len(found) - 1)
    starts, n = (np.cumsum(lengths) - lengths)[code], lengths[code]
    place = np.arange(n.sum()) + np.repeat(starts - (np.cumsum(n) - n), n)
    per_row = np.add.reduceat(n, np.cumsum(sizes + 1) - (sizes + 1)) if len(sizes) else np.zeros(0, np.int64)
    offsets = np.concatenate(([0], np.cumsum(per_row))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[place], pa.int32()))


def encode(df: DataFrame, vocab: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           add_eos: bool = True) -> DataFrame:
    """``(id, ids array<int>)``: token ids in order, then ``<eos>`` (null text: no tokens)."""
    shared = _shared(vocab)
    end = [EOS] if add_eos else []

    @F.arrow_udf(Ty.ArrayType(Ty.IntegerType()))
    def ids(texts: pa.Array) -> pa.Array:
        release_memory()
        return ids_of(runs_of(texts), _ids_by_run(shared.value), end)

    return df.select(id_col, ids.asNondeterministic()(F.col(text_col)).alias("ids"))


def token_count(encoded: DataFrame) -> DataFrame:
    return encoded.agg(F.sum(F.size("ids")).cast("bigint").alias("n_tokens"))


def check_uint16(encoded: DataFrame) -> DataFrame:
    """Fails the job if an id does not fit the uint16 stream."""
    bad = F.exists("ids", lambda x: (x < 0) | (x > 65535))
    return encoded.withColumn("_ok", F.assert_true(~bad)).drop("_ok")


def pack(encoded: DataFrame, id_col: str = "doc_id", ctx: int = CONTEXT) -> DataFrame:
    """``(seq, ids)``: all documents concatenated in id order, cut every ``ctx``.

    Ids are read by the offsets and by the pieces, so they are written once."""
    encoded = cut_lineage(encoded.select(id_col, "ids"))
    lens = encoded.select(id_col, F.size("ids").cast("bigint").alias("_n"))
    offs = ordering.prefix_sum(lens, [id_col], "_n", "_off").select(id_col, "_off")
    placed = encoded.join(offs, id_col).filter(F.size("ids") > 0)
    end = F.col("_off") + F.size("ids")
    pieces = placed.select("_off", "ids", end.alias("_end"), F.explode(F.sequence(
        F.floor(F.col("_off") / ctx).cast("bigint"), F.floor((end - 1) / ctx).cast("bigint"))).alias("seq"))
    start = F.greatest(F.col("seq") * ctx, F.col("_off"))
    stop = F.least((F.col("seq") + 1) * ctx, F.col("_end"))
    pieces = pieces.select("seq", start.alias("at"), F.slice(
        "ids", (start - F.col("_off") + 1).cast("int"), (stop - start).cast("int")).alias("piece"))
    agg = pieces.groupBy("seq").agg(F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("_p"))
    return agg.select("seq", F.flatten(F.transform("_p", lambda p: p["piece"])).alias("ids"))


def decode_bytes(encoded: DataFrame, vocab: DataFrame, out: str = "bytes") -> DataFrame:
    """``encoded`` with ``out`` in place of ``ids``: the bytes that they stand for."""
    shared = _shared(vocab)

    @F.arrow_udf(Ty.BinaryType())
    def run(ids: pa.Array) -> pa.Array:
        release_memory()
        known = shared.value
        return pa.array([b"".join([known[i] for i in own or ()]) for own in ids.to_pylist()], pa.binary())

    return encoded.select(*[c for c in encoded.columns if c != "ids"], run(F.col("ids")).alias(out))


def decode(encoded: DataFrame, vocab: DataFrame) -> DataFrame:
    """Ids mapped back to ``text``. A packed sequence may begin or end within a
    character, which then shows as U+FFFD; a document's own ids give its text."""
    return decode_bytes(encoded, vocab, "text").withColumn("text", F.make_valid_utf8(F.col("text").cast("string")))


def draw_starts(spark, n_tokens: int, batch: int, ctx: int, seed: int = 0) -> DataFrame:
    """``(draw, start)``: ``batch`` starts uniform in ``[0, n_tokens - ctx)``,
    with replacement, from a hash of ``seed:draw`` (same in any engine)."""
    if n_tokens <= ctx:
        raise ValueError("need more tokens than the context length")
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"))), 1, 12),
               16, 10).cast("bigint")
    return spark.range(batch).select(F.col("id").alias("draw"),
                                     F.pmod(h, F.lit(n_tokens - ctx)).alias("start"))


def sample_windows(packed: DataFrame, draws: DataFrame, ctx: int, seq_len: int = CONTEXT
                   ) -> DataFrame:
    """R2: ``(draw, start, x, y)`` with ``y`` = ``x`` shifted by one token.

    ``ctx <= seq_len`` so a window (``ctx + 1`` ids) spans at most two packed
    sequences; each draw fetches those two by an equi-join on ``seq``. The
    draws table has ``batch`` rows (a parameter), so it is broadcast.
    """
    if ctx > seq_len:
        raise ValueError("context longer than a packed sequence")
    first = F.floor(F.col("start") / seq_len).cast("bigint")
    need = draws.select("draw", "start", F.explode(F.array(first, first + 1)).alias("seq"))
    got = packed.join(F.broadcast(need), "seq")
    agg = got.groupBy("draw", "start").agg(
        F.array_sort(F.collect_list(F.struct("seq", "ids"))).alias("_p"))
    flat = F.flatten(F.transform("_p", lambda p: p["ids"]))
    local = (F.col("start") - F.floor(F.col("start") / seq_len) * seq_len + 1).cast("int")
    agg = agg.select("draw", "start", flat.alias("_f"), local.alias("_o"))
    return agg.select("draw", "start", F.slice("_f", F.col("_o"), ctx).alias("x"),
                      F.slice("_f", F.col("_o") + 1, ctx).alias("y"))
