"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from grist.session import BYTES_PER_BATCH, ROWS_PER_BATCH, materialize, release_memory  # noqa: F401

#: A word, everywhere in this subpackage: a maximal run of characters other
#: than the six ASCII blanks. ``bytes.split()`` splits at exactly these six.
WORD = r"[^\x20\x09-\x0D]+"


def tune(spark: SparkSession) -> None:
    """Arrow batches of at most ``ROWS_PER_BATCH`` rows and ``BYTES_PER_BATCH`` bytes, so
    that a batch of long documents stays small beside an executor's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A whole table of ``sf_dir``, narrowed to ``columns``."""
    tune(spark)
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return table.select(*columns) if columns else table


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(text: Column) -> Column:
    """128 bits that stand for a text where the id alone may repeat."""
    body = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(body).alias("a"), F.xxhash64(F.lit("second"), body).alias("b"))


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """``wanted`` names, each with underscores put before it until ``df`` has
    no column of that name (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


FILTER_BITS = 1 << 25


def key_filter(keys: DataFrame, column: str):
    """A predicate over 64-bit keys that is true for every key of ``keys`` and
    for few others: a Bloom filter of a fixed 4 MB, so its size never follows
    the data. With far more keys than bits it lets everything pass; callers
    join afterwards, so it only saves shuffling rows that can't match.
    """
    def places(c: str) -> Column:                # three places of 25 bits
        return F.array(*[F.shiftrightunsigned(F.xxhash64(F.lit(i), F.col(c)), 39) for i in range(3)])

    bits = (keys.select(F.explode(places(column)).alias("bit"))
            .groupBy(F.shiftright("bit", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")))
    table = np.zeros(FILTER_BITS >> 6, np.uint64)
    found = bits.toArrow()                       # at most FILTER_BITS / 64 rows
    table[found["word"].to_numpy().astype(np.int64)] = found["bits"].to_numpy().astype(np.int64).view(np.uint64)
    shared = keys.sparkSession.sparkContext.broadcast(table.tobytes())

    @F.arrow_udf(BooleanType())
    def passes(bit: pa.Array) -> pa.Array:
        words = np.frombuffer(shared.value, np.uint64)
        at = bit.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        hit = (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
        return pa.array(hit.reshape(-1, 3).all(axis=1))

    return lambda c: passes(places(c))
