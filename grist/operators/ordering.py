"""Global running sums without a single-partition window.

``sum(w) over (order by k)`` with no ``partition by`` moves every row to one
task. :func:`prefix_sum` instead

1. range-partitions the rows by the order key and sorts within partitions
   (a distributed sort), tags each row with its partition id and writes the
   result to the checkpoint folder, so both passes below see identical
   partitions even after an executor is lost;
2. sums the weights per partition — one row per partition, a bounded
   table — and turns them into partition start offsets on the driver;
3. adds each partition's start to a local running sum inside an
   Arrow-batched ``mapInPandas`` (rows arrive in sorted order).

The order key must be unique (add the id as the last key).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from grist.session import cut_lineage

PID = "_pid"


def prefix_sum(df: DataFrame, order_cols: Sequence[str], weight_col: str | None = None,
               out: str = "offset", partitions: int | None = None) -> DataFrame:
    """Adds ``out`` = sum of weights of all rows strictly before this row in
    ``order_cols`` order (weight 1 when ``weight_col`` is None: the 0-based rank)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    w = weight_col or "_w1"
    if weight_col is None:
        df = df.withColumn(w, F.lit(1).cast("bigint"))
    ranged = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn(PID, F.spark_partition_id()))
    ranged = cut_lineage(ranged)
    totals = {r[PID]: r["t"] for r in
              ranged.groupBy(PID).agg(F.sum(w).alias("t")).collect()}  # one row per partition
    starts, acc = {}, 0
    for pid in sorted(totals):
        starts[pid] = acc
        acc += int(totals[pid] or 0)

    schema = Ty.StructType(ranged.schema.fields + [Ty.StructField(out, Ty.LongType(), False)])

    def running(batches):
        carry = None
        for pdf in batches:
            if pdf.empty:
                continue
            pid = int(pdf[PID].iloc[0])
            if carry is None:
                carry = starts.get(pid, 0)
            weights = pdf[w].fillna(0).astype(np.int64).to_numpy()
            csum = np.cumsum(weights)
            pdf[out] = carry + csum - weights
            carry = carry + int(csum[-1])
            yield pdf

    # sortWithinPartitions survives the checkpoint read; keep it explicit
    result = ranged.sortWithinPartitions(*order_cols).mapInPandas(running, schema)
    result = result.drop(PID)
    if weight_col is None:
        result = result.drop(w)
    return result


def rank_within(df: DataFrame, group_col: str, order_cols: Sequence[str],
                out: str = "rn") -> DataFrame:
    """1-based rank inside each ``group_col`` value, computed as a global rank
    over ``(group, order...)`` minus the group's start (group sizes are one
    row per group, a small table)."""
    ranked = prefix_sum(df, [group_col, *order_cols], None, "_g")
    starts = ranked.groupBy(group_col).agg(F.min("_g").alias("_s"))
    return (ranked.join(F.broadcast(starts), group_col)
            .withColumn(out, F.col("_g") - F.col("_s") + 1).drop("_g", "_s"))


TOP_K_DIRECT = 100_000


def first_k(df: DataFrame, order_cols: Sequence, k: int) -> DataFrame:
    """The first ``k`` rows in ``order_cols`` order (unique key).

    A small ``k`` uses ``orderBy().limit()`` (each task keeps its own top k,
    then one merge of at most ``tasks * k`` rows). A ``k`` that grows with the
    data would pile those rows into one task, so it is answered with the
    distributed rank of :func:`prefix_sum` instead.
    """
    if k <= TOP_K_DIRECT:
        return df.orderBy(*order_cols).limit(k)
    names = []
    keyed = df
    for i, c in enumerate(order_cols):
        if isinstance(c, str):
            names.append(c)
        else:
            keyed = keyed.withColumn(f"_k{i}", c)
            names.append(f"_k{i}")
    ranked = prefix_sum(keyed, names, None, "_rank")
    return ranked.filter(F.col("_rank") < k).drop("_rank", *[n for n in names if n.startswith("_k")])
