"""Joins that stay balanced when one key holds a large share of the rows.

A sort-merge join sends every row of a key to one task. When a key is hot
(a boilerplate bucket, a hub vertex holding a third of the graph) that task
gets a third of the data. :func:`split_join` finds the hot keys from a count
table (which callers usually already have, e.g. bucket sizes or degrees),
checks how many there are, and then

* ``n_hot == 0``: plain join;
* ``n_hot <= max_broadcast_keys``: joins the hot rows against a broadcast of
  the hot keys' partners (a proven bound: at most ``max_broadcast_keys``
  keys, and the partner side is counted before it is broadcast) and the
  rest with an ordinary shuffle join;
* otherwise: salts the hot rows over ``salts`` sub-keys and replicates only
  the hot partners ``salts`` times, so no task receives a whole hot key.

All three produce the same rows. AQE's skew-join split remains on as a
second line of defence for joins not routed through here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grist.session import cut_lineage

DEFAULT_HOT_ROWS = 1 << 17          # rows per key above which a key is hot
DEFAULT_MAX_BROADCAST_KEYS = 1 << 16
DEFAULT_MAX_BROADCAST_ROWS = 1 << 20
DEFAULT_SALTS = 64


def hot_keys(key_counts: DataFrame, keys: Sequence[str], count_col: str,
             hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Keys whose row count reaches ``hot_rows``; written to the checkpoint
    folder so later rounds reuse it without recomputation."""
    hot = key_counts.filter(F.col(count_col) >= hot_rows).select(*keys).distinct()
    return cut_lineage(hot)


def split_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner",
               hot: DataFrame | None = None, key_counts: DataFrame | None = None,
               count_col: str = "n", hot_rows: int = DEFAULT_HOT_ROWS,
               max_broadcast_keys: int = DEFAULT_MAX_BROADCAST_KEYS,
               max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
               salts: int = DEFAULT_SALTS) -> DataFrame:
    """``big.join(small, keys, how)`` with hot keys of ``big`` split off.

    ``how`` must preserve ``big`` (inner, left, left_semi, left_anti).
    Pass ``hot`` (a key table) or ``key_counts`` (keys + ``count_col``); if
    neither is given the counts are aggregated from ``big`` (partial
    aggregation, so the count itself is skew-proof).
    """
    keys = list(keys)
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"split_join keeps the big side; unsupported how={how!r}")
    if hot is None:
        if key_counts is None:
            key_counts = big.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
        hot = hot_keys(key_counts, keys, count_col, hot_rows)
    n_hot = hot.count()
    if n_hot == 0:
        return big.join(small, keys, how)

    small_hot = small.join(_bcast_or_plain(hot, n_hot, max_broadcast_keys), keys, "left_semi")
    small_cold = small.join(_bcast_or_plain(hot, n_hot, max_broadcast_keys), keys, "left_anti")
    if n_hot <= max_broadcast_keys:
        big_hot = big.join(F.broadcast(hot), keys, "left_semi")
        big_cold = big.join(F.broadcast(hot), keys, "left_anti")
        n_small_hot = small_hot.count()
        if n_small_hot <= max_broadcast_rows:
            hot_part = big_hot.join(F.broadcast(small_hot), keys, how)
        else:
            hot_part = _salted(big_hot, small_hot, keys, how, salts)
        cold_part = big_cold.join(small_cold, keys, how)
        return hot_part.unionByName(cold_part)
    # Too many hot keys to broadcast even the key list: salt every row of big
    # against partners replicated per salt. Balanced, at the cost of copying
    # the partner side ``salts`` times.
    return _salted(big, small, keys, how, salts)


def _bcast_or_plain(df: DataFrame, n: int, limit: int) -> DataFrame:
    return F.broadcast(df) if n <= limit else df


def _salted(big: DataFrame, small: DataFrame, keys: list[str], how: str, salts: int) -> DataFrame:
    salt = "_salt"
    spread = big.withColumn(salt, F.pmod(F.xxhash64(*big.columns), F.lit(salts)))
    copies = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, keys + [salt], how).drop(salt)
