"""Dedup and upsert.

``latest_per_key`` is an aggregation (max of an ordered struct), not a window:
copies of a hot key collapse inside each map task before the shuffle, so a key
holding a third of all rows never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                   descending: bool = True) -> DataFrame:
    """One row per key: the greatest (or least) by ``order_by``, remaining columns as tie-break."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = F.struct(*[F.col(c) for c in list(order_by) + rest]).alias("_row")
    pick = F.max(packed) if descending else F.min(packed)
    agg = df.groupBy(*keys).agg(pick.alias("_row"))
    return agg.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in df.columns if c not in keys]).select(*df.columns)


def new_keys(rows: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key is not stored yet; null parts of a key compare as equal."""
    there = stored.select(*[F.col(k).alias(f"_stored_{k}") for k in keys])
    same = [rows[k].eqNullSafe(there[f"_stored_{k}"]) for k in keys]
    return rows.join(there, same, "left_anti")


def new_keys_in_place(rows: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``new_keys`` for a cached result of ``latest_per_key``: plain equality fits the layout that its rows have by key, so only
    the stored keys are shuffled and sorted, and never broadcast; rows with a null part in their key are compared by ``new_keys``."""
    full = F.lit(True)
    for k in keys:
        full = full & F.col(k).isNotNull()
    there = stored.filter(full).select(*[F.col(k).alias(f"_stored_{k}") for k in keys]).hint("merge")
    known = rows.filter(full)
    fresh = known.join(there, [known[k] == there[f"_stored_{k}"] for k in keys], "left_anti")
    return fresh.unionByName(new_keys(rows.filter(~full), stored.filter(~full), keys))


def upsert_new(existing: DataFrame | None, new: DataFrame, keys: Sequence[str],
               order_by: Sequence[str] | None = None) -> DataFrame:
    """Existing rows kept; new keys appended once. A missing target means 'create'."""
    keys = list(keys)
    incoming = latest_per_key(new, keys, order_by or [c for c in new.columns if c not in keys][:1])
    if existing is None:
        return incoming
    fresh = incoming.join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail the job if ``keys`` repeat (guards a dimension before a fact join).

    One aggregate; the check runs when called, before the join is planned.
    """
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"dimension key {list(keys)} is not unique")
    return df
