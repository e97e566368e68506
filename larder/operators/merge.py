"""Rows that replace one another by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_given(keys: Sequence[str]) -> Column:
    """Whether a row has a key: no part of it is NULL."""
    has_key = F.lit(True)
    for key in keys:
        has_key &= F.col(f"`{key}`").isNotNull()
    return has_key


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """For each value of ``keys`` the row that is greatest by ``order``, NULL being least; rows without a key all stay.

    Rows that are alike in ``order`` are told apart by a hash of all their columns, so the same rows give the same result.
    Each task keeps one row of a key before the shuffle, so a key that holds most rows costs no task more than a row from
    each other one. Whole rows are shuffled and sorted; for wide rows ``larder.sources.latest`` moves only keys.
    """
    has_key = all_given(keys)
    names = [f"`{name}`" for name in df.columns]
    ranked = df.where(has_key).select(
        F.struct(*names).alias("row"),
        F.struct(*(F.col(f"`{name}`").alias(f"o{i}") for i, name in enumerate(order)), F.xxhash64(*names).alias("tie")).alias("order"),
        *(F.col(f"`{key}`").alias(f"k{i}") for i, key in enumerate(keys)),
    )
    best = ranked.groupBy(*(f"k{i}" for i in range(len(keys)))).agg(F.max_by("row", "order").alias("row"))
    return best.select("row.*").unionByName(df.where(~has_key))
