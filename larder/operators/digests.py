"""Digests of groups of rows, by which two tables are compared without joining their rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _parts(field: T.StructField) -> T.DataType:
    """The type of a column's values, or of those inside its arrays."""
    return field.dataType.elementType if isinstance(field.dataType, T.ArrayType) else field.dataType


def can_digest(schema: T.StructType) -> bool:
    """Whether all columns are plain values or arrays of those."""
    return not any(isinstance(_parts(field), (T.ArrayType, T.MapType, T.StructType, T.VariantType)) for field in schema)


def _hashed(schema: T.StructType) -> Iterator[Column]:
    """What a row's hash is made of. Hashing passes over NULLs and joins arrays, so both are told apart by values of their own."""
    for field in schema:
        column = F.col(f"`{field.name}`")
        if not can_digest(T.StructType([field])):
            raise ValueError(f"{field.name} is neither a plain value nor an array of plain values")
        yield column
        yield column.isNull()
        if isinstance(field.dataType, T.ArrayType):
            yield F.size(column)
            yield F.transform(column, F.isnull)


def group_digests(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """For each value of ``by`` the number of rows, ``rows``, and the sums of two 64-bit hashes of them, ``sum1`` and ``sum2``.

    Groups with the same rows, each as often, have the same digest, in whatever order and files the rows are; others have another
    one but for collisions of both hashes. Sums are exact and leave each task as one row per group, so a group that holds most
    rows costs no task more than another. Columns are plain values or arrays of those; names are compared by position, so
    select them first. An empty table has no groups.
    """
    parts = list(_hashed(df.schema))
    # Decimals hold the sum of 10^10 rows without overflow.
    sums = [F.sum(F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)")).alias(f"sum{seed}") for seed in (1, 2)]
    return df.groupBy(*by).agg(F.count("*").alias("rows"), *sums)


def differing_groups(new: DataFrame, old: DataFrame, by: Sequence[str]) -> DataFrame:
    """The groups of ``new`` whose rows are not those of ``old``: ``by``, ``rows`` and ``old_rows``, which is 0 for new groups.

    Groups that only ``old`` has are left out. NULL is a group like any other.
    """
    ours, theirs = group_digests(new, by), group_digests(old.select(*new.columns), by)
    tagged = ours.withColumn("new", F.lit(True)).unionByName(theirs.withColumn("new", F.lit(False)))

    def of(side: bool, name: str) -> Column:
        return F.max(F.when(F.col("new") == side, F.col(name)))

    both = tagged.groupBy(*by).agg(
        of(True, "rows").alias("rows"),
        F.coalesce(of(False, "rows"), F.lit(0)).alias("old_rows"),
        *(of(True, name).eqNullSafe(of(False, name)).alias(f"same_{name}") for name in ("rows", "sum1", "sum2")),
    )
    changed = F.col("rows").isNotNull() & ~(F.col("same_rows") & F.col("same_sum1") & F.col("same_sum2"))
    return both.where(changed).select(*by, "rows", "old_rows")
