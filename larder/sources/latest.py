"""The latest row of each key of rows in parquet files, found without moving whole rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.merge import all_given
from larder.sources.files import remove_folder
from larder.sources.shared import broadcast_if_small, scratch_path

# Rows whose bits Spark's bitmap functions put into one value of 4 KB, and how many of these are broadcast at most (64 MB).
BITMAP_ROWS = 32_768
BITMAPS_BROADCAST = 16_384
WHERE = ("_file", "_at")


def located(df: DataFrame) -> DataFrame:
    """``df``, read from parquet files, with the file and the place in it that each row comes from."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))


@contextmanager
def written_once(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written to the shared folder, read back and ``located``; the folder is removed in the end."""
    spark = df.sparkSession
    path = scratch_path(spark, "rows")
    df.write.option("compression", "zstd").parquet(path)
    try:
        yield located(spark.read.schema(df.schema).parquet(path))
    finally:
        remove_folder(spark, path)


def latest_located(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``latest_per_key`` of ``located`` rows.

    Only keys, order, a hash and the place of each row are shuffled. The places of the rows that stay become bitmaps, one bit for each
    row of a file, computed here and now; whole rows are then filtered where they are read, without a shuffle or a sort.
    Beyond ``BITMAPS_BROADCAST`` bitmaps Spark joins them by a shuffle.
    """
    names = [f"`{name}`" for name in rows.columns if name not in WHERE]
    has_key = all_given(keys)
    ranked = rows.where(has_key).select(
        F.struct(*WHERE).alias("at"),
        F.struct(*(F.col(f"`{name}`").alias(f"o{i}") for i, name in enumerate(order)), F.xxhash64(*names).alias("tie")).alias("order"),
        *(F.col(f"`{key}`").alias(f"k{i}") for i, key in enumerate(keys)),
    )
    best = ranked.groupBy(*(f"k{i}" for i in range(len(keys)))).agg(F.max_by("at", "order").alias("at")).select("at.*")
    bucket = F.expr(f"_at div {BITMAP_ROWS}").alias("_bucket")
    bits = best.groupBy("_file", bucket).agg(F.bitmap_construct_agg(F.col("_at") % BITMAP_ROWS).alias("_bits"))
    bits = broadcast_if_small(bits, BITMAPS_BROADCAST)
    stays = F.expr(
        f"getbit(cast(conv(hex(substring(_bits, cast(_at % {BITMAP_ROWS} div 8 as int) + 1, 1)), 16, 10) as int), cast(_at % 8 as int)) = 1"
    )
    joined = rows.withColumn("_bucket", bucket).join(bits, ["_file", "_bucket"], "left")
    return joined.where(~has_key | F.coalesce(stays, F.lit(False))).select(*names, *WHERE)


@contextmanager
def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> Iterator[DataFrame]:
    """``latest_per_key`` of ``df``, which is computed once; to be used up inside the ``with``."""
    with written_once(df) as rows:
        yield latest_located(rows, keys, order).select(*(f"`{name}`" for name in df.columns))
