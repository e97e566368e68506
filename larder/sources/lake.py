"""Partitioned parquet tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.digests import can_digest, differing_groups
from larder.sources.files import listed_files, remove_folder, subfolders
from larder.sources.latest import WHERE, latest_located, located, written_once
from larder.sources.shared import broadcast_if_small

# Fewest shuffle partitions for arranging a table: above the number of months it usually holds, so
# that they rarely share one. Adaptive execution merges the small ones.
MONTHS_APART = 512


def read_lake(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet table under a known schema; partition columns come from folder names."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def arrange(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Brings the rows of a partition together without overloading a task.

    With adaptive execution Spark splits partitions beyond
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` and merges tiny ones, whatever share of the
    rows one month holds. Otherwise each partition is spread over all shuffle tasks by the input
    split a row came from, which also spreads equal rows and is the same on a retry, but leaves
    more and smaller files.
    """
    conf = df.sparkSession.conf
    shuffled = int(conf.get("spark.sql.shuffle.partitions"))
    if (
        conf.get("spark.sql.adaptive.enabled") == "true"
        and conf.get("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled") == "true"
    ):
        return df.hint("rebalance", max(shuffled, MONTHS_APART), *partition_by)
    spread = F.spark_partition_id() % shuffled
    return df.withColumn("_spread", spread).repartition(*partition_by, "_spread").drop("_spread")


def _has_runs(spark: SparkSession, path: str) -> bool | None:
    """Whether the folders of a table begin with ``run_id``; None where there is no table yet."""
    folders = [name for name in subfolders(spark, path) if "=" in name]
    return folders[0].startswith("run_id=") if folders else None


def write_lake(
    df: DataFrame,
    path: str,
    mode: str,
    partition_by: Sequence[str] = ("year", "month"),
    run_id: int | None = None,
    clustered: bool = False,
    observe: Column | None = None,
    sort_by: Sequence[str] = (),
    **options: str,
) -> str | None:
    """Writes a partitioned table; returns the value of ``observe`` over the rows written.

    ``mode`` is ``overwrite`` (the whole table), ``append``, or ``replace``: only the partitions that
    ``df`` has rows of. With ``run_id`` the table gets a leading ``run_id`` partition, and appending replaces
    what an earlier attempt of the same run left behind; a table written without one cannot take such
    rows, nor the other way round, and ``ValueError`` is raised before anything is written. ``clustered`` skips
    the shuffle for input that already arrives by partition.

    ``observe`` is an aggregate such as ``max``, computed while writing. It must not change when
    rows are seen twice, because a lost executor's tasks run again.

    ``sort_by`` orders the rows of each file, so that the least and greatest values which parquet keeps of every row group
    let readers pass over groups inside a month. Tasks sort what they write anyway by partition, so it adds no
    shuffle and no second sort. Other ``options`` go to the writer, such as ``parquet.block.size``, the bytes of a row group.
    """
    folders = list(partition_by)
    if mode == "replace" and run_id is not None:
        raise ValueError("partitions staged by run cannot be replaced")
    if mode != "overwrite" and _has_runs(df.sparkSession, path) == (run_id is None):
        raise ValueError(f"{path} was written {'without' if run_id is not None else 'with'} a run_id partition")
    arranged = df if clustered else arrange(df, folders)
    if run_id is not None and mode == "append":
        path, mode = f"{path.rstrip('/')}/run_id={run_id}", "overwrite"
    elif run_id is not None:
        arranged = arranged.withColumn("run_id", F.lit(run_id).cast("bigint"))
        folders = ["run_id", *folders]
    # Observed after the shuffle: adaptive execution drops the plan below an empty shuffle.
    seen = None
    if observe is not None:
        seen = Observation()
        arranged = arranged.observe(seen, observe.cast("string").alias("value"))
    if sort_by:
        arranged = arranged.sortWithinPartitions(*folders, *sort_by)
    # Said here, so that what is replaced does not hang on the session's setting.
    writer = arranged.write.options(**options).option("partitionOverwriteMode", "dynamic" if mode == "replace" else "static")
    writer.mode("overwrite" if mode == "replace" else mode).partitionBy(*folders).parquet(path)
    return seen.get["value"] if seen else None


def in_partitions(partitions: Sequence[Row | Mapping], partition_by: Sequence[str]) -> Column:
    """Whether a row is in one of ``partitions``; only their folders are read."""
    inside = F.lit(False)
    for row in partitions:
        same = F.lit(True)
        for name in partition_by:
            same &= F.col(name).isNull() if row[name] is None else F.col(name) == row[name]
        inside |= same
    return inside


def merge_lake(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    order: Sequence[str],
    partition_by: Sequence[str] = ("year", "month"),
    observe: Column | None = None,
    sort_by: Sequence[str] = (),
) -> str | None:
    """Puts ``df`` into a partitioned table, where rows of the same ``keys`` replace one another; returns ``observe`` over
    the rows of ``df``.

    Of the rows of a key the one greatest by ``order`` stays, whether it is new or was there, and the new one of equals. Rows
    with a NULL key are added. Merging the same rows again changes nothing, but for those.

    The key columns of the table are read to find the months that hold an earlier row of a key. Of those months, and the
    months of the new rows, the ones whose digest (``group_digests``) changes are written anew; no others are. Columns that
    have no digest, such as structs, have all of them written. Their number is bounded by the calendar, so they are filtered by
    value. A month whose rows all moved elsewhere is removed. Which rows stay is found from their keys, so that whole rows are
    stored once, if new, and shuffled once, when they are written (``latest_located``). The months' folders are replaced one
    after the other, so readers should not run meanwhile, and a merge that died is to be run again.
    """
    spark = df.sparkSession
    folders = list(partition_by)
    if _has_runs(spark, path):
        raise ValueError(f"{path} keeps its runs apart, so their rows cannot replace one another")
    with written_once(df.select(*schema.fieldNames())) as rows:
        new = latest_located(rows, keys, order)
        table = read_lake(spark, path, schema)
        same = table.select(*keys, *folders).join(broadcast_if_small(new.select(*keys), stored=True), list(keys), "left_semi")
        months = same.select(*folders).union(new.select(*folders)).distinct().collect()
        if months:
            touched = located(spark.read.schema(schema).parquet(path)).where(in_partitions(months, folders))
            both = touched.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
            merged = latest_located(both, keys, [*order, "_new"]).drop("_new", *WHERE)
            left = {tuple(row) for row in merged.select(*folders).distinct().collect()}
            if can_digest(schema):
                changed = differing_groups(merged, touched.drop(*WHERE), folders).collect()
                merged = merged.where(in_partitions(changed, folders))
            # Spark writes beside the folders that it replaces, and moves the new files there after all rows are read.
            write_lake(merged, path, "replace", folders, sort_by=sort_by)
            for row in months:
                if tuple(row) not in left:
                    names = (f"{name}={'__HIVE_DEFAULT_PARTITION__' if row[name] is None else row[name]}" for name in folders)
                    remove_folder(spark, "/".join([path.rstrip("/"), *names]))
        return None if observe is None else new.agg(observe.cast("string")).first()[0]


def compact_lake(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition_by: Sequence[str] = ("year", "month"),
    file_bytes: int = 256 << 20,
    sort_by: Sequence[str] = (),
) -> int:
    """Merges the files of each month into as few as its bytes need at ``file_bytes`` each; returns the months written.

    Only months with more files than that are read and written; the others are not touched. A month's rows are dealt
    evenly to its files whatever they hold, each file being written by a task of its own and ordered by ``sort_by``. The months'
    folders are replaced one after the other, so readers should not run meanwhile.
    """
    folders = list(partition_by)
    if _has_runs(spark, path):
        folders = ["run_id", *folders]
        schema = T.StructType([*schema, T.StructField("run_id", T.LongType())])
    files = listed_files(spark, path, pathGlobFilter="*.parquet")
    values = [F.regexp_extract("path", f"/{name}=([^/]*)/", 1) for name in folders]
    months = (
        files.select("length", *(value.alias(name) for value, name in zip(values, folders, strict=True)))
        .groupBy(*folders)
        .agg(F.count("*").alias("files"), F.ceil(F.sum("length") / file_bytes).alias("needed"))
        .where("files > needed")
        .collect()
    )
    if not months:
        return 0
    kinds = {field.name: field.dataType for field in schema}
    first, rows = 0, []
    for month in sorted(months, key=str):
        values = [None if month[name] == "__HIVE_DEFAULT_PARTITION__" else int(month[name]) for name in folders]
        rows.append((*values, first, month.needed))
        first += month.needed
    known = T.StructType(
        [*(T.StructField(f"_{name}", kinds[name]) for name in folders), T.StructField("_first", T.LongType()), T.StructField("_n", T.LongType())]
    )
    slots = spark.createDataFrame(rows, known)
    chosen = [Row(**dict(zip(folders, row, strict=False))) for row in rows]
    table = read_lake(spark, path, schema).where(in_partitions(chosen, folders))
    own = F.lit(True)
    for name in folders:
        own &= F.col(name).eqNullSafe(F.col(f"_{name}"))
    slot = F.col("_first") + F.monotonically_increasing_id() % F.col("_n")
    dealt = table.join(F.broadcast(slots), own).withColumn("_slot", slot.cast("int"))
    packed = dealt.repartitionById(first, "_slot").select(*schema.fieldNames())
    if sort_by:
        packed = packed.sortWithinPartitions(*folders, *sort_by)
    packed.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(*folders).parquet(path)
    return len(months)
