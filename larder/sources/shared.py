"""The folder all executors share, and what is kept there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A broadcast id column of this many rows is a few tens of megabytes.
BROADCAST_ROWS = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, made ready for ``checkpoint()``.

    A local session without one gets a temporary folder; a cluster session has to name its own,
    because a temporary folder would exist on one machine only.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="larder-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for one result in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def computed_once(df: DataFrame) -> DataFrame:
    """``df`` stored in the shared folder, so that several uses do not compute it again."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, stored: bool = False) -> DataFrame:
    """``df`` computed once, with a broadcast hint only if it has at most ``max_rows`` rows.

    For narrow rows such as ids. Larger frames come back without a hint, for Spark to shuffle.
    ``stored`` says that ``df`` comes from ``computed_once`` already.
    """
    kept = df if stored else computed_once(df)
    return F.broadcast(kept) if kept.count() <= max_rows else kept
