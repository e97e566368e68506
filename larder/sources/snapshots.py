"""Tables whose loads readers see whole or not at all."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators import history as runs
from larder.sources.files import remove_folder, subfolders
from larder.sources.history_table import HistoryTable

# Fixed value: what the second filter column of a history row is named when it holds a snapshot.
SNAPSHOT = "snapshot"


def snapshot_path(root: str, run_id: int) -> str:
    return f"{root.rstrip('/')}/{SNAPSHOT}={run_id}"


def stored_snapshot(run: Row) -> int | None:
    """The run whose full load began the snapshot that a history row makes current."""
    value = run.filter_col2_value if run.filter_col2_name == SNAPSHOT else None
    return int(value) if value and re.fullmatch(r"[0-9]{1,18}", value) else None


def read_current(history: HistoryTable, etl_name: str, root: str, schema: T.StructType) -> DataFrame:
    """The rows of a pipeline's finished runs: its current snapshot, without the run under way.

    A full load writes a folder of its own, a delta a run folder inside the current one. Both count from the moment the
    run's history row is there; until then, and if the run dies, readers get the rows before it.
    """
    run = runs.current_runs(history.read(), etl_name).first()
    snapshot = None if run is None else stored_snapshot(run)
    if snapshot is None:
        raise ValueError(f"{etl_name} has no snapshot yet")
    staged = T.StructType([*schema, T.StructField("run_id", T.LongType())])
    table = history.spark.read.schema(staged).parquet(snapshot_path(root, snapshot))
    return table.where(F.col("run_id") < run.id).select(*schema.fieldNames())


def expire_snapshots(history: HistoryTable, etl_name: str, root: str) -> list[int]:
    """Deletes the snapshots before the current one, for which no reader may be left; returns their numbers."""
    run = runs.current_runs(history.read(), etl_name).first()
    current = None if run is None else stored_snapshot(run)
    gone = []
    for name in subfolders(history.spark, root) if current is not None else ():
        match = re.fullmatch(rf"{SNAPSHOT}=([0-9]+)", name)
        if match and int(match[1]) < current:
            remove_folder(history.spark, f"{root.rstrip('/')}/{name}")
            gone.append(int(match[1]))
    return sorted(gone)
