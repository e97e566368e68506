"""Loading a table fully or from its high-water mark, as its run history asks."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Sequence
from contextlib import nullcontext
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators import history as runs
from larder.operators.digests import differing_groups
from larder.sources.claims import RunClaims
from larder.sources.history_table import HistoryTable
from larder.sources.lake import in_partitions, merge_lake, read_lake, write_lake
from larder.sources.latest import latest_rows
from larder.sources.ledger import FileLedger
from larder.sources.profiles import RunProfiles
from larder.sources.snapshots import snapshot_path, stored_snapshot

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Ingested:
    """What a run did: ``full``, ``delta`` or ``skip``, and the mark the next run starts from.

    ``months`` are the year and month of the rows it wrote, where that is known.
    """

    mode: str
    run_id: int | None = None
    watermark: str | None = None
    months: tuple[tuple[int | None, int | None], ...] | None = None


@dataclass(frozen=True)
class Merge:
    """Rows alike in ``keys`` replace one another; the greatest by ``order`` stays."""

    keys: Sequence[str]
    order: Sequence[str]


def ingest(
    history: HistoryTable,
    etl_name: str,
    load: Callable[[str | None], DataFrame],
    lake_path: str,
    watermark_column: str = "datePublished",
    stage_by_run: bool = False,
    clustered: bool = False,
    lookback_days: int = 0,
    load_new: Callable[[str, datetime], DataFrame] | None = None,
    ledger: FileLedger | None = None,
    load_files: Callable[[list[str]], DataFrame] | None = None,
    snapshots: bool = False,
    merge: Merge | None = None,
    reconcile: bool = False,
    sort_by: Sequence[str] = (),
    claims: RunClaims | None = None,
    profiles: RunProfiles | None = None,
) -> Ingested:
    """Runs a pipeline once.

    ``load`` gives the rows newer than a watermark, or all rows for None. The largest date (or
    timestamp, by the type of ``watermark_column``) is taken while the rows are written, so it belongs to exactly
    those rows. One added history row records the run, dated when it began, before any file was listed; if the job
    dies before it, the next attempt loads the same rows again, and ``stage_by_run`` makes it replace what the
    first one wrote.

    With ``lookback_days`` a delta loads whole months, from the one that many days before the mark, and
    replaces those months of the table, so that late rows get in and none comes twice. This is complete
    while the input still holds those months. It goes with neither ``stage_by_run`` nor ``load_new``.

    A delta calls ``load_new`` instead of ``load`` if given, with the mark and the start of the run before,
    so that older files can stay unread.

    With a ``ledger``, ``load_files`` is called instead with the paths that the run has to read: all files for a full load,
    and for a delta those that no finished run has loaded, whatever their rows' dates. Each file is loaded once, late
    and undated rows included, so the table holds what a full load would give.

    With ``snapshots`` the table is a folder of snapshots: a full load writes a new one, a delta a run folder inside
    the current one, and the history row makes either visible to ``read_current``.

    With ``merge`` rows replace those of the same key, in a full load and in deltas (``merge_lake``).

    With ``reconcile`` a delta compares digests of each month between all input and the table, and replaces just the months that
    differ, so rows that are late by any time, undated ones and corrections get in. Months that the input no longer
    holds stay. A month of which it holds fewer rows than the table fails the run before anything is written, as part of it may
    be gone from the input.

    With ``sort_by`` the rows of each file are in that order (``write_lake``).

    With ``claims`` of several attempts at one run the first loads and the others end in ``skip``.

    With ``profiles`` numbers and sketches of the rows are taken in the same pass and stored for the run.
    """
    if ledger and not load_files:
        raise ValueError("a ledger needs a function that loads its files")
    if ledger and (load_new or lookback_days):
        raise ValueError("a ledger decides which files are read, so it goes with no lookback and no times of files")
    if snapshots and (stage_by_run or lookback_days or merge):
        raise ValueError("snapshots keep their runs apart, so rows are neither staged again nor replaced")
    if merge and (stage_by_run or lookback_days):
        raise ValueError("rows replaced by key are neither staged by run nor looked back for")
    if reconcile and (stage_by_run or lookback_days or load_new or ledger or snapshots or merge):
        raise ValueError("months are compared with all input and replaced, which goes with no other kind of delta")
    if lookback_days and (stage_by_run or load_new):
        raise ValueError("a lookback replaces months, for which it needs all input and no run folders")
    began = datetime.now(timezone.utc)
    table = history.read()
    current = (
        runs.current_runs(table, etl_name)
        .withColumn("load_mode", runs.load_mode())
        .withColumn("stored_watermark", runs.stored_watermark())
    )
    run = current.first()
    if run is None:
        log.warning("%s has no active run, nothing loaded", etl_name)
        return Ingested("skip")
    if run.load_mode == "skip":
        log.warning("%s is set to be skipped, nothing loaded", etl_name)
        return Ingested("skip", run.id, run.stored_watermark)
    if run.load_mode == "error":
        raise ValueError(f"run {run.id} of {etl_name} asks for a delta but stores no watermark")
    if run.filter_col1_name not in (None, watermark_column):
        raise ValueError(f"run {run.id} of {etl_name} marks {run.filter_col1_name}, not {watermark_column}")

    claim = claims.claim(etl_name, run.id) if claims else None
    if claims and claim is None:
        log.warning("run %s of %s belongs to another attempt, nothing loaded", run.id, etl_name)
        return Ingested("skip", run.id, run.stored_watermark)
    with claim or nullcontext():
        now = runs.current_runs(history.read(), etl_name).first() if claim else run
        if now is None or now.id != run.id:
            claim.release()
            log.warning("run %s of %s is over, nothing loaded", run.id, etl_name)
            return Ingested("skip", run.id, run.stored_watermark)
        start = None if run.load_mode == "full" else run.stored_watermark
        target, folder = lake_path, run.id if stage_by_run else None
        base = run.id if start is None else stored_snapshot(run)
        if snapshots:
            if base is None:
                raise ValueError(f"run {run.id} of {etl_name} has no snapshot to add to; load in full first")
            target, folder = snapshot_path(lake_path, base), run.id
        mode = "overwrite" if start is None else "append"
        if ledger:
            rows = load_files(ledger.claim(etl_name, run.id, full=start is None))
        elif start is None:
            rows = load(None)
        elif reconcile:
            rows, mode = changed_months(load(None), target), "replace"
        elif lookback_days:
            rows, mode = load(before_month(start, lookback_days)), "replace"
        elif load_new:
            rows = load_new(start, run.run_date)
        else:
            rows = load(start)
        # A table's months are bounded by the calendar, and a set does not change when rows are seen twice.
        months = F.collect_set(F.struct("year", "month")).alias("months")
        seen = [F.max(watermark_column).cast("string").alias("mark"), months]
        if profiles:
            seen.append(profiles.observed().alias("profile"))
        observe = F.to_json(F.struct(*seen))
        if merge and mode == "append":
            noted = merge_lake(rows, target, rows.schema, merge.keys, merge.order, observe=observe, sort_by=sort_by)
        else:
            with latest_rows(rows, merge.keys, merge.order) if merge else nullcontext(rows) as kept:
                noted = write_lake(kept, target, mode, run_id=folder, clustered=clustered, observe=observe, sort_by=sort_by)
        written = json.loads(noted)
        loaded, months = written.get("mark"), None
        if not (merge and mode == "append"):  # which writes other months as well
            months = tuple((month.get("year"), month.get("month")) for month in written.get("months", ()))
        if profiles:
            profiles.store(etl_name, run.id, start is None, written["profile"])
        finished = current.where(F.col("id") == run.id).withColumn("new_watermark", F.lit(loaded))
        if snapshots:
            finished = finished.withColumn("new_snapshot", F.lit(str(base)))
        if claim and not claim.held():
            raise RuntimeError(f"run {run.id} of {etl_name} was taken over by a later attempt")
        history.append(runs.follow_up(table, finished, F.lit(began).cast("timestamp")))
        marks = [mark for mark in (start, loaded) if mark is not None]
        return Ingested(run.load_mode, run.id, max(marks, default=None), months)


def changed_months(rows: DataFrame, path: str) -> DataFrame:
    """Of all input the months whose rows are not those of the table at ``path``. Months are bounded by the calendar."""
    folders = ["year", "month"]
    stored = read_lake(rows.sparkSession, path, rows.schema)
    months = differing_groups(rows, stored, folders).collect()
    fewer = sorted((f"{month.year}-{month.month}" for month in months if month.rows < month.old_rows))
    if fewer:
        raise ValueError(f"the input holds fewer rows than the table of {', '.join(fewer)}; load in full if that is meant")
    return rows.where(in_partitions(months, folders))


def before_month(mark: str, lookback_days: int) -> str:
    """The last moment before the month that holds the day ``lookback_days`` before ``mark``."""
    first = (date.fromisoformat(mark[:10]) - timedelta(days=lookback_days)).replace(day=1)
    last = datetime.combine(first, datetime.min.time()) - timedelta(microseconds=1)
    return last.isoformat(sep=" ") if len(mark) > 10 else last.date().isoformat()
