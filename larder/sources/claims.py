"""Claims on runs, so that of two attempts at one run only one loads anything."""

from __future__ import annotations

import re
import time
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import SparkSession

from larder.sources.files import create_if_absent, plain_files, remove_file


@dataclass(frozen=True)
class Claim:
    """A run that belongs to this attempt. Used as a context it is given back if the attempt fails."""

    claims: RunClaims
    etl_name: str
    run_id: int
    attempt: int

    def held(self) -> bool:
        """Whether no later attempt has taken the run over."""
        return max(self.claims.attempts(self.etl_name).get(self.run_id, {0: 0})) == self.attempt

    def release(self) -> None:
        self.claims.remove(self.etl_name, self.run_id, self.attempt)

    def __enter__(self) -> Claim:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is not None:
            self.release()


class RunClaims:
    """One empty file per attempt at a run, which only one attempt can create.

    An attempt that fails removes its file. One that died leaves it, and after ``stale_after`` the next attempt takes the run
    over by creating the file of the next number; times are those of the files, compared with this machine's clock. An
    attempt that was only slow finds that it no longer holds the run before it records it. The file of a finished run
    goes away when a later run is claimed, so whoever wins a claim has to look whether the run is still the current one.
    """

    def __init__(self, spark: SparkSession, path: str, stale_after: timedelta = timedelta(hours=24)):
        self.spark = spark
        self.path = path.rstrip("/")
        self.stale_after = stale_after

    def _folder(self, etl_name: str) -> str:
        return f"{self.path}/etl={etl_name.encode().hex()}"

    def attempts(self, etl_name: str) -> dict[int, dict[int, int]]:
        """The attempts at each run, by their numbers, with the time of their files in milliseconds."""
        found: dict[int, dict[int, int]] = {}
        for name, changed in plain_files(self.spark, self._folder(etl_name)).items():
            match = re.fullmatch(r"run-([0-9]+)-attempt-([0-9]+)", name)
            if match:
                found.setdefault(int(match[1]), {})[int(match[2])] = changed
        return found

    def remove(self, etl_name: str, run_id: int, attempt: int) -> None:
        remove_file(self.spark, f"{self._folder(etl_name)}/run-{run_id}-attempt-{attempt}")

    def claim(self, etl_name: str, run_id: int) -> Claim | None:
        """The claim on a run; None while another attempt holds it."""
        before = self.attempts(etl_name)
        latest = max(before.get(run_id, {0: 0}))
        if latest and time.time() * 1000 - before[run_id][latest] < self.stale_after.total_seconds() * 1000:
            return None
        if not create_if_absent(self.spark, f"{self._folder(etl_name)}/run-{run_id}-attempt-{latest + 1}"):
            return None
        for finished in before:
            if finished < run_id:
                for attempt in before[finished]:
                    self.remove(etl_name, finished, attempt)
        return Claim(self, etl_name, run_id, latest + 1)
