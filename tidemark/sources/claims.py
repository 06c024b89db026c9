"""Claims that only one run can hold, and numbers that only one run can take."""

from __future__ import annotations

import datetime as dt
import json
import re
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources import files

LEASE_HOURS = 24.0


class Taken(RuntimeError):
    """Another run holds the claim, or has finished what it stands for."""


@dataclass(frozen=True)
class Claim:
    """The n-th attempt at something that is to happen once."""

    folder: str
    attempt: int

    def path(self, state: str = "") -> str:
        return f"{self.folder}/{self.attempt:06d}{state and '.' + state}.json"


def _note(**about) -> str:
    return json.dumps({"at": dt.datetime.now(dt.timezone.utc).isoformat(), **about})


def _attempts(spark: SparkSession, folder: str) -> tuple[int, int, set[str]]:
    """(last attempt, when it was taken in milliseconds, its marks); 0 where there was none."""
    held = [(m[1], m[2], modified) for name, modified in files.names(spark, folder)
            if (m := re.fullmatch(r"(\d{6})(?:\.(done|failed))?\.json", name))]
    if not held:
        return 0, 0, set()
    last = max(int(n) for n, _, _ in held)
    own = [(mark, modified) for n, mark, modified in held if int(n) == last]
    return last, max((t for mark, t in own if mark is None), default=0), {mark for mark, _ in own if mark}


def state(spark: SparkSession, folder: str, lease_hours: float = LEASE_HOURS) -> str:
    """"free", "held", "done", "failed", or "left" for a claim whose lease has run out."""
    last, taken, marks = _attempts(spark, folder)
    if not last:
        return "free"
    if marks:
        return "done" if "done" in marks else "failed"
    return "left" if time.time() * 1000 - taken > lease_hours * 3_600_000 else "held"


def take(spark: SparkSession, folder: str, lease_hours: float = LEASE_HOURS, again: bool = False, **about) -> Claim:
    """The claim on a folder's matter, or `Taken`.

    Free to take are matters without an attempt, with a failed one, or with one
    whose lease ran out before it was done; with `again` also those that were
    done. Of runs that try at the same time one gets the claim, as the file of
    an attempt can be created once only.
    """
    now = state(spark, folder, lease_hours)
    if now == "held" or now == "done" and not again:
        raise Taken(f"{folder} is {now}")
    claim = Claim(folder, _attempts(spark, folder)[0] + 1)
    if not files.create_if_absent(spark, claim.path(), _note(**about)):
        raise Taken(f"{folder} was taken by another run")
    return claim


def is_mine(spark: SparkSession, claim: Claim) -> bool:
    """Whether no later attempt has been made and this one has not ended: asked before results are made known."""
    last, _, marks = _attempts(spark, claim.folder)
    return last == claim.attempt and not marks


def finish(spark: SparkSession, claim: Claim, **about) -> None:
    files.create_if_absent(spark, claim.path("done"), _note(**about))


def fail(spark: SparkSession, claim: Claim, **about) -> None:
    """Give the claim back: another run may try at once."""
    files.create_if_absent(spark, claim.path("failed"), _note(**about))


def reserve(spark: SparkSession, folder: str, after: int = 0) -> int:
    """The next number that no run has taken yet, above `after`; numbers of runs that failed stay unused."""
    held = [int(name[:-5]) for name, _ in files.names(spark, folder) if re.fullmatch(r"\d{8}\.json", name)]
    number = max([after, *held]) + 1
    while not files.create_if_absent(spark, f"{folder}/{number:08d}.json", _note()):
        number += 1
    return number


def compare_and_set(spark: SparkSession, folder: str, number: int, record: dict) -> bool:
    """Add a record under a number that has none; False, and nothing changed, where another run has added one."""
    return files.create_if_absent(spark, f"{folder}/{number:08d}.json", json.dumps(record))


def records(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All records of the folders below, one per file; none where nothing was recorded."""
    if not files.exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(folder)
