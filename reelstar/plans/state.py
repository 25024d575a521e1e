"""Run state: the watermark of the last successful run, and the run window.

The state is a one-row JSON dataset ``{"last_run_ts": "..."}`` at a shared
path. It is read back as its date (the boundary day is fetched again on the
next run, which is why landed data overlaps and facts de-duplicate), and it
is written only after every table was built.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from reelstar.functions import utc
from reelstar.plans.config import INCREMENTAL, parse_bool, parse_mode

# Days of history a full run asks the API for.
FULL_HISTORY_DAYS = 730


def read_checkpoint(spark: SparkSession, path: str | None) -> dt.date | None:
    """Date of the last committed run, None when no state exists yet."""
    if not path:
        return None
    try:
        rows = spark.read.schema("last_run_ts string").json(path).take(1)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return None
        raise
    if not rows or not rows[0].last_run_ts:
        return None
    return dt.date.fromisoformat(rows[0].last_run_ts.split("T")[0])


def commit_checkpoint(spark: SparkSession, path: str | None, new_last_run_ts: str | None,
                      persist_state: bool | str = True, dry_run: bool | str = False) -> dict:
    """Persist the watermark after success; skipped on dry runs or on request."""
    if not new_last_run_ts:
        raise ValueError("missing new_last_run_ts")
    if parse_bool(dry_run) or not parse_bool(persist_state, True) or not path:
        return {"status": "skipped", "new_last_run_ts": new_last_run_ts}
    (spark.createDataFrame([(new_last_run_ts,)], "last_run_ts string")
     .coalesce(1).write.mode("overwrite").json(path))
    return {"status": "committed", "new_last_run_ts": new_last_run_ts}


@dataclass(frozen=True)
class RunWindow:
    fetch_start: dt.date | None     # lower bound asked from the API
    fetch_end: dt.date | None
    start_date: dt.date | None      # lower bound of the fact rebuild (None: full)
    new_last_run_ts: str


def resolve_window(mode: str | None, start_date: dt.date | None, checkpoint: dt.date | None,
                   now: dt.datetime) -> RunWindow:
    """What to fetch and which facts to rebuild.

    An incremental run starts at the explicit date, else at the checkpoint;
    without either it fetches the whole history and rebuilds everything. A full
    run rebuilds everything whatever the start date; it fetches from that date
    if given, else 730 days.

    The new watermark is the run's start instant, taken before fetching, so
    events arriving during the run are fetched again next time.
    """
    mode = parse_mode(mode)
    now = utc(now)
    stamp = now.isoformat()
    if mode == INCREMENTAL:
        since = start_date or checkpoint
        return RunWindow(since, None, since, stamp)
    if start_date is not None:
        return RunWindow(start_date, None, None, stamp)
    today = now.date()
    return RunWindow(today - dt.timedelta(days=FULL_HISTORY_DAYS), today, None, stamp)
