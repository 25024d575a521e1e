"""Job configuration: one frozen record, validated on construction."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from reelstar.operators.clustered import BUCKET_ROWS
from reelstar.operators.dims import DEFAULT_DATES_START
from reelstar.operators.joins import DEFAULT_MAX_BROADCAST_ROWS

FULL, INCREMENTAL = "full", "incremental"
# Accepted spellings of the two modes.
MODE_ALIASES = {"full": FULL, "full_refresh": FULL, "incremental": INCREMENTAL}


def parse_mode(value: str | None) -> str:
    if value is None:
        return FULL
    mode = MODE_ALIASES.get(str(value).strip().lower())
    if mode is None:
        raise ValueError(f"unknown pipeline mode {value!r}; use one of {sorted(MODE_ALIASES)}")
    return mode


def parse_bool(value: bool | str | None, default: bool = False) -> bool:
    """Strict boolean: a bool, or the text true/false (any case)."""
    if value is None:
        return default
    if isinstance(value, bool):
        return value
    text = str(value).strip().lower()
    if text in ("true", "false"):
        return text == "true"
    raise ValueError(f"not a boolean: {value!r}")


def parse_date(value: dt.date | str | None) -> dt.date | None:
    if value is None or value == "":
        return None
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    try:
        return dt.date.fromisoformat(str(value).strip()[:10])
    except ValueError as exc:
        raise ValueError(f"not a date (YYYY-MM-DD): {value!r}") from exc


@dataclass(frozen=True)
class PipelineConfig:
    source_path: str
    target_db: str
    warehouse_dir: str | None = None
    mode: str = FULL
    start_date: dt.date | None = None
    dry_run: bool = False
    dates_start: dt.date = DEFAULT_DATES_START
    dates_end: dt.date | None = None          # None: the run date
    prune_raw_by_ingest_date: bool = False    # only where no event is dated after its landing
    stage_raw: bool = True                    # parse raw JSON once per run
    incremental_dims: bool = False            # merge dims from new landings (append-only sources)
    tracked: bool = False                     # follow the landings by a ledger instead of a start date
    rebuild_bytes: int = 1 << 40              # tracked full runs: raw bytes parsed before that is noted
    range_rows: int = 5_000_000_000           # tracked runs: events of the days rebuilt at a time
    cluster_facts: bool = False               # move events once for both facts (bucketed copy)
    bucket_rows: int = BUCKET_ROWS            # events in one of its buckets
    raw_mode: str = "PERMISSIVE"              # what a malformed line does: kept, dropped, fails
    quarantine_path: str | None = None        # where malformed lines are copied to
    allow_missing_source: bool = False        # read an absent folder as empty
    late_aware: bool = False                  # widen the window to late events' days
    replace_all: bool = False                 # static overwrite of the facts
    state_path: str | None = None             # checkpoint of the last run
    persist_state: bool = True
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS

    def __post_init__(self):
        object.__setattr__(self, "mode", parse_mode(self.mode))
        object.__setattr__(self, "start_date", parse_date(self.start_date))
        object.__setattr__(self, "dates_start", parse_date(self.dates_start))
        object.__setattr__(self, "dates_end", parse_date(self.dates_end))
        object.__setattr__(self, "dry_run", parse_bool(self.dry_run))
        object.__setattr__(self, "persist_state", parse_bool(self.persist_state, True))
        object.__setattr__(self, "stage_raw", parse_bool(self.stage_raw, True))
        object.__setattr__(self, "incremental_dims", parse_bool(self.incremental_dims, False))
        object.__setattr__(self, "tracked", parse_bool(self.tracked, False))
        object.__setattr__(self, "cluster_facts", parse_bool(self.cluster_facts, False))
        object.__setattr__(self, "prune_raw_by_ingest_date", parse_bool(self.prune_raw_by_ingest_date, False))
        object.__setattr__(self, "allow_missing_source", parse_bool(self.allow_missing_source, False))
        object.__setattr__(self, "raw_mode", str(self.raw_mode).strip().upper())
        object.__setattr__(self, "late_aware", parse_bool(self.late_aware, False))
        if not self.source_path or not self.target_db:
            raise ValueError("source_path and target_db are required")
        if self.replace_all and self.mode == INCREMENTAL:
            # a static overwrite with only the window's days would drop history
            raise ValueError("replace_all needs a full run")

    @property
    def facts_start(self) -> dt.date | None:
        """Lower bound of the fact rebuild; None rebuilds everything."""
        return self.start_date if self.mode == INCREMENTAL else None

    @classmethod
    def from_args(cls, args: Mapping[str, object]) -> PipelineConfig:
        """From job arguments named like ``SOURCE_PATH`` or ``source_path``."""
        norm = {str(k).lower(): v for k, v in args.items()}
        if "pipeline_mode" in norm and "mode" not in norm:
            norm["mode"] = norm.pop("pipeline_mode")
        known = set(cls.__dataclass_fields__)
        return cls(**{k: v for k, v in norm.items() if k in known})
