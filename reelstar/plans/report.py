"""What a run did."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from reelstar.sinks.tables import WriteResult


@dataclass
class RunReport:
    mode: str
    facts_start: dt.date | None
    run_ts: dt.datetime
    writes: dict[str, WriteResult] = field(default_factory=dict)
    table_rows: dict[str, int] = field(default_factory=dict)
    checkpoint: dict | None = None
    dimensions: str = "rebuilt"      # "merged" (incremental, from new landings), "partials" (tracked)
    raw_rows: dict[str, int] = field(default_factory=dict)   # rows scanned for dimensions
    landings: list[str] = field(default_factory=list)        # tracked runs: landings read
    touched: list[dt.date | None] = field(default_factory=list)   # tracked runs: days rebuilt
