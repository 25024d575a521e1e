"""Join helpers: broadcast only behind a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup of (id, double) rows costs well under 100 bytes a row in a
# broadcast hash relation; one million rows stays far below executor memory.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                      known_rows: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast if it has at most ``max_rows`` rows.

    ``known_rows`` is a count of the table the lookup was written to. Without
    one, or beyond the bound, the frame is returned unmarked: the lookup is
    not computed just to be counted, AQE knows its size once it has run and
    switches to a broadcast then, or splits skewed partitions.
    """
    if known_rows is None:
        return df
    return F.broadcast(df) if known_rows <= max_rows else df


def lookup_join(left: DataFrame, lookup: DataFrame, key: str,
                max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                known_rows: int | None = None) -> DataFrame:
    """``left`` LEFT JOIN a lookup that is unique on ``key``."""
    return left.join(bounded_broadcast(lookup, max_rows, known_rows), on=key, how="left")
