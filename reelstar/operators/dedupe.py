"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PACKED = "__latest"


def latest_per_key(df: DataFrame, keys: str | Sequence[str],
                   order_by: Sequence[str]) -> DataFrame:
    """Keep, for every key, the row that is greatest by ``order_by``.

    ``order_by`` columns are compared left to right, descending, NULL
    lowest; the remaining columns break any tie left, so the result does
    not depend on input order or partitioning. NULL key values form a group
    of their own (as in a window partition).

    Planned as one aggregate, ``max(struct(order..., rest...))`` by key:
    the partial aggregate runs before the shuffle, so a hot key (one media
    with a third of all events, or all anonymous events of a media at the
    same instant) is reduced in every map task and never lands whole on a
    single reducer. Output columns keep the input order.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = list(order_by)
    missing = [c for c in keys + order if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns {missing}")
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    return (
        df.groupBy(*keys)
        .agg(F.max(packed).alias(_PACKED))
        .select(*[F.col(c) if c in keys else F.col(f"{_PACKED}.{c}").alias(c)
                  for c in df.columns])
    )


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (empty when ``keys`` is a primary key)."""
    return df.groupBy(*keys).count().where(F.col("count") > 1)
