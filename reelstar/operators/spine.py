"""Calendar spine generators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_spine_between(bounds: DataFrame, start: str | Column, end: str | Column) -> DataFrame:
    """Days between per-row bounds computed by Spark (e.g. min/max of a
    column); rows whose end precedes their start yield nothing."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return (
        bounds.where(s <= e)
        # bounds known while planning are folded before the filter holds them back
        .select(F.explode(F.sequence(s, F.greatest(s, e), F.expr("interval 1 day"))).alias("date"))
    )


def date_spine(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive; empty if end < start."""
    bounds = spark.range(1).select(F.lit(str(start)).cast("date").alias("s"),
                                   F.lit(str(end)).cast("date").alias("e"))
    return date_spine_between(bounds, "s", "e")
