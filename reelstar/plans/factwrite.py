"""Write both facts of whole days, by either of two plans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar import schemas
from reelstar.functions import parse_event_time
from reelstar.operators import facts
from reelstar.operators.clustered import ClusteredFacts
from reelstar.plans.config import PipelineConfig
from reelstar.sinks.tables import WriteResult, in_partitions, overwrite_partitions

#: The bucketed copy of a run; it is there only while the facts are written.
CLUSTERED_TABLE = "clustered_events"


def event_days(raw_events: DataFrame) -> DataFrame:
    """The fact partitions that raw events belong to."""
    return raw_events.select(F.to_date(parse_event_time("received_at")).alias(schemas.TARGET_PARTITION_COL))


def write_facts(spark: SparkSession, cfg: PipelineConfig, events: DataFrame, durations: DataFrame,
                durations_rows: int, staging: str, run_ts: dt.datetime,
                days: WriteResult | None = None) -> dict[str, WriteResult]:
    """Write both facts from the raw events of whole days (``days`` where the caller knows them).

    With ``cluster_facts`` events move once, into a bucketed copy at ``staging`` that both facts are read
    from. Without it engagement is built from the event fact just written.
    """
    db, part = cfg.target_db, schemas.TARGET_PARTITION_COL
    if cfg.cluster_facts:
        moved = ClusteredFacts.write(events, durations, f"{db}.{CLUSTERED_TABLE}", staging, cfg.max_broadcast_rows,
                                     durations_rows, cfg.bucket_rows)
        try:
            res = overwrite_partitions(moved.events(run_ts), f"{db}.fct_events", replace_all=cfg.replace_all,
                                       days=days or moved.days())
            engagement = overwrite_partitions(moved.engagement(run_ts), f"{db}.fct_media_engagement",
                                              replace_all=cfg.replace_all, days=res)
        finally:
            moved.drop()
        return {"fct_events": res, "fct_media_engagement": engagement}
    fct_events = facts.build_events(events, durations, run_ts, cfg.max_broadcast_rows, durations_rows=durations_rows)
    res = overwrite_partitions(fct_events, f"{db}.fct_events", replace_all=cfg.replace_all,
                               days=days or event_days(events))
    written = in_partitions(spark.table(f"{db}.fct_events"), part, res)
    return {"fct_events": res, "fct_media_engagement": overwrite_partitions(
        facts.build_media_engagement(written, run_ts), f"{db}.fct_media_engagement",
        replace_all=cfg.replace_all, days=res)}
