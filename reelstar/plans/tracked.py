"""Runs that follow the landings (R2 by ledger instead of by start date).

``run_tracked`` reads only landings that came, changed or went since the last run
and rebuilds exactly the days they had or have, in whatever order things are
landed. Dimensions come from the ledger's partial minima and maxima, equal to a rebuild also after a
landing was replaced, backfilled or purged. A media whose duration changed
takes along the days on which it was watched, so watch time never goes stale. Days left without an event
lose their partitions. A full run, and the first one, reads everything, in groups of landings and
ranges of days: one that was stopped is taken up where it ended.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar import schemas
from reelstar.operators import dims
from reelstar.plans.config import INCREMENTAL, PipelineConfig
from reelstar.plans.dimstate import DimState
from reelstar.plans.factwrite import write_facts
from reelstar.plans.ledger import DAY, EVENTS, MEDIA, Ledger
from reelstar.plans.report import RunReport
from reelstar.sinks.tables import WriteResult, drop_partitions, overwrite_table, partition_values, table_counts

log = logging.getLogger("reelstar")


def changed_durations(before: DataFrame, after: DataFrame) -> DataFrame:
    """Media whose duration differs between two states of the dimension, or that only one of them has."""
    old = before.select("media_id", F.col("duration").alias("_before"))
    both = old.join(after.select("media_id", "duration"), "media_id", "full")
    return both.where(~F.col("duration").eqNullSafe(F.col("_before"))).select("media_id")


def run_tracked(spark: SparkSession, cfg: PipelineConfig, run_ts: dt.datetime) -> RunReport:
    """One run; the caller has made the tables."""
    db = cfg.target_db
    ledger = Ledger.for_db(spark, db, cfg.warehouse_dir, cfg.source_path)
    whole = cfg.mode != INCREMENTAL or ledger.current() is None
    report = RunReport(cfg.mode, None, run_ts, dimensions="partials")
    changes = ledger.look(cfg.allow_missing_source, forget=whole)
    report.landings = sorted(v for k in (EVENTS, MEDIA) for v in changes.read[k].values())
    pending = ledger.pending()
    if changes or pending or whole:
        if whole:
            todo = changes.without(ledger.done_units())
            report.landings = sorted(v for k in (EVENTS, MEDIA) for v in todo.read[k].values())
            if any(todo.read.values()):
                ledger.forget_days()                          # written before what is read now
            for group in todo.groups(cfg.rebuild_bytes):
                ledger.parse(group, cfg.raw_mode)
                ledger.note_units(group)
        else:
            ledger.parse(changes, cfg.raw_mode)
        report.raw_rows = ledger.index(changes)
        if cfg.quarantine_path:
            ledger.quarantine(changes, cfg.quarantine_path)
        days = {r[0] for r in ledger.touched(changes).collect()} | set(pending)
        media = ledger.materialize(dims.media_from_partials(ledger.read("media"), ledger.read("urls"), run_ts), "media")
        if whole:
            # what an earlier run left behind goes, too
            days |= set(partition_values(spark, f"{db}.fct_events")) | set(
                partition_values(spark, f"{db}.fct_media_engagement"))
        else:
            moved = changed_durations(spark.table(f"{db}.dim_media"), media)
            days |= {r[0] for r in ledger.days_of_media(moved).collect()}
        if whole:
            days -= ledger.done_days()
        days = sorted(days, key=lambda d: (d is not None, d))
        report.touched = days
        ledger.note_pending(days)
        # an untracked merge can't go on from what is written here
        DimState.for_db(spark, db, cfg.warehouse_dir).begin_write(spark)
        visitors = dims.visitors_from_partials(ledger.read("visitors"), run_ts)
        for name, df in (("dim_visitors", visitors), ("dim_media", media),
                         ("dim_dates", dims.build_dates(spark, cfg.dates_start, cfg.dates_end or run_ts.date(), run_ts))):
            report.writes[name] = overwrite_table(df, f"{db}.{name}")
        for some in ledger.ranges(days, cfg.range_rows):
            rebuild_days(spark, cfg, ledger, some, run_ts, report)
            if whole:
                ledger.note_days(some)
    else:
        log.info("no landing changed")
        df = dims.build_dates(spark, cfg.dates_start, cfg.dates_end or run_ts.date(), run_ts)
        report.writes["dim_dates"] = overwrite_table(df, f"{db}.dim_dates")
        ledger.index(changes)
    ledger.commit()
    report.table_rows = {r.table_name: r.rows for r in table_counts(spark, db).collect()}
    return report


def _add(report: RunReport, table: str, done: WriteResult) -> None:
    """Writes of several ranges of days as one."""
    before = report.writes.get(table)
    if before is not None:
        done = WriteResult(table, before.rows + done.rows, before.partitions + done.partitions,
                           before.null_partition or done.null_partition)
    report.writes[table] = done


def rebuild_days(spark: SparkSession, cfg: PipelineConfig, ledger: Ledger, days: list[dt.date | None],
                 run_ts: dt.datetime, report: RunReport) -> None:
    """Both facts of these days from the staged events; days without any lose their partitions."""
    if not days:
        return
    db = cfg.target_db
    events = ledger.events_of(days)
    there = {r[0] for r in events.select(DAY).distinct().collect()}
    result = WriteResult("days", 0, sorted(d for d in there if d is not None), None in there)
    if there:
        durations = spark.table(f"{db}.dim_media").select("media_id", "duration")
        staging = DimState.for_db(spark, db, cfg.warehouse_dir).staging("clustered")
        for table, done in write_facts(spark, cfg, events, durations, report.writes["dim_media"].rows, staging,
                                       run_ts, result).items():
            _add(report, table, done)
    empty = [d for d in days if d not in there]
    for name in schemas.FACTS:
        drop_partitions(spark, f"{db}.{name}", empty)
