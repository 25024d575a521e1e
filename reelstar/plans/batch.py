"""Batch jobs: full or incremental rebuild of the star schema (R1, R2),
and the land -> build -> commit chain (R4).

Raw events JSON is parsed once per run: the used columns are staged as
parquet next to the tables, in a folder of the run's own, and media URLs,
visitors and the event fact read that columnar copy. Dimensions are rebuilt
from all raw data in both modes; merging them from new landings is an option
for append-only sources. Engagement reads the event fact back from the
partitions just written, the duration lookup comes from the written media
dimension.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar import schemas, session
from reelstar.functions import parse_event_time, utc
from reelstar.operators import dims, facts
from reelstar.plans.config import FULL, INCREMENTAL, PipelineConfig
from reelstar.plans.dimstate import DimState
from reelstar.plans.factwrite import write_facts
from reelstar.plans.report import RunReport
from reelstar.plans.state import commit_checkpoint, read_checkpoint, resolve_window
from reelstar.plans.tracked import run_tracked
from reelstar.sinks.tables import WriteResult, ensure_tables, overwrite_table, table_counts
from reelstar.sources import landing
from reelstar.sources.raw import EVENT_COLUMNS_USED, read_raw_events, read_raw_media, stage

log = logging.getLogger("reelstar")


def _raw(spark: SparkSession, cfg: PipelineConfig, reader, since: dt.date | None = None,
         with_corrupt: bool = False) -> DataFrame:
    # lines to be copied away have to be seen, also where they are dropped afterwards
    mode = "PERMISSIVE" if with_corrupt and cfg.raw_mode == "DROPMALFORMED" else cfg.raw_mode
    return reader(spark, cfg.source_path, since=since, mode=mode, with_corrupt=with_corrupt,
                  missing_ok=cfg.allow_missing_source)


def quarantine(raw: DataFrame, path: str, since: dt.date | None = None) -> None:
    """Copy the malformed lines of raw events (read with their corrupt column) to ``path``, by landing
    day. The landing days read (all, or those from ``since`` on) lose what was copied before."""
    part, spark = schemas.RAW_PARTITION_COL, raw.sparkSession
    for name in session.folder_names(spark, path):
        day = name.removeprefix(f"{part}=")
        if name != day and (since is None or day >= since.isoformat()):
            session.delete_path(spark, f"{path.rstrip('/')}/{name}")
    # Spark refuses to parse for the corrupt column alone, so a data column is looked at with it
    corrupt = F.col(schemas.CORRUPT_COL)
    bad = raw.where(corrupt.isNotNull() & (F.length(F.concat_ws("", corrupt, "event_key")) > 0))
    (bad.select(corrupt.alias("value"), part).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(part).text(path))


def _through(df: DataFrame):
    """Latest landing day of a frame and its rows."""
    return df.agg(F.max(schemas.RAW_PARTITION_COL).alias("through"), F.count(F.lit(1)).alias("rows")).first()


def run_batch(spark: SparkSession, cfg: PipelineConfig,
              run_ts: dt.datetime | None = None) -> RunReport:
    """Rebuild dimensions over all raw data and facts from ``cfg.facts_start`` on.

    With ``incremental_dims`` an incremental run, once a previous run left its
    dimension state, reads only landings on or after the older of the fact
    window start and the dimension watermark, and merges them into the
    existing dimensions (the same result for append-only sources, see
    ``dimstate``). With ``tracked`` the ledger of landings decides what is read
    and rebuilt (see ``tracked``), and a start date has no part in it.
    """
    session.configure(spark)
    run_ts = utc(run_ts or dt.datetime.now(dt.timezone.utc)).replace(microsecond=0)
    db, start = cfg.target_db, cfg.facts_start
    report = RunReport(cfg.mode, start, run_ts)
    if cfg.dry_run:
        return _dry_run(spark, cfg, run_ts, report)
    ensure_tables(spark, db, cfg.warehouse_dir)
    if cfg.tracked:
        return run_tracked(spark, cfg, run_ts)
    state = DimState.for_db(spark, db, cfg.warehouse_dir)
    events_wm, media_wm = state.watermark(spark) if start else (None, None)
    urls_prev = state.urls(spark) if events_wm and media_wm else None
    merge_dims = bool(start and cfg.incremental_dims and urls_prev is not None)

    part = F.col(schemas.RAW_PARTITION_COL)
    since = min(events_wm, start) if merge_dims else None
    raw_events = _raw(spark, cfg, read_raw_events, since, bool(cfg.quarantine_path))
    raw_media = _raw(spark, cfg, read_raw_media, media_wm if merge_dims else None)
    corrupt = (schemas.CORRUPT_COL,) if cfg.quarantine_path else ()
    if cfg.stage_raw:
        raw_events = stage(raw_events, state.staging("raw_events"), EVENT_COLUMNS_USED + corrupt)
    if cfg.quarantine_path:
        quarantine(raw_events, cfg.quarantine_path, since)
        if cfg.raw_mode == "DROPMALFORMED":
            raw_events = raw_events.where(F.col(schemas.CORRUPT_COL).isNull())
    seen, seen_media = _through(raw_events), _through(raw_media)
    dim_events = raw_events
    if merge_dims:
        report.dimensions = "merged"
        dim_events = dim_events.where(part >= F.lit(events_wm))
    report.writes.update(write_dimensions(spark, cfg, state, dim_events, raw_media, run_ts,
                                          urls_prev if merge_dims else None))

    # Facts from the events of the window only. Late-aware runs start the
    # window at the earliest event day among landings inside it (one
    # aggregate over the pruned landings): events landed after the previous
    # run but dated before the window are rebuilt too, instead of waiting
    # for a full run.
    facts_raw = raw_events
    if start and cfg.late_aware:
        earliest = (raw_events.where(part >= F.lit(start))
                    .agg(F.min(F.to_date(parse_event_time("received_at")))).first()[0])
        if earliest and earliest < start:
            log.info("late events: window widened from %s to %s", start, earliest)
            if merge_dims and earliest < min(events_wm, start):
                # the widened days may hold copies landed before this run's scan
                facts_raw = _raw(spark, cfg, read_raw_events, earliest)
            start = report.facts_start = earliest
    durations = spark.table(f"{db}.dim_media").select("media_id", "duration")
    windowed = facts.events_since(facts_raw, start, cfg.prune_raw_by_ingest_date)
    report.writes.update(write_facts(spark, cfg, windowed, durations, report.writes["dim_media"].rows,
                                     state.staging("clustered"), run_ts))

    # Dimension watermark last: a failed run leaves the previous one. Valid in
    # both modes: a rebuild saw every landing, a merge every landing since.
    report.raw_rows = {"events": seen.rows, "media": seen_media.rows}
    log.info("raw rows read: %s", report.raw_rows)
    state.write_watermark(spark, seen.through or events_wm, seen_media.through or media_wm)
    state.drop_staging(spark)
    report.table_rows = {r.table_name: r.rows for r in table_counts(spark, db).collect()}
    return report


def write_dimensions(spark: SparkSession, cfg: PipelineConfig, state: DimState,
                     events: DataFrame, raw_media: DataFrame, run_ts: dt.datetime,
                     previous_urls: DataFrame | None) -> dict[str, WriteResult]:
    """Write the three dimensions and the URL state.

    With ``previous_urls`` (the state of an earlier run) ``events`` and
    ``raw_media`` are only the new landings and are merged into the
    existing dimensions; without it they are everything and the dimensions
    are rebuilt.
    """
    db = cfg.target_db
    if previous_urls is not None:
        urls = state.stage_urls(spark, dims.merge_media_urls(previous_urls, events))
        visitors = state.materialize(
            dims.merge_visitors(spark.table(f"{db}.dim_visitors"), events, run_ts), "dim_visitors")
        media = state.materialize(
            dims.merge_media(spark.table(f"{db}.dim_media"), raw_media, urls, run_ts), "dim_media")
    else:
        urls = state.stage_urls(spark, dims.media_urls(events))
        visitors = dims.build_visitors(events, run_ts)
        media = dims.media_from_urls(raw_media, urls, run_ts)
    out = {}
    state.begin_write(spark)
    for name, df in (
        ("dim_dates", dims.build_dates(spark, cfg.dates_start, cfg.dates_end or run_ts.date(),
                                       run_ts)),
        ("dim_visitors", visitors),
        ("dim_media", media),
    ):
        out[name] = overwrite_table(df, f"{db}.{name}")
    state.commit_urls(spark)
    return out


def _dry_run(spark: SparkSession, cfg: PipelineConfig, run_ts: dt.datetime,
             report: RunReport) -> RunReport:
    """Build every table and count it, write no table: raw JSON is parsed once
    into a staging folder, which goes afterwards."""
    raw_media = _raw(spark, cfg, read_raw_media)
    raw_events = _raw(spark, cfg, read_raw_events)
    staged = session.scratch_path(spark, "dry")
    if cfg.stage_raw:
        raw_events = stage(raw_events, f"{staged}/raw_events")
    built = {
        "dim_dates": dims.build_dates(spark, cfg.dates_start, cfg.dates_end or run_ts.date(),
                                      run_ts),
        "dim_visitors": dims.build_visitors(raw_events, run_ts),
        "dim_media": dims.build_media(raw_media, raw_events, run_ts),
    }
    for name, df in built.items():
        report.writes[name] = WriteResult(name, df.count(), written=False)
    durations = dims.media_durations(raw_media)
    # both facts from one pass: engagement rows of a day out of the events' rows
    fct = facts.build_events(
        facts.events_since(raw_events, cfg.facts_start, cfg.prune_raw_by_ingest_date),
        durations, run_ts, cfg.max_broadcast_rows)
    day = schemas.TARGET_PARTITION_COL
    by_day = (fct.groupBy(day, "media_id", "visitor_id").agg(F.count(F.lit(1)).alias("n"))
              .groupBy(day).agg(F.sum("n").alias("events"), F.count(F.lit(1)).alias("engagement")).collect())
    days = sorted(r[day] for r in by_day if r[day] is not None)
    for name, col in (("fct_events", "events"), ("fct_media_engagement", "engagement")):
        report.writes[name] = WriteResult(name, sum(r[col] for r in by_day), days,
                                          any(r[day] is None for r in by_day), written=False)
    session.delete_path(spark, staged)
    return report


def run_pipeline(spark: SparkSession, cfg: PipelineConfig, pages: DataFrame | None = None,
                 media_snapshot: DataFrame | None = None,
                 now: dt.datetime | None = None) -> RunReport:
    """Land what was fetched, rebuild, and only then commit the watermark.

    A failure anywhere before the commit leaves the state untouched, so the
    next run fetches the same window again (landing batches are replaced,
    not appended, so the replay is harmless).
    """
    session.configure(spark)
    now = utc(now or dt.datetime.now(dt.timezone.utc))
    checkpoint = read_checkpoint(spark, cfg.state_path)
    window = resolve_window(cfg.mode, cfg.start_date, checkpoint, now)
    if not cfg.dry_run:
        if pages is not None:
            records = landing.records_from_pages(pages, now)
            landing.land_events(records, cfg.source_path,
                                landing.batch_name(window.fetch_start, window.fetch_end))
        if media_snapshot is not None:
            landing.land_media(media_snapshot, cfg.source_path, now.date())
    # an incremental run without a start rebuilds everything, too, unless the ledger knows better
    mode = cfg.mode if cfg.tracked else INCREMENTAL if window.start_date else FULL
    build_cfg = PipelineConfig(**{**cfg.__dict__, "start_date": window.start_date, "mode": mode})
    report = run_batch(spark, build_cfg, now)
    report.checkpoint = commit_checkpoint(spark, cfg.state_path, window.new_last_run_ts,
                                          cfg.persist_state, cfg.dry_run)
    return report
