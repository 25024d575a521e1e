"""Registered queries: one per operator, each over the whole test tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose
columns match the DuckDB oracle of the same name (``reelstar.oracle``).
Raw inputs are derived from the test tables by ``reelstar.sources.testdata``.
The per-run audit column ``updated_at`` is left out of every result, and
floating sums and averages are rounded to 8 decimals for the comparison
(summation order differs between engines).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar import schemas, session
from reelstar.functions import parse_event_time, watch_time
from reelstar.operators import dims, facts
from reelstar.operators.dedupe import latest_per_key
from reelstar.operators.joins import lookup_join
from reelstar.operators.spine import date_spine_between
from reelstar.plans.batch import run_batch
from reelstar.plans.config import PipelineConfig
from reelstar.plans.ledger import DAY, Ledger
from reelstar.sinks.tables import (ensure_tables, overwrite_partitions, overwrite_table,
                                   partition_difference, partition_values, table_counts, table_folder)
from reelstar.sources import landing, testdata
from reelstar.sources.drift import event_drift
from reelstar.sources.raw import ingest_date_counts, read_raw_events, read_raw_media
from reelstar.streaming import incremental as incremental_stream

Query = Callable[[SparkSession, str], DataFrame]
ROUND = 8
ROUNDED = ("total_watch_time", "avg_watch_time_per_view", "avg_percent_viewed")
# Parameters of the job-level queries: start of the incremental window,
# landing cut-offs of the earlier runs, and the landing time of the pages.
INCREMENTAL_START = "2024-01-20"
EARLY_CUTOFF = "2024-01-10"
MERGE_FIRST_CUTOFF = "2024-01-22"
LANDING_TS = "2024-02-02T00:00:00"
QUIET_START = "2030-01-01"
# Ledger queries: landings that are replaced, purged, backfilled and landed twice.
REPLACED_DAY, PURGED_DAY, BACKFILL_DAY, AGAIN_DAY = "2024-01-12", "2024-01-15", "2024-01-05", "2024-01-25"
# Days whose partitions lose their folders, and a folder added outside Spark.
REMOVED_BEFORE, STRAY_DAY = "2024-01-04", "2034-01-10"
# Buckets of the copy that both facts are built from.
CLUSTERED_BUCKETS = 16
REPLACED_KEEPS = "event_key RLIKE '[02468]r?$'"


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    session.configure(spark)
    return testdata.raw_events(spark, sf_dir), testdata.raw_media(spark, sf_dir)


def _values(df: DataFrame, table: str) -> DataFrame:
    """Curated columns minus ``updated_at``; floating aggregates rounded."""
    return df.select(*[
        F.round(c, ROUND).alias(c) if c in ROUNDED else F.col(c)
        for c in schemas.value_columns(table)
    ])


def q_dim_visitors(spark, sf_dir):
    ev, _ = _inputs(spark, sf_dir)
    return _values(dims.build_visitors(ev), "dim_visitors")


def q_dim_media(spark, sf_dir):
    ev, media = _inputs(spark, sf_dir)
    return _values(dims.build_media(media, ev), "dim_media")


def _fct_events(spark, sf_dir, start=None):
    ev, media = _inputs(spark, sf_dir)
    return facts.build_events(facts.events_since(ev, start), dims.media_durations(media))


def q_fct_events(spark, sf_dir):
    return _values(_fct_events(spark, sf_dir), "fct_events")


def q_fct_media_engagement(spark, sf_dir):
    return _values(facts.build_media_engagement(_fct_events(spark, sf_dir)),
                   "fct_media_engagement")


def _run_date_bounds(ev: DataFrame) -> DataFrame:
    """One row: first observed event date, and the run date (last landing)."""
    return ev.agg(
        F.min(F.to_date(parse_event_time("received_at"))).alias("first_event_date"),
        F.max(schemas.RAW_PARTITION_COL).alias("run_date"),
    )


def q_dim_dates(spark, sf_dir):
    """Calendar from the configured start to the run date of the data, as the job builds it."""
    ev, _ = _inputs(spark, sf_dir)
    return dims.build_dates(spark, dims.DEFAULT_DATES_START, _run_date(ev)).drop("updated_at")


def q_date_spine(spark, sf_dir):
    """Spine over the observed event dates, with calendar attributes."""
    ev, _ = _inputs(spark, sf_dir)
    spine = date_spine_between(_run_date_bounds(ev), "first_event_date", "run_date")
    return dims.dates_from_spine(spine).drop("updated_at")


def q_spine_left_observed(spark, sf_dir):
    """Spine LEFT JOIN observed dates: one row per day, flag for activity."""
    ev, _ = _inputs(spark, sf_dir)
    spine = date_spine_between(_run_date_bounds(ev), "first_event_date", "run_date")
    observed = dims.observed_dates(ev).withColumn("has_events", F.lit(True))
    return (spine.join(observed, on="date", how="left")
            .select("date", F.coalesce("has_events", F.lit(False)).alias("has_events")))


# --- raw zone: scans and landing ------------------------------------------

def _landed(spark: SparkSession, sf_dir: str, events_filter=None) -> str:
    """Land the raw inputs as JSON Lines under a fresh scratch root."""
    ev, media = _inputs(spark, sf_dir)
    root = session.scratch_path(spark, "raw")
    landing.land(ev if events_filter is None else ev.where(events_filter), root, "events",
                 "adapter")
    landing.land(media, root, "media", "media")
    return root


def q_raw_scan(spark, sf_dir):
    """JSON round trip of the raw events: every column as landed."""
    return read_raw_events(spark, _landed(spark, sf_dir))


def q_raw_media_scan(spark, sf_dir):
    return read_raw_media(spark, _landed(spark, sf_dir))


def q_raw_ingest_date_counts(spark, sf_dir):
    """Rows per discovered landing partition."""
    return ingest_date_counts(read_raw_events(spark, _landed(spark, sf_dir)))


def q_land_events(spark, sf_dir):
    """API pages -> records stamped with media and landing time -> JSON -> read."""
    session.configure(spark)
    root = session.scratch_path(spark, "land")
    records = landing.records_from_pages(testdata.pages(spark, sf_dir), LANDING_TS)
    batch = landing.batch_name(None, None)
    landing.land_events(records, root, batch)
    landing.land_events(records, root, batch)        # replayed batch replaces itself
    return read_raw_events(spark, root)


def q_raw_drift(spark, sf_dir):
    """Raw fields against the declared ones after the API changed: one field more, one less, one a number."""
    ev, _ = _inputs(spark, sf_dir)
    root = session.scratch_path(spark, "drift")
    cut = F.lit(INCREMENTAL_START).cast("date")
    landing.land(ev.where(F.col(schemas.RAW_PARTITION_COL) < cut), root, "events", "b1")
    changed = (ev.where(F.col(schemas.RAW_PARTITION_COL) >= cut).drop("region")
               .withColumn("percent_viewed", F.col("percent_viewed").cast("double"))
               .withColumn("referrer", F.concat(F.lit("ref-"), "event_key")))
    landing.land(changed, root, "events", "b2")
    return event_drift(spark, root)


def q_land_media(spark, sf_dir):
    """Media snapshots landed per day; a replayed day replaces its snapshot."""
    _, media = _inputs(spark, sf_dir)
    root = session.scratch_path(spark, "land")
    landing.land_media(media, root)
    first = media.where(F.col(schemas.RAW_PARTITION_COL) == F.lit(testdata.FIRST_SNAPSHOT_DATE))
    landing.land_media(first, root)
    return read_raw_media(spark, root)


# --- projections, filters -------------------------------------------------

def q_typed_visitors(spark, sf_dir):
    ev, _ = _inputs(spark, sf_dir)
    return dims.typed_visitors(ev)


def q_typed_media(spark, sf_dir):
    _, media = _inputs(spark, sf_dir)
    return dims.typed_media(media)


def q_typed_events(spark, sf_dir):
    ev, _ = _inputs(spark, sf_dir)
    t = facts.typed_events(ev)
    return t.select(*t.columns, F.to_date("created_at").alias("date"),
                    F.to_date("created_at").alias(schemas.TARGET_PARTITION_COL))


def q_event_watch_time(spark, sf_dir):
    """Every raw event with its media duration and seconds watched."""
    ev, media = _inputs(spark, sf_dir)
    t = facts.typed_events(ev)
    joined = lookup_join(t, dims.media_durations(media), "media_id")
    return joined.select("event_key", "media_id", "percent_viewed", "duration",
                         watch_time("duration", "percent_viewed").alias("duration_viewed"))


def q_media_channel_counts(spark, sf_dir):
    ev, media = _inputs(spark, sf_dir)
    return (dims.build_media(media, ev).groupBy("channel")
            .agg(F.count(F.lit(1)).alias("n_media")))


def q_incremental_filter(spark, sf_dir):
    """Raw events dated on/after the window start, some of them dated after
    their landing day or without one."""
    ev, _ = _inputs(spark, sf_dir)
    return (facts.events_since(testdata.unordered_landings(ev), INCREMENTAL_START)
            .select("event_key", "media_id", "received_at", schemas.RAW_PARTITION_COL))


# --- joins, aggregates, windows -------------------------------------------

def q_latest_per_key(spark, sf_dir):
    """Generic dedupe on another key: each visitor's latest landed event."""
    ev, _ = _inputs(spark, sf_dir)
    t = facts.typed_events(ev).where(F.col("visitor_id").isNotNull())
    return latest_per_key(t, "visitor_id", ["ingest_at", "event_key"]).select(
        "visitor_id", "event_key", "ingest_at", "media_id", "created_at", "percent_viewed")


def q_media_with_url(spark, sf_dir):
    ev, media = _inputs(spark, sf_dir)
    return dims.build_media(media, ev).select("media_id", "title", "media_url")


def q_distinct_media_urls(spark, sf_dir):
    ev, _ = _inputs(spark, sf_dir)
    return ev.select("media_id", "media_url").distinct()


def q_affected_partitions(spark, sf_dir):
    """Partitions an incremental run rewrites, with their row counts."""
    return (_fct_events(spark, sf_dir, INCREMENTAL_START).groupBy(schemas.TARGET_PARTITION_COL)
            .agg(F.count(F.lit(1)).alias("rows")))


def _long(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _metric(df: DataFrame, table: str, metric: str, value) -> DataFrame:
    return df.agg(value.cast("bigint").alias("value")).select(
        F.lit(table).alias("table_name"), F.lit(metric).alias("metric"), "value")


def q_pk_violations(spark, sf_dir):
    """Rows and duplicated primary keys of each table after a full run
    (expect 0), from one aggregate a table."""
    db = _full_run(spark, sf_dir)
    frames = []
    for table in schemas.CURATED:
        by_key = spark.table(f"{db}.{table}").groupBy(*schemas.PRIMARY_KEYS[table]).count()
        both = by_key.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("rows"),
                          F.count(F.when(F.col("count") > 1, 1)).alias("duplicate_keys"))
        frames.append(both.unpivot([], ["rows", "duplicate_keys"], "metric", "value")
                      .select(F.lit(table).alias("table_name"), "metric", "value"))
    return _long(frames)


# --- sinks and jobs -------------------------------------------------------

def _scratch_db(spark: SparkSession) -> tuple[str, str]:
    name = f"reelstar_{uuid.uuid4().hex[:10]}"
    return name, session.scratch_path(spark, "wh")


def _run_date(raw: DataFrame):
    return raw.agg(F.max(schemas.RAW_PARTITION_COL)).first()[0]


def q_overwrite_table_roundtrip(spark, sf_dir):
    """dim_visitors written from early data, then fully replaced, read back."""
    ev, _ = _inputs(spark, sf_dir)
    db, wh = _scratch_db(spark)
    ensure_tables(spark, db, wh)
    early = ev.where(F.col(schemas.RAW_PARTITION_COL) <= F.lit(EARLY_CUTOFF).cast("date"))
    overwrite_table(dims.build_visitors(early), f"{db}.dim_visitors")
    overwrite_table(dims.build_visitors(ev), f"{db}.dim_visitors")
    return _values(spark.table(f"{db}.dim_visitors"), "dim_visitors")


def q_overwrite_partitions_merge(spark, sf_dir):
    """Dynamic overwrite: a later rebuild of some days leaves the others."""
    ev, media = _inputs(spark, sf_dir)
    db, wh = _scratch_db(spark)
    ensure_tables(spark, db, wh)
    durations = dims.media_durations(media)
    first = ev.where(F.col(schemas.RAW_PARTITION_COL) <= F.lit(MERGE_FIRST_CUTOFF).cast("date"))
    overwrite_partitions(facts.build_events(first, durations), f"{db}.fct_events")
    overwrite_partitions(facts.build_events(facts.events_since(ev, INCREMENTAL_START), durations),
                         f"{db}.fct_events")
    return _values(spark.table(f"{db}.fct_events"), "fct_events")


def _full_run(spark, sf_dir) -> str:
    root = _landed(spark, sf_dir)
    db, wh = _scratch_db(spark)
    run_date = _run_date(read_raw_events(spark, root))
    run_batch(spark, PipelineConfig(source_path=root, target_db=db, warehouse_dir=wh,
                                    dates_end=run_date))
    return db


def _clustered_run(spark: SparkSession, sf_dir: str) -> str:
    """A full run whose facts come from one exchange; buckets are small enough for heavy pairs to be split."""
    root = _landed(spark, sf_dir)
    db, wh = _scratch_db(spark)
    raw = read_raw_events(spark, root)
    run_batch(spark, PipelineConfig(source_path=root, target_db=db, warehouse_dir=wh, dates_end=_run_date(raw),
                                    cluster_facts=True, bucket_rows=max(1, raw.count() // CLUSTERED_BUCKETS)))
    return db


def q_clustered_events(spark, sf_dir):
    return _values(spark.table(f"{_clustered_run(spark, sf_dir)}.fct_events"), "fct_events")


def q_clustered_engagement(spark, sf_dir):
    return _values(spark.table(f"{_clustered_run(spark, sf_dir)}.fct_media_engagement"), "fct_media_engagement")


def q_partition_diff(spark, sf_dir):
    """Partitions whose folders were removed, and folders that the catalog doesn't know."""
    table = f"{_full_run(spark, sf_dir)}.fct_events"
    part, root = schemas.TARGET_PARTITION_COL, table_folder(spark, table)
    for day in partition_values(spark, table):
        if day is not None and day.isoformat() < REMOVED_BEFORE:
            session.delete_path(spark, f"{root}/{part}={day}")
    one = spark.table(table).where(F.col(part) == F.lit(EARLY_CUTOFF).cast("date")).drop(part)
    one.write.parquet(f"{root}/{part}={STRAY_DAY}")
    return partition_difference(spark, table)


def q_table_counts(spark, sf_dir):
    """Row count of every table in the curated database after a full run."""
    return table_counts(spark, _full_run(spark, sf_dir))


def _table_summary(spark, db: str) -> DataFrame:
    frames = []
    for table in schemas.CURATED:
        df = spark.table(f"{db}.{table}")
        if schemas.PARTITION_COLS[table]:
            pc = F.col(schemas.TARGET_PARTITION_COL)
            parts, nulls = F.countDistinct(pc), F.sum(F.when(pc.isNull(), 1).otherwise(0))
        else:
            parts, nulls = F.lit(0), F.lit(0)
        frames.append(df.agg(F.count(F.lit(1)).alias("rows"),
                             parts.cast("bigint").alias("partitions"),
                             F.coalesce(nulls, F.lit(0)).cast("bigint").alias("null_date_rows"))
                      .select(F.lit(table).alias("table_name"), "*"))
    return _long(frames)


def q_full_pipeline_counts(spark, sf_dir):
    """Full rebuild from landed JSON: rows, partitions, NULL-day rows per table."""
    return _table_summary(spark, _full_run(spark, sf_dir))


def _dated(df: DataFrame, table: str) -> DataFrame:
    df = _values(df, table)
    if schemas.PARTITION_COLS[table]:
        df = df.where(F.col(schemas.TARGET_PARTITION_COL).isNotNull())
    return df


def q_incremental_equals_full(spark, sf_dir):
    """Full run on early landings, then an incremental run after the rest
    landed, against one full run over everything (dated partitions)."""
    ev, media = _inputs(spark, sf_dir)
    cut = F.lit(INCREMENTAL_START).cast("date")
    root = session.scratch_path(spark, "raw")
    landing.land(media, root, "media", "media")
    landing.land(ev.where(F.col(schemas.RAW_PARTITION_COL) < cut), root, "events", "b1")
    db_inc, wh = _scratch_db(spark)
    late = ev.where(F.col(schemas.RAW_PARTITION_COL) >= cut)
    run_date = _run_date(ev)
    run_batch(spark, PipelineConfig(source_path=root, target_db=db_inc, warehouse_dir=wh,
                                    dates_end=run_date))
    landing.land(late, root, "events", "b2")
    # the window starts at the earliest event day among the new landings
    start = late.agg(F.min(F.to_date(parse_event_time("received_at")))).first()[0]
    run_batch(spark, PipelineConfig(source_path=root, target_db=db_inc, warehouse_dir=wh,
                                    mode="incremental", start_date=start, dates_end=run_date))
    db_full, wh2 = _scratch_db(spark)
    run_batch(spark, PipelineConfig(source_path=root, target_db=db_full, warehouse_dir=wh2,
                                    dates_end=run_date))
    frames = []
    for table in schemas.CURATED:
        a = _dated(spark.table(f"{db_inc}.{table}"), table)
        b = _dated(spark.table(f"{db_full}.{table}"), table)
        frames.append(_metric(a, table, "rows", F.count(F.lit(1))))
        frames.append(_metric(a.exceptAll(b).unionByName(b.exceptAll(a)), table,
                              "mismatched_rows", F.count(F.lit(1))))
    return _long(frames)


def q_incremental_quiet_window(spark, sf_dir):
    """A full run, then an incremental run whose window holds no event: all tables as they were."""
    root = _landed(spark, sf_dir)
    db, wh = _scratch_db(spark)
    run_date = _run_date(read_raw_events(spark, root))
    cfg = dict(source_path=root, target_db=db, warehouse_dir=wh, dates_end=run_date)
    run_batch(spark, PipelineConfig(**cfg))
    run_batch(spark, PipelineConfig(mode="incremental", start_date=QUIET_START, **cfg))
    return _table_summary(spark, db)


def q_full_rebuild_after_purge(spark, sf_dir):
    """A full run over everything, then one over later landings alone that
    replaces all: no earlier row comes back."""
    db, wh = _scratch_db(spark)
    everything = _landed(spark, sf_dir)
    run_date = _run_date(read_raw_events(spark, everything))
    cfg = dict(target_db=db, warehouse_dir=wh, dates_end=run_date)
    run_batch(spark, PipelineConfig(source_path=everything, **cfg))
    later = _landed(spark, sf_dir, F.col(schemas.RAW_PARTITION_COL) >= F.lit(INCREMENTAL_START).cast("date"))
    run_batch(spark, PipelineConfig(source_path=later, replace_all=True, **cfg))
    return _values(spark.table(f"{db}.fct_events"), "fct_events")


def _incremental_run(spark: SparkSession, sf_dir: str) -> str:
    """Full run over early landings, the rest landed to an older day too, an incremental run."""
    ev, media = _inputs(spark, sf_dir)
    cut = F.lit(INCREMENTAL_START).cast("date")
    root = session.scratch_path(spark, "raw")
    landing.land(media, root, "media", "media")
    landing.land(ev.where(F.col(schemas.RAW_PARTITION_COL) < cut), root, "events", "b1")
    db, wh = _scratch_db(spark)
    cfg = dict(source_path=root, target_db=db, warehouse_dir=wh, dates_end=_run_date(ev))
    run_batch(spark, PipelineConfig(**cfg))
    late = ev.where(F.col(schemas.RAW_PARTITION_COL) >= cut)
    start = late.agg(F.min(F.to_date(parse_event_time("received_at")))).first()[0]
    # a backfill: landed under a day that the first run had already read
    landing.land(late.withColumn(schemas.RAW_PARTITION_COL, F.lit(EARLY_CUTOFF).cast("date")), root, "events", "b2")
    run_batch(spark, PipelineConfig(mode="incremental", start_date=start, **cfg))
    return db


def q_incremental_dim_visitors(spark, sf_dir):
    """dim_visitors after a backfilled landing and an incremental run."""
    return _values(spark.table(f"{_incremental_run(spark, sf_dir)}.dim_visitors"), "dim_visitors")


def q_incremental_engagement(spark, sf_dir):
    """Dated engagement after a backfilled landing and an incremental run."""
    return _dated(spark.table(f"{_incremental_run(spark, sf_dir)}.fct_media_engagement"), "fct_media_engagement")


def _tracked(spark: SparkSession, root: str, db: str, wh: str, mode: str = "incremental"):
    return run_batch(spark, PipelineConfig(source_path=root, target_db=db, warehouse_dir=wh, mode=mode, tracked=True,
                                           dates_end=LANDING_TS[:10]))


def _landing_day(day: str):
    return F.col(schemas.RAW_PARTITION_COL) == F.lit(day).cast("date")


def _tracked_run(spark: SparkSession, sf_dir: str) -> str:
    """A first tracked run over early landings, then one after a landing was
    replaced by half its rows, one purged, and all later events landed under an old day."""
    ev, media = _inputs(spark, sf_dir)
    cut = F.lit(INCREMENTAL_START).cast("date")
    root = session.scratch_path(spark, "raw")
    landing.land(media, root, "media", "media")
    landing.land(ev.where(F.col(schemas.RAW_PARTITION_COL) < cut), root, "events", "b1")
    db, wh = _scratch_db(spark)
    _tracked(spark, root, db, wh)
    landing.land(ev.where(_landing_day(REPLACED_DAY)).where(REPLACED_KEEPS), root, "events", "b1")
    session.delete_path(spark, f"{root}/events/{schemas.RAW_PARTITION_COL}={PURGED_DAY}")
    late = ev.where(F.col(schemas.RAW_PARTITION_COL) >= cut)
    landing.land(late.withColumn(schemas.RAW_PARTITION_COL, F.lit(BACKFILL_DAY).cast("date")), root, "events", "late")
    _tracked(spark, root, db, wh)
    return db


def q_incremental_partials(spark, sf_dir):
    """dim_visitors from the partials of landings, after a replaced, a purged and a backfilled one."""
    return _values(spark.table(f"{_tracked_run(spark, sf_dir)}.dim_visitors"), "dim_visitors")


def q_tracked_media(spark, sf_dir):
    """dim_media after the same landings: URLs that only the purged one had are gone."""
    return _values(spark.table(f"{_tracked_run(spark, sf_dir)}.dim_media"), "dim_media")


def q_tracked_engagement(spark, sf_dir):
    """Engagement of all days, the unknown one too, after the same landings."""
    return _values(spark.table(f"{_tracked_run(spark, sf_dir)}.fct_media_engagement"), "fct_media_engagement")


def q_touched_days(spark, sf_dir):
    """Days to rebuild after a landing was purged, one was landed again and the oldest event once more."""
    ev, media = _inputs(spark, sf_dir)
    root = session.scratch_path(spark, "raw")
    landing.land(media, root, "media", "media")
    landing.land(ev, root, "events", "b1")
    db, wh = _scratch_db(spark)
    _tracked(spark, root, db, wh)
    oldest = ev.agg(F.min(F.struct("received_at", "event_key"))["event_key"]).first()[0]
    again = ev.where(_landing_day(AGAIN_DAY) | (F.col("event_key") == oldest))
    landing.land(again.withColumn(schemas.RAW_PARTITION_COL, F.lit(LANDING_TS[:10]).cast("date")), root, "events", "again")
    session.delete_path(spark, f"{root}/events/{schemas.RAW_PARTITION_COL}={PURGED_DAY}")
    ledger = Ledger.for_db(spark, db, wh, root)
    changes = ledger.look()
    ledger.take(changes)
    return ledger.touched(changes).withColumnRenamed(DAY, schemas.TARGET_PARTITION_COL)


def q_duration_change(spark, sf_dir):
    """Engagement after a snapshot was replaced by one with other durations: nothing
    but the days of those media is rebuilt, and no watch time is stale."""
    ev, media = _inputs(spark, sf_dir)
    root = session.scratch_path(spark, "raw")
    wrong = F.when(F.col("id").cast("long") % 5 == 0, (F.col("duration").cast("double") * 2).cast("string"))
    landing.land(media.withColumn("duration", F.coalesce(wrong, F.col("duration"))), root, "media", "media")
    landing.land(ev, root, "events", "b1")
    db, wh = _scratch_db(spark)
    _tracked(spark, root, db, wh)
    landing.land(media, root, "media", "media")
    _tracked(spark, root, db, wh)
    return _values(spark.table(f"{db}.fct_media_engagement"), "fct_media_engagement")


def _stream_db(spark: SparkSession, sf_dir: str) -> str:
    """Run the availableNow stream over two landings; return the database it maintained."""
    ev, media = _inputs(spark, sf_dir)
    cut = F.lit(INCREMENTAL_START).cast("date")
    root = session.scratch_path(spark, "raw")
    landing.land(media, root, "media", "media")
    db, wh = _scratch_db(spark)
    cfg = PipelineConfig(source_path=root, target_db=db, warehouse_dir=wh)
    ckpt = session.scratch_path(spark, "stream")
    landing.land(ev.where(F.col(schemas.RAW_PARTITION_COL) < cut), root, "events", "b1")
    incremental_stream.run_available_now(spark, cfg, ckpt, max_files_per_trigger=128)
    landing.land(ev.where(F.col(schemas.RAW_PARTITION_COL) >= cut), root, "events", "b2")
    incremental_stream.run_available_now(spark, cfg, ckpt, max_files_per_trigger=128)
    return db


def q_stream_incremental(spark, sf_dir):
    """availableNow file stream over two landings; dated engagement after both."""
    db = _stream_db(spark, sf_dir)
    return _values(spark.table(f"{db}.fct_media_engagement"), "fct_media_engagement")


def q_stream_dim_visitors(spark, sf_dir):
    """dim_visitors as merged micro-batch by micro-batch by the stream."""
    return _values(spark.table(f"{_stream_db(spark, sf_dir)}.dim_visitors"), "dim_visitors")


def q_stream_dim_media(spark, sf_dir):
    """dim_media (with URL state) as maintained by the stream."""
    return _values(spark.table(f"{_stream_db(spark, sf_dir)}.dim_media"), "dim_media")


def queries() -> dict[str, Query]:
    return {
        # flagship and the five tables
        "fct_media_engagement": q_fct_media_engagement,
        "fct_events": q_fct_events,
        "dim_visitors": q_dim_visitors,
        "dim_media": q_dim_media,
        "dim_dates": q_dim_dates,
        # generators and joins on the calendar
        "date_spine": q_date_spine,
        "spine_left_observed": q_spine_left_observed,
        # raw zone
        "raw_scan": q_raw_scan,
        "raw_media_scan": q_raw_media_scan,
        "raw_ingest_date_counts": q_raw_ingest_date_counts,
        "land_events": q_land_events,
        "land_media": q_land_media,
        "raw_drift": q_raw_drift,
        # projections and filters
        "typed_visitors": q_typed_visitors,
        "typed_media": q_typed_media,
        "typed_events": q_typed_events,
        "event_watch_time": q_event_watch_time,
        "media_channel_counts": q_media_channel_counts,
        "incremental_filter": q_incremental_filter,
        # joins, aggregates, dedupe
        "latest_per_key": q_latest_per_key,
        "media_with_url": q_media_with_url,
        "distinct_media_urls": q_distinct_media_urls,
        "affected_partitions": q_affected_partitions,
        "pk_violations": q_pk_violations,
        # sinks and jobs
        "overwrite_table_roundtrip": q_overwrite_table_roundtrip,
        "overwrite_partitions_merge": q_overwrite_partitions_merge,
        "clustered_events": q_clustered_events,
        "clustered_engagement": q_clustered_engagement,
        "partition_diff": q_partition_diff,
        "table_counts": q_table_counts,
        "full_pipeline_counts": q_full_pipeline_counts,
        "incremental_equals_full": q_incremental_equals_full,
        "incremental_quiet_window": q_incremental_quiet_window,
        "incremental_dim_visitors": q_incremental_dim_visitors,
        "incremental_engagement": q_incremental_engagement,
        "incremental_partials": q_incremental_partials,
        "tracked_media": q_tracked_media,
        "tracked_engagement": q_tracked_engagement,
        "touched_days": q_touched_days,
        "duration_change": q_duration_change,
        "full_rebuild_after_purge": q_full_rebuild_after_purge,
        "stream_incremental": q_stream_incremental,
        "stream_dim_visitors": q_stream_dim_visitors,
        "stream_dim_media": q_stream_dim_media,
    }
