"""Incremental fact maintenance on Structured Streaming (R5).

A file stream over the raw events directory (``trigger(availableNow)``)
hands each micro-batch of newly landed files to ``foreachBatch``. A batch is
parsed once: its used columns are appended to a parquet copy partitioned by event
day and batch id, which lives inside the stream's checkpoint and holds all that the
stream has seen: a new checkpoint begins a new copy. The days a batch touches are its partitions in the copy; they are
rebuilt from the copy, which reads these days only, and replace their fact
partitions by dynamic overwrite. A replayed batch replaces its own partitions
of the copy and recomputes the same days, so the sink is idempotent and the
stream's checkpoint gives exactly-once progress.

Once a day has ``FAN`` folders of a like size they are rewritten as one (``compact``), so a day keeps
a number of files that grows with the logarithm of its batches. Only batches before the current
one are rewritten, for a replay replaces no other; a rewritten folder has a negative id of its
own. It is moved into place before its parts are removed: a run that stops in between leaves
rows twice, which the facts' dedupe and the dimensions' minima and maxima take for one.

Dimensions are merged from the batch's copy (min/max merges, see
``operators.dims``) plus the media snapshots landed since the media watermark, so
the stream keeps all five tables current; a stream only ever sees landings
appended. If an earlier write of them stopped half-way they are rebuilt from the raw
zone instead. Like the batch job's incremental mode, events whose time
cannot be parsed (NULL day) are left to full runs.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reelstar import schemas, session
from reelstar.functions import parse_event_time, utc
from reelstar.operators import dims, facts
from reelstar.plans.config import PipelineConfig
from reelstar.sinks.tables import WriteResult, ensure_tables, in_partitions, overwrite_partitions
from reelstar.sources.landing import BATCH_COL
from reelstar.sources.raw import EVENT_COLUMNS_USED, read_raw_events, read_raw_media


DAY_COL, ID_COL = "event_day", "batch_id"
# Folders of a size class that are rewritten as one, and the first class's limit; size of the files made.
FAN = 8
SMALL_BYTES = 1 << 20
FILE_BYTES = 128 << 20


def append_batch(batch: DataFrame, batch_id: int, copy: str) -> DataFrame:
    """Parse a micro-batch into the event-day copy; the batch as read back."""
    day = F.to_date(parse_event_time("received_at")).alias(DAY_COL)
    (batch.select(*EVENT_COLUMNS_USED, schemas.RAW_PARTITION_COL, day, F.lit(batch_id).cast("long").alias(ID_COL))
     .hint("rebalance", DAY_COL).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(DAY_COL, ID_COL).parquet(copy))
    return read_copy(batch.sparkSession, copy).where(F.col(ID_COL) == batch_id)


def copy_path(checkpoint_location: str) -> str:
    return f"{checkpoint_location.rstrip('/')}/event-days"


def read_copy(spark: SparkSession, copy: str) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in EVENT_COLUMNS_USED])
    for name, kind in ((schemas.RAW_PARTITION_COL, "date"), (DAY_COL, "date"), (ID_COL, "long")):
        schema = schema.add(name, kind)
    return spark.read.schema(schema).parquet(copy)


def _tier(size: int) -> int:
    """Size class of a folder: each is ``FAN`` times the one before."""
    tier, limit = 0, SMALL_BYTES
    while size >= limit:
        tier, limit = tier + 1, limit * FAN
    return tier


def compact(spark: SparkSession, copy: str, dates: list[dt.date | None], batch_id: int) -> int:
    """Rewrite the batch folders of days that have ``FAN`` of a size class; returns the folders removed."""
    schema = T.StructType([f for f in read_copy(spark, copy).schema if f.name not in (DAY_COL, ID_COL)])
    removed = 0
    for date in dates:
        day = f"{copy}/{DAY_COL}={'__HIVE_DEFAULT_PARTITION__' if date is None else date}"
        tiers: dict[int, list[tuple[str, int]]] = {}
        for name, size in session.folder_sizes(spark, day):
            if name.startswith(f"{ID_COL}=") and name != f"{ID_COL}={batch_id}":
                tiers.setdefault(_tier(size), []).append((f"{day}/{name}", size))
        for parts in tiers.values():
            if len(parts) < FAN:
                continue
            # hidden from readers until it is moved: names with an underscore aren't listed
            made = f"{copy}/_made/{uuid.uuid4().hex}"
            files = -(-sum(size for _, size in parts) // FILE_BYTES)
            spark.read.schema(schema).parquet(*[p for p, _ in parts]).coalesce(files).write.parquet(made)
            session.move_path(spark, made, f"{day}/{ID_COL}=-{uuid.uuid4().int >> 80}")
            for p, _ in parts:
                session.delete_path(spark, p)
            removed += len(parts)
    return removed


def touched_dates(batch: DataFrame) -> list[dt.date]:
    """Distinct event days of a batch in the copy: its partition values."""
    return sorted(r[0] for r in batch.select(DAY_COL).where(F.col(DAY_COL).isNotNull()).distinct().collect())


def rebuild_dates(spark: SparkSession, cfg: PipelineConfig, copy: str, dates: list[dt.date],
                  run_ts: dt.datetime | None = None,
                  media_rows: int | None = None) -> dict[str, WriteResult]:
    """Recompute both facts for ``dates`` from the copy and replace them.

    ``media_rows``: row count of dim_media if this micro-batch just wrote it
    (a proven bound for broadcasting the duration lookup).
    """
    if not dates:
        return {}
    db = cfg.target_db
    events = read_copy(spark, copy).where(F.col(DAY_COL).isin(dates))
    if media_rows or spark.table(f"{db}.dim_media").take(1):
        durations = spark.table(f"{db}.dim_media").select("media_id", "duration")
    else:
        durations, media_rows = dims.media_durations(
            read_raw_media(spark, cfg.source_path, missing_ok=cfg.allow_missing_source)), None
    days = WriteResult("days", 0, dates)
    fct = facts.build_events(events, durations, run_ts, cfg.max_broadcast_rows, media_rows)
    out = {"fct_events": overwrite_partitions(fct, f"{db}.fct_events", days=days)}
    written = in_partitions(spark.table(f"{db}.fct_events"), schemas.TARGET_PARTITION_COL, days)
    out["fct_media_engagement"] = overwrite_partitions(
        facts.build_media_engagement(written, run_ts), f"{db}.fct_media_engagement", days=days)
    return out


def refresh_dimensions(spark: SparkSession, cfg: PipelineConfig, batch: DataFrame,
                       run_ts: dt.datetime | None = None) -> dict[str, WriteResult]:
    """Merge a batch of the copy (and new media snapshots) into the
    dimensions. The events watermark is left to batch runs, which re-read
    from their own watermark (harmless overlap: the merges are idempotent)."""
    from reelstar.plans.batch import write_dimensions
    from reelstar.plans.dimstate import DimState

    run_ts = utc(run_ts or dt.datetime.now(dt.timezone.utc)).replace(microsecond=0)
    state = DimState.for_db(spark, cfg.target_db, cfg.warehouse_dir)
    events_wm, media_wm = state.watermark(spark)
    reread = state.write_open(spark)
    urls = state.urls(spark)
    if reread:
        batch, media_wm = read_raw_events(spark, cfg.source_path), None
    elif urls is None:
        urls = spark.createDataFrame([], "media_id string, media_url string")
    media = read_raw_media(spark, cfg.source_path, since=media_wm, missing_ok=cfg.allow_missing_source)
    through = media.agg(F.max(schemas.RAW_PARTITION_COL)).first()[0]
    out = write_dimensions(spark, cfg, state, batch, media, run_ts, urls)
    state.write_watermark(spark, events_wm, through or media_wm)
    state.drop_staging(spark)
    return out


def start(spark: SparkSession, cfg: PipelineConfig, checkpoint_location: str,
          max_files_per_trigger: int | None = None, available_now: bool = True,
          processing_time: str | None = None, maintain_dimensions: bool = True) -> StreamingQuery:
    """Start the stream; with ``available_now`` it stops when caught up."""
    session.configure(spark)
    ensure_tables(spark, cfg.target_db, cfg.warehouse_dir)
    read_schema = (T.StructType(list(schemas.RAW_EVENTS.fields))
                   .add(schemas.RAW_PARTITION_COL, "date").add(BATCH_COL, "string"))
    reader = spark.readStream.schema(read_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(f"{cfg.source_path.rstrip('/')}/events")
    # inside the checkpoint, with which it lives and dies: both know the same files
    copy = copy_path(checkpoint_location)

    def process(batch: DataFrame, batch_id: int) -> None:
        copied = append_batch(batch, batch_id, copy)
        media_rows = None
        if maintain_dimensions:
            media_rows = refresh_dimensions(spark, cfg, copied)["dim_media"].rows
        dates = touched_dates(copied)
        rebuild_dates(spark, cfg, copy, dates, media_rows=media_rows)
        compact(spark, copy, [*dates, None], batch_id)

    writer = (stream.writeStream.foreachBatch(process)
              .option("checkpointLocation", checkpoint_location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_available_now(spark: SparkSession, cfg: PipelineConfig, checkpoint_location: str,
                      max_files_per_trigger: int | None = None,
                      maintain_dimensions: bool = True) -> int:
    """Process everything landed so far; returns the number of micro-batches."""
    q = start(spark, cfg, checkpoint_location, max_files_per_trigger,
              maintain_dimensions=maintain_dimensions)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return sum(1 for p in q.recentProgress if p.get("numInputRows", 0) > 0)
