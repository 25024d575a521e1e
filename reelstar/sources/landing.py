"""Landing: API pages -> raw records -> JSON Lines partitioned by day.

Pages are ``(media_id, page, payload)`` with ``payload`` the JSON array the
API returned; an empty array ends a media. Parsing and flattening are
narrow (per-row) operators; the only aggregate finds each media's first
empty page (one row per media).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstar import schemas, session
from reelstar.functions import utc
from reelstar.operators.joins import DEFAULT_MAX_BROADCAST_ROWS

STAMPED = ("media_id", "ingest_ts")
RECORD_FIELDS = [c for c in schemas.RAW_EVENT_COLUMNS if c not in STAMPED]
RECORDS = "array<map<string,string>>"
BATCH_COL = schemas.RAW_BATCH_COL
# The whole record as JSON text, as it is landed.
RECORD_COL = "record"


def _before_stop(pages: DataFrame, max_broadcast_rows: int) -> DataFrame:
    """Pages before the first empty one of their media.

    The stop pages (one row a media that has any) are found once, written, and
    broadcast if there are few enough. Beyond that the pages to leave out are found
    without their payload, by (media, page): they are the few pages after an end. What
    is left over is left out by a broadcast or a join on these two columns, whose
    keys are spread; payloads aren't shuffled by a media that has a third of them.
    """
    spark = pages.sparkSession
    path = session.scratch_path(spark, "stops")
    found = pages.where(F.json_array_length("payload") == 0).groupBy("media_id").agg(F.min("page").alias("stop_page"))
    found.write.parquet(path)
    stops = spark.read.schema(found.schema).parquet(path)
    if stops.count() <= max_broadcast_rows:
        kept = pages.join(F.broadcast(stops), "media_id", "left")
        return kept.where(F.col("stop_page").isNull() | (F.col("page") < F.col("stop_page"))).select(*pages.columns)
    after = (pages.select("media_id", "page").join(stops, "media_id")
             .where(~F.coalesce(F.col("page") < F.col("stop_page"), F.lit(False)))
             .select(F.col("media_id").alias("_media"), F.col("page").alias("_page")).distinct())
    return pages.join(after, (F.col("media_id") == F.col("_media")) & F.col("page").eqNullSafe(F.col("_page")), "left_anti")


def records_from_pages(pages: DataFrame, ingest_ts: dt.datetime | str,
                       max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Flatten pages into raw event records stamped with media and landing time.

    Pages after a media's first empty page are ignored (the fetch loop stops
    there). Scalar API values of any JSON type land as their text. ``record``
    holds the whole record, also fields that the raw columns don't name. A page
    that is neither NULL nor a JSON array of records fails the job.

    The stop page is found by counting a page's elements; records are parsed
    once, and only of the pages kept.
    """
    stamp = ingest_ts if isinstance(ingest_ts, str) else utc(ingest_ts).isoformat()
    length = F.json_array_length("payload")
    kept = _before_stop(pages, max_broadcast_rows).where(F.col("payload").isNotNull())
    bad = F.raise_error(F.concat(F.lit("page "), F.col("page").cast("string"), F.lit(" of media "),
                                 F.coalesce("media_id", F.lit("NULL")), F.lit(" isn't a JSON array")))
    whole = F.when(length.isNull(), bad.cast("string")).otherwise(F.col("payload"))
    # what is an array but no array of objects fails in the parser
    flat = kept.select("media_id", F.explode(F.from_json(whole, RECORDS, {"mode": "FAILFAST"})).alias("r"))
    stamped = F.map_from_arrays(F.array(*map(F.lit, STAMPED)), F.array("media_id", F.lit(stamp)))
    others = F.map_filter("r", lambda k, v: ~k.isin(*STAMPED))
    by_name = {c: F.col("r")[c] for c in RECORD_FIELDS}
    by_name["media_id"] = F.col("media_id")
    by_name["ingest_ts"] = F.lit(stamp)
    return flat.select(*[by_name[c].alias(c) for c in schemas.RAW_EVENT_COLUMNS],
                       F.to_json(F.map_concat(others, stamped)).alias(RECORD_COL),
                       F.to_date(F.lit(stamp[:10])).alias(schemas.RAW_PARTITION_COL))


def batch_name(start: dt.date | None, end: dt.date | None) -> str:
    """Name of a landing batch: re-running the same window replaces it."""
    if start and end:
        return f"events_{start.isoformat()}-{end.isoformat()}"
    if start:
        return f"events_{start.isoformat()}-latest"
    return "events_full_refresh"


def land(records: DataFrame, root: str, table: str, batch: str) -> None:
    """Write records under ``root/table/ingest_date=D/batch=B/`` as JSON Lines.

    Dynamic overwrite on (ingest_date, batch): a replayed batch replaces its
    own files only; other batches of the same day stay. Of an empty frame
    only the folder is made. Whole records, where there are any, are written
    as they are.
    """
    out = records.withColumn(BATCH_COL, F.lit(batch))
    whole = RECORD_COL in records.columns
    if whole:
        out = out.select(RECORD_COL, schemas.RAW_PARTITION_COL, BATCH_COL)
    writer = (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy(schemas.RAW_PARTITION_COL, BATCH_COL))
    (writer.text if whole else writer.json)(f"{root.rstrip('/')}/{table}")


def land_events(records: DataFrame, root: str, batch: str) -> None:
    land(records, root, "events", batch)


def land_media(snapshot: DataFrame, root: str, ingest_date: dt.date | str | None = None) -> None:
    """Land a media metadata snapshot; one snapshot per landing day."""
    cols = [F.col(c) if c in snapshot.columns else F.lit(None).cast("string").alias(c)
            for c in schemas.RAW_MEDIA_COLUMNS]
    day = (F.lit(ingest_date).cast("date") if ingest_date is not None
           else F.col(schemas.RAW_PARTITION_COL))
    land(snapshot.select(*cols, day.alias(schemas.RAW_PARTITION_COL)), root, "media", "media")
