"""Dimension builders: visitors, media, dates.

Pure ``DataFrame -> DataFrame`` functions; ``run_ts`` is the run's single
audit timestamp (``updated_at``), so a whole run stamps one value.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar import schemas
from reelstar.functions import channel_of, date_attributes, typed_select, utc
from reelstar.operators.spine import date_spine

# --- fixed values: raw -> typed projections (source, target, type) -------
VISITOR_SPEC = (
    ("visitor_key", "visitor_id", "string"),
    ("received_at", "created_at", "timestamp"),
    ("ip", "ip_address", "string"),
    ("country", "country", "string"),
    ("region", "region", "string"),
)
MEDIA_SPEC = (
    ("hashed_id", "media_id", "string"),
    ("created", "created_at", "timestamp"),
    ("duration", "duration", "double"),
    ("name", "title", "string"),
)
# First day of the calendar dimension unless configured otherwise.
DEFAULT_DATES_START = dt.date(2024, 1, 29)


def audit_ts(run_ts: dt.datetime | None) -> Column:
    """The run's ``updated_at``: a literal when given, else the query time.

    A time without a zone is in UTC. It goes to Spark as text with a zone:
    a plain datetime would be read in the driver's own time zone.
    """
    if run_ts is None:
        return F.current_timestamp()
    return F.lit(utc(run_ts).isoformat() + "Z").cast("timestamp")


def typed_visitors(raw_events: DataFrame) -> DataFrame:
    return typed_select(raw_events, VISITOR_SPEC).where(F.col("visitor_id").isNotNull())


def build_visitors(raw_events: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """dim_visitors, one row per known visitor.

    First-seen instant and the greatest ip / country / region per visitor
    (column-wise maxima, NULLs skipped). Anonymous events are left out.
    """
    return (
        typed_visitors(raw_events)
        .groupBy("visitor_id")
        .agg(
            F.min("created_at").alias("created_at"),
            F.max("ip_address").alias("ip_address"),
            F.max("country").alias("country"),
            F.max("region").alias("region"),
        )
        .select(*schemas.DIM_VISITORS.names[:-1], audit_ts(run_ts).alias("updated_at"))
    )


def typed_media(raw_media: DataFrame) -> DataFrame:
    return typed_select(raw_media, MEDIA_SPEC).where(F.col("media_id").isNotNull())


def media_attributes(raw_media: DataFrame) -> DataFrame:
    """Per media over all snapshots: earliest creation, greatest duration
    and title, plus the channel derived from that title."""
    return (
        typed_media(raw_media)
        .groupBy("media_id")
        .agg(
            F.min("created_at").alias("created_at"),
            F.max("duration").alias("duration"),
            F.max("title").alias("title"),
        )
        .withColumn("channel", channel_of("title"))
    )


def media_durations(raw_media: DataFrame) -> DataFrame:
    """``(media_id, duration)`` lookup, unique on media_id."""
    return (
        typed_media(raw_media)
        .groupBy("media_id")
        .agg(F.max("duration").alias("duration"))
    )


def media_urls(raw_events: DataFrame) -> DataFrame:
    """One URL per media seen in events: the greatest non-NULL one.

    Aggregated before any join, so the join cannot fan out; the partial
    aggregate keeps a hot media from loading one reducer.
    """
    return (
        raw_events.where(F.col("media_id").isNotNull())
        .groupBy("media_id")
        .agg(F.max("media_url").alias("media_url"))
    )


def build_media(raw_media: DataFrame, raw_events: DataFrame,
                run_ts: dt.datetime | None = None) -> DataFrame:
    """dim_media: media known from snapshots, with channel and URL.

    Both sides are aggregated by media_id, so the join reuses their hash
    partitioning (no further exchange) and AQE may turn it into a broadcast.
    Media seen only in events do not enter the dimension.
    """
    return (
        media_attributes(raw_media)
        .join(media_urls(raw_events), on="media_id", how="left")
        .select(*schemas.DIM_MEDIA.names[:-1], audit_ts(run_ts).alias("updated_at"))
    )


def media_from_urls(raw_media: DataFrame, urls: DataFrame,
                    run_ts: dt.datetime | None = None) -> DataFrame:
    """dim_media from snapshots and an already aggregated URL per media."""
    return (
        media_attributes(raw_media)
        .join(urls, on="media_id", how="left")
        .select(*schemas.DIM_MEDIA.names[:-1], audit_ts(run_ts).alias("updated_at"))
    )


def build_dates(spark: SparkSession, start: dt.date | str = DEFAULT_DATES_START,
                end: dt.date | str | None = None,
                run_ts: dt.datetime | None = None) -> DataFrame:
    """dim_dates: the calendar from ``start`` to ``end`` (default: today, UTC).

    The reference left-joins the spine with the observed event dates and
    de-duplicates again, which adds nothing; the spine alone is the result.
    """
    end = end or dt.datetime.now(dt.timezone.utc).date()
    return dates_from_spine(date_spine(spark, start, end), run_ts)


def dates_from_spine(spine: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    return spine.select("date", *date_attributes("date"), audit_ts(run_ts).alias("updated_at"))


def observed_dates(raw_events: DataFrame) -> DataFrame:
    """Distinct event dates (pattern-parsed), NULLs removed."""
    from reelstar.functions import parse_event_time

    return (
        raw_events.select(F.to_date(parse_event_time("received_at")).alias("date"))
        .where(F.col("date").isNotNull())
        .distinct()
    )


# --- incremental maintenance ------------------------------------------------
# Every dimension attribute is a min or max over raw rows: associative and
# idempotent. With append-only raw data, aggregating (previous dimension
# UNION aggregate of the new landings) equals a rebuild from all raw data,
# and re-reading an overlapping landing day changes nothing.

VISITOR_ATTRS = (("created_at", F.min), ("ip_address", F.max), ("country", F.max),
                 ("region", F.max))
MEDIA_ATTRS = (("created_at", F.min), ("duration", F.max), ("title", F.max))


def _merge(frames: list[DataFrame], key: str, attrs) -> DataFrame:
    cols = [key] + [name for name, _ in attrs]
    both = frames[0].select(*cols)
    for f in frames[1:]:
        both = both.unionByName(f.select(*cols))
    return both.groupBy(key).agg(*[fn(name).alias(name) for name, fn in attrs])


def merge_visitors(previous: DataFrame, new_raw_events: DataFrame,
                   run_ts: dt.datetime | None = None) -> DataFrame:
    """dim_visitors from the previous dimension and newly landed events."""
    fresh = build_visitors(new_raw_events)
    return (_merge([previous, fresh], "visitor_id", VISITOR_ATTRS)
            .select(*schemas.DIM_VISITORS.names[:-1], audit_ts(run_ts).alias("updated_at")))


def merge_media_urls(previous: DataFrame, new_raw_events: DataFrame) -> DataFrame:
    """URL per media (also media not in any snapshot yet), merged by max."""
    return _merge([previous, media_urls(new_raw_events)], "media_id", (("media_url", F.max),))


def merge_media(previous: DataFrame, new_raw_media: DataFrame, urls: DataFrame,
                run_ts: dt.datetime | None = None) -> DataFrame:
    """dim_media from the previous dimension, new snapshots and merged URLs."""
    attrs = (_merge([previous, media_attributes(new_raw_media)], "media_id", MEDIA_ATTRS)
             .withColumn("channel", channel_of("title")))
    return (attrs.join(urls, on="media_id", how="left")
            .select(*schemas.DIM_MEDIA.names[:-1], audit_ts(run_ts).alias("updated_at")))


# --- partials by landing ----------------------------------------------------
# The same minima and maxima for each landing (``unit``) on its own: a landing that
# is replaced replaces its partials, so the merge over all of them needs nothing
# taken back.

def visitor_partials(raw_events: DataFrame, unit: str) -> DataFrame:
    typed = typed_select(raw_events, VISITOR_SPEC + ((unit, unit, None),)).where(F.col("visitor_id").isNotNull())
    return typed.groupBy(unit, "visitor_id").agg(*[fn(name).alias(name) for name, fn in VISITOR_ATTRS])


def url_partials(raw_events: DataFrame, unit: str) -> DataFrame:
    return (raw_events.where(F.col("media_id").isNotNull()).groupBy(unit, "media_id")
            .agg(F.max("media_url").alias("media_url")))


def media_partials(raw_media: DataFrame, unit: str) -> DataFrame:
    typed = typed_select(raw_media, MEDIA_SPEC + ((unit, unit, None),)).where(F.col("media_id").isNotNull())
    return typed.groupBy(unit, "media_id").agg(*[fn(name).alias(name) for name, fn in MEDIA_ATTRS])


def visitors_from_partials(partials: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    return (_merge([partials], "visitor_id", VISITOR_ATTRS)
            .select(*schemas.DIM_VISITORS.names[:-1], audit_ts(run_ts).alias("updated_at")))


def media_from_partials(partials: DataFrame, urls: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """dim_media from the partials of snapshots and of event URLs."""
    attrs = _merge([partials], "media_id", MEDIA_ATTRS).withColumn("channel", channel_of("title"))
    return (attrs.join(_merge([urls], "media_id", (("media_url", F.max),)), on="media_id", how="left")
            .select(*schemas.DIM_MEDIA.names[:-1], audit_ts(run_ts).alias("updated_at")))
