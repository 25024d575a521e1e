"""Schemas of the raw landing zone and the curated star schema.

Column names, order and types below are fixed values: they must equal the
external tables the curated data is read through, because writes are
positional (``insertInto``).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: raw event columns (all text), in declared order -------
RAW_EVENT_COLUMNS = [
    "city", "conversion_type", "country", "email", "embed_url", "event_key",
    "iframe_heatmap_url", "ingest_ts", "ip", "lat", "lon", "media_id",
    "media_name", "media_url", "org", "percent_viewed", "received_at",
    "region", "thumbnail", "user_agent_details", "visitor_key",
]

# --- fixed values: raw media columns (all text), in declared order -------
RAW_MEDIA_COLUMNS = [
    "archived", "assets", "created", "description", "duration", "hashed_id",
    "id", "name", "progress", "project", "section", "status", "subfolder",
    "tags", "thumbnail", "type", "updated",
]

RAW_PARTITION_COL = "ingest_date"
TARGET_PARTITION_COL = "p_date"
CORRUPT_COL = "_corrupt_record"


def _all_strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


RAW_EVENTS = _all_strings(RAW_EVENT_COLUMNS)
RAW_MEDIA = _all_strings(RAW_MEDIA_COLUMNS)

_S, _TS, _D = T.StringType(), T.TimestampType(), T.DoubleType()
_I, _L, _B, _DT = T.IntegerType(), T.LongType(), T.BooleanType(), T.DateType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- fixed values: curated tables, columns in DDL order ------------------
DIM_DATES = _struct(
    ("date", _DT), ("month_num", _I), ("day", _I), ("day_of_week_name", _S),
    ("day_of_week", _I), ("is_weekday", _B), ("year", _I), ("month_name", _S),
    ("week_of_year", _I), ("updated_at", _TS),
)
DIM_VISITORS = _struct(
    ("visitor_id", _S), ("created_at", _TS), ("ip_address", _S),
    ("country", _S), ("region", _S), ("updated_at", _TS),
)
DIM_MEDIA = _struct(
    ("media_id", _S), ("created_at", _TS), ("duration", _D), ("title", _S),
    ("channel", _S), ("media_url", _S), ("updated_at", _TS),
)
FCT_EVENTS = _struct(
    ("media_id", _S), ("visitor_id", _S), ("created_at", _TS), ("date", _DT),
    ("percent_viewed", _D), ("duration_viewed", _D), ("updated_at", _TS),
    ("p_date", _DT),
)
FCT_MEDIA_ENGAGEMENT = _struct(
    ("media_id", _S), ("visitor_id", _S), ("date", _DT), ("play_count", _L),
    ("total_watch_time", _D), ("avg_watch_time_per_view", _D),
    ("max_percent_viewed", _D), ("avg_percent_viewed", _D),
    ("updated_at", _TS), ("p_date", _DT),
)

CURATED: dict[str, T.StructType] = {
    "dim_dates": DIM_DATES,
    "dim_visitors": DIM_VISITORS,
    "dim_media": DIM_MEDIA,
    "fct_events": FCT_EVENTS,
    "fct_media_engagement": FCT_MEDIA_ENGAGEMENT,
}
DIMENSIONS = ("dim_dates", "dim_visitors", "dim_media")
FACTS = ("fct_events", "fct_media_engagement")

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "dim_dates": ("date",),
    "dim_visitors": ("visitor_id",),
    "dim_media": ("media_id",),
    "fct_events": ("media_id", "visitor_id", "created_at"),
    "fct_media_engagement": ("media_id", "visitor_id", "date"),
}

PARTITION_COLS: dict[str, str | None] = {
    "dim_dates": None,
    "dim_visitors": None,
    "dim_media": None,
    "fct_events": TARGET_PARTITION_COL,
    "fct_media_engagement": TARGET_PARTITION_COL,
}


def value_columns(table: str) -> list[str]:
    """Curated columns without the per-run audit column ``updated_at``."""
    return [n for n in CURATED[table].names if n != "updated_at"]


def columns_ddl(schema: T.StructType, all_strings: bool = False) -> str:
    """``name type, ...`` text for a schema (typed, or every column string)."""
    return ", ".join(
        f"{f.name} {'string' if all_strings else f.dataType.simpleString()}"
        for f in schema.fields
    )


def table_ddl(db: str, table: str, location: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` for a curated table as a parquet table.

    The partition column stays last, as in the schema, so positional
    inserts line up.
    """
    schema = CURATED[table]
    part = PARTITION_COLS[table]
    loc = f" LOCATION '{location}'" if location else ""
    parted = f" PARTITIONED BY ({part})" if part else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {db}.{table} ({columns_ddl(schema)}) "
        f"USING parquet{parted}{loc}"
    )


RAW_BATCH_COL = "batch"


def raw_table_ddl(db: str, table: str, location: str) -> str:
    """External JSON table over a raw landing directory.

    Landing writes ``ingest_date=D/batch=B/`` (see ``sources.landing``), so
    both levels are partition columns; run ``MSCK REPAIR TABLE`` after new
    landings to register their directories.
    """
    schema = RAW_EVENTS if table == "events" else RAW_MEDIA
    return (
        f"CREATE TABLE IF NOT EXISTS {db}.{table} "
        f"({columns_ddl(schema)}, {RAW_PARTITION_COL} date, {RAW_BATCH_COL} string) USING json "
        f"PARTITIONED BY ({RAW_PARTITION_COL}, {RAW_BATCH_COL}) LOCATION '{location}'"
    )
