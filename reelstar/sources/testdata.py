"""Adapter: raw events and media derived from the generated test tables.

``events`` (event_id, ts, user_id, event_type, value, props) becomes API
view events; ``part`` becomes media snapshots. Every row of both tables is
used. A re-ingested copy of a tenth of the events (landed a day later, with
a different percent viewed) reproduces the overlap of consecutive landings
that makes de-duplication necessary; a second media snapshot for a fifth of
the media does the same for media. Edge cases are spread by id arithmetic:
anonymous visitors, unparseable event times, NULL countries, events of
media without metadata (ids m0-m9) and media without events.

The same derivation is written as SQL in ``reelstar.oracle`` for the DuckDB
oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar import schemas

# --- fixed values of the adapter -----------------------------------------
RECEIVED_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
INGEST_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
URL_PREFIX = "https://example.com/"
MEDIA_ID_OFFSET = 10           # part key p -> media id m(p + 10)
FIRST_SNAPSHOT_DATE = "2024-01-31"
SECOND_SNAPSHOT_DATE = "2024-02-01"


def _events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


# Spark SQL expression per raw event column; _copy marks a re-ingested row
# (one JVM call per column).
EVENT_EXPRS = {
    "country": "CASE user_id % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'CA' WHEN 2 THEN 'DE' END",
    "event_key": "concat('e', CAST(event_id AS STRING), if(_copy, 'r', ''))",
    "ingest_ts": f'date_format(if(_copy, ts + INTERVAL 2 DAYS, ts + INTERVAL 1 DAYS), "{INGEST_FORMAT}")',
    "ip": "concat_ws('.', '10', CAST(user_id % 7 AS STRING), CAST(user_id % 256 AS STRING), "
          "CAST(event_id % 256 AS STRING))",
    "media_id": "concat('m', get_json_object(props, '$.k'))",
    "media_url": f"concat('{URL_PREFIX}', event_type, '/', get_json_object(props, '$.k'))",
    "percent_viewed": "CAST(least(if(_copy, value + 1.0D, value), 100.0D) AS STRING)",
    "received_at": "CASE WHEN event_id % 211 = 0 THEN 'not-a-timestamp' "
                   f'ELSE date_format(ts, "{RECEIVED_FORMAT}") END',
    "region": "concat('R', CAST(user_id % 11 AS STRING))",
    "visitor_key": "CASE WHEN event_id % 97 != 0 THEN concat('v', CAST(user_id AS STRING)) END",
    schemas.RAW_PARTITION_COL: "to_date(if(_copy, ts + INTERVAL 2 DAYS, ts + INTERVAL 1 DAYS))",
}


def _select(df: DataFrame, names: list[str], exprs: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{exprs.get(c, 'CAST(NULL AS STRING)')} AS {c}" for c in names])


def _shape_events(ev: DataFrame, copies: bool) -> DataFrame:
    """One scan: a row becomes one or, if it was re-ingested, two."""
    flags = "if(event_id % 10 = 3, array(false, true), array(false))" if copies else "array(false)"
    return _select(ev.selectExpr("*", f"explode({flags}) AS _copy"),
                   schemas.RAW_EVENT_COLUMNS + [schemas.RAW_PARTITION_COL], EVENT_EXPRS)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events as landed: every event, plus the re-ingested copies."""
    return _shape_events(_events_table(spark, sf_dir), copies=True)


# Days on which some events were landed other than on the day after: a day
# before they happened (clocks differ), or on a day that nobody noted.
EARLY_LANDING = "event_key RLIKE '7r?$'"
NO_LANDING_DAY = "event_key RLIKE '9r?$'"


def unordered_landings(raw: DataFrame) -> DataFrame:
    """``raw`` with landing days that don't bound the event days."""
    day = schemas.RAW_PARTITION_COL
    return raw.withColumn(day, F.expr(f"CASE WHEN {NO_LANDING_DAY} THEN NULL "
                                      f"WHEN {EARLY_LANDING} THEN date_sub({day}, 3) ELSE {day} END"))


# A second snapshot (_second) has a later day and another name.
MEDIA_EXPRS = {
    "archived": "'false'",
    "created": "concat('2023-12-', lpad(CAST(p_partkey % 28 + if(_second, 2, 1) AS STRING), 2, '0'), "
               "'T00:00:00+00:00')",
    "duration": "CAST(p_retailprice AS STRING)",
    "hashed_id": f"concat('m', CAST(p_partkey + {MEDIA_ID_OFFSET} AS STRING))",
    "id": "CAST(p_partkey AS STRING)",
    "name": "concat(if(_second, 'zz ', ''), p_name, CASE p_partkey % 3 "
            "WHEN 0 THEN ' - FaceBook' WHEN 1 THEN ' - YouTube' ELSE '' END)",
    "type": "'Video'",
    schemas.RAW_PARTITION_COL: f"if(_second, DATE'{SECOND_SNAPSHOT_DATE}', DATE'{FIRST_SNAPSHOT_DATE}')",
}


def raw_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw media snapshots: every part, plus a later snapshot of some."""
    part = spark.read.parquet(f"{sf_dir.rstrip('/')}/part.parquet")
    both = part.selectExpr("*", "explode(if(p_partkey % 5 = 0, array(false, true), array(false))) AS _second")
    return _select(both, schemas.RAW_MEDIA_COLUMNS + [schemas.RAW_PARTITION_COL], MEDIA_EXPRS)


def pages(spark: SparkSession, sf_dir: str, page_size: int = 100) -> DataFrame:
    """API responses as pages ``(media_id, page, payload)``.

    Events of a media are paged by event id (page = event_id div page_size
    + 1), so a page holds at most ``page_size`` records and building it
    never gathers a whole media into one group. Each media ends with an
    empty page ``[]``, as the API does; what an API gave after it must not be
    landed, so each has one more page of a record that no event has.
    """
    ev = _shape_events(_events_table(spark, sf_dir), copies=False)
    record_cols = [c for c in schemas.RAW_EVENT_COLUMNS if c not in ("media_id", "ingest_ts")]
    paged = ev.withColumn(
        "page", (F.floor(F.col("event_key").substr(F.lit(2), F.lit(64)).cast("long") / page_size)
                 + 1).cast("int"))
    full = paged.groupBy("media_id", "page").agg(
        F.to_json(F.collect_list(F.struct(*record_cols))).alias("payload"))
    ends = full.groupBy("media_id").agg((F.max("page") + 1).alias("page")) \
        .withColumn("payload", F.lit("[]"))
    after = ends.select("media_id", (F.col("page") + 1).alias("page"),
                        F.lit('[{"event_key": "after-the-end"}]').alias("payload"))
    return full.unionByName(ends).unionByName(after)
