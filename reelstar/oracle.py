"""DuckDB SQL that computes each registered query independently.

Tables ``events`` and ``part`` (and the other test tables) are views in the
oracle database. The raw inputs are derived with the same rules as
``reelstar.sources.testdata``; every query then restates the operator in
plain SQL (window functions where the engine uses aggregates, and so on),
so agreement checks the Spark plans, not a shared code path.
"""

from __future__ import annotations

from collections.abc import Callable

from reelstar import schemas
from reelstar.plans.queries import (AGAIN_DAY, EARLY_CUTOFF, INCREMENTAL_START, LANDING_TS, MERGE_FIRST_CUTOFF,
                                    PURGED_DAY, REMOVED_BEFORE, REPLACED_DAY, STRAY_DAY)

EVENT_TIME = "'%Y-%m-%dT%H:%M:%S.%gZ'"


def _event_select(copy: bool) -> str:
    shift = 2 if copy else 1
    value = "value + 1.0" if copy else "value"
    return f"""
  SELECT
    CASE user_id % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'CA' WHEN 2 THEN 'DE' END AS country,
    'e' || CAST(event_id AS VARCHAR) || '{'r' if copy else ''}' AS event_key,
    strftime(ts + INTERVAL {shift} DAY, '%Y-%m-%dT%H:%M:%S.%g') AS ingest_ts,
    '10.' || CAST(user_id % 7 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR)
      || '.' || CAST(event_id % 256 AS VARCHAR) AS ip,
    'm' || k AS media_id,
    'https://example.com/' || event_type || '/' || k AS media_url,
    CAST(least({value}, 100.0) AS VARCHAR) AS percent_viewed,
    CASE WHEN event_id % 211 = 0 THEN 'not-a-timestamp'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') END AS received_at,
    'R' || CAST(user_id % 11 AS VARCHAR) AS region,
    CASE WHEN event_id % 97 <> 0 THEN 'v' || CAST(user_id AS VARCHAR) END AS visitor_key,
    CAST(ts + INTERVAL {shift} DAY AS DATE) AS ingest_date
  FROM ev{' WHERE event_id % 10 = 3' if copy else ''}"""


def _media_select(second: bool) -> str:
    return f"""
  SELECT
    'false' AS archived, CAST(p_partkey AS VARCHAR) AS id, 'Video' AS type,
    'm' || CAST(p_partkey + 10 AS VARCHAR) AS hashed_id,
    '2023-12-' || lpad(CAST(p_partkey % 28 + {2 if second else 1} AS VARCHAR), 2, '0')
      || 'T00:00:00+00:00' AS created,
    CAST(p_retailprice AS VARCHAR) AS duration,
    {"'zz ' || " if second else ''}p_name || CASE p_partkey % 3 WHEN 0 THEN ' - FaceBook'
      WHEN 1 THEN ' - YouTube' ELSE '' END AS name,
    DATE '{'2024-02-01' if second else '2024-01-31'}' AS ingest_date
  FROM part{' WHERE p_partkey % 5 = 0' if second else ''}"""


# name -> (dependencies, SQL body or a function building it)
CTES: dict[str, tuple[tuple[str, ...], str | Callable[[], str]]] = {
    "ev": ((), "SELECT event_id, ts, user_id, event_type, value, "
                "json_extract_string(props, '$.k') AS k FROM events"),
    "raw_events": (("ev",), _event_select(False) + "\n  UNION ALL" + _event_select(True)),
    "raw_media": ((), _media_select(False) + "\n  UNION ALL" + _media_select(True)),
    "media_typed": (("raw_media",), """
  SELECT hashed_id AS media_id, try_cast(created AS TIMESTAMP) AS created_at,
         try_cast(duration AS DOUBLE) AS duration, name AS title
  FROM raw_media WHERE hashed_id IS NOT NULL"""),
    "media_attrs": (("media_typed",), """
  SELECT media_id, created_at, duration, title,
         CASE WHEN contains(lower(title), 'facebook') THEN 'Facebook'
              WHEN contains(lower(title), 'youtube') THEN 'YouTube'
              ELSE 'Other' END AS channel
  FROM (SELECT media_id, min(created_at) AS created_at, max(duration) AS duration,
               max(title) AS title FROM media_typed GROUP BY media_id)"""),
    "media_urls": (("raw_events",), """
  SELECT media_id, max(media_url) AS media_url
  FROM raw_events WHERE media_id IS NOT NULL GROUP BY media_id"""),
    "dim_media": (("media_attrs", "media_urls"), """
  SELECT a.media_id, a.created_at, a.duration, a.title, a.channel, u.media_url
  FROM media_attrs a LEFT JOIN media_urls u ON a.media_id = u.media_id"""),
    "durations": (("media_typed",), """
  SELECT media_id, max(duration) AS duration FROM media_typed GROUP BY media_id"""),
    "typed_events": (("raw_events",), f"""
  SELECT media_id, visitor_key AS visitor_id,
         try_strptime(received_at, {EVENT_TIME}) AS created_at,
         try_cast(percent_viewed AS DOUBLE) AS percent_viewed,
         try_cast(ingest_ts AS TIMESTAMP) AS ingest_at, event_key, ingest_date
  FROM raw_events"""),
    "fct_events_all": (("typed_events", "durations"), lambda: _fct("typed_events")),
    "engagement_all": (("fct_events_all",), lambda: _eng("fct_events_all")),
    "dim_visitors": (("raw_events",), """
  SELECT visitor_key AS visitor_id, min(try_cast(received_at AS TIMESTAMP)) AS created_at,
         max(ip) AS ip_address, max(country) AS country, max(region) AS region
  FROM raw_events WHERE visitor_key IS NOT NULL GROUP BY visitor_key"""),
    "bounds": (("raw_events",), f"""
  SELECT min(CAST(try_strptime(received_at, {EVENT_TIME}) AS DATE)) AS first_event_date,
         max(ingest_date) AS run_date
  FROM raw_events"""),
    "observed": (("raw_events",), f"""
  SELECT DISTINCT CAST(try_strptime(received_at, {EVENT_TIME}) AS DATE) AS date
  FROM raw_events WHERE try_strptime(received_at, {EVENT_TIME}) IS NOT NULL"""),
}


def _fct(src: str) -> str:
    """fct_events over a typed-events relation: latest copy per key by window."""
    return f"""
  SELECT r.media_id, r.visitor_id, r.created_at, CAST(r.created_at AS DATE) AS date,
         r.percent_viewed, d.duration * r.percent_viewed / 100 AS duration_viewed,
         CAST(r.created_at AS DATE) AS p_date
  FROM (SELECT *, row_number() OVER (
          PARTITION BY media_id, visitor_id, created_at
          ORDER BY ingest_at DESC NULLS LAST, event_key DESC NULLS LAST,
                   percent_viewed DESC NULLS LAST) AS rn
        FROM {src}) r
  LEFT JOIN durations d ON r.media_id = d.media_id
  WHERE r.rn = 1"""


def _eng(src: str) -> str:
    return f"""
  SELECT media_id, visitor_id, date, count(created_at) AS play_count,
         round(sum(duration_viewed), 8) AS total_watch_time,
         round(avg(duration_viewed), 8) AS avg_watch_time_per_view,
         max(percent_viewed) AS max_percent_viewed,
         round(avg(percent_viewed), 8) AS avg_percent_viewed, date AS p_date
  FROM {src} GROUP BY media_id, visitor_id, date"""


def _full_columns(src: str, names: list[str], present: set[str], extra: str) -> str:
    cols = [c if c in present else f"CAST(NULL AS VARCHAR) AS {c}" for c in names]
    return f"SELECT {', '.join(cols)}, {extra} FROM {src}"


_EVENT_PRESENT = {"country", "event_key", "ingest_ts", "ip", "media_id", "media_url",
                  "percent_viewed", "received_at", "region", "visitor_key"}
_MEDIA_PRESENT = {"archived", "id", "type", "hashed_id", "created", "duration", "name"}
_DATED = f"CAST(try_strptime(received_at, {EVENT_TIME}) AS DATE)"

CTES.update({
    "raw_events_full": (("raw_events",), _full_columns(
        "raw_events", schemas.RAW_EVENT_COLUMNS, _EVENT_PRESENT, "ingest_date")),
    "raw_media_full": (("raw_media",), _full_columns(
        "raw_media", schemas.RAW_MEDIA_COLUMNS, _MEDIA_PRESENT, "ingest_date")),
    "original_events": (("ev",), _event_select(False)),
    "landed_pages": (("original_events",), _full_columns(
        "original_events", schemas.RAW_EVENT_COLUMNS, _EVENT_PRESENT - {"ingest_ts"},
        f"'{LANDING_TS}' AS ingest_ts, DATE '{LANDING_TS[:10]}' AS ingest_date")
        .replace("CAST(NULL AS VARCHAR) AS ingest_ts, ", "")),
    "typed_since": (("typed_events",), f"""
  SELECT * FROM typed_events WHERE CAST(created_at AS DATE) >= DATE '{INCREMENTAL_START}'"""),
    "fct_since": (("typed_since", "durations"), lambda: _fct("typed_since")),
    "typed_first": (("typed_events",), f"""
  SELECT * FROM typed_events WHERE ingest_date <= DATE '{MERGE_FIRST_CUTOFF}'"""),
    "typed_later": (("typed_events",), f"""
  SELECT * FROM typed_events WHERE ingest_date >= DATE '{INCREMENTAL_START}'"""),
    "fct_later": (("typed_later", "durations"), lambda: _fct("typed_later")),
    "fct_first": (("typed_first", "durations"), lambda: _fct("typed_first")),
    "raw_after": (("raw_events",), f"""
  SELECT * FROM raw_events
  WHERE ingest_date <> DATE '{PURGED_DAY}'
    AND (ingest_date <> DATE '{REPLACED_DAY}' OR regexp_matches(event_key, '[02468]r?$'))"""),
    "typed_after": (("typed_events",), f"""
  SELECT t.* FROM typed_events t
  WHERE ingest_date <> DATE '{PURGED_DAY}'
    AND (ingest_date <> DATE '{REPLACED_DAY}' OR regexp_matches(event_key, '[02468]r?$'))"""),
    "fct_after": (("typed_after", "durations"), lambda: _fct("typed_after")),
    "dim_dates_run": (("bounds",), lambda: _calendar(_spine("DATE '2024-01-29'", "run_date"))),
})


def _body(name: str) -> str:
    """SQL of a CTE; templated bodies are built when first needed."""
    body = CTES[name][1]
    return body() if callable(body) else body


def _calendar(spine_sql: str) -> str:
    return f"""
SELECT date, CAST(month(date) AS INTEGER) AS month_num, CAST(day(date) AS INTEGER) AS day,
       strftime(date, '%a') AS day_of_week_name, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
       isodow(date) - 1 <= 4 AS is_weekday, CAST(year(date) AS INTEGER) AS year,
       strftime(date, '%b') AS month_name, CAST(week(date) AS INTEGER) AS week_of_year
FROM ({spine_sql}) s"""


def _spine(start: str, end: str) -> str:
    return (f"SELECT CAST(unnest(generate_series(CAST({start} AS TIMESTAMP), "
            f"CAST({end} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM bounds")


def _with(body: str, *needs: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][0]:
            visit(dep)
        order.append(name)

    for n in needs:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({_body(n)}\n)" for n in order)
    return f"WITH {ctes}\n{body}"


def oracle_sql() -> dict[str, str]:
    return {
        "fct_media_engagement": _with("SELECT * FROM engagement_all", "engagement_all"),
        "fct_events": _with("SELECT * FROM fct_events_all", "fct_events_all"),
        "dim_visitors": _with("SELECT * FROM dim_visitors", "dim_visitors"),
        "dim_media": _with("SELECT * FROM dim_media", "dim_media"),
        "dim_dates": _with(_calendar(_spine("DATE '2024-01-29'", "run_date")), "bounds"),
        "date_spine": _with(_calendar(_spine("first_event_date", "run_date")), "bounds"),
        "spine_left_observed": _with(f"""
SELECT s.date, o.date IS NOT NULL AS has_events
FROM ({_spine("first_event_date", "run_date")}) s LEFT JOIN observed o ON s.date = o.date""",
                                     "bounds", "observed"),
        "raw_scan": _with("SELECT * FROM raw_events_full", "raw_events_full"),
        "raw_media_scan": _with("SELECT * FROM raw_media_full", "raw_media_full"),
        "raw_ingest_date_counts": _with(
            "SELECT ingest_date, count(*) AS rows FROM raw_events GROUP BY ingest_date",
            "raw_events"),
        "land_events": _with("SELECT * FROM landed_pages", "landed_pages"),
        "land_media": _with("SELECT * FROM raw_media_full", "raw_media_full"),
        "raw_drift": _drift_sql(),
        "typed_visitors": _with("""
SELECT visitor_key AS visitor_id, try_cast(received_at AS TIMESTAMP) AS created_at,
       ip AS ip_address, country, region
FROM raw_events WHERE visitor_key IS NOT NULL""", "raw_events"),
        "typed_media": _with("SELECT * FROM media_typed", "media_typed"),
        "typed_events": _with("""
SELECT created_at, visitor_id, media_id, percent_viewed, ingest_at, event_key,
       CAST(created_at AS DATE) AS date, CAST(created_at AS DATE) AS p_date
FROM typed_events""", "typed_events"),
        "event_watch_time": _with("""
SELECT t.event_key, t.media_id, t.percent_viewed, d.duration,
       d.duration * t.percent_viewed / 100 AS duration_viewed
FROM typed_events t LEFT JOIN durations d ON t.media_id = d.media_id""",
                                  "typed_events", "durations"),
        "media_channel_counts": _with(
            "SELECT channel, count(*) AS n_media FROM dim_media GROUP BY channel", "dim_media"),
        "incremental_filter": _with(f"""
SELECT event_key, media_id, received_at,
       CASE WHEN regexp_matches(event_key, '9r?$') THEN NULL
            WHEN regexp_matches(event_key, '7r?$') THEN CAST(ingest_date - INTERVAL 3 DAYS AS DATE)
            ELSE ingest_date END AS ingest_date
FROM raw_events
WHERE {_DATED} >= DATE '{INCREMENTAL_START}'""", "raw_events"),
        "latest_per_key": _with("""
SELECT visitor_id, event_key, ingest_at, media_id, created_at, percent_viewed
FROM (SELECT *, row_number() OVER (PARTITION BY visitor_id
        ORDER BY ingest_at DESC NULLS LAST, event_key DESC NULLS LAST) AS rn
      FROM typed_events WHERE visitor_id IS NOT NULL)
WHERE rn = 1""", "typed_events"),
        "media_with_url": _with("SELECT media_id, title, media_url FROM dim_media", "dim_media"),
        "distinct_media_urls": _with("SELECT DISTINCT media_id, media_url FROM raw_events",
                                     "raw_events"),
        "affected_partitions": _with(
            "SELECT p_date, count(*) AS rows FROM fct_since GROUP BY p_date", "fct_since"),
        "pk_violations": _with(_pk_sql(), *_TABLE_CTES.values()),
        "overwrite_table_roundtrip": _with("SELECT * FROM dim_visitors", "dim_visitors"),
        "overwrite_partitions_merge": _with(f"""
SELECT * FROM fct_first WHERE p_date < DATE '{INCREMENTAL_START}' OR p_date IS NULL
UNION ALL
SELECT * FROM fct_since""", "fct_first", "fct_since"),
        "clustered_events": _with("SELECT * FROM fct_events_all", "fct_events_all"),
        "clustered_engagement": _with("SELECT * FROM engagement_all", "engagement_all"),
        "partition_diff": _with(f"""
SELECT DISTINCT 'p_date=' || p_date AS partition, 'vanished' AS status
FROM fct_events_all WHERE p_date < DATE '{REMOVED_BEFORE}'
UNION ALL
SELECT DISTINCT 'p_date={STRAY_DAY}', 'unregistered' FROM fct_events_all WHERE p_date = DATE '{EARLY_CUTOFF}'""",
                                "fct_events_all"),
        "table_counts": _with(" UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS rows FROM {c}"
            for t, c in _TABLE_CTES.items()), *_TABLE_CTES.values()),
        "full_pipeline_counts": _summary_sql(),
        "incremental_quiet_window": _summary_sql(),
        "incremental_dim_visitors": _with("SELECT * FROM dim_visitors", "dim_visitors"),
        "incremental_engagement": _with(
            "SELECT * FROM engagement_all WHERE p_date IS NOT NULL", "engagement_all"),
        "incremental_partials": _with("""
SELECT visitor_key AS visitor_id, min(try_cast(received_at AS TIMESTAMP)) AS created_at,
       max(ip) AS ip_address, max(country) AS country, max(region) AS region
FROM raw_after WHERE visitor_key IS NOT NULL GROUP BY visitor_key""", "raw_after"),
        "tracked_media": _with("""
SELECT a.media_id, a.created_at, a.duration, a.title, a.channel, u.media_url
FROM media_attrs a LEFT JOIN (SELECT media_id, max(media_url) AS media_url FROM raw_after GROUP BY media_id) u
  ON a.media_id = u.media_id""", "media_attrs", "raw_after"),
        "tracked_engagement": _with(_eng("fct_after"), "fct_after"),
        "touched_days": _with(f"""
SELECT DISTINCT {_DATED} AS p_date FROM raw_events
WHERE ingest_date IN (DATE '{AGAIN_DAY}', DATE '{PURGED_DAY}')
UNION
SELECT min({_DATED}) FROM raw_events""", "raw_events"),
        "duration_change": _with("SELECT * FROM engagement_all", "engagement_all"),
        "full_rebuild_after_purge": _with("SELECT * FROM fct_later", "fct_later"),
        "incremental_equals_full": _with(" UNION ALL ".join(
            f"SELECT '{t}' AS table_name, 'rows' AS metric, count(*) AS value FROM {c}"
            + (" WHERE p_date IS NOT NULL" if t.startswith("fct") else "")
            + f" UNION ALL SELECT '{t}', 'mismatched_rows', CAST(0 AS BIGINT)"
            for t, c in _TABLE_CTES.items()), *_TABLE_CTES.values()),
        "stream_incremental": _with(
            "SELECT * FROM engagement_all WHERE p_date IS NOT NULL", "engagement_all"),
        "stream_dim_visitors": _with("SELECT * FROM dim_visitors", "dim_visitors"),
        "stream_dim_media": _with("SELECT * FROM dim_media", "dim_media"),
    }


# curated table -> CTE computing it
_TABLE_CTES = {
    "dim_dates": "dim_dates_run",
    "dim_visitors": "dim_visitors",
    "dim_media": "dim_media",
    "fct_events": "fct_events_all",
    "fct_media_engagement": "engagement_all",
}


def _summary_sql() -> str:
    return _with(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows, "
        + ("count(DISTINCT p_date) AS partitions, "
           "count(*) FILTER (WHERE p_date IS NULL) AS null_date_rows"
           if t.startswith("fct") else
           "CAST(0 AS BIGINT) AS partitions, CAST(0 AS BIGINT) AS null_date_rows")
        + f" FROM {c}" for t, c in _TABLE_CTES.items()), *_TABLE_CTES.values())


def _drift_sql() -> str:
    """Counts of each field by landing day; NULLs aren't landed."""
    cut = f"ingest_date >= DATE '{INCREMENTAL_START}'"
    fields = sorted(_EVENT_PRESENT)
    counts = " UNION ALL ".join(
        f"SELECT ingest_date, '{c}' AS field, count({c}){f' FILTER (WHERE NOT {cut})' if c == 'region' else ''} AS n "
        "FROM raw_events GROUP BY ingest_date" for c in fields)
    return _with(f"""
SELECT c.ingest_date, c.field, 'vanished' AS status, CAST(NULL AS VARCHAR) AS kind, CAST(0 AS BIGINT) AS rows
FROM ({counts}) c JOIN (SELECT field, min(ingest_date) AS began FROM ({counts}) WHERE n > 0 GROUP BY field) f
  ON c.field = f.field AND c.ingest_date > f.began
WHERE c.n = 0
UNION ALL
SELECT ingest_date, 'percent_viewed', 'retyped', 'number', count(percent_viewed) FROM raw_events
WHERE {cut} GROUP BY ingest_date
UNION ALL
SELECT ingest_date, 'referrer', 'added', 'string', count(*) FROM raw_events WHERE {cut} GROUP BY ingest_date""",
                 "raw_events")


def _pk_sql() -> str:
    parts = []
    for table, cte in _TABLE_CTES.items():
        keys = ", ".join(schemas.PRIMARY_KEYS[table])
        parts.append(f"SELECT '{table}' AS table_name, 'rows' AS metric, count(*) AS value "
                     f"FROM {cte}")
        parts.append(f"SELECT '{table}', 'duplicate_keys', count(*) FROM "
                     f"(SELECT {keys} FROM {cte} GROUP BY {keys} HAVING count(*) > 1)")
    return "\nUNION ALL\n".join(parts)
