"""Readers of the raw landing zone (JSON Lines, partitioned by ingest_date).

Always an explicit all-text schema: no inference job, no type drift between
runs, nested API fields kept as their JSON text. An empty directory reads as an
empty frame; a missing one is an error unless the caller allows it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstar import schemas

# Parse modes of Spark's JSON reader: keep malformed lines as all-NULL rows
# (the reference behaviour), drop them, or fail the job.
MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")


def _read_schema(schema: T.StructType, with_corrupt: bool) -> T.StructType:
    fields = list(schema.fields)
    if with_corrupt:
        fields.append(T.StructField(schemas.CORRUPT_COL, T.StringType(), True))
    fields.append(T.StructField(schemas.RAW_PARTITION_COL, T.DateType(), True))
    return T.StructType(fields)


def read_raw(spark: SparkSession, path: str, schema: T.StructType, *,
             with_corrupt: bool = False, mode: str = "PERMISSIVE",
             since: dt.date | str | None = None, missing_ok: bool = False) -> DataFrame:
    """Scan a raw directory. ``since`` prunes landing partitions."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    read_schema = _read_schema(schema, with_corrupt)
    options = {"mode": mode}
    if with_corrupt:
        options["columnNameOfCorruptRecord"] = schemas.CORRUPT_COL
    try:
        df = spark.read.schema(read_schema).options(**options).json(path)
    except AnalysisException as exc:
        missing = "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc)
        if not (missing and missing_ok):
            raise
        df = spark.createDataFrame([], read_schema)
    df = df.select(*read_schema.names)
    if since is not None:
        df = df.where(F.col(schemas.RAW_PARTITION_COL) >= F.lit(since).cast("date"))
    return df


def read_raw_events(spark: SparkSession, source_path: str, **kw) -> DataFrame:
    return read_raw(spark, f"{source_path.rstrip('/')}/events", schemas.RAW_EVENTS, **kw)


def read_raw_media(spark: SparkSession, source_path: str, **kw) -> DataFrame:
    return read_raw(spark, f"{source_path.rstrip('/')}/media", schemas.RAW_MEDIA, **kw)


def ingest_date_counts(raw: DataFrame) -> DataFrame:
    """Rows per landing partition."""
    return raw.groupBy(schemas.RAW_PARTITION_COL).agg(F.count(F.lit(1)).alias("rows"))


# Raw event columns any builder reads.
EVENT_COLUMNS_USED = ("visitor_key", "received_at", "ip", "country", "region", "media_id",
                      "media_url", "percent_viewed", "ingest_ts", "event_key")


def stage(raw: DataFrame, path: str, columns: tuple[str, ...] = EVENT_COLUMNS_USED) -> DataFrame:
    """Parse raw JSON once and keep the used columns as parquet at ``path``.

    Builders that would each re-parse the JSON (the costliest step at scale)
    read this columnar copy instead, pruned to their own columns and, by
    ``ingest_date``, to their own landing days. The copy also cuts the
    lineage: a lost executor costs a re-read of parquet, not a re-parse.
    ``path`` belongs to one run. The overwrite is static whatever the session
    says: days that this run doesn't read must not stay behind.
    """
    part = schemas.RAW_PARTITION_COL
    (raw.select(*columns, part).hint("rebalance", part).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy(part).parquet(path))
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns]
                          + [T.StructField(part, T.DateType(), True)])
    return raw.sparkSession.read.schema(schema).parquet(path)
