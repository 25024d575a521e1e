"""Drift of raw JSON against the declared fields, landing day by landing day.

The readers have a fixed all-text schema, so a field that the API adds is left out and one
it drops reads as NULL without a word. ``drift`` looks at the lines themselves: each
is parsed to a VARIANT once, its top-level fields are counted by landing day, and
``schema_of_variant_agg`` gives each field's type there. Rows meet in partial aggregates,
so what is shuffled are days and fields, not records.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelstar import schemas

ADDED, VANISHED, RETYPED = "added", "vanished", "retyped"
# Kinds of JSON values by what Spark calls their types.
KINDS = (("STRING", "string"), ("BOOLEAN", "boolean"), ("OBJECT", "object"), ("ARRAY", "array"),
         ("BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT", "number"))
MIXED = "mixed"


def kind_of(type_name: Column) -> Column:
    out = F.lit(MIXED)
    for pattern, kind in reversed(KINDS):
        out = F.when(type_name.rlike(f"^(?:{pattern})"), kind).otherwise(out)
    return out


def read_lines(spark: SparkSession, source_path: str, table: str = "events", since: dt.date | str | None = None,
               missing_ok: bool = False) -> DataFrame:
    """Raw lines with their landing day."""
    part = schemas.RAW_PARTITION_COL
    schema = f"value string, {part} date"
    try:
        df = spark.read.schema(schema).text(f"{source_path.rstrip('/')}/{table}").select("value", part)
    except AnalysisException as exc:
        if not (missing_ok and "PATH_NOT_FOUND" in str(exc)):
            raise
        df = spark.createDataFrame([], schema)
    return df if since is None else df.where(F.col(part) >= F.lit(since).cast("date"))


def field_types(lines: DataFrame) -> DataFrame:
    """``(ingest_date, field, rows, kind)``: how many records of a day have a
    field with a value, and of what kind (``mixed`` if of several). Lines that are no
    JSON object have no fields."""
    part = schemas.RAW_PARTITION_COL
    parsed = lines.select(part, F.try_parse_json("value").alias("v"))
    fields = lines.sparkSession.sql(
        f"SELECT {part}, f.key AS field, f.value AS v FROM {{parsed}}, LATERAL variant_explode(v) AS f "
        "WHERE f.key IS NOT NULL AND NOT is_variant_null(f.value)", parsed=parsed)
    return (fields.groupBy(part, "field").agg(F.count(F.lit(1)).alias("rows"), F.schema_of_variant_agg("v").alias("type"))
            .select(part, "field", "rows", kind_of(F.col("type")).alias("kind")))


def drift(lines: DataFrame, declared: list[str]) -> DataFrame:
    """``(ingest_date, field, status, kind, rows)`` of each departure.

    ``added``: a field that isn't declared. ``retyped``: a declared field whose values
    are of another kind than on the first day that had it. ``vanished``: a declared field that
    an earlier day had and no record of this day has (a NULL counts as absent).
    Landings without a day are left out: they come before or after nothing.
    """
    part = schemas.RAW_PARTITION_COL
    found = field_types(lines.where(F.col(part).isNotNull()))
    known = F.col("field").isin(declared)
    first = F.first("kind").over(Window.partitionBy("field").orderBy(part))
    status = F.when(~known, ADDED).when(F.col("kind") != F.col("_first"), RETYPED)
    present = (found.withColumn("_first", first).withColumn("status", status).where("status IS NOT NULL")
               .select(part, "field", "status", "kind", "rows"))
    # days by fields: both small, whatever the number of records
    days = lines.where(F.col(part).isNotNull()).select(part).distinct()
    began = found.where(known).groupBy("field").agg(F.min(part).alias("_began"))
    expected = days.join(began, F.col(part) > F.col("_began")).select(part, "field")
    gone = (expected.join(found.select(part, "field"), [part, "field"], "left_anti")
            .select(part, "field", F.lit(VANISHED).alias("status"), F.lit(None).cast("string").alias("kind"),
                    F.lit(0).cast("long").alias("rows")))
    return present.unionByName(gone)


def event_drift(spark: SparkSession, source_path: str, since: dt.date | str | None = None,
                missing_ok: bool = False) -> DataFrame:
    return drift(read_lines(spark, source_path, "events", since, missing_ok), schemas.RAW_EVENT_COLUMNS)


def media_drift(spark: SparkSession, source_path: str, since: dt.date | str | None = None,
                missing_ok: bool = False) -> DataFrame:
    return drift(read_lines(spark, source_path, "media", since, missing_ok), schemas.RAW_MEDIA_COLUMNS)
