"""Writers for the curated tables.

Unpartitioned tables are replaced by a switch: the new rows are written beside the
old ones, their keys are checked there, and then the table's location is
changed. Readers see the old rows until then; a write that fails or breaks the key
changes nothing. The version before stays until the next switch, for queries still reading it.

Partitions are replaced by ``insertInto``. Such writes are ``insertInto`` (positional), so every frame is first projected
to the target's column order by name. The set of rewritten partitions is read
from the rows' days before the write and row counts from the written table, so
neither depends on metrics of tasks that may be retried or planned away.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar import schemas, session

log = logging.getLogger("reelstar")
#: Between a table's name and its version in the name of a folder.
VERSION = "__v"
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@dataclass
class WriteResult:
    table: str
    rows: int
    partitions: list = field(default_factory=list)   # non-NULL partition values
    null_partition: bool = False
    written: bool = True
    whole: bool = False                              # the table was replaced, not only these partitions


class KeyViolation(ValueError):
    """A table's new rows repeat a primary key."""


def ensure_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")


def ensure_tables(spark: SparkSession, db: str, warehouse_dir: str | None = None) -> None:
    """Create the five curated parquet tables if missing."""
    ensure_database(spark, db, f"{warehouse_dir.rstrip('/')}/{db}.db" if warehouse_dir else None)
    for table in schemas.CURATED:
        loc = f"{warehouse_dir.rstrip('/')}/{db}.db/{table}" if warehouse_dir else None
        spark.sql(schemas.table_ddl(db, table, loc))


def _aligned(df: DataFrame, table: str, partition_col: str | None) -> DataFrame:
    target = df.sparkSession.table(table).columns
    if partition_col:
        target = [c for c in target if c != partition_col] + [partition_col]
    missing = [c for c in target if c not in df.columns]
    if missing:
        raise ValueError(f"{table}: frame lacks columns {missing}")
    return df.select(*target)


def _partitions(days: DataFrame, partition_col: str) -> tuple[list, bool]:
    """Partition values in a frame, and whether NULL is among them: one
    aggregate, at most one row per day."""
    values = [r[0] for r in days.select(partition_col).distinct().collect()]
    return sorted(v for v in values if v is not None), None in values


def in_partitions(df: DataFrame, partition_col: str, res: WriteResult) -> DataFrame:
    """Rows of the partitions that a write replaced."""
    if res.whole:
        return df
    pc = F.col(partition_col)
    cond = pc.isin(res.partitions) if res.partitions else F.lit(False)
    if res.null_partition:
        cond = cond | pc.isNull()
    return df.where(cond)


def _write(df: DataFrame, table: str, partition_col: str | None, dry_run: bool,
           mode: str, days: DataFrame | WriteResult | None = None) -> WriteResult:
    df = _aligned(df, table, partition_col)
    spark = df.sparkSession
    res = WriteResult(table, 0, written=not dry_run, whole=mode == "static")
    if dry_run:
        if partition_col:
            counts = df.groupBy(partition_col).count().collect()
            res.rows = sum(r["count"] for r in counts)
            res.partitions = sorted(r[0] for r in counts if r[0] is not None)
            res.null_partition = any(r[0] is None for r in counts)
        else:
            res.rows = df.count()
        log.info("[dry run] %s: %d rows, partitions %s", table, res.rows, res.partitions)
        return res
    if partition_col:
        if isinstance(days, WriteResult):
            res.partitions, res.null_partition = days.partitions, days.null_partition
        else:
            res.partitions, res.null_partition = _partitions(df if days is None else days, partition_col)
        if mode == "dynamic" and not res.partitions and not res.null_partition:
            log.info("%s: nothing to write", table)
            return res
        # Cluster rows of a day together so each task writes few files; AQE
        # splits a heavy day and merges light ones (no single-task day).
        df = df.hint("rebalance", partition_col)
    # insertInto takes the overwrite mode from the session, not from writer
    # options: switch it for this write only.
    conf = spark.conf
    previous = conf.get(_OVERWRITE_MODE, "static")
    conf.set(_OVERWRITE_MODE, mode)
    try:
        df.write.insertInto(table, overwrite=True)
    finally:
        conf.set(_OVERWRITE_MODE, previous)
    spark.catalog.refreshTable(table)
    # what was written is counted on the table itself (parquet footers)
    written = spark.table(table)
    res.rows = (in_partitions(written, partition_col, res) if partition_col else written).count()
    log.info("%s: wrote %d rows, partitions %s", table, res.rows, res.partitions)
    return res


def overwrite_table(df: DataFrame, table: str, dry_run: bool = False,
                    keys: Sequence[str] | None = None) -> WriteResult:
    """Replace an unpartitioned table (full rebuild) by a checked switch.

    ``keys`` must be unique in the new rows (default: the curated table's primary
    key); a repeated one raises :class:`KeyViolation`. ``df`` may read ``table`` itself.
    """
    if dry_run:
        return _write(df, table, None, True, "static")
    spark = df.sparkSession
    keys = schemas.PRIMARY_KEYS.get(table.rsplit(".", 1)[-1], ()) if keys is None else keys
    old = table_folder(spark, table)
    parent, name = old.rsplit("/", 1)
    base = name.split(VERSION)[0]
    new = f"{base}{VERSION}{uuid.uuid4().hex[:12]}"
    aligned = _aligned(df, table, None)
    try:
        aligned.write.parquet(f"{parent}/{new}")
        written = spark.read.schema(spark.table(table).schema).parquet(f"{parent}/{new}")
        if keys:
            # one pass: rows, and keys that occur more than once
            by_key = written.groupBy(*keys).count()
            found = by_key.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("rows"),
                               F.count(F.when(F.col("count") > 1, 1)).alias("repeated")).first()
            rows, repeated = found.rows, found.repeated
        else:
            rows, repeated = written.count(), 0
        if repeated:
            raise KeyViolation(f"{table}: {repeated} values of {tuple(keys)} occur more than once")
    except Exception:
        session.delete_path(spark, f"{parent}/{new}")
        raise
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{parent}/{new}'")
    spark.catalog.refreshTable(table)
    for other in session.folder_names(spark, parent):
        if other not in (new, name) and (other == base or other.startswith(base + VERSION)):
            session.delete_path(spark, f"{parent}/{other}")
    log.info("%s: wrote %d rows", table, rows)
    return WriteResult(table, rows, whole=True)


def overwrite_partitions(df: DataFrame, table: str, partition_col: str = schemas.TARGET_PARTITION_COL,
                         dry_run: bool = False, replace_all: bool = False,
                         repair: bool = False,
                         days: DataFrame | WriteResult | None = None) -> WriteResult:
    """Replace only the partitions present in ``df`` (dynamic overwrite).

    ``days`` tells which partitions these are where that is cheaper to find
    than from ``df``: a frame with the partition column, or the result of an
    earlier write of the same days. A frame without rows replaces nothing.

    Other days keep their rows; ``replace_all`` switches to a static
    overwrite that empties the table first. ``repair`` re-syncs partition
    metadata with the file system (for directories added or removed outside Spark).
    """
    res = _write(df, table, partition_col, dry_run, "static" if replace_all else "dynamic", days)
    if repair and not dry_run:
        sync_partitions(df.sparkSession, table)
    return res


def table_folder(spark: SparkSession, table: str) -> str:
    """Where a table's files are."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").select("data_type").collect()
    return rows[0][0].rstrip("/")


def partition_values(spark: SparkSession, table: str, partition_col: str = schemas.TARGET_PARTITION_COL) -> list:
    """Values (None among them) of the partitions that the catalog knows: no data is read."""
    out = []
    for r in spark.sql(f"SHOW PARTITIONS {table}").collect():
        value = r[0].split("=", 1)[1]
        out.append(None if value in ("__HIVE_DEFAULT_PARTITION__", "null") else dt.date.fromisoformat(value))
    return out


def drop_partitions(spark: SparkSession, table: str, values: list,
                    partition_col: str = schemas.TARGET_PARTITION_COL) -> None:
    """Remove partitions, their files too (the tables' folders are ours also where they are external)."""
    known = set(partition_values(spark, table, partition_col))
    for v in values:
        if v not in known:
            continue
        spec = "NULL" if v is None else f"DATE '{v}'"
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition_col} = {spec})")
        name = "__HIVE_DEFAULT_PARTITION__" if v is None else v.isoformat()
        session.delete_path(spark, f"{table_folder(spark, table)}/{partition_col}={name}")
    if values:
        spark.catalog.refreshTable(table)


def partition_difference(spark: SparkSession, table: str) -> DataFrame:
    """``(partition, status)`` where folders and catalog differ: ``unregistered``
    folders hold files that queries don't see, ``vanished`` partitions have no file left.

    Folders come from a listing of the table's files by Spark (their content isn't read), so a
    table of any number of partitions is compared as two tables, not in the driver.
    """
    root = table_folder(spark, table)
    null = F.lit("__HIVE_DEFAULT_PARTITION__")
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        files = spark.createDataFrame([], "path string")
    below = F.substring_index("path", f"/{root.rsplit('/', 1)[1]}/", -1)
    folders = files.select(F.regexp_extract(below, "^(.*)/[^/]*$", 1).alias("partition")).where("partition <> ''").distinct()
    catalog = spark.sql(f"SHOW PARTITIONS {table}").select(
        F.regexp_replace("partition", "=null(?=/|$)", F.concat(F.lit("="), null)).alias("partition"))
    only = lambda a, b, status: a.join(b, "partition", "left_anti").select("partition", F.lit(status).alias("status"))
    return only(folders, catalog, "unregistered").unionByName(only(catalog, folders, "vanished"))


def sync_partitions(spark: SparkSession, table: str) -> DataFrame:
    """Make the catalog agree with the folders, both ways; returns what differed."""
    found = partition_difference(spark, table)
    found = spark.createDataFrame(found.collect(), found.schema)   # one row a folder that differs
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)
    return found


def table_counts(spark: SparkSession, db: str) -> DataFrame:
    """``(table_name, rows)`` for every table of a database, one job."""
    names = sorted(r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect()
                   if not r.isTemporary)
    frames = [spark.table(f"{db}.{n}").agg(F.count(F.lit(1)).alias("rows"))
              .select(F.lit(n).alias("table_name"), "rows") for n in names]
    if not frames:
        return spark.createDataFrame([], "table_name string, rows bigint")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
