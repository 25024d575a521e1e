"""Tables replaced by a checked switch; partitions compared with folders."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from reelstar import session
from reelstar.sinks.tables import (KeyViolation, ensure_tables, overwrite_partitions, overwrite_table,
                                   partition_difference, sync_partitions)

VISITORS = "visitor_id string, created_at timestamp, ip_address string, country string, region string, updated_at timestamp"
EVENTS = ("media_id string, visitor_id string, created_at timestamp, date date, percent_viewed double, "
          "duration_viewed double, updated_at timestamp, p_date date")


@pytest.fixture
def db(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex[:8]}"
    ensure_tables(spark, name, str(tmp_path))
    return name


def visitors(spark, ids):
    return spark.createDataFrame([(i, None, "x", None, None, None) for i in ids], VISITORS)


def ids(spark, db):
    return sorted(r.visitor_id for r in spark.table(f"{db}.dim_visitors").collect())


def versions(spark, tmp_path, db):
    return [n for n in session.folder_names(spark, f"{tmp_path}/{db}.db") if n.startswith("dim_visitors")]


def test_write_that_fails_half_way_leaves_the_old_rows(spark, db, tmp_path):
    table = f"{db}.dim_visitors"
    assert overwrite_table(visitors(spark, ["a", "b"]), table).rows == 2
    before = versions(spark, tmp_path, db)
    broken = visitors(spark, [str(i) for i in range(1000)]).withColumn(
        "region", F.when(F.col("visitor_id") == "997", F.raise_error(F.lit("lost"))).otherwise("r").cast("string"))
    with pytest.raises(Exception, match="lost"):
        overwrite_table(broken, table)
    assert ids(spark, db) == ["a", "b"] and versions(spark, tmp_path, db) == before


def test_write_that_breaks_the_key_leaves_the_old_rows(spark, db, tmp_path):
    table = f"{db}.dim_visitors"
    overwrite_table(visitors(spark, ["a"]), table)
    before = versions(spark, tmp_path, db)
    with pytest.raises(KeyViolation, match="visitor_id"):
        overwrite_table(visitors(spark, ["b", "c", "c"]), table)
    assert ids(spark, db) == ["a"] and versions(spark, tmp_path, db) == before
    assert overwrite_table(visitors(spark, ["c", "c"]), table, keys=()).rows == 2


def test_readers_keep_the_version_they_began_with(spark, db, tmp_path):
    table = f"{db}.dim_visitors"
    overwrite_table(visitors(spark, ["a"]), table)
    reader = spark.table(table)                              # planned on the version of now
    files = reader.inputFiles()
    # a table may be replaced by what is read from it
    overwrite_table(reader.unionByName(visitors(spark, ["b"])), table)
    assert ids(spark, db) == ["a", "b"]
    assert spark.read.parquet(*files).count() == 1
    for more in ("c", "d"):
        overwrite_table(spark.table(table).unionByName(visitors(spark, [more])), table)
    assert ids(spark, db) == ["a", "b", "c", "d"] and len(versions(spark, tmp_path, db)) == 2


def test_empty_replacement_and_dry_run(spark, db):
    table = f"{db}.dim_visitors"
    overwrite_table(visitors(spark, ["a"]), table)
    assert overwrite_table(visitors(spark, ["z", "z"]), table, dry_run=True).rows == 2
    assert ids(spark, db) == ["a"]
    assert overwrite_table(visitors(spark, []), table).rows == 0 and ids(spark, db) == []


def events(spark, days):
    return spark.createDataFrame([("m", "v", dt.datetime(2024, 1, 1), d, 1.0, 1.0, None, d) for d in days], EVENTS)


def test_removed_folders_leave_the_catalog(spark, db, tmp_path):
    table, root = f"{db}.fct_events", f"{tmp_path}/{db}.db/fct_events"
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)] + [None]
    overwrite_partitions(events(spark, days), table)
    assert partition_difference(spark, table).collect() == []
    session.delete_path(spark, f"{root}/p_date=2024-01-02")
    session.delete_path(spark, f"{root}/p_date=__HIVE_DEFAULT_PARTITION__")
    events(spark, [dt.date(2031, 5, 5)]).drop("p_date").write.parquet(f"{root}/p_date=2031-05-05")
    want = {("p_date=2024-01-02", "vanished"), ("p_date=__HIVE_DEFAULT_PARTITION__", "vanished"),
            ("p_date=2031-05-05", "unregistered")}
    assert {tuple(r) for r in sync_partitions(spark, table).collect()} == want
    assert partition_difference(spark, table).collect() == []
    assert {r[0] for r in spark.table(table).select("p_date").collect()} == {
        dt.date(2024, 1, 1), dt.date(2024, 1, 3), dt.date(2031, 5, 5)}
