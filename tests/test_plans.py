"""Physical-plan shape: the properties the design relies on at scale."""

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL, events_df
from reelstar.operators import dims, facts
from reelstar.operators.dedupe import latest_per_key
from reelstar.operators.joins import lookup_join
from reelstar.session import scratch_path
from reelstar.sources import landing, testdata
from reelstar.sources.raw import read_raw_events, stage


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_aggregates_partially_before_the_shuffle(spark):
    plan = _plan(latest_per_key(testdata.raw_events(spark, SF_SMALL), ["media_id", "visitor_key"],
                                ["ingest_ts", "event_key"]))
    partial = plan.index("partial_max")
    exchange = plan.index("Exchange hashpartitioning(media_id")
    assert exchange < partial  # the tree prints parents first: partial sits below the exchange


def test_fact_lookup_is_broadcast_and_events_never_shuffle_on_media_alone(spark):
    ev, media = testdata.raw_events(spark, SF_SMALL), testdata.raw_media(spark, SF_SMALL)
    plan = _plan(facts.build_events(ev, dims.media_durations(media), durations_rows=200))
    assert "BroadcastHashJoin" in plan
    assert not re.search(r"hashpartitioning\(media_id#\d+, \d+\)", plan.split("BroadcastExchange")[0])


def test_lookup_beyond_the_bound_is_not_broadcast(spark):
    left = spark.range(100).select(F.col("id").cast("string").alias("k"))
    right = spark.range(50).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lookup_join(left, right, "k", max_rows=10)._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" not in plan
        # of unknown size: left to AQE, not counted first
        plan = lookup_join(left, right, "k", max_rows=100)._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" not in plan
        plan = lookup_join(left, right, "k", max_rows=100, known_rows=50)._jdf.queryExecution() \
            .sparkPlan().toString()
        assert "BroadcastHashJoin" in plan
        plan = lookup_join(left, right, "k", max_rows=10, known_rows=50)._jdf.queryExecution() \
            .sparkPlan().toString()
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _read_schema(plan: str) -> set[str]:
    found = re.search(r"ReadSchema: struct<([^>]*)>", plan)
    return {c.split(":")[0] for c in found.group(1).split(",")}


def test_json_scan_reads_only_used_columns_and_prunes_landing_days(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        root = scratch_path(spark, "raw")
        landing.land(testdata.raw_events(spark, SF_SMALL), root, "events", "b")
        raw = read_raw_events(spark, root)
        assert _read_schema(_plan(dims.build_visitors(raw))) == {
            "visitor_key", "received_at", "ip", "country", "region"}
        assert "2024-01-20" not in _plan(facts.events_since(raw, "2024-01-20")).split("PartitionFilters")[1]
        since = _plan(facts.events_since(raw, "2024-01-20", prune_by_ingest_date=True))
        assert "PartitionFilters: [isnotnull(ingest_date" in since and "2024-01-20" in since
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_staged_copy_is_pruned_by_landing_day(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        root = scratch_path(spark, "raw")
        landing.land(testdata.raw_events(spark, SF_SMALL), root, "events", "b")
        staged = stage(read_raw_events(spark, root), scratch_path(spark, "stage"))
        lookup = spark.createDataFrame([("m1", 1.0)], "media_id string, duration double")
        plan = _plan(facts.build_events(facts.events_since(staged, "2024-01-20", True), lookup))
        assert "PartitionFilters: [isnotnull(ingest_date" in plan
        assert _read_schema(plan) == {"visitor_key", "received_at", "media_id", "percent_viewed",
                                      "ingest_ts", "event_key"}
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_adapter_reads_events_once_without_a_shuffle(spark):
    ev, media = testdata.raw_events(spark, SF_SMALL), testdata.raw_media(spark, SF_SMALL)
    plan = _plan(facts.build_events(ev, dims.media_durations(media)))
    assert plan.count("events.parquet") == 1 and "RoundRobin" not in plan


def test_landing_parses_records_once(spark):
    records = landing.records_from_pages(testdata.pages(spark, SF_SMALL), "2024-02-02T00:00:00")
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_stream_copy_is_read_by_touched_day(spark):
    from reelstar.streaming import incremental
    copy = scratch_path(spark, "copy")
    incremental.append_batch(testdata.raw_events(spark, SF_SMALL), 3, copy)
    batch = incremental.append_batch(testdata.raw_events(spark, SF_SMALL).limit(10), 4, copy)
    days = incremental.touched_dates(batch)
    whole = incremental.read_copy(spark, copy)
    some = whole.where(F.col(incremental.DAY_COL).isin(days[:1]))
    assert re.search(r"PartitionFilters: \[[^]]*event_day", _plan(some))
    read = {r[0] for r in some.select(F.input_file_name()).distinct().collect()}
    assert read and all(f"event_day={days[0]}" in f for f in read)
    # a replayed batch replaces itself
    n = whole.count()
    incremental.append_batch(testdata.raw_events(spark, SF_SMALL), 3, copy)
    assert incremental.read_copy(spark, copy).count() == n


def test_hot_key_results_match_brute_force(spark):
    """A third of all rows share one (media, visitor, instant) key."""
    hot = [{"event_key": f"h{i:04d}", "percent_viewed": str(i % 100),
            "ingest_ts": f"2024-03-0{1 + i % 9}T00:00:00"} for i in range(600)]
    cold = [{"event_key": f"c{i:04d}", "visitor_key": f"cv{i}",
             "received_at": f"2024-03-01T01:{i % 60:02d}:00.000Z"} for i in range(1200)]
    ev = events_df(spark, hot + cold).repartition(16)
    out = facts.build_events(ev, spark.createDataFrame([("m1", 10.0)], "media_id string, duration double"))
    rows = out.collect()
    hot_row = [r for r in rows if r.visitor_id == "v1"]
    assert len(hot_row) == 1
    # latest landing day is 2024-03-09 (i % 9 == 8); greatest event key among those
    best = max((h for h in hot if h["ingest_ts"].startswith("2024-03-09")), key=lambda h: h["event_key"])
    assert hot_row[0].percent_viewed == float(best["percent_viewed"])
    assert len(rows) == 1 + len({(f"cv{i}", i % 60) for i in range(1200)})
