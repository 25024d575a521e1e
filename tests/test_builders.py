import datetime as dt
import os
import subprocess
import sys

from pyspark.sql import functions as F

from conftest import events_df, media_df
from reelstar import schemas
from reelstar.operators import dims, facts


def test_visitors_drop_anonymous_and_take_columnwise_max(spark):
    ev = events_df(spark, [
        {"visitor_key": "v1", "country": None, "ip": "9.0.0.1", "received_at": "2024-03-01T01:30:00Z"},
        {"visitor_key": "v1", "country": "US", "ip": "10.0.0.1", "received_at": "2024-02-01T00:00:00.5Z"},
        {"visitor_key": None, "country": "DE"},
    ])
    rows = dims.build_visitors(ev).collect()
    assert len(rows) == 1
    v = rows[0]
    assert v.visitor_id == "v1" and v.country == "US"
    assert v.ip_address == "9.0.0.1"  # text order: "9..." > "10..."
    assert v.created_at == dt.datetime(2024, 2, 1, 0, 0, 0, 500000)
    assert dims.build_visitors(ev).columns == schemas.DIM_VISITORS.names


def test_media_dimension(spark):
    media = media_df(spark, [
        {"hashed_id": "m1", "name": "a - YouTube", "duration": "90", "created": "2024-01-02T00:00:00+00:00"},
        {"hashed_id": "m1", "name": "b - facebook", "duration": "100", "created": "2024-01-01T00:00:00+00:00"},
        {"hashed_id": "m2", "name": None, "duration": "x"},
        {"hashed_id": None, "name": "dropped"},
    ])
    ev = events_df(spark, [
        {"media_id": "m1", "media_url": "https://a"}, {"media_id": "m1", "media_url": "https://b"},
        {"media_id": "m1", "media_url": None}, {"media_id": "m9", "media_url": "https://z"},
    ])
    out = {r.media_id: r for r in dims.build_media(media, ev).collect()}
    assert set(out) == {"m1", "m2"}                       # media only in events are absent
    m1 = out["m1"]
    assert (m1.duration, m1.title, m1.channel, m1.media_url) == (100.0, "b - facebook", "Facebook", "https://b")
    assert m1.created_at == dt.datetime(2024, 1, 1)
    assert (out["m2"].duration, out["m2"].channel, out["m2"].media_url) == (None, "Other", None)


def test_events_dedupe_latest_copy_and_anonymous_collapse(spark):
    ev = events_df(spark, [
        {"event_key": "e1", "percent_viewed": "10", "ingest_ts": "2024-03-02T00:00:00"},
        {"event_key": "e1r", "percent_viewed": "20", "ingest_ts": "2024-03-03T00:00:00.000"},
        {"event_key": "e2", "visitor_key": None, "percent_viewed": "30"},
        {"event_key": "e3", "visitor_key": None, "percent_viewed": "40"},
        {"event_key": "e4", "received_at": "junk", "percent_viewed": "1"},
        {"event_key": "e5", "received_at": "2024-03-01T01:30:00Z", "percent_viewed": "2"},
        {"event_key": "e6", "media_id": "m9", "received_at": "2024-03-04T00:00:00.000Z"},
    ])
    media = media_df(spark, [{"hashed_id": "m1", "duration": "200"}])
    out = facts.build_events(ev, dims.media_durations(media))
    assert out.columns == schemas.FCT_EVENTS.names
    rows = out.collect()
    by = {(r.media_id, r.visitor_id, r.created_at): r for r in rows}
    t = dt.datetime(2024, 3, 1, 1, 30, 0, 123000)
    assert by[("m1", "v1", t)].percent_viewed == 20.0
    assert by[("m1", "v1", t)].duration_viewed == 40.0
    assert by[("m1", None, t)].percent_viewed == 40.0          # anonymous collapse, latest key
    nulls = [r for r in rows if r.created_at is None]
    assert len(nulls) == 1 and nulls[0].date is None and nulls[0].p_date is None
    assert nulls[0].percent_viewed == 2.0                       # e5 > e4 by event key
    assert by[("m9", "v1", dt.datetime(2024, 3, 4))].duration_viewed is None
    assert len(rows) == 4


def test_engagement_counts_only_known_times(spark):
    ev = events_df(spark, [
        {"event_key": "a", "received_at": "2024-03-01T01:00:00.000Z", "percent_viewed": "50"},
        {"event_key": "b", "received_at": "2024-03-01T02:00:00.000Z", "percent_viewed": "100"},
        {"event_key": "c", "received_at": "bad", "percent_viewed": "10"},
    ])
    media = media_df(spark, [{"hashed_id": "m1", "duration": "60"}])
    eng = facts.build_media_engagement(facts.build_events(ev, dims.media_durations(media)))
    assert eng.columns == schemas.FCT_MEDIA_ENGAGEMENT.names
    rows = {r.date: r for r in eng.collect()}
    day = rows[dt.date(2024, 3, 1)]
    assert (day.play_count, day.total_watch_time, day.avg_watch_time_per_view) == (2, 90.0, 45.0)
    assert (day.max_percent_viewed, day.avg_percent_viewed) == (100.0, 75.0)
    assert rows[None].play_count == 0


def test_events_since_drops_null_dates_and_prunes_landings(spark):
    ev = events_df(spark, [
        {"event_key": "old", "received_at": "2024-02-28T00:00:00.000Z", "ingest_date": dt.date(2024, 2, 29)},
        {"event_key": "new", "received_at": "2024-03-01T00:00:00.000Z", "ingest_date": dt.date(2024, 3, 1)},
        {"event_key": "bad", "received_at": "x", "ingest_date": dt.date(2024, 3, 2)},
    ])
    got = [r.event_key for r in facts.events_since(ev, "2024-03-01").collect()]
    assert got == ["new"]
    assert facts.events_since(ev, None).count() == 3


def test_events_dated_after_their_landing_are_kept(spark):
    ev = events_df(spark, [
        {"event_key": "early", "received_at": "2024-03-02T00:00:00.000Z", "ingest_date": dt.date(2024, 2, 29)},
        {"event_key": "nowhere", "received_at": "2024-03-02T00:00:00.000Z"},
    ]).withColumn("ingest_date", F.expr("if(event_key = 'nowhere', NULL, ingest_date)"))
    assert sorted(r.event_key for r in facts.events_since(ev, "2024-03-01").collect()) == ["early", "nowhere"]
    assert facts.events_since(ev, "2024-03-01", prune_by_ingest_date=True).count() == 0


def test_audit_time_does_not_depend_on_the_driver_zone():
    code = ("from conftest import events_df\nimport datetime as dt\n"
            "from reelstar.session import local_session\nfrom reelstar.operators import dims\n"
            "s = local_session(1)\n"
            "for t in (dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 1, 1, tzinfo=dt.timezone(dt.timedelta(hours=1)))):\n"
            "    df = dims.build_visitors(events_df(s, [{}]), t)\n"
            "    print('AT', df.selectExpr('CAST(updated_at AS STRING) t').first().t)\n")
    here = os.path.dirname(os.path.abspath(__file__))
    env = os.environ | {"TZ": "America/New_York", "PYTHONPATH": os.pathsep.join([here, os.path.dirname(here)])}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=180, check=True)
    assert [x for x in out.stdout.splitlines() if x.startswith("AT")] == ["AT 2024-03-01 00:00:00"] * 2


def test_dates_dimension(spark):
    rows = dims.build_dates(spark, "2024-02-27", "2024-03-01").collect()
    assert [r.date for r in rows] == [dt.date(2024, 2, 27), dt.date(2024, 2, 28), dt.date(2024, 2, 29),
                                      dt.date(2024, 3, 1)]
    leap = rows[2]
    assert (leap.day_of_week_name, leap.day_of_week, leap.is_weekday, leap.month_name) == ("Thu", 3, True, "Feb")
    assert dims.build_dates(spark, "2024-03-01", "2024-03-01").count() == 1
    assert dims.build_dates(spark, "2024-03-02", "2024-03-01").count() == 0
    ny = dims.build_dates(spark, "2024-12-29", "2024-12-30").collect()
    assert [(r.week_of_year, r.day_of_week, r.is_weekday) for r in ny] == [(52, 6, False), (1, 0, True)]
    assert dims.build_dates(spark, "2024-01-01", "2024-01-02").columns == schemas.DIM_DATES.names


def test_spine_join_with_observed_dates_changes_nothing(spark):
    ev = events_df(spark, [{"received_at": "2024-03-01T00:00:00.000Z"}] * 3)
    spine = dims.build_dates(spark, "2024-02-28", "2024-03-02").select("date")
    joined = spine.join(dims.observed_dates(ev), "date", "left")
    assert sorted(r.date for r in joined.collect()) == sorted(r.date for r in spine.collect())


def test_results_do_not_depend_on_partitioning(spark):
    from reelstar.sources import testdata
    ev = testdata.raw_events(spark, "/root/testdata/sf0.001")
    media = testdata.raw_media(spark, "/root/testdata/sf0.001")
    a = facts.build_events(ev, dims.media_durations(media)).drop("updated_at")
    b = facts.build_events(ev.repartition(5, F.rand(3)), dims.media_durations(media)).drop("updated_at")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_spine_between_data_bounds(spark):
    from reelstar.operators.spine import date_spine_between
    bounds = spark.createDataFrame(
        [(dt.date(2024, 2, 28), dt.date(2024, 3, 1)), (dt.date(2024, 3, 5), dt.date(2024, 3, 4))],
        "s date, e date")
    got = sorted(r.date for r in date_spine_between(bounds, "s", "e").collect())
    assert got == [dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1)]
