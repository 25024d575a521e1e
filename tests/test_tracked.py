"""Runs that follow the landings: replaced, purged, backfilled, failed and quiet ones."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import events_df, media_df
from reelstar import schemas, session
from reelstar.operators import facts
from reelstar.plans import tracked
from reelstar.plans.batch import run_batch
from reelstar.plans.config import PipelineConfig
from reelstar.plans.ledger import Ledger
from reelstar.sinks.tables import partition_values
from reelstar.sources import landing
from reelstar.sources.raw import read_raw_events

D = dt.date
RUN = dt.datetime(2024, 4, 1)


def event(key, at, **kw):
    return {"event_key": key, "received_at": f"{at}T10:00:00.000Z", **kw}


class World:
    """A raw zone, a database and runs over them."""

    def __init__(self, spark, tmp_path):
        self.spark, self.root, self.wh = spark, str(tmp_path / "raw"), str(tmp_path / "wh")
        self.db = f"t_{uuid.uuid4().hex[:8]}"

    def land(self, rows, day, batch="b1"):
        df = events_df(self.spark, [{**r, schemas.RAW_PARTITION_COL: day} for r in rows])
        landing.land(df, self.root, "events", batch)

    def media(self, rows, day=D(2024, 3, 2)):
        landing.land(media_df(self.spark, [{**r, schemas.RAW_PARTITION_COL: day} for r in rows]), self.root, "media", "media")

    def run(self, mode="incremental", db=None, **kw):
        return run_batch(self.spark, PipelineConfig(source_path=self.root, target_db=db or self.db, warehouse_dir=self.wh,
                                                    mode=mode, dates_end=D(2024, 4, 1), **{"tracked": True, **kw}), RUN)

    def rows(self, table, db=None):
        df = self.spark.table(f"{db or self.db}.{table}").drop("updated_at")
        return sorted(map(str, df.select(*sorted(df.columns)).collect()))

    def same_as_full(self):
        db = f"t_{uuid.uuid4().hex[:8]}"
        self.run("full", db, tracked=False)
        for table in schemas.CURATED:
            assert self.rows(table) == self.rows(table, db), table


@pytest.fixture
def world(spark, tmp_path):
    w = World(spark, tmp_path)
    w.media([{"hashed_id": "m1"}, {"hashed_id": "m2", "duration": "30"}])
    w.land([event("e1", "2024-03-01"), event("e2", "2024-03-02", visitor_key="v2", country="ZZ")], D(2024, 3, 2))
    w.land([event("e3", "2024-03-03", media_id="m2", media_url="https://zz"), event("e4", "bad", visitor_key=None)], D(2024, 3, 4))
    return w


def test_first_run_equals_an_untracked_one(world):
    report = world.run()
    assert len(report.landings) == 3 and report.raw_rows == {"events": 4, "media": 2}
    world.same_as_full()
    assert world.rows("dim_visitors") == world.rows("dim_visitors")


def test_nothing_landed_nothing_rebuilt(world):
    world.run()
    before = {t: world.rows(t) for t in schemas.CURATED}
    report = world.run()
    assert report.landings == [] and report.touched == [] and "fct_events" not in report.writes
    assert {t: world.rows(t) for t in schemas.CURATED} == before
    report = world.run()                                      # and the list was kept
    assert report.landings == []


def test_one_very_old_event_rebuilds_one_day(world):
    world.run()
    world.land([event("old", "2020-05-05", visitor_key="v9")], D(2024, 3, 9))
    report = world.run()
    assert report.touched == [D(2020, 5, 5)] and report.landings == ["ingest_date=2024-03-09/batch=b1"]
    assert report.raw_rows["events"] == 1
    world.same_as_full()


def test_replaced_landing_takes_its_values_back(world):
    world.run()
    world.land([event("e1", "2024-03-01", country="AA")], D(2024, 3, 2))
    report = world.run()
    assert report.touched == [D(2024, 3, 1), D(2024, 3, 2)]
    world.same_as_full()
    visitors = {r.visitor_id: r.country for r in world.spark.table(f"{world.db}.dim_visitors").collect()}
    assert visitors == {"v1": "US", "v2": None} or set(visitors) == {"v1"}
    # the day without events has no partition any more
    assert D(2024, 3, 2) not in partition_values(world.spark, f"{world.db}.fct_events")
    assert D(2024, 3, 2) not in partition_values(world.spark, f"{world.db}.fct_media_engagement")


def test_purged_landing_and_unknown_days(world):
    world.run()
    assert None in partition_values(world.spark, f"{world.db}.fct_events")
    session.delete_path(world.spark, f"{world.root}/events/ingest_date=2024-03-04")
    report = world.run()
    assert report.landings == [] and report.touched == [None, D(2024, 3, 3)]
    world.same_as_full()
    assert None not in partition_values(world.spark, f"{world.db}.fct_events")
    assert world.spark.table(f"{world.db}.dim_media").where("media_url = 'https://zz'").count() == 0


def test_backfill_under_a_day_already_read(world):
    world.run()
    world.land([event("e9", "2024-03-01", visitor_key="v7"), event("e1", "2024-03-01", percent_viewed="90",
                                                                  ingest_ts="2024-03-08T00:00:00.000")], D(2024, 3, 2), "b2")
    report = world.run()
    assert report.touched == [D(2024, 3, 1)] and report.landings == ["ingest_date=2024-03-02/batch=b2"]
    world.same_as_full()


def test_changed_duration_rebuilds_the_days_of_the_media(world):
    world.run()
    world.media([{"hashed_id": "m1"}, {"hashed_id": "m2", "duration": "500"}])
    report = world.run()
    assert report.touched == [D(2024, 3, 3)] and report.landings == ["ingest_date=2024-03-02/batch=media"]
    world.same_as_full()
    world.media([{"hashed_id": "m1", "duration": None}], D(2024, 3, 20))
    assert world.run().touched == []                          # the maximum stays
    world.media([{"hashed_id": "m2", "duration": "500"}])     # m1 is known without a duration now
    assert world.run().touched == [None, D(2024, 3, 1), D(2024, 3, 2)]
    world.same_as_full()


def test_failed_run_is_made_up_for(world, monkeypatch):
    world.run()
    world.land([event("e5", "2024-03-07")], D(2024, 3, 8))
    real = tracked.rebuild_days

    def half(spark, cfg, ledger, days, run_ts, report):
        real(spark, cfg, ledger, days, run_ts, report)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(tracked, "rebuild_days", half)
    with pytest.raises(RuntimeError):
        world.run()
    monkeypatch.setattr(tracked, "rebuild_days", real)
    # what the failed run had written for 03-07 is in no list, and the landing has changed meanwhile
    world.land([event("e5", "2024-03-06")], D(2024, 3, 8))
    report = world.run()
    assert report.touched == [D(2024, 3, 6), D(2024, 3, 7)]
    world.same_as_full()
    assert world.run().touched == []


def test_full_run_reads_all_and_drops_what_was_left(world):
    world.run("full")
    session.delete_path(world.spark, f"{world.root}/events/ingest_date=2024-03-02")
    # a database that an untracked run has filled
    other = f"t_{uuid.uuid4().hex[:8]}"
    world.land([event("x", "2024-01-01")], D(2024, 1, 2))
    world.run("full", other, tracked=False)
    session.delete_path(world.spark, f"{world.root}/events/ingest_date=2024-01-02")
    assert world.run("full", other).touched[0] is None
    assert partition_values(world.spark, f"{other}.fct_events") == [D(2024, 3, 3), None] or set(
        partition_values(world.spark, f"{other}.fct_events")) == {D(2024, 3, 3), None}
    world.run("full")
    world.same_as_full()


def test_landings_without_batches_or_days(world):
    world.run()
    rows = events_df(world.spark, [event("p1", "2024-03-05", visitor_key="pv", media_id="m2")]).drop(schemas.RAW_PARTITION_COL)
    rows.coalesce(1).write.json(f"{world.root}/events/ingest_date=__HIVE_DEFAULT_PARTITION__/batch=b x+1")
    report = world.run()
    assert report.touched == [D(2024, 3, 5)]
    assert report.landings == ["ingest_date=__HIVE_DEFAULT_PARTITION__/batch=b x+1"]
    world.same_as_full()


def test_days_only_layout(spark, tmp_path):
    w = World(spark, tmp_path)
    w.media([{"hashed_id": "m1"}])
    for day in ("2024-03-02", "2024-03-03"):
        events_df(spark, [event("a" + day, day)]).drop(schemas.RAW_PARTITION_COL).coalesce(1).write.json(
            f"{w.root}/events/ingest_date={day}")
    assert w.run().raw_rows["events"] == 2
    session.delete_path(spark, f"{w.root}/events/ingest_date=2024-03-03")
    assert w.run().touched == [D(2024, 3, 3)]
    w.same_as_full()


def test_only_changed_landings_are_parsed(world, monkeypatch):
    world.run()
    world.land([event("e9", "2024-03-01")], D(2024, 3, 9))
    seen = []
    from reelstar.plans import ledger as module
    real = module.read_files
    monkeypatch.setattr(module, "read_files", lambda *a, **k: seen.append(real(*a, **k)) or seen[-1])
    world.run()
    files = [f for df in seen for f in df.inputFiles()]
    assert files and all("ingest_date=2024-03-09" in f for f in files)


def test_quarantine_of_mended_landings(world, tmp_path):
    bad = str(tmp_path / "bad")
    folder = f"{world.root}/events/ingest_date=2024-03-11/batch=b1"
    world.spark.createDataFrame([("{broken",), ('{"event_key": "k", "received_at": "2024-03-11T00:00:00.000Z"}',)],
                                "value string").coalesce(1).write.text(folder)
    world.run(quarantine_path=bad)
    assert [r.value for r in world.spark.read.text(bad).collect()] == ["{broken"]
    world.land([event("k", "2024-03-11")], D(2024, 3, 11))
    world.run(quarantine_path=bad)
    assert world.spark.read.schema("value string").text(bad).count() == 0


def test_zone_map_prunes_files_by_event_day(world):
    # landed before they happened, landed long after, and without a landing day
    world.land([event("f1", "2024-03-20"), event("f2", "2024-03-21")], D(2024, 3, 1), "early")
    world.land([event("g1", "2023-01-01")], D(2024, 3, 25), "late")
    rows = events_df(world.spark, [event("h1", "2024-03-22")]).drop(schemas.RAW_PARTITION_COL)
    rows.coalesce(1).write.json(f"{world.root}/events/ingest_date=__HIVE_DEFAULT_PARTITION__/batch=b1")
    world.run()
    ledger = Ledger.for_db(world.spark, world.db, world.wh, world.root)
    every = read_raw_events(world.spark, world.root)
    for start, end in ((D(2024, 3, 3), None), (D(2024, 3, 20), None), (D(2022, 1, 1), D(2023, 12, 31)), (D(2030, 1, 1), None)):
        pruned = ledger.raw_since(start, end)
        want = facts.events_since(every, start)
        if end:
            want = want.where(F.to_date("received_at") <= F.lit(end))
        assert sorted(map(str, pruned.collect())) == sorted(map(str, want.select(*pruned.columns).collect()))
    assert len(ledger.raw_since(D(2024, 3, 20)).inputFiles()) < len(every.inputFiles())
    zones = {r.file: r for r in ledger.zones().collect()}
    assert len(zones) == len(every.inputFiles()) and sum(z.rows for z in zones.values()) == every.count()
    assert sum(z.undated for z in zones.values()) == 1


def test_missing_and_empty_raw_zone(spark, tmp_path):
    w = World(spark, tmp_path)
    report = w.run(allow_missing_source=True)
    assert report.table_rows["fct_events"] == 0 and report.landings == []
    w.media([{"hashed_id": "m1"}])
    w.land([event("e1", "2024-03-01")], D(2024, 3, 2))
    w.run(allow_missing_source=True)
    w.same_as_full()
    session.delete_path(spark, f"{w.root}/events")
    session.delete_path(spark, f"{w.root}/media")
    report = w.run(allow_missing_source=True)
    assert report.table_rows["fct_events"] == report.table_rows["dim_media"] == 0


def test_stopped_full_run_goes_on_where_it_ended(world, monkeypatch):
    for day in range(5, 12):
        world.land([event(f"d{day}", f"2024-03-{day:02d}")], D(2024, 3, day))
    steps = dict(mode="full", rebuild_bytes=1, range_rows=1)
    real, calls = tracked.rebuild_days, []

    def stop_after(n):
        def step(spark, cfg, ledger, days, run_ts, report):
            if len(calls) == n:
                raise RuntimeError("killed")
            calls.append(days)
            real(spark, cfg, ledger, days, run_ts, report)
        return step

    monkeypatch.setattr(tracked, "rebuild_days", stop_after(4))
    with pytest.raises(RuntimeError):
        world.run(**steps)
    monkeypatch.setattr(tracked, "rebuild_days", stop_after(99))
    report = world.run(**steps)
    # nothing was parsed again, and each range was written once
    assert report.landings == []
    assert [d for days in calls for d in days] == [None, *(D(2024, 3, d) for d in (1, 2, 3, 5, 6, 7, 8, 9, 10, 11))]
    assert len(report.touched) == 7
    world.same_as_full()
    # a full run after that begins anew
    assert len(world.run(**steps).landings) == 10


def test_stopped_full_run_over_a_raw_zone_that_changed(world, monkeypatch):
    steps = dict(mode="full", rebuild_bytes=1, range_rows=1)
    real = Ledger.note_units
    noted = []

    def killed(self, changes):
        real(self, changes)
        noted.append(changes)
        if len(noted) == 2:
            raise RuntimeError("killed")

    monkeypatch.setattr(Ledger, "note_units", killed)
    with pytest.raises(RuntimeError):
        world.run(**steps)
    monkeypatch.setattr(Ledger, "note_units", real)
    world.land([event("e1", "2024-03-01", country="QQ")], D(2024, 3, 2))
    report = world.run(**steps)
    assert "ingest_date=2024-03-02/batch=b1" in report.landings and len(report.landings) == 2
    world.same_as_full()


def test_untracked_quarantine_of_mended_days(world, tmp_path):
    bad = str(tmp_path / "bad")
    folder = f"{world.root}/events/ingest_date=2024-03-11/batch=b1"
    lines = [("{broken",), ('{"event_key": "k", "received_at": "2024-03-11T00:00:00.000Z", "media_id": "m1"}',)]
    world.spark.createDataFrame(lines, "value string").coalesce(1).write.text(folder)
    for mode, rows in (("PERMISSIVE", 6), ("DROPMALFORMED", 5)):
        report = world.run("full", tracked=False, quarantine_path=bad, raw_mode=mode)
        assert [r.value for r in world.spark.read.text(bad).collect()] == ["{broken"]
        assert report.table_rows["fct_events"] == rows
    world.land([event("k", "2024-03-11")], D(2024, 3, 11))
    world.run("full", tracked=False, quarantine_path=bad)
    assert world.spark.read.schema("value string").text(bad).count() == 0


def test_command_line_follows_the_landings(world):
    from reelstar.__main__ import _config, _parser
    from reelstar.plans.batch import run_pipeline

    args = _parser().parse_args(["build", "--source-path", world.root, "--target-db", world.db, "--warehouse-dir", world.wh,
                                 "--mode", "incremental", "--tracked", "--dates-end", "2024-04-01"])
    assert run_pipeline(world.spark, _config(args), now=RUN).raw_rows["events"] == 4
    world.land([event("new", "2024-03-15")], D(2024, 3, 16))
    report = run_pipeline(world.spark, _config(args), now=RUN)
    assert report.touched == [D(2024, 3, 15)] and report.raw_rows["events"] == 1


def test_files_and_units_of_rows_are_those_of_the_listing(spark, tmp_path):
    from pyspark.sql import functions as F

    from reelstar.plans import ledger
    for folder in ("ingest_date=2024-03-02/batch=b1", "ingest_date=2024-03-03/batch=a+b %41 ü", "ingest_date=2024-03-04/batch=c+d"):
        (tmp_path / "events" / folder).mkdir(parents=True)
        (tmp_path / "events" / folder / "part 1.json").write_text('{"event_key": "e1"}\n', encoding="utf-8")
    listed = {(r.file, r.unit, r.landing) for r in ledger.list_files(spark, str(tmp_path), "events").collect()}
    rows = ledger.read_files(spark, str(tmp_path), "events", sorted({f for _, _, f in listed}))
    assert {(r.file, r.unit) for r in rows.collect()} == {(f, u) for f, u, _ in listed}
    assert {f for _, _, f in listed} == {f.rsplit("/", 1)[0] for f, _, _ in listed}
    one = spark.createDataFrame([("a/b/c.json",), ("c.json",), ("/x",), ("a//b",), (None,)], "f string")
    assert [r[0] for r in one.select(ledger._folder(F.col("f"))).collect()] == ["a/b", "", "", "a/", None]
    # no row waits for a regular expression
    assert "regexp" not in rows._jdf.queryExecution().optimizedPlan().toString()
