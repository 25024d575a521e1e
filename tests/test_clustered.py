"""Both facts from one exchange: equal to the two-step plan, whatever is heavy."""

from __future__ import annotations

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import events_df, media_df
from reelstar import schemas
from reelstar.operators import clustered, facts
from reelstar.operators.clustered import NO_SALT, ClusteredFacts, place, profile
from reelstar.plans.batch import run_batch
from reelstar.plans.config import PipelineConfig
from reelstar.sources import landing

RUN = dt.datetime(2024, 4, 1)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _events(spark, n=3000):
    """A third of all rows are one anonymous pair, a sixth one instant of another, the rest light; re-landed
    copies, junk times, media without duration and NULL media."""
    rows = []
    for i in range(n):
        row = {"event_key": f"e{i:05d}", "percent_viewed": str(i % 101), "ingest_ts": f"2024-03-0{1 + i % 9}T00:00:00",
               "media_id": f"m{i % 7}", "visitor_key": f"v{i % 211}",
               "received_at": f"2024-03-{1 + i % 5:02d}T01:{i % 60:02d}:{i % 53:02d}.000Z"}
        if i % 3 == 0:
            row.update(media_id="m1", visitor_key=None)
        elif i % 6 == 1:
            row.update(media_id="m2", visitor_key="robot", received_at="2024-03-03T01:00:00.000Z")
        elif i % 41 == 0:
            row.update(received_at="junk")
        elif i % 43 == 0:
            row.update(media_id=None)
        rows.append(row)
    return events_df(spark, rows + rows[::10]).repartition(4)


DURATIONS = [(f"m{i}", 10.0 * i) for i in range(1, 6)] + [("m6", None)]


def _durations(spark):
    return spark.createDataFrame(DURATIONS, "media_id string, duration double")


def _rows(df):
    cols = sorted(c for c in df.columns if c != "updated_at")
    return sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.select(*cols).collect())


@pytest.fixture
def write(spark, tmp_path):
    made = []

    def make(events, durations=None, **kw):
        out = ClusteredFacts.write(events, _durations(spark) if durations is None else durations,
                                   f"clustered_{uuid.uuid4().hex[:8]}", str(tmp_path / uuid.uuid4().hex), **kw)
        made.append(out)
        return out

    yield make
    for m in made:
        m.drop()


@pytest.mark.parametrize("bucket_rows", [400, 10**6])
def test_equal_to_the_two_step_plan(spark, write, bucket_rows):
    ev = _events(spark)
    moved = write(ev, bucket_rows=bucket_rows)
    two = facts.build_events(ev, _durations(spark))
    assert _rows(moved.events()) == _rows(two)
    assert _rows(moved.engagement()) == _rows(facts.build_media_engagement(two))
    assert {r[0] for r in moved.days().distinct().collect()} == {r[0] for r in two.select("p_date").distinct().collect()}


def test_one_exchange_for_both_facts(spark, write):
    """Moving the events is the only exchange; the facts are built from the buckets without any."""
    ev = _events(spark).where("visitor_key <> 'robot' OR visitor_key IS NULL")
    typed = facts.typed_events(ev.coalesce(4))
    prof = profile(typed, 400)
    assert prof.pairs and not prof.instants
    plan = _plan(place(typed.withColumn("duration_viewed", F.lit(1.0)), prof, 8))
    moves = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(moves) == 1 and re.sub(r"#\d+L?", "", moves[0]) == "media_id, visitor_id, salt, 8"
    moved = write(ev, bucket_rows=400)
    assert "Exchange" not in _plan(moved.events())
    light = ClusteredFacts(spark, moved.table, moved.path, clustered.Profile(1), moved.n_buckets)
    assert "Exchange" not in _plan(light.engagement())
    # what heavy pairs move again are sums of salts, from files of their own
    whole = _plan(moved.engagement())
    assert whole.count("Exchange hashpartitioning") == 1
    assert len(re.findall(r"PartitionFilters: \[[^]]*heavy", whole)) == 2


def test_hot_pair_stays_split(spark, write):
    """A third of all rows of one pair spread over the buckets; no bucket holds much more than its share."""
    ev = _events(spark, 6000)
    moved = write(ev, bucket_rows=500)
    assert len(moved.profile.pairs) >= 1 and len(moved.profile.instants) == 1
    hot = moved.rows().where("media_id = 'm1' AND visitor_id IS NULL")
    assert hot.where(F.col("salt") == NO_SALT).count() == 0
    by_salt = [r["count"] for r in hot.groupBy("salt").count().collect()]
    assert len(by_salt) > moved.n_buckets / 2 and max(by_salt) < sum(by_salt) / 3
    # the instant that alone is heavy is reduced before the exchange: one row a task, not a thousand
    placed = place(facts.typed_events(ev), moved.profile, moved.n_buckets)
    plan = _plan(placed)
    assert "partial_max" in plan.split("Union")[1]


def test_profile_finds_heavy_keys_and_counts(spark):
    typed = facts.typed_events(_events(spark))
    prof = profile(typed, 100)
    assert prof.rows == typed.count() and prof.buckets(100) == -(-prof.rows // 100)
    of = lambda cond, *cols: typed.where(cond).select(F.xxhash64(*cols)).first()[0]
    assert of("media_id = 'm1' AND visitor_id IS NULL", "media_id", "visitor_id") in prof.pairs
    assert prof.instants == (of("visitor_id = 'robot'", "media_id", "visitor_id", "created_at"),)
    assert profile(typed, 10**9).pairs == ()
    assert profile(typed.limit(0)) == clustered.Profile(0) and clustered.Profile(0).buckets() == 1
    # at most TOP keys, however small the buckets
    assert len(profile(typed, 1).pairs) <= clustered.TOP


def test_empty_and_all_null(spark, write):
    assert write(_events(spark).limit(0)).engagement().count() == 0
    ev = events_df(spark, [{"media_id": None, "visitor_key": None, "received_at": None, "percent_viewed": None}] * 3)
    moved = write(ev, bucket_rows=1)
    two = facts.build_events(ev, _durations(spark))
    assert moved.events().count() == 1
    assert _rows(moved.engagement()) == _rows(facts.build_media_engagement(two))


def test_large_lookup_is_joined_before_the_move(spark, write):
    """Beyond the broadcast bound the duration join shuffles before the events are placed, and placing holds."""
    ev = _events(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = write(ev, bucket_rows=400, max_broadcast_rows=1, durations_rows=6)
        assert _rows(moved.events()) == _rows(facts.build_events(ev, _durations(spark)))
        assert "Exchange" not in _plan(moved.events())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


class Job:
    def __init__(self, spark, tmp_path):
        self.spark, self.root, self.wh = spark, str(tmp_path / "raw"), str(tmp_path / "wh")
        landing.land(_events(spark), self.root, "events", "b1")
        landing.land(media_df(spark, [{"hashed_id": m, "duration": None if d is None else str(d)} for m, d in DURATIONS]),
                     self.root, "media", "media")

    def run(self, db, **kw):
        return run_batch(self.spark, PipelineConfig(source_path=self.root, target_db=db, warehouse_dir=self.wh,
                                                    dates_end=dt.date(2024, 4, 1), **kw), RUN)

    def facts(self, db):
        return [_rows(self.spark.table(f"{db}.{t}")) for t in schemas.FACTS]


@pytest.mark.parametrize("how", [{"mode": "incremental", "start_date": "2024-03-03"}, {"tracked": True},
                                 {"replace_all": True}, {"mode": "incremental", "start_date": "2030-01-01"}])
def test_jobs_agree(spark, tmp_path, how):
    job = Job(spark, tmp_path)
    one, two = (f"t_{uuid.uuid4().hex[:8]}" for _ in "ab")
    a, b = job.run(one, cluster_facts=True, bucket_rows=600, **how), job.run(two, **how)
    assert job.facts(one) == job.facts(two)
    assert {k: (w.rows, w.partitions, w.null_partition) for k, w in a.writes.items()} == \
        {k: (w.rows, w.partitions, w.null_partition) for k, w in b.writes.items()}
    assert a.table_rows == b.table_rows    # the copy is gone


def test_failed_run_leaves_no_copy_and_the_next_one_goes_on(spark, tmp_path, monkeypatch):
    job, db = Job(spark, tmp_path), f"t_{uuid.uuid4().hex[:8]}"
    job.run(db)
    before = job.facts(db)
    monkeypatch.setattr(ClusteredFacts, "engagement", lambda self, ts=None: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        job.run(db, cluster_facts=True, bucket_rows=600)
    assert not spark.catalog.tableExists(f"{db}.clustered_events")
    monkeypatch.undo()
    job.run(db, cluster_facts=True, bucket_rows=600)
    assert job.facts(db) == before
