"""The stream's event-day copy under many batches; pages after an end."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from conftest import events_df
from reelstar import session
from reelstar.sources import landing
from reelstar.streaming import incremental as inc

DAY = dt.date(2024, 3, 1)


def batch(spark, i):
    return events_df(spark, [{"event_key": f"e{i}-{k}", "received_at": f"2024-03-01T00:{i % 60:02d}:00.000Z"} for k in range(2)]
                     + [{"event_key": f"n{i}", "received_at": "bad"}]).coalesce(1)


def folders(spark, copy, day=DAY):
    return session.folder_names(spark, f"{copy}/event_day={day}")


def keys(spark, copy):
    return Counter(r.event_key for r in inc.read_copy(spark, copy).select("event_key").collect())


def test_fifty_batches_leave_few_folders_and_replay_is_exact(spark, tmp_path):
    copy = inc.copy_path(str(tmp_path / "ckpt"))
    most = 0
    for i in range(50):
        inc.append_batch(batch(spark, i), i, copy)
        inc.compact(spark, copy, [DAY, None], i)
        most = max(most, len(folders(spark, copy)))
    # at most FAN folders of a size class, and the current one
    assert most <= inc.FAN + 1 and len(folders(spark, copy, "__HIVE_DEFAULT_PARTITION__")) <= inc.FAN + 1
    want = Counter(f"e{i}-{k}" for i in range(50) for k in range(2)) + Counter(f"n{i}" for i in range(50))
    assert keys(spark, copy) == want
    # a replay of the last batch replaces its own rows alone
    inc.append_batch(batch(spark, 49), 49, copy)
    inc.compact(spark, copy, [DAY, None], 49)
    assert keys(spark, copy) == want
    assert {r.event_key for r in inc.append_batch(batch(spark, 50), 50, copy).collect()} == {"e50-0", "e50-1", "n50"}


def test_classes_grow_by_the_fan():
    small = inc.SMALL_BYTES
    assert [inc._tier(s) for s in (0, small - 1, small, small * inc.FAN - 1, small * inc.FAN)] == [0, 0, 1, 1, 2]


def test_compaction_that_stops_before_the_parts_are_removed(spark, tmp_path, monkeypatch):
    copy = inc.copy_path(str(tmp_path / "ckpt"))
    for i in range(inc.FAN):
        inc.append_batch(batch(spark, i), i, copy)
    monkeypatch.setattr(inc.session, "delete_path", lambda *a: None)
    inc.compact(spark, copy, [DAY], 99)
    monkeypatch.undo()
    # rows are there twice, and distinct keys are the same
    assert set(keys(spark, copy).values()) == {1, 2} and len(keys(spark, copy)) == 3 * inc.FAN


def test_pages_after_an_end_beyond_the_broadcast_bound(spark):
    rows = [("a", 1, '[{"event_key": "1"}]'), ("a", 2, "[]"), ("a", 3, '[{"event_key": "late"}]'), ("a", 4, "[]"),
            ("b", 1, '[{"event_key": "2"}]'), (None, 1, '[{"event_key": "3"}]'), ("c", 1, "[]"), ("d", 1, None)]
    pages = spark.createDataFrame(rows, "media_id string, page int, payload string")
    for bound in (0, 10):
        got = landing.records_from_pages(pages, "2024-02-02T00:00:00", max_broadcast_rows=bound)
        assert sorted(r.event_key for r in got.collect()) == ["1", "2", "3"]
    # the payload side has no exchange where stops are broadcast
    plan = landing.records_from_pages(pages, "2024-02-02T00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning(media_id" not in plan
