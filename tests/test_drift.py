from __future__ import annotations

import datetime as dt

from reelstar.sources import drift

D = [dt.date(2024, 3, d) for d in (1, 2, 3)]
LINES = [
    (D[0], '{"a": "x", "b": "1", "c": "keep"}'), (D[0], '{"a": "y", "b": "2", "c": null}'),
    (D[1], '{"a": "x", "b": 2.5, "new": {"k": 1}}'), (D[1], '{"a": "x", "b": "3", "new": {"k": 2}}'), (D[1], "{broken"),
    (D[2], '{"a": true, "b": 7, "c": "back", "new": [1]}'), (D[2], "[1, 2]"), (D[2], ""), (None, '{"z": 1}'),
]


def report(spark, lines, declared=("a", "b", "c", "never")):
    df = spark.createDataFrame(lines, "ingest_date date, value string")
    return {tuple(r) for r in drift.drift(df, list(declared)).collect()}


def test_added_vanished_and_retyped_fields(spark):
    assert report(spark, LINES) == {
        (D[1], "new", "added", "object", 2), (D[2], "new", "added", "array", 1),
        (D[1], "b", "retyped", "mixed", 2), (D[2], "b", "retyped", "number", 1),
        (D[2], "a", "retyped", "boolean", 1), (D[1], "c", "vanished", None, 0)}


def test_nothing_to_report(spark):
    assert report(spark, LINES[:2]) == set() == report(spark, [])


def test_reads_landed_files(spark, tmp_path):
    for day, lines in ((D[0], ['{"event_key": "e"}']), (D[1], ['{"event_key": 5, "surprise": "s"}'])):
        spark.createDataFrame([(x,) for x in lines], "value string").write.text(
            f"{tmp_path}/events/ingest_date={day}/batch=b1")
    got = {tuple(r) for r in drift.event_drift(spark, str(tmp_path)).collect()}
    assert got == {(D[1], "event_key", "retyped", "number", 1), (D[1], "surprise", "added", "string", 1)}
    assert drift.event_drift(spark, str(tmp_path), since=D[1]).count() == 1
    assert drift.media_drift(spark, str(tmp_path), missing_ok=True).count() == 0
