import json

from conftest import SF_SMALL
from reelstar.__main__ import ddl, main
from reelstar.session import scratch_path
from reelstar.sources import landing, testdata


def test_ddl_lists_every_table():
    text = ddl("raw", "cur", "/land", "/wh")
    for t in ("raw.events", "raw.media", "cur.dim_dates", "cur.dim_visitors", "cur.dim_media",
              "cur.fct_events", "cur.fct_media_engagement"):
        assert f"CREATE TABLE IF NOT EXISTS {t} " in text
    assert "PARTITIONED BY (p_date)" in text and "LOCATION '/wh/cur.db/fct_events'" in text


def test_build_command_runs_and_commits(spark, capsys):
    root = scratch_path(spark, "raw")
    landing.land(testdata.raw_events(spark, SF_SMALL), root, "events", "b")
    landing.land(testdata.raw_media(spark, SF_SMALL), root, "media", "media")
    state = scratch_path(spark, "state")
    args = ["build", "--source-path", root, "--target-db", "cli_db", "--warehouse-dir",
            scratch_path(spark, "wh"), "--mode", "incremental", "--state-path", state,
            "--dates-end", "2024-02-01"]
    assert main(args) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["checkpoint"]["status"] == "committed"
    assert out["table_rows"]["fct_events"] == 1000 and out["dimensions"] == "rebuilt"
    assert main(args[:-2] + ["--dry-run", "true"]) == 0
    dry = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert dry["checkpoint"]["status"] == "skipped"


def test_stream_command(spark, capsys):
    root = scratch_path(spark, "raw")
    landing.land(testdata.raw_events(spark, SF_SMALL), root, "events", "b")
    landing.land(testdata.raw_media(spark, SF_SMALL), root, "media", "media")
    args = ["stream", "--source-path", root, "--target-db", "cli_stream",
            "--warehouse-dir", scratch_path(spark, "wh"),
            "--checkpoint-location", scratch_path(spark, "ckpt")]
    assert main(args) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["micro_batches"] >= 1
    assert spark.table("cli_stream.fct_media_engagement").count() > 0
    assert spark.table("cli_stream.dim_visitors").count() == 15


def test_column_listing_of_a_dataframe(spark):
    from reelstar.operators import dims
    from reelstar.schemas import columns_ddl
    from conftest import events_df
    df = dims.build_visitors(events_df(spark, [{}]))
    assert columns_ddl(df.schema) == ("visitor_id string, created_at timestamp, ip_address string, "
                                      "country string, region string, updated_at timestamp")
    assert columns_ddl(df.schema, all_strings=True).count(" string") == 6


def test_land_command(spark, tmp_path, capsys):
    pages, media, root = tmp_path / "pages.jsonl", tmp_path / "media.jsonl", tmp_path / "raw"
    pages.write_text("\n".join(json.dumps({"media_id": "m1", "page": i, "payload": p}) for i, p in (
        (1, '[{"event_key": "a"}]'), (2, "[]"), (3, '[{"event_key": "late"}]'))))
    media.write_text(json.dumps({"hashed_id": "m1", "name": "x"}))
    assert main(["land", "--source-path", str(root), "--pages", str(pages), "--media", str(media),
                 "--start-date", "2026-01-27", "--ingest-ts", "2026-01-28T02:00:00+02:00"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["batch"] == "events_2026-01-27-latest" and out["ingest_ts"] == "2026-01-28T00:00:00"
    from reelstar.sources.raw import read_raw_events, read_raw_media
    assert [r.event_key for r in read_raw_events(spark, str(root)).collect()] == ["a"]
    assert read_raw_media(spark, str(root)).first().hashed_id == "m1"
