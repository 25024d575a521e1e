import datetime as dt

import pytest

from reelstar.plans.config import PipelineConfig, parse_bool, parse_mode
from reelstar.plans.state import commit_checkpoint, read_checkpoint, resolve_window
from reelstar.session import scratch_path


def test_modes():
    assert parse_mode("full") == parse_mode("full_refresh") == parse_mode(None) == "full"
    assert parse_mode("INCREMENTAL") == "incremental"
    with pytest.raises(ValueError):
        parse_mode("delta")


def test_strict_booleans():
    assert parse_bool("false") is False and parse_bool("TRUE") is True and parse_bool(None, True)
    with pytest.raises(ValueError):
        parse_bool("yes")


def test_config_validation():
    with pytest.raises(ValueError):
        PipelineConfig(source_path="s", target_db="d", start_date="2024-13-01")
    cfg = PipelineConfig.from_args({"SOURCE_PATH": "s", "TARGET_DB": "d", "PIPELINE_MODE": "incremental",
                                    "START_DATE": "2024-01-20", "DRY_RUN": "false"})
    assert cfg.facts_start == dt.date(2024, 1, 20) and cfg.dry_run is False
    assert PipelineConfig(source_path="s", target_db="d", start_date="2024-01-20").facts_start is None
    assert PipelineConfig(source_path="s", target_db="d", persist_state="false").persist_state is False
    with pytest.raises(ValueError):
        PipelineConfig(source_path="s", target_db="d", mode="incremental", replace_all=True)


def test_window_resolution():
    now = dt.datetime(2026, 1, 28, 0, 0, 3, 120000)
    w = resolve_window("incremental", None, dt.date(2026, 1, 27), now)
    assert (w.fetch_start, w.start_date, w.new_last_run_ts) == (dt.date(2026, 1, 27), dt.date(2026, 1, 27),
                                                                "2026-01-28T00:00:03.120000")
    w = resolve_window("full", None, dt.date(2026, 1, 27), now)
    assert w.start_date is None and w.fetch_end == dt.date(2026, 1, 28)
    assert w.fetch_start == dt.date(2026, 1, 28) - dt.timedelta(days=730)
    w = resolve_window("full", dt.date(2026, 1, 1), None, now)
    assert (w.fetch_start, w.start_date) == (dt.date(2026, 1, 1), None)      # a full run rebuilds all
    w = resolve_window("incremental", None, None, now)
    assert (w.fetch_start, w.fetch_end, w.start_date) == (None, None, None)  # first run: the whole history
    w = resolve_window("incremental", dt.date(2026, 1, 1), dt.date(2026, 1, 27), now)
    assert (w.fetch_start, w.start_date) == (dt.date(2026, 1, 1), dt.date(2026, 1, 1))
    zoned = dt.datetime(2026, 1, 28, 2, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    assert resolve_window("full", None, None, zoned).new_last_run_ts == "2026-01-28T00:00:00"


def test_checkpoint_roundtrip(spark):
    path = scratch_path(spark, "state")
    assert read_checkpoint(spark, path) is None
    assert commit_checkpoint(spark, path, "2026-01-28T00:00:03.120000", persist_state="false")["status"] == "skipped"
    assert read_checkpoint(spark, path) is None
    assert commit_checkpoint(spark, path, "2026-01-28T00:00:03.120000", dry_run=True)["status"] == "skipped"
    assert commit_checkpoint(spark, path, "2026-01-28T00:00:03.120000")["status"] == "committed"
    assert read_checkpoint(spark, path) == dt.date(2026, 1, 28)
    with pytest.raises(ValueError):
        commit_checkpoint(spark, path, None)
