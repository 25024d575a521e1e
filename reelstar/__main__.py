"""Command line: ``python -m reelstar <command> [options]``.

    land    land fetched pages and media snapshots from files
    build   rebuild the star schema (full or incremental), then commit state
    stream  run the availableNow stream over newly landed events
    ddl     print the DDL of the raw and curated tables

Arguments mirror the job parameters (``--source-path``, ``--target-db``,
``--mode``, ``--start-date``, ``--dry-run`` ...). The session comes from
``spark-submit`` / the cluster; nothing here starts servers.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import logging
import sys

from pyspark.sql import SparkSession

from reelstar import schemas, session
from reelstar.plans.batch import run_pipeline
from reelstar.functions import utc
from reelstar.plans.config import PipelineConfig, parse_date
from reelstar.sources import landing


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="reelstar")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("build", "stream"):
        s = sub.add_parser(name)
        s.add_argument("--source-path", required=True)
        s.add_argument("--target-db", required=True)
        s.add_argument("--warehouse-dir")
        s.add_argument("--mode", default="full")
        s.add_argument("--start-date")
        s.add_argument("--dates-end")
        s.add_argument("--dry-run", default="false")
        s.add_argument("--state-path")
        s.add_argument("--persist-state", default="true")
        s.add_argument("--replace-all", action="store_true")
        s.add_argument("--no-stage-raw", action="store_true")
        s.add_argument("--prune-raw", action="store_true",
                       help="skip landings older than the window (no event may be dated after its landing day)")
        s.add_argument("--incremental-dims", action="store_true",
                       help="merge dimensions from new landings (append-only sources)")
        s.add_argument("--tracked", action="store_true",
                       help="follow the landings by a ledger: incremental runs need no start date")
        s.add_argument("--cluster-facts", action="store_true",
                       help="move events once for both facts, by a bucketed copy")
        s.add_argument("--dates-start")
        s.add_argument("--raw-mode", default="PERMISSIVE", help="PERMISSIVE, DROPMALFORMED or FAILFAST")
        s.add_argument("--quarantine-path", help="copy malformed lines there")
        s.add_argument("--allow-missing-source", action="store_true")
        s.add_argument("--late-aware", action="store_true",
                       help="widen the incremental window to late events' days")
        if name == "stream":
            s.add_argument("--checkpoint-location", required=True)
            s.add_argument("--max-files-per-trigger", type=int)
            s.add_argument("--no-dimensions", action="store_true",
                           help="maintain only the facts; dimensions come from batch runs")
    s = sub.add_parser("land")
    s.add_argument("--source-path", required=True, help="root of the raw zone")
    s.add_argument("--pages", help="pages as JSON Lines")
    s.add_argument("--media", help="media snapshots as JSON Lines")
    s.add_argument("--start-date", help="window that was fetched: names the batch")
    s.add_argument("--end-date")
    s.add_argument("--ingest-ts")
    d = sub.add_parser("ddl")
    d.add_argument("--source-db", default="raw")
    d.add_argument("--target-db", default="curated")
    d.add_argument("--source-path", default="<raw-root>")
    d.add_argument("--warehouse-dir")
    return p


def _config(a: argparse.Namespace) -> PipelineConfig:
    return PipelineConfig(
        source_path=a.source_path, target_db=a.target_db, warehouse_dir=a.warehouse_dir,
        mode=a.mode, start_date=a.start_date, dates_end=a.dates_end, dry_run=a.dry_run,
        state_path=a.state_path, persist_state=a.persist_state, replace_all=a.replace_all,
        stage_raw=not a.no_stage_raw, prune_raw_by_ingest_date=a.prune_raw,
        incremental_dims=a.incremental_dims, tracked=a.tracked, cluster_facts=a.cluster_facts,
        raw_mode=a.raw_mode, quarantine_path=a.quarantine_path,
        allow_missing_source=a.allow_missing_source, late_aware=a.late_aware,
        **({"dates_start": a.dates_start} if a.dates_start else {}))


def land(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Land pages ``{"media_id", "page", "payload"}`` and media snapshots, both JSON Lines."""
    now = utc(dt.datetime.fromisoformat(a.ingest_ts)) if a.ingest_ts else utc(dt.datetime.now(dt.timezone.utc))
    batch = landing.batch_name(parse_date(a.start_date), parse_date(a.end_date))
    if a.pages:
        pages = spark.read.schema("media_id string, page int, payload string").json(a.pages, mode="FAILFAST")
        landing.land_events(landing.records_from_pages(pages, now), a.source_path, batch)
    if a.media:
        landing.land_media(spark.read.schema(schemas.RAW_MEDIA).json(a.media, mode="FAILFAST"), a.source_path, now.date())
    return {"batch": batch, "ingest_ts": now.isoformat(), "pages": bool(a.pages), "media": bool(a.media)}


def ddl(source_db: str, target_db: str, source_path: str, warehouse_dir: str | None) -> str:
    out = [f"CREATE DATABASE IF NOT EXISTS {source_db};",
           f"CREATE DATABASE IF NOT EXISTS {target_db};"]
    for t in ("events", "media"):
        out.append(schemas.raw_table_ddl(source_db, t, f"{source_path.rstrip('/')}/{t}") + ";")
    for t in schemas.CURATED:
        loc = f"{warehouse_dir.rstrip('/')}/{target_db}.db/{t}" if warehouse_dir else None
        out.append(schemas.table_ddl(target_db, t, loc) + ";")
    return "\n".join(out)


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    a = _parser().parse_args(argv)
    if a.command == "ddl":
        print(ddl(a.source_db, a.target_db, a.source_path, a.warehouse_dir))
        return 0
    spark = session.configure(SparkSession.builder.getOrCreate())
    if a.command == "land":
        print(json.dumps(land(spark, a)))
        return 0
    cfg = _config(a)
    if a.command == "build":
        rep = run_pipeline(spark, cfg)
        print(json.dumps({"mode": rep.mode, "facts_start": str(rep.facts_start),
                          "dimensions": rep.dimensions, "checkpoint": rep.checkpoint,
                          "rows": {k: v.rows for k, v in rep.writes.items()},
                          "table_rows": rep.table_rows}))
    else:
        from reelstar.streaming.incremental import run_available_now
        n = run_available_now(spark, cfg, a.checkpoint_location, a.max_files_per_trigger,
                              maintain_dimensions=not a.no_dimensions)
        print(json.dumps({"micro_batches": n}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
