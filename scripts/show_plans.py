"""Print the physical plans of the pipeline's builders over landed JSON.

    python scripts/show_plans.py [sf_dir]

Lands the test-data raw events once (scratch folder), stages them as the
batch job does, and prints ``explain("formatted")`` for the dedupe/fact
build, the engagement aggregate and the visitor dimension.
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from reelstar.operators import dims, facts  # noqa: E402
from reelstar.session import local_session, scratch_path  # noqa: E402
from reelstar.sources import landing, testdata  # noqa: E402
from reelstar.sources.raw import read_raw_events, read_raw_media, stage  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    root = scratch_path(spark, "plans")
    landing.land(testdata.raw_events(spark, sf_dir), root, "events", "b")
    landing.land(testdata.raw_media(spark, sf_dir), root, "media", "media")
    staged = stage(read_raw_events(spark, root), scratch_path(spark, "plans-stage"))
    durations = dims.media_durations(read_raw_media(spark, root))
    fct = facts.build_events(facts.events_since(staged, "2024-01-20"), durations)
    for title, df in (("fct_events (incremental window)", fct),
                      ("fct_media_engagement", facts.build_media_engagement(fct)),
                      ("dim_visitors", dims.build_visitors(staged))):
        print(f"===== {title} =====")
        df.explain("formatted")


if __name__ == "__main__":
    main()
