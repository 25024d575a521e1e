from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from reelstar import schemas  # noqa: E402
from reelstar.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, shuffle_partitions=8, app="reelstar-tests")
    yield s


def raw_event(**kw) -> dict:
    """A raw event record with every column, defaults filled in."""
    base = {c: None for c in schemas.RAW_EVENT_COLUMNS}
    base.update({
        "event_key": "e1", "media_id": "m1", "visitor_key": "v1",
        "received_at": "2024-03-01T01:30:00.123Z", "percent_viewed": "50",
        "ingest_ts": "2024-03-02T00:00:00.000", "ip": "10.0.0.1", "country": "US",
        "region": "R1", "media_url": "https://x/m1",
    })
    base.update(kw)
    base.setdefault(schemas.RAW_PARTITION_COL, None)
    if base[schemas.RAW_PARTITION_COL] is None:
        base[schemas.RAW_PARTITION_COL] = dt.date(2024, 3, 2)
    return base


def raw_media_row(**kw) -> dict:
    base = {c: None for c in schemas.RAW_MEDIA_COLUMNS}
    base.update({"hashed_id": "m1", "created": "2024-01-01T00:00:00+00:00",
                 "duration": "100.0", "name": "Intro - YouTube"})
    base.update(kw)
    base.setdefault(schemas.RAW_PARTITION_COL, dt.date(2024, 3, 2))
    return base


def events_df(spark, rows: list[dict]):
    from pyspark.sql import types as T
    schema = T.StructType(list(schemas.RAW_EVENTS.fields)).add(schemas.RAW_PARTITION_COL, "date")
    return spark.createDataFrame([raw_event(**r) for r in rows], schema)


def media_df(spark, rows: list[dict]):
    from pyspark.sql import types as T
    schema = T.StructType(list(schemas.RAW_MEDIA.fields)).add(schemas.RAW_PARTITION_COL, "date")
    return spark.createDataFrame([raw_media_row(**r) for r in rows], schema)
