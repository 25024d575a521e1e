"""State that lets dimensions be maintained from new landings only.

Merging is off unless asked for: min and max cannot take a value back, so it equals
a rebuild only where landings are appended in order of their days and never
replaced.

* Watermark - table properties of ``dim_visitors``: the latest landing day
  the dimensions have seen, for events and for media snapshots. The next
  merging run re-reads that boundary day (harmless: min/max are idempotent).
  Catalog properties need no file that may be missing.
* Open write - a property set while the dimensions are replaced. A run that
  finds it set rebuilds them: what a failed write left is no base for a merge.
* ``media_urls`` - parquet next to the curated tables
  (``<warehouse>/<db>.db/_reelstar_state``): URL per media id over all
  events, including media that no snapshot has described yet (they are
  absent from dim_media). Two slots alternate; a table property names the
  current one, so the state is written once per run and switched only after
  the dimensions were written.

Frames that are read from and then overwrite the same place are first
written to ``staging/`` in the same folder (reliable storage, lineage cut).
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reelstar import session

URLS_SCHEMA = T.StructType([T.StructField("media_id", T.StringType(), True),
                            T.StructField("media_url", T.StringType(), True)])
# Property keys (none may contain "url": Spark redacts such values).
EVENTS_KEY, MEDIA_KEY, URLS_KEY, WRITE_KEY = ("reelstar.events_through", "reelstar.media_through",
                                              "reelstar.link_slot", "reelstar.dims_write")


@dataclass
class DimState:
    root: str
    table: str                       # the table carrying the state properties
    run_id: str = "run"              # names this run's staging folder
    staged_slot: str | None = None   # URL slot written by this run, not yet current

    @classmethod
    def for_db(cls, spark: SparkSession, db: str, warehouse_dir: str | None) -> DimState:
        # next to the tables: the state lasts as long as they do
        base = (f"{warehouse_dir.rstrip('/')}/{db}.db" if warehouse_dir
                else spark.catalog.getDatabase(db).locationUri.rstrip("/"))
        return cls(f"{base}/_reelstar_state", f"{db}.dim_visitors", uuid.uuid4().hex[:12])

    def _props(self, spark: SparkSession) -> dict[str, str]:
        if not spark.catalog.tableExists(self.table):
            return {}
        return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {self.table}").collect()}

    def watermark(self, spark: SparkSession) -> tuple[dt.date | None, dt.date | None]:
        props = self._props(spark)
        conv = lambda v: dt.date.fromisoformat(v) if v else None
        return conv(props.get(EVENTS_KEY)), conv(props.get(MEDIA_KEY))

    def write_watermark(self, spark: SparkSession, events_through: dt.date | None,
                        media_through: dt.date | None) -> None:
        text = lambda d: d.isoformat() if d else ""
        spark.sql(f"ALTER TABLE {self.table} SET TBLPROPERTIES ("
                  f"'{EVENTS_KEY}' = '{text(events_through)}', "
                  f"'{MEDIA_KEY}' = '{text(media_through)}')")

    def begin_write(self, spark: SparkSession) -> None:
        """Note that dimensions are being replaced; :meth:`commit_urls` clears it."""
        spark.sql(f"ALTER TABLE {self.table} SET TBLPROPERTIES ('{WRITE_KEY}' = 'open')")

    def write_open(self, spark: SparkSession) -> bool:
        """Whether an earlier run stopped while it replaced the dimensions:
        they may lack rows then and must be rebuilt, not merged into."""
        return self._props(spark).get(WRITE_KEY) == "open"

    def urls(self, spark: SparkSession) -> DataFrame | None:
        if self.write_open(spark):
            return None
        slot = self._props(spark).get(URLS_KEY)
        if slot not in ("a", "b"):
            return None
        return spark.read.schema(URLS_SCHEMA).parquet(f"{self.root}/media_urls_{slot}")

    def stage_urls(self, spark: SparkSession, urls: DataFrame) -> DataFrame:
        """Write merged URLs to the slot not in use and read them back.

        The previous slot stays intact until :meth:`commit_urls` switches
        the table property, so a failed run leaves the old state usable.
        """
        slot = "b" if self._props(spark).get(URLS_KEY) == "a" else "a"
        path = f"{self.root}/media_urls_{slot}"
        urls.select("media_id", "media_url").write.mode("overwrite").parquet(path)
        self.staged_slot = slot
        return spark.read.schema(URLS_SCHEMA).parquet(path)

    def commit_urls(self, spark: SparkSession) -> None:
        if self.staged_slot is None:
            raise RuntimeError("no URL state staged in this run")
        spark.sql(f"ALTER TABLE {self.table} SET TBLPROPERTIES "
                  f"('{URLS_KEY}' = '{self.staged_slot}', '{WRITE_KEY}' = 'done')")

    def staging(self, name: str) -> str:
        """A folder of this run alone: two runs on one database don't meet."""
        return f"{self.root}/staging/{self.run_id}/{name}"

    def drop_staging(self, spark: SparkSession) -> None:
        session.delete_path(spark, f"{self.root}/staging/{self.run_id}")

    def materialize(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` to the staging folder and read it back."""
        path = self.staging(name)
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
