"""Ledger of landings: what was read of the raw zone, and what came of it.

A landing is a folder of the raw zone (``ingest_date=D/batch=B``, or whatever
levels there are) and the unit of change: a run lists the files, compares path, size
and modification time with the list of the last run, and reads a landing anew if
any of its files came, went or changed. Nothing is read to find that out. For each landing the
ledger keeps, in one partition (``unit``) each of parquet tables beside the curated ones:

* ``staged``      the used event columns, parsed once, with file and event day;
* ``visitors``, ``urls``, ``media``  partial minima and maxima by key;
* ``media_days``  the event days of each media;
* ``days``        the event days of each file and their rows (a zone map).

Replacing a landing replaces its partitions and a purged one takes them along, so
minima and maxima over all partials are those of a rebuild: no value has to be
taken back. The lists of files and days are written anew as a generation, and a table
property names the current one. It is switched when all tables have been written, so after a
failure the next run finds the same landings changed. Days about to be rebuilt are
noted (``pending``) before the first write and rebuilt by the next run if that note is still there.

A run over everything goes by groups of landings and ranges of days and notes each that is
done (``rebuild``). If it is stopped, the next full run goes on from there: landings whose files are
as they were aren't parsed again, and, where no landing changed at all, days already written are left alone.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstar import schemas, session
from reelstar.functions import parse_event_time
from reelstar.operators import dims
from reelstar.sources.raw import EVENT_COLUMNS_USED

EVENTS, MEDIA = "events", "media"
LEDGER_KEY = "reelstar.ledger"
UNIT, FILE, DAY = "unit", "file", "event_day"

REBUILD_UNITS = "kind string, unit string, signature string"
FILES = "kind string, landing string, unit string, file string, length long, modified timestamp"
DAYS = f"{UNIT} string, {FILE} string, {DAY} date, rows long"
#: Tables with a partition for each landing, and their other columns.
UNITS = {
    "staged": ", ".join(f"{c} string" for c in EVENT_COLUMNS_USED)
              + f", {schemas.RAW_PARTITION_COL} date, {schemas.CORRUPT_COL} string, {FILE} string, {DAY} date",
    "visitors": "visitor_id string, created_at timestamp, ip_address string, country string, region string",
    "urls": "media_id string, media_url string",
    "media": "media_id string, created_at timestamp, duration double, title string",
    "media_days": f"media_id string, {DAY} date",
}


def unit_of(landing: Column) -> Column:
    """Partition value of a landing: a folder name that needs no escapes."""
    return F.concat(F.lit("u"), F.md5(landing.cast("binary")))


def _relative(path: Column, table: str) -> Column:
    return F.substring_index(path, f"/{table}/", -1)


def _folder(file: Column) -> Column:
    name = F.substring_index(file, "/", -1)
    return F.substring(file, F.lit(1), F.length(file) - F.length(name) - 1)


def file_of(table: str) -> Column:
    """File of a row below the table's folder. The reader's path is URL-encoded; one without
    an escape is taken as it is, for this is worked out for every row."""
    path = F.col("_metadata.file_path")
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return _relative(F.when(path.contains("%"), decoded).otherwise(path), table)


def list_files(spark: SparkSession, source_path: str, table: str, missing_ok: bool = False) -> DataFrame:
    """Files of a raw table with size and modification time; their content isn't read."""
    try:
        found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .load(f"{source_path.rstrip('/')}/{table}"))
    except AnalysisException as exc:
        if not missing_ok or "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], FILES)
    file = _relative(F.col("path"), table)
    return found.select(F.lit(table).alias("kind"), _folder(file).alias("landing"), unit_of(_folder(file)).alias(UNIT),
                        file.alias(FILE), "length", F.col("modificationTime").alias("modified"))


def read_files(spark: SparkSession, source_path: str, table: str, below: list[str],
               mode: str = "PERMISSIVE") -> DataFrame:
    """Raw rows of landings or single files (paths below the table's folder), with file and unit."""
    root = f"{source_path.rstrip('/')}/{table}"
    schema = schemas.RAW_EVENTS if table == EVENTS else schemas.RAW_MEDIA
    part, corrupt = schemas.RAW_PARTITION_COL, schemas.CORRUPT_COL
    known = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType(), True),
                          T.StructField(part, T.DateType(), True)])
    reader = (spark.read.schema(known).option("mode", mode).option("basePath", root)
              .option("columnNameOfCorruptRecord", corrupt))
    rows = reader.json([f"{root}/{b}" for b in below])
    file = file_of(table)
    return rows.select(*schema.names, corrupt, part, file.alias(FILE), unit_of(_folder(file)).alias(UNIT))


@dataclass
class Changes:
    """Landings to read anew and landings that went, by table: ``{unit: landing}``."""
    read: dict[str, dict[str, str]] = field(default_factory=lambda: {EVENTS: {}, MEDIA: {}})
    gone: dict[str, dict[str, str]] = field(default_factory=lambda: {EVENTS: {}, MEDIA: {}})

    #: What each landing's files are, and how many bytes, by unit.
    signature: dict[str, str] = field(default_factory=dict)
    size: dict[str, int] = field(default_factory=dict)

    def units(self, kind: str) -> list[str]:
        return [*self.read[kind], *self.gone[kind]]

    def groups(self, limit: int) -> list[Changes]:
        """The same changes in parts of about ``limit`` bytes to read; a part has a landing at least."""
        out, room = [], -1
        for kind in (EVENTS, MEDIA):
            for unit, landing in self.read[kind].items():
                if room < 0:
                    out.append(Changes(signature=self.signature, size=self.size))
                    room = limit
                out[-1].read[kind][unit] = landing
                room -= self.size.get(unit, 0) + 1
        if any(self.gone.values()):
            out.append(Changes(gone=self.gone))
        return out

    def without(self, done: dict[str, str]) -> Changes:
        """The landings that weren't done with the files they have now."""
        keep = lambda of: {u: x for u, x in of.items() if done.get(u) != self.signature.get(u)}
        return Changes({k: keep(v) for k, v in self.read.items()}, self.gone, self.signature, self.size)

    def __bool__(self) -> bool:
        return any(self.units(k) for k in (EVENTS, MEDIA))


@dataclass
class Ledger:
    spark: SparkSession
    root: str
    table: str                       # the table whose property names the current generation
    source_path: str
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex[:12])

    @classmethod
    def for_db(cls, spark: SparkSession, db: str, warehouse_dir: str | None, source_path: str) -> Ledger:
        base = (f"{warehouse_dir.rstrip('/')}/{db}.db" if warehouse_dir
                else spark.catalog.getDatabase(db).locationUri.rstrip("/"))
        return cls(spark, f"{base}/_reelstar_ledger", f"{db}.dim_visitors", source_path)

    # --- generations ----------------------------------------------------------

    def current(self) -> str | None:
        props = {r.key: r.value for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.table}").collect()}
        return props.get(LEDGER_KEY) or None

    def _generation(self, run_id: str | None, name: str, schema: str) -> DataFrame:
        if run_id is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/generations/{run_id}/{name}")

    def files(self, run_id: str | None = None) -> DataFrame:
        return self._generation(run_id or self.current(), "files", FILES)

    def days(self, run_id: str | None = None) -> DataFrame:
        return self._generation(run_id or self.current(), "days", DAYS)

    def _write_generation(self, df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/generations/{self.run_id}/{name}")

    def commit(self) -> None:
        """Make this run's generation the current one, then forget the older ones."""
        self.spark.sql(f"ALTER TABLE {self.table} SET TBLPROPERTIES ('{LEDGER_KEY}' = '{self.run_id}')")
        session.delete_path(self.spark, f"{self.root}/pending")
        session.delete_path(self.spark, f"{self.root}/rebuild")
        session.delete_path(self.spark, f"{self.root}/temp/{self.run_id}")
        for name in session.folder_names(self.spark, f"{self.root}/generations"):
            if name != self.run_id:
                session.delete_path(self.spark, f"{self.root}/generations/{name}")

    # --- changes --------------------------------------------------------------

    def look(self, missing_ok: bool = False, forget: bool = False) -> Changes:
        """List the raw zone and compare with the last run's list. ``forget``
        takes every landing as changed."""
        now = (list_files(self.spark, self.source_path, EVENTS, missing_ok)
               .unionByName(list_files(self.spark, self.source_path, MEDIA, missing_ok)))
        self._write_generation(now, "files")
        now, old = self.files(self.run_id), self.files()
        key = ["kind", "landing", UNIT, FILE]
        both = (now.withColumn("here", F.lit(True))
                .join(old.select(*key, F.col("length").alias("_l"), F.col("modified").alias("_m"), F.lit(True).alias("was")),
                      key, "full"))
        same = F.col("length").eqNullSafe(F.col("_l")) & F.col("modified").eqNullSafe(F.col("_m"))
        one = F.when(F.col("here"), F.concat_ws(" ", FILE, "length", F.col("modified").cast("double")))
        by = (both.groupBy("kind", "landing", UNIT)
              .agg(F.bool_or(~same).alias("differs"), F.coalesce(F.bool_or("here"), F.lit(False)).alias("here"),
                   F.md5(F.array_join(F.sort_array(F.collect_list(one)), "\n").cast("binary")).alias("signature"),
                   F.coalesce(F.sum("length"), F.lit(0)).alias("size")))
        changed = by if forget else by.filter("differs")
        out = Changes()
        # a row for each changed landing (a folder), none for a file or an event
        for r in changed.collect():
            (out.read if r.here else out.gone)[r.kind][r.unit] = r.landing
            out.signature[r.unit], out.size[r.unit] = r.signature, r.size
        return out

    # --- tables by landing ----------------------------------------------------

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, units: list[str] | None = None) -> DataFrame:
        """A table of the ledger, or the partitions of some landings."""
        schema = T.StructType.fromDDL(f"{UNITS[name]}, {UNIT} string")
        try:
            df = self.spark.read.schema(schema).parquet(self.path(name))
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            df = self.spark.createDataFrame([], schema)
        return df if units is None else df.where(F.col(UNIT).isin(units))

    def replace(self, name: str, df: DataFrame, units: list[str]) -> None:
        """Write the partitions of landings read anew; those of all ``units`` go before."""
        for u in units:
            session.delete_path(self.spark, f"{self.path(name)}/{UNIT}={u}")
        names = T.StructType.fromDDL(UNITS[name]).names
        out = df.select(*names, UNIT).hint("rebalance", UNIT)
        if name == "staged":
            # sorted by day, a day's rows lie in few row groups
            out = out.sortWithinPartitions(UNIT, DAY)
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(UNIT)
         .parquet(self.path(name)))

    def take(self, changes: Changes, mode: str = "PERMISSIVE") -> dict[str, int]:
        """Read the changed landings, each raw row once, and replace what the ledger
        keeps of them; then their days. Returns the rows read."""
        self.parse(changes, mode)
        return self.index(changes)

    def parse(self, changes: Changes, mode: str = "PERMISSIVE") -> None:
        """The staged events and the partials of changed landings."""
        if units := changes.units(EVENTS):
            fresh = list(changes.read[EVENTS])
            if fresh:
                raw = read_files(self.spark, self.source_path, EVENTS, list(changes.read[EVENTS].values()), mode)
                day = F.to_date(parse_event_time("received_at")).alias(DAY)
                self.replace("staged", raw.select(*EVENT_COLUMNS_USED, schemas.RAW_PARTITION_COL, schemas.CORRUPT_COL, FILE,
                                                  UNIT, day), units)
                staged = self.read("staged", fresh)
                self.replace("visitors", dims.visitor_partials(staged, UNIT), units)
                self.replace("urls", dims.url_partials(staged, UNIT), units)
                self.replace("media_days", staged.select(UNIT, "media_id", DAY).where("media_id IS NOT NULL").distinct(), units)
            else:
                for name in ("staged", "visitors", "urls", "media_days"):
                    self._drop(name, units)
        if units := changes.units(MEDIA):
            if changes.read[MEDIA]:
                raw = read_files(self.spark, self.source_path, MEDIA, list(changes.read[MEDIA].values()), mode)
                self.replace("media", dims.media_partials(raw, UNIT), units)
            else:
                self._drop("media", units)

    def index(self, changes: Changes) -> dict[str, int]:
        """The event days of each file, those of changed landings anew; rows of changed landings."""
        rows = {EVENTS: 0, MEDIA: 0}
        kept = self.days().where(~F.col(UNIT).isin(changes.units(EVENTS)))
        fresh = self.read("staged", list(changes.read[EVENTS])) if changes.read[EVENTS] else None
        if fresh is not None:
            kept = kept.unionByName(fresh.groupBy(UNIT, FILE, DAY).agg(F.count(F.lit(1)).alias("rows")))
        self._write_generation(kept, "days")
        if fresh is not None:
            rows[EVENTS] = self.days(self.run_id).where(F.col(UNIT).isin(list(changes.read[EVENTS]))).agg(
                F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        if changes.read[MEDIA]:
            rows[MEDIA] = self.read("media", list(changes.read[MEDIA])).count()
        return rows

    # --- full runs in steps -----------------------------------------------------

    def _rebuild(self, name: str, schema: str) -> list:
        try:
            return (self.spark.read.schema(schema).option("recursiveFileLookup", "true")
                    .parquet(f"{self.root}/rebuild/{name}").collect())
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            return []

    def done_units(self) -> dict[str, str]:
        """Landings that a stopped full run has parsed, with the files they had."""
        return {r.unit: r.signature for r in self._rebuild("units", REBUILD_UNITS)}

    def done_days(self) -> set[dt.date | None]:
        return {r[0] for r in self._rebuild("days", f"{DAY} date")}

    def _note(self, name: str, rows: list, schema: str) -> None:
        (self.spark.createDataFrame(rows, schema).coalesce(1).write
         .parquet(f"{self.root}/rebuild/{name}/{uuid.uuid4().hex[:12]}"))

    def note_units(self, changes: Changes) -> None:
        rows = [(k, u, changes.signature[u]) for k in (EVENTS, MEDIA) for u in changes.read[k]]
        if rows:
            self._note("units", rows, REBUILD_UNITS)

    def note_days(self, days: list[dt.date | None]) -> None:
        self._note("days", [(d,) for d in days], f"{DAY} date")

    def forget_days(self) -> None:
        session.delete_path(self.spark, f"{self.root}/rebuild/days")

    def ranges(self, days: list[dt.date | None], limit: int) -> list[list[dt.date | None]]:
        """The days in order, in ranges of about ``limit`` rows; a range has a day at least."""
        rows = {r[0]: r[1] for r in self.days(self.run_id).groupBy(DAY).agg(F.sum("rows")).collect()}
        out, room = [], -1
        for d in days:
            if room < 0:
                out.append([])
                room = limit
            out[-1].append(d)
            room -= rows.get(d, 0) + 1
        return out

    def quarantine(self, changes: Changes, path: str) -> None:
        """Malformed lines of the changed landings, a folder for each; a mended landing loses its own."""
        for u in changes.units(EVENTS):
            session.delete_path(self.spark, f"{path.rstrip('/')}/{UNIT}={u}")
        corrupt = schemas.CORRUPT_COL
        bad = self.read("staged", list(changes.read[EVENTS])).where(F.col(corrupt).isNotNull())
        (bad.select(F.col(corrupt).alias("value"), UNIT).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(UNIT).text(path))

    def _drop(self, name: str, units: list[str]) -> None:
        for u in units:
            session.delete_path(self.spark, f"{self.path(name)}/{UNIT}={u}")

    # --- days -----------------------------------------------------------------

    def touched(self, changes: Changes) -> DataFrame:
        """Event days (NULL among them) whose facts the changed landings had or have."""
        units = changes.units(EVENTS)
        of = lambda df: df.where(F.col(UNIT).isin(units)).select(DAY)
        return of(self.days()).unionByName(of(self.days(self.run_id))).distinct()

    def days_of_media(self, media: DataFrame) -> DataFrame:
        """Event days of the given media (``media_id``)."""
        return self.read("media_days").join(media.select("media_id"), "media_id", "left_semi").select(DAY).distinct()

    def note_pending(self, days: list[dt.date | None]) -> None:
        (self.spark.createDataFrame([(d,) for d in days], f"{DAY} date").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.root}/pending/{self.run_id}"))

    def pending(self) -> list[dt.date | None]:
        """Days that an earlier run began to rebuild and didn't finish."""
        try:
            rows = (self.spark.read.schema(f"{DAY} date").option("recursiveFileLookup", "true")
                    .parquet(f"{self.root}/pending").distinct().collect())
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            return []
        return [r[0] for r in rows]

    def events_of(self, days: list[dt.date | None]) -> DataFrame:
        """Staged events of these days, out of the landings that have any."""
        wanted = _among(F.col(DAY), days)
        units = [r[0] for r in self.days(self.run_id).where(wanted).select(UNIT).distinct().collect()]
        return self.read("staged", units).where(wanted)

    def materialize(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/temp/{self.run_id}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # --- zone map -------------------------------------------------------------

    def zones(self) -> DataFrame:
        """``(file, first_day, last_day, rows, undated)`` of each file of the raw events."""
        return self.days().groupBy(FILE).agg(
            F.min(DAY).alias("first_day"), F.max(DAY).alias("last_day"), F.sum("rows").alias("rows"),
            F.sum(F.when(F.col(DAY).isNull(), F.col("rows")).otherwise(0)).alias("undated"))

    def raw_since(self, start: dt.date, end: dt.date | None = None, mode: str = "PERMISSIVE") -> DataFrame:
        """Raw events dated in the window, read from the files alone that have any: landing days
        needn't bound event days, nor be there. For files as the last run saw them."""
        day = F.col(DAY)
        meets = (day >= F.lit(start)) & (F.lit(True) if end is None else day <= F.lit(end))
        files = [r[0] for r in self.days().where(meets).select(FILE).distinct().collect()]
        schema = T.StructType([*schemas.RAW_EVENTS.fields, T.StructField(schemas.RAW_PARTITION_COL, T.DateType(), True)])
        if not files:
            return self.spark.createDataFrame([], schema)
        rows = read_files(self.spark, self.source_path, EVENTS, files, mode).select(*schema.names)
        dated = F.to_date(parse_event_time("received_at"))
        return rows.where((dated >= F.lit(start)) & (F.lit(True) if end is None else dated <= F.lit(end)))


def _among(col: Column, days: list[dt.date | None]) -> Column:
    known = [d for d in days if d is not None]
    cond = col.isin(known) if known else F.lit(False)
    return cond | col.isNull() if None in days else cond
