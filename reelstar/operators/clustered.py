"""Both facts from one exchange of the events.

Built one after the other, the event fact moves all events by (media, visitor, instant) and engagement moves
the result again by (media, visitor, day). Here events move once, by (media, visitor, salt); everything
that follows groups by more columns than these, so the rows lie right already:

* the latest copy of each event is found in the task that received it and written to a table bucketed by
  (media, visitor, salt);
* the event fact is a scan of that table, engagement an aggregate of its buckets without an exchange.

A pair with few events has no salt (-1), so all its days lie in one bucket. A heavy pair (anonymous visitors
of a media, a robot) is salted by the instant and spread over all buckets; copies of an event share the
instant, so they still meet. Its engagement is put together from one partial row a bucket and day: only these
move again. Heavy pairs are in a folder of their own, so the two halves read different files.

Which pairs are heavy decides where rows lie, never what the result is. They come from a frequent-items
sketch (:func:`profile`), merged in two steps and bounded in size whatever the data.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar import schemas, session
from reelstar.functions import watch_time
from reelstar.operators.dedupe import latest_per_key
from reelstar.operators.dims import audit_ts
from reelstar.operators.facts import EVENT_KEY, LATEST_ORDER, typed_events
from reelstar.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, lookup_join

PAIR = ("media_id", "visitor_id")
SALT, HEAVY = "salt", "heavy"
NO_SALT = -1
#: Events in one bucket, about 200 MB of the used columns.
BUCKET_ROWS = 4_000_000
#: Spark's own limit of buckets (spark.sql.sources.bucketing.maxBuckets).
MAX_BUCKETS = 100_000
#: Keys that are told as heavy at most, and keys a sketch tracks (an undercount of 3.5 / TRACKED of all rows at most).
TOP, TRACKED = 1_000, 10_000
#: Tasks that merge the sketches before the last one does.
MERGERS = 64


@dataclass(frozen=True)
class Profile:
    """Rows of a frame, and hashes of the pairs and of the instants that hold very many of them."""
    rows: int
    pairs: tuple[int, ...] = ()
    instants: tuple[int, ...] = ()

    def buckets(self, bucket_rows: int = BUCKET_ROWS) -> int:
        return max(1, min(MAX_BUCKETS, -(-self.rows // bucket_rows)))


def _pair() -> Column:
    return F.xxhash64(*PAIR)


def _instant() -> Column:
    return F.xxhash64(*EVENT_KEY)


def _is_one_of(key: Column, hashes: tuple[int, ...]) -> Column:
    return key.isin(list(hashes)) if hashes else F.lit(False)


def profile(typed: DataFrame, bucket_rows: int = BUCKET_ROWS) -> Profile:
    """Count typed events and find their heavy keys in one scan of the key columns.

    Heavy is what fills half a bucket, and at least a thousandth of all rows where there are more
    than ``TOP / 2`` buckets.
    """
    sketches = (
        typed.select(_pair().alias("p"), _instant().alias("i"))
        .groupBy((F.spark_partition_id() % MERGERS).alias("part"))
        .agg(F.count(F.lit(1)).alias("rows"),
             *[F.expr(f"approx_top_k_accumulate({c}, {TRACKED})").alias(c) for c in ("p", "i")])
    )
    # by a key (one for all), since sketches of no rows can't be merged
    found = sketches.groupBy((F.col("part") < 0).alias("part")).agg(
        F.sum("rows").alias("rows"),
        *[F.expr(f"approx_top_k_estimate(approx_top_k_combine({c}, {TRACKED}), {TOP})").alias(c)
          for c in ("p", "i")]).first()
    if found is None:
        return Profile(0)
    least = max(bucket_rows / 2, found.rows / TOP)
    heavy = lambda items: tuple(sorted(x["item"] for x in items if x["count"] >= least))
    return Profile(found.rows, heavy(found.p), heavy(found.i))


def place(typed: DataFrame, prof: Profile, buckets: int) -> DataFrame:
    """The latest copy of each event, each pair (or each salt of a heavy pair) in one partition of ``buckets``.

    Copies of an instant that alone fills half a bucket are reduced before the exchange.
    """
    if prof.instants:
        hot = _is_one_of(_instant(), prof.instants)
        typed = typed.where(~hot).unionByName(latest_per_key(typed.where(hot), EVENT_KEY, LATEST_ORDER))
    salt = F.when(_is_one_of(_pair(), prof.pairs),
                  F.pmod(F.xxhash64("created_at"), F.lit(buckets)).cast("int")).otherwise(F.lit(NO_SALT))
    placed = typed.withColumn(SALT, salt).repartition(buckets, *PAIR, SALT)
    # the salt follows from the key: grouping by it, too, changes no group and lets Spark see that rows lie right
    return latest_per_key(placed, [*PAIR, SALT, "created_at"], LATEST_ORDER)


def engagement_parts(events: DataFrame) -> DataFrame:
    """Sums of placed events by pair, salt and day: no exchange."""
    return events.groupBy(*PAIR, SALT, "date").agg(
        F.count("created_at").alias("plays"), F.sum("duration_viewed").alias("watched"),
        F.count("duration_viewed").alias("watches"), F.max("percent_viewed").alias("most"),
        F.sum("percent_viewed").alias("percents"), F.count("percent_viewed").alias("views"))


def engagement_of(parts: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """Engagement rows from sums that are whole."""
    mean = lambda total, n: F.when(F.col(n) > 0, F.col(total) / F.col(n))
    return parts.select(
        *PAIR, "date", F.col("plays").alias("play_count"), F.col("watched").alias("total_watch_time"),
        mean("watched", "watches").alias("avg_watch_time_per_view"), F.col("most").alias("max_percent_viewed"),
        mean("percents", "views").alias("avg_percent_viewed"), audit_ts(run_ts).alias("updated_at"),
        F.col("date").alias(schemas.TARGET_PARTITION_COL))


@dataclass(frozen=True)
class ClusteredFacts:
    """De-duplicated events of some window in a bucketed table of this run's own."""
    spark: SparkSession
    table: str
    path: str
    profile: Profile
    n_buckets: int

    @classmethod
    def write(cls, raw_events: DataFrame, durations: DataFrame, table: str, path: str,
              max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, durations_rows: int | None = None,
              bucket_rows: int = BUCKET_ROWS) -> ClusteredFacts:
        """Move raw events once and write them.

        Watch time is looked up before they move: a lookup too large to be broadcast would move them again.
        ``raw_events`` is read twice (keys only, then whole), so it should be the staged copy. A table
        that a failed run left behind is replaced.
        """
        spark = raw_events.sparkSession
        typed = typed_events(raw_events)
        prof = profile(typed, bucket_rows)
        n = prof.buckets(bucket_rows)
        looked_up = lookup_join(typed, durations.select("media_id", "duration"), "media_id",
                                max_broadcast_rows, durations_rows)
        looked_up = looked_up.withColumn("duration_viewed", watch_time("duration", "percent_viewed")).drop("duration")
        rows = place(looked_up, prof, n).select(
            *EVENT_KEY, F.to_date("created_at").alias("date"), "percent_viewed", "duration_viewed", SALT,
            (F.col(SALT) != NO_SALT).alias(HEAVY))
        out = cls(spark, table, path.rstrip("/"), prof, n)
        out.drop()
        (rows.write.format("parquet").option("path", out.path).partitionBy(HEAVY)
         .bucketBy(n, *PAIR, SALT).sortBy(*PAIR, SALT).saveAsTable(table))
        return out

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def days(self) -> DataFrame:
        """The fact partitions these events belong to."""
        return self.rows().select(F.col("date").alias(schemas.TARGET_PARTITION_COL))

    def events(self, run_ts: dt.datetime | None = None) -> DataFrame:
        """Rows of the event fact: a scan."""
        return self.rows().select(*EVENT_KEY, "date", "percent_viewed", "duration_viewed",
                                  audit_ts(run_ts).alias("updated_at"),
                                  F.col("date").alias(schemas.TARGET_PARTITION_COL))

    def engagement(self, run_ts: dt.datetime | None = None) -> DataFrame:
        """Rows of the engagement fact: light pairs where they lie, heavy ones put together from their salts."""
        light = engagement_parts(self.rows().where(~F.col(HEAVY))).drop(SALT)
        if self.profile.pairs:
            salted = engagement_parts(self.rows().where(F.col(HEAVY)))
            light = light.unionByName(salted.groupBy(*PAIR, "date").agg(
                *[(F.max if c == "most" else F.sum)(c).alias(c)
                  for c in ("plays", "watched", "watches", "most", "percents", "views")]))
        return engagement_of(light, run_ts)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        session.delete_path(self.spark, self.path)
