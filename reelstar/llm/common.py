"""Helpers shared by the text operators."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar.session import checkpoint_dir, scratch_path

#: ASCII white space: space, tab, line feed, vertical tab, form feed, return.
SPACE_SET = r"[\x20\x09-\x0D]+"

_UNICODE_ONLY = re.compile("[\x1c-\x1f\x85\xa0  -     　]")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that jobs run
    wherever it is installed on the driver alone. The archive goes to the
    shared folder, from where Spark hands it out."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    path = f"{scratch_path(spark, 'package')}/reelstar_package.zip"
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    out.write(archive.getvalue())
    out.close()
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage and survives the loss of executors; the folder is the
    one the cluster names in ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint`` usable with the cluster's folder."""
    path = checkpoint_dir(spark)
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def held_out(doc_id: Column) -> Column:
    """The evaluation fold: crc32 of the id as text, a multiple of five."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def ascii_words(text: str | None) -> list[str]:
    """Words between runs of ASCII white space, unchanged."""
    if not text:
        return []
    if _UNICODE_ONLY.search(text) is None:
        return text.split()
    # str.split would also cut at Unicode spaces; bytes cut at ASCII ones only
    return [w.decode("utf-8", "surrogatepass")
            for w in text.encode("utf-8", "surrogatepass").split()]


def blocks(texts: list[str | None], chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``chars`` characters (one text at least)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Texts travel to Python in batches of at most ``rows`` rows, so that a
    batch of long documents stays within a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of at most ``rows`` rows for the jobs that run inside; the
    session's own setting comes back afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def spread_join(rows: DataFrame, table: DataFrame, key: str, size: int, large: Column,
                bound: int = 100_000) -> DataFrame:
    """``rows`` joined to a table of ``size`` rows that has every ``key`` once or a few times.

    Up to ``bound`` rows it is broadcast. Beyond it only its ``large`` keys
    are, which the caller bounds by their share of all rows; the rest is
    shuffled, and no key of the rest is large.
    """
    if size <= bound:
        return rows.join(F.broadcast(table), key)
    hot = F.broadcast(table.filter(large))
    cold = rows.join(F.broadcast(table.filter(large).select(key).distinct()), key, "left_anti")
    return rows.join(hot, key).unionByName(cold.join(table.filter(~large), key))


def ragged_gather(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenation of ``flat[s:s + n]`` for each (s, n), without a loop."""
    total = int(lens.sum())
    if total == 0:
        return flat[:0]
    ends = np.cumsum(lens)
    return flat[np.repeat(starts - (ends - lens), lens) + np.arange(total)]


class Interner(dict):
    """Maps a key to the next free slot; new keys queue up in ``fresh``."""

    def __init__(self):
        super().__init__()
        self.fresh: list = []

    def __missing__(self, key):
        slot = self[key] = len(self)
        self.fresh.append(key)
        return slot

    def slots(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))

    def take_fresh(self) -> list:
        out, self.fresh = self.fresh, []
        return out
