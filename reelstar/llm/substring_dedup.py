"""Repeated passages found with a compressed FM-index in each shard.

A window is ``WINDOW`` consecutive words of one document; a word goes if a window
over it also starts in a document with a smaller id.

Dealing texts to shards. Each window has a key, the smallest hash among its runs of
``RUN`` words (its minimiser). Equal windows have equal keys, and neighbouring windows
mostly share theirs, so a document falls into segments of windows with one
key. Keys that occur in one document alone can't hold a repeated window and
stop here. Segments of equal words are indexed once, for the smallest document
that has them (pre-aggregation: thousands of copies make one entry). A shard gets
all segments of its keys. Where one key has more than ``HOT`` distinct segments
(a common passage in ever new surroundings), its windows are dealt on by the hash of
their first and last run of words, which equal windows share too.

Searching. A shard's segments form one text, indexed by a suffix array, its
Burrows-Wheeler transform as a wavelet matrix of packed bits with rank
counts, and longest common prefixes. All segments are streamed against it from their
right ends, in step: backward search extends each match by a word as long as
the match occurs in a smaller document than the segment's own (a range minimum over
the suffix array), else the match is cut to its parent interval. The length
reached at a word is its matching statistic; ``WINDOW`` or more reports the window
that starts there. A segment's later holders lose all its windows: they all
start in its first holder.

Reported intervals are joined back to the documents, which drop the words they cover.

Defined results: a null text has no words; documents shorter than a window
lose nothing; repeated rows (one id) don't remove each other and come out once
each; a null id counts as larger than any other; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstar.llm import bytewords
from reelstar.llm.common import durable, small_batches
from reelstar.llm.fm_index import FMIndex

WINDOW = 50
#: Words in the runs whose hashes make keys.
RUN = 10
#: Windows in a segment at most (periodic texts have endless segments).
LONGEST = 64
#: Distinct segments of one key that go to one shard.
HOT = 10_000
#: Segments in a shard, on average.
SHARD = 8_000
NULL_ID = (1 << 63) - 1

_B = 0xD1342543DE82EF95
_B_INV = pow(_B, -1, 1 << 64)
_base = {True: np.ones(1, np.uint64), False: np.ones(1, np.uint64)}


def _powers(n: int, up: bool) -> np.ndarray:
    if len(_base[up]) <= n:
        p = np.full(max(n + 1, 1 << 20), _B if up else _B_INV, np.uint64)
        p[0] = 1
        _base[up] = np.cumprod(p)
    return _base[up]


class Runs:
    """Hashes of any run of words of a block, from prefix sums."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.sums = np.empty(n + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(words * _powers(n, True)[:n], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return bytewords.mix((self.sums[end] - self.sums[start]) * _powers(len(self.sums), False)[start]
                             + (end - start).astype(np.uint64))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (width - size)], x[width - size:]) if width > size else x


def segments(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, run: int = RUN,
             longest: int = LONGEST) -> tuple[np.ndarray, ...]:
    """Segments of a block of texts: text, first window, windows, key, hash of the words."""
    starts, ends, sizes = bytewords.find(data, offsets, bytewords.NOT_SPACE)
    none = np.zeros(0, np.int64)
    if len(starts) < window:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    runs = Runs(bytewords.hashes(data, starts, ends))
    at = np.arange(len(starts) - run + 1)
    low = _sliding_min(runs(at, at + run), window - run + 1)          # by first word of the window
    text = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    own = text[:len(low)]
    ok = np.flatnonzero(own == text[window - 1:window - 1 + len(low)])  # windows that lie in one text
    if not len(ok):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    key, doc = low[ok], own[ok]
    new = np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]
    since = np.arange(len(ok)) - np.maximum.accumulate(np.where(new, np.arange(len(ok)), 0))
    cut = np.flatnonzero(since % longest == 0)
    count = np.diff(np.r_[cut, len(ok)])
    s = ok[cut]
    return doc[cut], s - first[doc[cut]], count, key[cut], runs(s, s + count + window - 1)


def shard_hits(parts: list[bytes], owner: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """For each part (words joined by a space) the windows, by first word, that
    start in a part of a smaller owner."""
    words = [p.split(b" ") for p in parts]
    size = np.fromiter(map(len, words), np.int64, len(words))
    codes = pd.factorize(np.array([w for p in words for w in p], object))[0] + 1
    # a 0 ends each part
    end = np.cumsum(size + 1) - 1
    start = end - size
    text = np.zeros(int(end[-1]) + 1, np.int64)
    body = np.ones(len(text), bool)
    body[end] = False
    text[body] = codes
    rank = np.unique(owner, return_inverse=True)[1]
    index = FMIndex(text, np.repeat(rank, size + 1), int(size.max()))
    statistic = index.matching_statistics(text, start, end, rank)
    return [np.flatnonzero(statistic[s:e] >= window) for s, e in zip(start, end, strict=True)]


def _intervals(first: np.ndarray) -> list[int]:
    """Rising places as a flat list of (first, count)."""
    if not len(first):
        return []
    new = np.flatnonzero(np.r_[True, np.diff(first) > 1])
    return np.c_[first[new], np.diff(np.r_[new, len(first)])].ravel().tolist()


def _find_segments(docs: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = (batch.column(i).to_numpy() for i in (0, 1))
            for a, _, data, offsets in bytewords.texts(batch.column(2)):
                doc, s, n, key, words = segments(data, offsets, window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a + doc]), pa.array(rows[a + doc]), pa.array(s.astype(np.int32)), pa.array(n.astype(np.int32)),
                     pa.array(key.view(np.int64)), pa.array(words.view(np.int64))], ["_d", "_r", "s", "n", "key", "words"])

    return docs.mapInArrow(run, "_d long, _r long, s int, n int, key long, words long")


def _ship(owners: DataFrame, docs: DataFrame, window: int, shards: int) -> DataFrame:
    """The words of each distinct segment, once, with the shard it goes to. A
    key with ``split`` parts is dealt on by window, as runs of windows of one part."""
    wanted = (owners.groupBy("_d", "_r")
              .agg(F.collect_list(F.struct("s", "n", "key", "words", "split")).alias("_segments")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for d, t, segs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(),
                                  strict=True):
                words = t.encode("utf-8", "surrogatepass").split()
                hashed = None
                for g in segs:
                    s, n, key, split = g["s"], g["n"], g["key"], g["split"]
                    if split <= 1:
                        pieces = [(s, n, 0)]
                    else:
                        if hashed is None:
                            hashed = Runs(bytewords.hash_words([w.decode("utf-8", "surrogatepass") for w in words]))
                        at = np.arange(s, s + n)
                        # by all words of a window: templates with equal edges are spread by what is between
                        part = (bytewords.mix(hashed(at, at + window)) % np.uint64(split)).astype(np.int64)
                        new = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
                        pieces = [(s + int(b), int(e - b), int(part[b])) for b, e in zip(new, np.r_[new[1:], n], strict=True)]
                    for b, count, part in pieces:
                        out.append((d, key, g["words"], b - s, count, (hash((key, part)) & 0x7FFFFFFF) % shards,
                                    b" ".join(words[b:b + count + window - 1])))
            if out:
                cols = list(zip(*out, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                                 ["_d", "key", "words", "at", "n", "shard", "body"])

    return (docs.join(wanted, ["_d", "_r"]).select("_d", "_t", "_segments")
            .mapInArrow(run, "_d long, key long, words long, at int, n int, shard int, body binary"))


def _search(shipped: DataFrame, window: int) -> DataFrame:
    """Windows of each distinct segment that start in a smaller document, by shard."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        hits = shard_hits(pdf["body"].tolist(), pdf["_d"].to_numpy(), window)
        found = [_intervals(h + a) for h, a in zip(hits, pdf["at"], strict=True)]
        return pd.DataFrame({"key": pdf["key"], "words": pdf["words"], "_o": pdf["_d"], "hits": found})

    return shipped.groupBy("shard").applyInPandas(run, "key long, words long, _o long, hits array<long>")


def repeated_intervals(docs: DataFrame, window: int = WINDOW, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """``(_d, _r, spans)``: flat lists of (first window, windows) to remove, for
    each document that has any. ``docs`` has ids, row hashes and texts in _d, _r, _t."""
    found = durable(_find_segments(docs, window), "segments")
    keys = durable(found.groupBy("key").agg(F.min("_d").alias("lo"), F.max("_d").alias("hi"))
                   .filter("lo < hi").select("key"), "keys")
    shared = durable(found.join(keys, "key", "left_semi"), "shared")
    first = F.min(F.struct("_d", "_r", "s", "n")).alias("o")
    owners = durable(shared.groupBy("key", "words").agg(first).select("key", "words", "o.*"), "owners")
    total = owners.count()
    # keys with more than ``hot`` segments: at most total / hot of them
    many = owners.groupBy("key").count().filter(F.col("count") > hot).select(
        "key", F.ceil(F.col("count") / hot).cast("int").alias("split"))
    many = durable(many, "many")
    if many.count() <= 100_000:
        many = F.broadcast(many)
    dealt = owners.join(many, "key", "left").withColumn("split", F.coalesce("split", F.lit(1)))
    shipped = _ship(dealt, docs, window, max(1, -(-total // shard)))
    searched = durable(_search(shipped, window), "hits")
    results = durable(searched.groupBy("key", "words").agg(F.min("_o").alias("_o"), F.flatten(F.collect_list("hits")).alias("hits")),
                      "results")
    # the first holder loses what starts before it, later ones the whole segment
    spans = F.when(F.col("_d") > F.col("_o"), F.array(F.lit(0).cast("long"), F.col("n").cast("long"))).otherwise(F.col("hits"))
    rows = (shared.join(results, ["key", "words"]).withColumn("hits", spans).filter(F.size("hits") > 0)
            .select("_d", "_r", F.col("s").cast("long").alias("s"), "hits").distinct())
    return rows.groupBy("_d", "_r").agg(F.collect_list(F.struct("s", "hits")).alias("spans"))


def _covered(n_words: int, spans: list[dict], window: int) -> np.ndarray:
    """True for each word that a removed window covers."""
    change = np.zeros(n_words + 1, np.int64)
    for span in spans or ():
        s, h = span["s"], span["hits"]
        for first, count in zip(h[::2], h[1::2], strict=True):
            change[s + first] += 1
            change[s + first + count + window - 1] -= 1
    return np.cumsum(change[:-1]) > 0


def deduplicate(docs: DataFrame, window: int = WINDOW, hot: int = HOT, shard: int = SHARD, id_col: str = "doc_id",
                text_col: str = "text", with_text: bool = False) -> DataFrame:
    """``(id, n_words, n_removed, kept_sha256)`` for each row of ``docs``, with
    the kept words as ``text`` on request."""
    if window < 2 * RUN:
        raise ValueError(f"a window holds two runs of {RUN} words at least")
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("_d"),
                        F.xxhash64(text).alias("_r"), text.alias("_t"))
    spans = durable(repeated_intervals(keyed, window, hot, shard), "spans")
    schema = "_d long, n_words long, n_removed long, kept_sha256 string" + (", text string" if with_text else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = t.encode("utf-8", "surrogatepass").split()
                n = len(words)
                if s:
                    words = [words[i] for i in np.flatnonzero(~_covered(n, s, window))]
                kept = b" ".join(words)
                out.append((n, n - len(words), hashlib.sha256(kept).hexdigest(), kept))
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            arrays = [batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())]
            if with_text:
                arrays.append(pa.array([k.decode("utf-8", "replace") for k in cols[3]], pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in schema.split(", ")])

    done = keyed.join(spans, ["_d", "_r"], "left").select("_d", "_t", "spans").mapInArrow(run, schema)
    rest = [c.split()[0] for c in schema.split(", ")[1:]]
    return done.select(F.when(F.col("_d") != NULL_ID, F.col("_d")).alias(id_col), *rest)
