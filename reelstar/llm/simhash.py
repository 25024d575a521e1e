"""Near copies by SimHash, found through an index of bytes by position.

A fingerprint is eight bytes. Fingerprints that differ in at most three bits
differ in at most three bytes, so a linked pair has at least five of eight
positional bytes in common, and at least four among the first seven. The
inverted index lists fingerprints under each choice of four of the first seven
positions with the bytes found there. Within a list the positional bytes that
two fingerprints share are tallied; pairs below five are dropped, the rest are
verified by their differing bits.

Lists hold distinct fingerprints only. Within a list, links are reduced to one
edge a member (to the smallest of its group), so no list gives all its pairs. A list too
long for pairwise tallying is split by a fifth shared byte, and if still too
long its members look their neighbours up: every fingerprint within three
bits, by search in the sorted list. That is linear in the list's length.

Groups are then joined across lists by alternating star contraction, in
tables written to the shared folder.

Defined results: a null or wordless text has fingerprint zero and is linked
like any other; fewer words than a shingle make one shingle; repeated rows and
null ids pass through, one row out for each row in (a group of null ids alone
has a null component); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstar.llm.common import durable, small_batches

SEED = 42
SHINGLE = 3
MAX_BITS = 3
#: Bytes that a linked pair shares for certain, of all eight and of the first seven.
SHARED = 8 - MAX_BITS
INDEXED = 7
CHOICES = list(combinations(range(INDEXED), INDEXED - MAX_BITS))
#: Members of a list that are tallied pair by pair.
PAIRWISE = 2000

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)   # by value, high bit first
_WEIGHTS = (1 << np.arange(63, -1, -1, dtype=np.uint64))
_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text, unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    h = np.fromiter(map(_hash, grams), np.uint64)
    by_byte = h.astype(">u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(by_byte[:, p], minlength=256) @ _BITS for p in range(8)])
    return int(_WEIGHTS[2 * ones > len(h)].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(_id, _r, fp)``: a hash of the text to tell rows of one id apart, and
    the fingerprint's bits as a signed long."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))],
                                             ["_id", "_r", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_r"), F.col(text_col).alias("_t"))
            .mapInArrow(run, f"_id {kind}, _r long, fp long"))


def shared_bytes(diff: np.ndarray) -> np.ndarray:
    """Positional bytes in common, from the exclusive or of two fingerprints."""
    return (np.ascontiguousarray(diff).view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)


def linked(a: np.ndarray, b: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    diff = a ^ b
    out = shared_bytes(diff) >= 8 - max_bits
    out[out] = np.bitwise_count(diff[out]) <= max_bits
    return out


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that links (a, b) reach."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while True:
            jump = new[new]
            if (jump == new).all():
                break
            new = jump
        root = new
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def _pairwise(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    left, right = [], []
    for step in range(1, len(fps)):
        hit = np.flatnonzero(linked(fps[:-step], fps[step:], max_bits))
        left.append(hit)
        right.append(hit + step)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _neighbours(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a sorted list by looking up every value within ``max_bits``
    of each member, over the bits in which the list differs at all."""
    varied = int(np.bitwise_or.reduce(fps ^ fps[0]))
    flips = [np.uint64(1 << p) for p in range(64) if varied >> p & 1]
    left, right = [], []
    for k in range(1, max_bits + 1):
        for chosen in combinations(flips, k):
            near = fps ^ np.bitwise_or.reduce(np.array(chosen, np.uint64))
            at = np.minimum(np.searchsorted(fps, near), len(fps) - 1)
            hit = np.flatnonzero((fps[at] == near) & (near > fps))
            left.append(hit)
            right.append(at[hit])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def list_links(fps: np.ndarray, max_bits: int = MAX_BITS, pairwise: int = PAIRWISE) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, smallest of its group) within one list of the index."""
    fps = np.sort(fps)
    if len(fps) <= pairwise:
        a, b = _pairwise(fps, max_bits)
    else:
        varied = np.flatnonzero(np.array([np.bitwise_or.reduce(fps ^ fps[0])]).view(np.uint8))
        found = []
        if len(varied) <= max_bits:                         # five bytes are shared already
            found.append(_neighbours(fps, max_bits))
            varied = varied[:0]
        for p in varied:
            byte = fps.view(np.uint8).reshape(-1, 8)[:, p]
            order = np.argsort(byte, kind="stable")          # within a value, members stay sorted
            for part in np.split(order, np.flatnonzero(np.diff(byte[order])) + 1):
                if len(part) > 1:
                    x, y = (_pairwise if len(part) <= pairwise else _neighbours)(fps[part], max_bits)
                    found.append((part[x], part[y]))
        if not found:
            return fps[:0], fps[:0]
        a, b = (np.concatenate(c) for c in zip(*found, strict=True))
    root = _roots(len(fps), a, b)
    own = np.flatnonzero(root != np.arange(len(fps)))
    return fps[own], fps[root[own]]


def _short_lists(key: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within all lists of sorted (key, fingerprint) rows at once."""
    left, right = [], []
    at = np.arange(len(key))
    for step in range(1, len(key)):
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        if not len(at):
            break
        hit = at[linked(fps[at], fps[at + step], max_bits)]
        left.append(fps[hit + step])
        right.append(fps[hit])
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Edges from rows (key, fp) that arrive sorted by key."""
    short = 64
    held_k, held_f = [], []

    def edges(k: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        sizes = np.diff(np.r_[starts, len(k)])
        few = np.repeat((sizes > 1) & (sizes <= short), sizes)
        found = [_short_lists(k[few], f[few], max_bits)]
        found += [list_links(f[s:s + n], max_bits) for s, n in zip(starts[sizes > short], sizes[sizes > short],
                                                                   strict=True)]
        a, b = (np.concatenate(c) for c in zip(*found, strict=True))
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        k, f = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
        last = int(np.searchsorted(k, k[-1]))               # the last list may go on in the next batch
        if last == 0 and held_k and held_k[0][0] == k[0]:
            held_k.append(k)
            held_f.append(f)
            continue
        done = [np.concatenate([*h, x[:last]]) for h, x in ((held_k, k), (held_f, f))]
        if len(done[0]):
            yield from edges(*done)
        held_k, held_f = [k[last:]], [f[last:]]
    if held_k:
        yield from edges(np.concatenate(held_k), np.concatenate(held_f))


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges ``(a, b)`` between the distinct fingerprints in column ``fp``;
    they join exactly the pairs that a chain of links joins."""
    if max_bits != MAX_BITS:
        raise ValueError(f"the index is laid out for {MAX_BITS} bits")

    def byte(p: int):
        return F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255))

    keys = []
    for n, chosen in enumerate(CHOICES):
        key = F.lit(n).cast("long")
        for p in chosen:
            key = key * 256 + byte(p)
        keys.append(key)
    index = distinct.select(F.explode(F.array(*keys)).alias("key"), "fp")
    return (index.repartition("key").sortWithinPartitions("key")
            .mapInArrow(lambda it: _links(it, max_bits), "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of ``edges`` (a, b): the smallest node of
    its group, by alternating large and small stars until nothing changes."""
    def both(e: DataFrame) -> DataFrame:
        return e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    edges = durable(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "edges")
    before = None
    while True:
        # large star: neighbours above a node move to the smallest around it
        around = both(edges)
        low = durable(around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "low")
        moved = around.filter("b > a").join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = durable(moved.distinct(), "large")
        # small star: what lies below a node is tied to the smallest of it
        low = durable(edges.groupBy("a").agg(F.min("b").alias("m")), "low")
        tied = edges.join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = durable(tied.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "small")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _grouped(docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    fps = durable(fingerprints(docs, shingle, id_col, text_col), "fps")
    distinct = durable(fps.groupBy("fp").agg(F.min("_id").alias("first")), "distinct")
    groups = durable(components(fingerprint_links(distinct.select("fp"), max_bits)), "groups")
    rooted = (distinct.join(groups, distinct["fp"] == groups["node"], "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    rooted = durable(rooted, "rooted")
    least = durable(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    of_fp = durable(rooted.join(least, "root").select("fp", "component_id"), "of-fp")
    return fps.join(of_fp, "fp")


def near_copies(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``(id, fingerprint, component_id)`` for each row of ``docs``."""
    return _grouped(docs, shingle, max_bits, id_col, text_col).select(
        F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group, that of the smallest id (of a
    group of null ids all stay). All columns unchanged."""
    dropped = durable(_grouped(docs, shingle, max_bits, id_col, text_col)
                      .filter(~F.col("_id").eqNullSafe(F.col("component_id")))
                      .select(F.col("_id").alias("_drop_id"), F.col("_r").alias("_drop_r")).distinct(), "dropped")
    same = docs[id_col].eqNullSafe(F.col("_drop_id")) & (F.xxhash64(docs[text_col]) == F.col("_drop_r"))
    return docs.join(dropped, same, "left_anti")
