"""Benchmark passages in documents, found by latent semantic retrieval.

Items are cut into passages of at most ``PASSAGE`` words, documents into
overlapping windows of twice ``HALF`` words and their halves. Both are TF-IDF vectors over the words
of the items; document frequencies are counted over all documents, and words
in more than ``COMMON`` of them are left out, but for the ``KEPT`` rarest of each
passage (a passage that leaked into many documents has no rarer ones). A
randomised singular value decomposition, fitted on the items and all windows of all documents,
gives the latent space. All it needs of the windows is how heavily each two words stand in
one of them: these sums are taken over every window, put together by Spark and kept in a
shared table, which the words of the items bound whatever the number of documents. Each round multiplies it
by a block of vectors; a task has whole rows of the product, so none reaches the driver twice.
Every window of every document is then searched. The final check is over the
region of a window (four halves), so a passage is left out for a region that holds too
little weight in its words for any common subsequence to pass (an exact consequence
of the check, summed up by an inverted index of the passages' words). For the rest, all
windows and halves inside the region are projected and compared with the passage by cosine.

A candidate pair is checked on the words themselves: the weighted longest common
subsequence of passage and window, and the answer check, the share of the
passage's ``ANSWER`` rarest words that occur there. Verbatim passages pass the
first alone; paraphrases have to pass both. A few words stand in common order in many
clean regions, so passages of fewer than ``SHORT`` words match only where all their words
stand in a row, whatever the cosine, and those of fewer than ``TIGHT`` words are checked in
stretches of twice their length.

Items are handled in blocks of about ``ITEMS``, so what is broadcast or held by the
driver (a vector of the latent space for each word of a block's items) has a
bound whatever the size of the benchmark. Items of fewer than ``LEAST`` words find nothing:
that a text holds one word tells nothing. ``left_out`` lists them. A word is a run of
letters, digits and underscores; in scripts written without spaces (Han, kana, Thai, Lao, Khmer,
Myanmar) each character is one.

Defined results: one row for each pair of a document and an item that pass, with
the best match; null and empty texts match nothing; repeated rows give one
pair; null document ids are kept as an id of their own; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from reelstar.llm import bytewords
from reelstar.llm.common import arrow_batches, durable, ragged_gather, small_batches

ITEMS = 500
PASSAGE = 60
HALF = 32
RANK = 256
OVERSAMPLE = 16
ROUNDS = 2
#: Tasks that the sums are dealt to, by stripes of as many words.
SHARDS, STRIPE = 8, 128
#: Sums are whole numbers of this part of a weight, so no order of adding changes them.
UNIT = 2.0 ** -30
COSINE = 0.25
#: Share of documents beyond which a word tells nothing, and the words of a passage that count in any case.
COMMON, KEPT = 0.02, 10
#: Least share of a passage's weight in common order, with and without the answer check.
LCS, VERBATIM = 0.6, 0.85
ANSWER, ANSWER_SHARE = 5, 0.4
#: Passages of fewer words are checked in stretches of twice their words, and have to stand in a row;
#: items of fewer words than ``LEAST`` tell nothing.
TIGHT, SHORT, LEAST = 12, 4, 2
#: Slack for sums in another order.
EPS = 1e-9
#: Windows projected at a time, and entries of the inverted index (or pairs of words) added up at a time.
GROUP, LISTED = 2_000, 1_000_000

def words(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores, and of all characters outside ASCII; characters
    of scripts written without spaces are words each."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    data = bytewords.lower(raw)
    starts, ends, _ = bytewords.find(data, np.array([0, len(data)]), bytewords.ALNUM, True)
    return [data[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(starts, ends, strict=True)]


def cut(found: list[str], size: int = PASSAGE) -> list[list[str]]:
    """Even parts of at most ``size`` words."""
    n = -(-len(found) // size)
    return [found[len(found) * i // n:len(found) * (i + 1) // n] for i in range(n)]


def ids_of(data: np.ndarray, offsets: np.ndarray, lookup: bytewords.Lookup) -> tuple[np.ndarray, np.ndarray]:
    """Places of all words of a block of texts (-1: not in the vocabulary), and their number in each text."""
    data = bytewords.lower(data)
    starts, ends, sizes = bytewords.find(data, offsets, bytewords.ALNUM, True)
    return lookup(bytewords.hashes(data, starts, ends)), sizes


def tfidf(ids: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, count = np.unique(ids[ids >= 0], return_counts=True)
    return at, (1 + np.log(count)) * idf[at]


def weighted_lcs(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> float:
    """Largest weight of a common subsequence; ``weight`` is by place."""
    best = np.zeros(len(b) + 1)
    for x in a:
        new = best.copy()
        hit = np.flatnonzero(b == x)
        new[hit + 1] = np.maximum(new[hit + 1], best[hit] + weight[x])
        best = np.maximum.accumulate(new)
    return float(best[-1])


@dataclass
class Passages:
    item: list
    ids: list[np.ndarray]
    mass: np.ndarray
    latent: np.ndarray
    rare: list[np.ndarray]
    idf: np.ndarray
    basis: np.ndarray
    weights: list[dict[int, float]]
    lookup: bytewords.Lookup
    #: By word: the passages that hold it, and its weight in each; ``listed`` has the lists' ends.
    listed: np.ndarray
    holder: np.ndarray
    held: np.ndarray
    size: np.ndarray
    short: np.ndarray
    #: For short passages, by length: tables of their beginnings of 2, 3 ... words, and the passages of each row.
    rows: list[tuple[list[np.ndarray], list[list[int]]]]


def _frequencies(docs: DataFrame, vocabulary: list[str]) -> tuple[int, np.ndarray]:
    lookup, size = bytewords.Lookup(vocabulary), len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(size, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, _, data, offsets in bytewords.texts(batch.column(0)):
                ids, sizes = ids_of(data, offsets, lookup)
                known = np.flatnonzero(ids >= 0)
                doc = np.repeat(np.arange(len(sizes)), sizes)[known]
                df += np.bincount(np.unique(doc * size + ids[known]) % size, minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at]), pa.array(np.r_[n, df[at]])], ["term", "df"])

    df, n = np.zeros(size, np.int64), 0
    for r in (docs.select("_t").mapInArrow(run, "term long, df long").groupBy("term")
              .agg(F.sum("df").alias("df")).collect()):
        if r.term < 0:
            n = r.df
        else:
            df[r.term] = r.df
    return n, df


def window_vectors(ids: np.ndarray, sizes: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, ...]:
    """The windows of a block of texts that hold a word of the vocabulary: text and first word of
    each, where its words begin, and the words, ascending, with the weights of its unit vector."""
    halves = np.maximum(-(-sizes // HALF), 1)
    first = np.cumsum(halves) - halves
    start = np.cumsum(sizes) - sizes
    own = np.repeat(np.arange(len(sizes)), sizes)
    known = np.flatnonzero(ids >= 0)
    text, term = own[known], ids[known]
    half = first[text] + (known - start[text]) // HALF
    # a window is two halves that follow each other in one text, or a text's only one
    here = (half < (first + halves - 1)[text]) | (halves[text] == 1)
    before = half > first[text]
    cell, count = np.unique(np.r_[half[here], half[before] - 1] * len(idf) + np.r_[term[here], term[before]],
                            return_counts=True)
    window, term = cell // len(idf), cell % len(idf)
    at = np.flatnonzero(np.r_[True, window[1:] != window[:-1]][:len(window)])
    weight = (1 + np.log(count)) * idf[term]
    if len(at):
        weight /= np.repeat(np.sqrt(np.add.reduceat(weight * weight, at)), np.diff(np.r_[at, len(window)]))
    text = np.repeat(np.arange(len(sizes)), halves)[window[at]]
    return text, (window[at] - first[text]) * HALF, np.r_[at, len(window)], term, weight


def _windows(docs: DataFrame, lookup: bytewords.Lookup, idf: np.ndarray) -> DataFrame:
    """All windows as sparse unit vectors, with a hash of their text and their place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashed = batch.column(1).to_numpy()
            for a, _, data, offsets in bytewords.texts(batch.column(0)):
                text, place, at, term, weight = window_vectors(*ids_of(data, offsets, lookup), idf)
                at = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashed[a + text]), pa.array(place), pa.ListArray.from_arrays(at, pa.array(term)),
                     pa.ListArray.from_arrays(at, pa.array(weight))], ["text", "place", "terms", "weights"])

    return (docs.select("_t", F.xxhash64("_t").alias("_h"))
            .mapInArrow(run, "text long, place long, terms array<long>, weights array<double>"))


def _sample(docs: DataFrame, n_docs: int, lookup: bytewords.Lookup, idf: np.ndarray, limit: int) -> DataFrame:
    """For a look at windows; nothing is fitted on it. The ``limit`` least by the hash of (text, place),
    whatever the order of rows, out of documents chosen by a hash of their text."""
    share = max(1, n_docs // max(1, limit // 8))             # about eight windows a document
    windows = _windows(docs.filter(F.pmod(F.xxhash64("_t"), F.lit(share)) == 0), lookup, idf)
    # equal texts have equal windows; the tie between them leaves no trace
    least = windows.orderBy(F.xxhash64("text", "place"), "text", "place").limit(limit)
    return durable(least.select("terms", "weights").repartition(SHARDS), "windows")


def _pairs(size: int, at: np.ndarray, term: np.ndarray, weight: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of words of one window, as ``a * size + b`` with a up to b, and the sums of the products of their
    weights in ``UNIT``s; about ``LISTED`` pairs at a time."""
    lens = np.repeat(at[1:], np.diff(at)) - np.arange(len(term))
    total = np.cumsum(lens)
    begin = 0
    while begin < len(term):
        stop = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + LISTED, "right")))
        one = np.repeat(np.arange(begin, stop), lens[begin:stop])
        two = ragged_gather(np.arange(len(term)), np.arange(begin, stop), lens[begin:stop])
        yield _summed(term[one] * size + term[two], np.rint(weight[one] * weight[two] / UNIT).astype(np.int64))
        begin = stop


def together(docs: DataFrame, lookup: bytewords.Lookup, idf: np.ndarray) -> DataFrame:
    """``(a, b, weight)``: for each two words (a up to b) the sum over all windows of all
    documents of the product of their weights, in ``UNIT``s; the upper half of A'A, A being the windows."""
    size = len(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(key // size), pa.array(key % size), pa.array(weight)],
                                              ["a", "b", "weight"])

        key, weight = none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for _, _, data, offsets in bytewords.texts(batch.column(0)):
                _, _, at, term, weights = window_vectors(*ids_of(data, offsets, lookup), idf)
                parts = list(_pairs(size, at, term, weights))
                key, weight = _summed(np.concatenate([key, *(k for k, _ in parts)]),
                                      np.concatenate([weight, *(w for _, w in parts)]))
                if len(key) > LISTED:
                    yield out()
                    key, weight = none
        yield out()

    sums = (docs.select("_t").mapInArrow(run, "a long, b long, weight long").groupBy("a", "b")
            .agg(F.sum("weight").alias("weight")))
    # a stripe of words lies in one task
    return durable(sums.repartition(SHARDS, F.floor(F.col("a") / STRIPE)).sortWithinPartitions("a", "b"), "together")


def both_halves(sums: DataFrame) -> DataFrame:
    """The sums of ``together`` under (b, a) too, the words of a stripe again in one task."""
    other = sums.filter("a != b").select(F.col("b").alias("a"), F.col("a").alias("b"), "weight")
    return durable(sums.unionByName(other).repartition(SHARDS, F.floor(F.col("a") / STRIPE))
                   .sortWithinPartitions("a", "b"), "halves")


def _product(sums: DataFrame, block: np.ndarray, both: bool = False) -> np.ndarray:
    """A'(A block), A being the windows whose sums are given (``both``: under (b, a) too). A task has all sums
    of its stripes, so the driver gets each row of the product once, by stripes, and no partial products."""
    rows = sums if both else both_halves(sums)
    shared = sums.sparkSession.sparkContext.broadcast(block)
    size, width = block.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = shared.value
        at, part = -1, np.zeros((0, width))
        for batch in batches:
            a, b, weight = (c.to_numpy() for c in batch.columns)
            for stripe in np.unique(a // STRIPE).tolist():
                some = a // STRIPE == stripe
                low = stripe * STRIPE
                dense = np.zeros((min(STRIPE, size - low), size))
                dense[a[some] - low, b[some]] = weight[some] * UNIT
                if stripe != at:
                    if at >= 0:
                        yield out(at, part)
                    at, part = stripe, np.zeros((len(dense), width))
                part += dense @ x
        if at >= 0:
            yield out(at, part)

    def out(stripe: int, part: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([stripe]), pa.array([part.tobytes()], pa.binary())], ["stripe", "part"])

    total = np.zeros_like(block)
    with arrow_batches(sums.sparkSession, LISTED):
        for r in rows.coalesce(SHARDS).mapInArrow(run, "stripe long, part binary").toLocalIterator():
            part = np.frombuffer(r.part).reshape(-1, width)
            total[r.stripe * STRIPE:r.stripe * STRIPE + len(part)] += part
    shared.destroy()                                          # else the driver keeps every round's block
    return total


def latent_basis(sums: DataFrame, own: np.ndarray, rank: int = RANK, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """Right singular vectors of all documents' windows (by ``together``) over the passages' vectors
    (rows of ``own``). The passages together weigh as much as the windows, so
    that the space holds what tells them apart."""
    n_terms = own.shape[1]
    # a window's vector has length one, so the diagonal adds up to the number of windows
    n_windows = round((sums.filter("a = b").agg(F.sum(F.col("weight") * F.lit(UNIT))).first()[0] or 0.0))
    share = max(1, n_windows) / len(own)
    width = min(rank + OVERSAMPLE, n_terms)
    rows = both_halves(sums)

    def multiplied(q: np.ndarray) -> np.ndarray:
        total = _product(rows, q, both=True)
        total += own.T @ (share * (own @ q))
        return total

    q = np.random.default_rng(seed).standard_normal((n_terms, width))
    for _ in range(rounds):
        q = np.linalg.qr(multiplied(q))[0]
    small = q.T @ multiplied(q)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return q @ vectors[:, np.argsort(-values)[:min(rank, width)]]


def _rows(ids: list[np.ndarray], short: list[int], n_terms: int) -> list[tuple[list[np.ndarray], list[list[int]]]]:
    """Short passages by length, as ``in_rows`` looks them up. All their words are in the vocabulary."""
    out = []
    for size in range(LEAST, SHORT):
        if own := [k for k in short if len(ids[k]) == size]:
            found = np.array([ids[k] for k in own])
            tables, state = [], found[:, 0]
            for j in range(1, size):
                table, state = np.unique(state * n_terms + found[:, j], return_inverse=True)
                tables.append(table)
            holders: list[list[int]] = [[] for _ in tables[-1]]
            for k, s in zip(own, state.tolist(), strict=True):
                holders[s].append(k)
            out.append((tables, holders))
    return out


def in_rows(p: Passages, ids: np.ndarray, own: np.ndarray) -> list[tuple[int, int]]:
    """``(place, passage)``: the first place in each text where all words of a short passage stand in a row."""
    out = []
    for tables, holders in p.rows:
        last = len(ids) - len(tables)
        at = np.flatnonzero((ids[:max(last, 0)] >= 0) & (own[:max(last, 0)] == own[len(tables):]))
        state = ids[at]
        for j, table in enumerate(tables, 1):
            key = state * len(p.idf) + ids[at + j]
            spot = np.minimum(np.searchsorted(table, key), len(table) - 1)
            hit = (ids[at + j] >= 0) & (table[spot] == key)
            at, state = at[hit], spot[hit]
        _, one = np.unique(own[at] * len(holders) + state, return_index=True)
        out += [(int(at[i]), k) for i in one.tolist() for k in holders[state[i]]]
    return out


def fit(docs: DataFrame, items: list[tuple[object, str]], rank: int = RANK) -> Passages | None:
    """The passages of a block of items in the latent space; ``docs`` has texts in ``_t``."""
    parts = [(i, p) for i, t in items if len(found := words(t)) >= LEAST for p in cut(found)]
    if not parts:
        return None
    every = sorted({w for _, p in parts for w in p})
    n, df = _frequencies(docs, every)
    df_of = dict(zip(every, df.tolist(), strict=True))
    kept = {w for w in every if df_of[w] <= COMMON * n}
    for _, p in parts:
        kept.update(sorted(set(p), key=lambda w: (df_of[w], w))[:KEPT])
    vocabulary = {w: k for k, w in enumerate(sorted(kept))}
    lookup = bytewords.Lookup(list(vocabulary))
    idf = np.log((1 + n) / (1 + np.array([df_of[w] for w in vocabulary]))) + 0.05
    ids = [np.array([vocabulary[w] for w in p if w in vocabulary], np.int64) for _, p in parts]
    own = np.zeros((len(parts), len(vocabulary)))
    for row, x in zip(own, ids, strict=True):
        at, w = tfidf(x, idf)
        row[at] = w / np.sqrt(w @ w)
    basis = latent_basis(together(docs, lookup, idf), own, rank)
    latent = own @ basis
    latent = (latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    weights = [{int(t): float(c * idf[t]) for t, c in zip(*np.unique(x, return_counts=True), strict=True)} for x in ids]
    rare = [np.array(sorted(set(x.tolist()), key=lambda t: (-idf[t], t))[:ANSWER]) for x in ids]
    size = np.array([len(p) for _, p in parts])
    short = size < SHORT
    entries = sorted((t, k, w) for k, x in enumerate(weights) if not short[k] for t, w in x.items())
    listed = np.r_[0, np.cumsum(np.bincount([t for t, _, _ in entries], minlength=len(idf)))].astype(np.int64)
    return Passages([i for i, _ in parts], ids, np.array([idf[x].sum() for x in ids]), latent, rare, idf,
                    basis.astype(np.float32), weights, lookup, listed,
                    np.array([k for _, k, _ in entries], np.int64), np.array([w for _, _, w in entries]),
                    size, short, _rows(ids, np.flatnonzero(short).tolist(), len(idf)))


def check(p: Passages, k: int, region: np.ndarray) -> tuple[float, float]:
    """Share of passage k's weight in common order with a region (-1: words outside the vocabulary), and of its
    rarest words there; for a passage of fewer than TIGHT words, with the best stretch of the region."""
    own = p.weights[k]
    most = LCS * p.mass[k] * (1 - EPS)

    def of(words_there: np.ndarray) -> tuple[float, float]:
        if sum(own.get(t, 0.0) for t in set(words_there.tolist())) < most:      # no subsequence can weigh more
            return 0.0, 0.0
        return weighted_lcs(p.ids[k], words_there, p.idf) / p.mass[k], float(np.isin(p.rare[k], words_there).mean())

    if p.size[k] >= TIGHT:
        return of(region[region >= 0])
    hits = np.flatnonzero(np.isin(region, p.ids[k]))
    found = [of(x[x >= 0]) for x in (region[a:a + 2 * p.size[k]] for a in hits)]
    return max(found, key=lambda m: (passes(*m), m), default=(0.0, 0.0))


def passes(lcs: float, answer: float) -> bool:
    return lcs >= VERBATIM or lcs >= LCS and answer >= ANSWER_SHARE


def _summed(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each one's weights."""
    if not len(key):
        return key, weight
    order = np.argsort(key)
    key, weight = key[order], weight[order]
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[at], np.add.reduceat(weight, at)


def reachable(p: Passages, at_half: np.ndarray, term: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(region, passage)`` pairs whose common words weigh enough for the final check.

    ``at_half`` and ``term`` are the distinct words of each half, in order of halves; ``first``
    and ``end`` are the halves of each half's text. Region r has the halves r - 1 to r + 2. No common
    subsequence weighs more than the sum over its halves of the passage's words there."""
    size = len(p.mass)
    lens = p.listed[term + 1] - p.listed[term]
    total = np.cumsum(lens)
    regions, passages = [], []
    # slices of whole texts of about LISTED list entries
    begin = 0
    while begin < len(at_half):
        done = total[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(total, done + LISTED, "right")))
        if stop < len(at_half):
            whole = int(np.searchsorted(at_half, first[at_half[stop]]))
            stop = whole if whole > begin else int(np.searchsorted(at_half, end[at_half[begin]]))
        h, t, c = at_half[begin:stop], term[begin:stop], lens[begin:stop]
        begin = stop
        key, weight = _summed(np.repeat(h, c) * size + ragged_gather(p.holder, p.listed[t], c),
                              ragged_gather(p.held, p.listed[t], c))
        k = key % size
        # a region of four halves needs one with a quarter of the weight
        some = key[weight >= LCS / 4 * p.mass[k] * (1 - EPS)]
        if not len(some):
            continue
        # regions stay inside the text of the half that proposes them
        by = np.tile(some // size, 4)
        cand = np.concatenate([some + d * size for d in (-2, -1, 0, 1)])
        cand = np.unique(cand[(cand // size >= first[by]) & (cand // size < end[by])])
        r, q = cand // size, cand % size
        sums = np.zeros(len(cand))
        for d in (-1, 0, 1, 2):
            want = cand + d * size
            spot = np.minimum(np.searchsorted(key, want), len(key) - 1)
            sums += np.where((key[spot] == want) & (r + d >= first[r]) & (r + d < end[r]), weight[spot], 0.0)
        enough = sums >= LCS * p.mass[q] * (1 - EPS)
        regions.append(r[enough])
        passages.append(q[enough])
    if not regions:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(regions), np.concatenate(passages)


def match(p: Passages, data: np.ndarray, offsets: np.ndarray, cosine: float = COSINE) -> list[tuple[int, int, float, float, float, int]]:
    """``(text, passage, cosine, lcs, answer, first word of the window)`` for each match."""
    ids, sizes = ids_of(data, offsets, p.lookup)
    if not len(ids):
        return []
    # half windows: a window is two that follow each other in one text
    halves = np.maximum(-(-sizes // HALF), 1)
    first_half = np.cumsum(halves) - halves
    start = np.cumsum(sizes) - sizes
    own = np.repeat(np.arange(len(sizes)), sizes)
    half = first_half[own] + (np.arange(len(ids)) - start[own]) // HALF
    known = np.flatnonzero(ids >= 0)
    cell, count = np.unique(half[known] * len(p.idf) + ids[known], return_counts=True)
    at_half, term = cell // len(p.idf), cell % len(p.idf)
    text = np.repeat(np.arange(len(sizes)), halves)
    n = len(text)
    first, end = first_half[text], (first_half + halves)[text]
    region, passage = reachable(p, at_half, term, first, end)
    stand = in_rows(p, ids, own)
    region = np.r_[region, half[np.array([i for i, _ in stand], np.int64)]]
    passage = np.r_[passage, np.array([k for _, k in stand], np.int64)]
    if not len(region):
        return []
    # a region's windows begin at its first three halves; halves are searched alone, too, for short passages
    pair = np.tile(np.arange(len(region)), 7)
    window = np.concatenate([region + d for d in (-1, 0, 1, -1, 0, 1, 2)])
    inside = (window >= first[region[pair]]) & (window < end[region[pair]])
    # a row stands in the window of the half in which it begins
    inside &= ~p.short[passage[pair]] | (np.arange(len(pair)) // len(region) == 1)
    window += np.repeat([0, n], [3 * len(region), 4 * len(region)])
    pair, window = pair[inside], window[inside]
    order = np.argsort(window, kind="stable")
    pair, window = pair[order], window[order]
    searched = np.zeros(2 * n, bool)
    searched[window] = True
    # each word stands in its half, in the window that begins there and in the one before
    earlier = at_half > first[at_half]
    place = np.r_[at_half, at_half[earlier] - 1, n + at_half]
    term, count = np.r_[term, term[earlier], term], np.r_[count, count[earlier], count]
    keep = searched[place]
    cell, count = _summed(place[keep] * len(p.idf) + term[keep], count[keep])
    place, term = cell // len(p.idf), cell % len(p.idf)
    weight = ((1 + np.log(count)) * p.idf[term]).astype(np.float32)
    at = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    filled = place[at]
    cos = np.full(len(pair), -1.0, np.float32)
    for g in range(0, len(at), GROUP):
        lo, hi = at[g], at[g + GROUP] if g + GROUP < len(at) else len(place)
        x = np.add.reduceat(p.basis[term[lo:hi]] * weight[lo:hi, None], at[g:g + GROUP] - lo, axis=0)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        a, b = np.searchsorted(window, [filled[g], filled[min(g + GROUP, len(at)) - 1] + 1])
        for c in range(a, b, 10 * GROUP):
            d = min(b, c + 10 * GROUP)
            row = np.searchsorted(filled, window[c:d]) - g
            row = np.minimum(row, len(x) - 1)
            has = filled[g + row] == window[c:d]
            cos[c:d] = np.where(has, np.einsum("ij,ij->i", x[row], p.latent[passage[pair[c:d]]]), -1.0)
    # the nearest window of each region
    order = np.lexsort((window, -cos, pair))
    order = order[np.r_[True, pair[order][1:] != pair[order][:-1]]]
    out: dict[tuple[int, int], tuple] = {}
    for j in order[(cos[order] >= cosine) | p.short[passage[pair[order]]]]:
        r, k = int(region[pair[j]]), int(passage[pair[j]])
        t = int(text[r])
        a = start[t] + (r - first_half[t]) * HALF
        words_there = ids[max(start[t], a - HALF):min(a + 3 * HALF, start[t] + sizes[t])]
        lcs, answer = (1.0, 1.0) if p.short[k] else check(p, k, words_there)
        if passes(lcs, answer) and (lcs, cos[j]) > out.get((t, k), (0, 0, 0.0, 0.0))[3:1:-1]:
            out[t, k] = (t, k, float(cos[j]), lcs, answer, int((window[j] % n - first_half[t]) * HALF))
    return list(out.values())


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", items: int = ITEMS,
                 cosine: float = COSINE) -> DataFrame:
    """``(id, item, cosine, lcs, answer, window_start)`` for each contaminated pair."""
    spark = docs.sparkSession
    small_batches(spark)
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    schema = f"_id {kind}, _item {item_kind}, cosine double, lcs double, answer double, window_start long"
    names = ["_id", "_item", "cosine", "lcs", "answer", "window_start"]
    item_type = to_arrow_type(benchmark.schema[item_col].dataType)
    found = spark.createDataFrame([], schema)
    stored = benchmark.select(F.col(item_col).alias("_i"), F.col(item_text_col).alias("_x")).filter("_x IS NOT NULL")
    n_blocks = -(-stored.count() // items)
    for b in range(n_blocks):
        # a block holds about ``items`` rows, by a hash of their text
        block = [(r._i, r._x) for r in stored.filter(F.pmod(F.xxhash64("_x"), F.lit(n_blocks)) == b)
                 .orderBy("_i", "_x").toLocalIterator()]
        passages = fit(texts, block)
        if passages is None:
            continue
        shared = spark.sparkContext.broadcast(passages)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            p = shared.value
            for batch in batches:
                for a, _, data, offsets in bytewords.texts(batch.column(1)):
                    if rows := match(p, data, offsets, cosine):
                        at, k, *rest = zip(*rows, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array([a + i for i in at])), pa.array([p.item[i] for i in k], item_type),
                             *(pa.array(r) for r in rest)], names)

        found = found.unionByName(texts.mapInArrow(run, schema))
    # an item's passages and a document's repeated rows meet in the best match
    best = F.max(F.struct("lcs", "cosine", "answer", F.col("window_start"))).alias("m")
    return (found.groupBy("_id", "_item").agg(best)
            .select(F.col("_id").alias(id_col), F.col("_item").alias(item_col), "m.cosine", "m.lcs", "m.answer",
                    "m.window_start"))


def left_out(benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(item, words)`` of the items that find nothing, for they have fewer than ``LEAST`` words."""
    item_type = to_arrow_type(benchmark.schema[item_col].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(words(t)) for t in batch.column(1).to_pylist()]
            at = [i for i, k in enumerate(n) if k < LEAST]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())).cast(item_type),
                                              pa.array([n[i] for i in at], pa.int64())], ["_item", "words"])

    kind = benchmark.schema[item_col].dataType.simpleString()
    return (benchmark.select(F.col(item_col).alias("_i"), F.col(item_text_col).alias("_x"))
            .mapInArrow(run, f"_item {kind}, words long").withColumnRenamed("_item", item_col))


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that hold a passage of the benchmark. All columns unchanged."""
    found = durable(contaminated(docs, benchmark, id_col, **options).select(F.col(id_col).alias("_drop_id")).distinct(),
                    "found")
    return docs.join(found, docs[id_col].eqNullSafe(F.col("_drop_id")), "left_anti")
