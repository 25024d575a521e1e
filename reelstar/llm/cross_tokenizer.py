"""Alignment of two tokenizers' tokens by merge-path partitioning.

Tokenizer A is a byte-level vocabulary of the tokenizers library and reads a
space and the text; B is a sentencepiece model that adds the space itself. Each
token covers bytes of that string, so both give rising byte offsets where tokens
end. Merging the two lists of ends tells where both end together.

A block of texts is one merge: its texts follow one another, and each ends with an
end of both. ``cut_points`` cuts the merge along equally spaced diagonals;
on each a binary search finds how many ends of A and of B come first, all
diagonals at once. The pieces hold the same number of ends and are merged independently
(``overlaps``); a common end that a diagonal parts, A's in one piece and B's in the next, and groups
over several pieces are stitched from the pieces' last and first ends.

Texts are encoded through a memory of distinct chunks: A never joins across white
space, nor a letter and a mark after it; B never joins what precedes a run of markers
or a line end to it. What the files have to fulfil for that is checked when they are loaded.

``count_links`` counts, over all texts, how often each pair of tokens ends together,
and sums up for each text. The table of pairs is broadcast up to
``MAX_PAIRS`` rows; beyond that only pairs that a thousandth of the texts have are, and
the others are shuffled.

Defined results: a null or empty text, and one whose tokens' bytes differ from
a space and the text (characters that B rewrites), has no tokens, no groups and an empty
string of groups; null ids and repeated rows pass through, each row
counts; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelstar.llm.chunked import SETTLED, ChunkEncoder
from reelstar.llm.common import arrow_batches, blocks, durable, ragged_gather, spread_join
from reelstar.llm.sentencepiece_codec import BYTE, MARK, NORMAL, Model
from reelstar.llm.token_counts import byte_symbols

#: Ends of A and B that a piece of the merge holds.
PIECE = 1 << 16
#: Rows of the table of pairs that may be broadcast (some 40 bytes each).
MAX_PAIRS = 4_000_000
#: Marks that neither vocabulary joins to a letter or digit before them.
TAILS = ",.!?;:%&*#$|"
#: Chunks that each encoder remembers.
MEMORY = 300_000
#: White space as the vocabulary's pattern understands it (Unicode White_Space).
_S = "\t-\r \x85\xa0  -     　"
_CUT_A = regex.compile(f" ?[^{_S}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_CUT_B = re.compile(" +[^ \n]*|\n[^ \n]*")


# --- merge path ---------------------------------------------------------------

def cut_points(a: np.ndarray, b: np.ndarray, size: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """How much of ``a`` and of ``b`` the merge has taken at every ``size``-th
    step, and at its end. Of equal ends A's comes first."""
    steps = np.append(np.arange(0, len(a) + len(b), size), len(a) + len(b))
    low, high = np.maximum(steps - len(b), 0), np.minimum(steps, len(a))
    while (low < high).any():
        mid = (low + high) // 2
        open_ = low < high
        # a[mid] is among the first ``step`` ends if it comes before b[step - mid - 1] or ties with it
        at = np.where(open_, mid, 0)
        taken = open_ & (a[np.minimum(at, len(a) - 1)] <= b[np.clip(steps - at - 1, 0, len(b) - 1)])
        low, high = np.where(taken, mid + 1, low), np.where(open_ & ~taken, mid, high)
    return low, steps - low


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common ends within one piece."""
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    same = np.flatnonzero(b[at] == a)
    return same, at[same]


def common_ends(a: np.ndarray, b: np.ndarray, size: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Places in two strictly rising lists where both have the same value, piece by piece."""
    ca, cb = cut_points(a, b, size)
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i0, i1, j0, j1 in zip(ca[:-1], ca[1:], cb[:-1], cb[1:], strict=True):
        if i0 and j0 < len(b) and a[i0 - 1] == b[j0]:          # the diagonal parted a common end
            found_a.append(np.array([i0 - 1]))
            found_b.append(np.array([j0]))
        pa_, pb_ = overlaps(a[i0:i1], b[j0:j1])
        found_a.append(pa_ + i0)
        found_b.append(pb_ + j0)
    return np.concatenate(found_a), np.concatenate(found_b)


# --- vocabularies -------------------------------------------------------------

class PieceEncoder(ChunkEncoder):
    """Piece ids of chunks that begin with a space, a line end or a mark."""

    def learn(self, fresh: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.parts is not None:
            return super().learn(fresh)
        # the model puts a space first; no piece has a line end, so one keeps it apart: two ids
        ids = self.tokenizer.encode(["\n" + c for c in fresh], num_threads=1)
        lens = np.fromiter(map(len, ids), np.int64, len(ids)) - 2
        return np.array([x for i in ids for x in i[2:]], np.int64), lens


class Vocabulary:
    """The bytes of each token, and an encoder."""

    def __init__(self, encoder: ChunkEncoder, token_bytes: list[bytes]):
        encoder.memory = MEMORY
        if encoder.parts is not None:
            encoder.parts.memory = MEMORY
        self.encoder = encoder
        self.lens = np.fromiter(map(len, token_bytes), np.int64, len(token_bytes))
        self.starts = np.cumsum(self.lens) - self.lens
        self.flat = np.frombuffer(b"".join(token_bytes), np.uint8)
        self.names = [str(i) for i in range(len(token_bytes))]

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and number of tokens; bytes and number of bytes of each text."""
        ids, n = self.encoder.encode(texts)
        sizes = np.r_[0, np.cumsum(self.lens[ids])]
        ends = np.cumsum(n)
        return ids, n, ragged_gather(self.flat, self.starts[ids], self.lens[ids]), sizes[ends] - sizes[ends - n]


def byte_level(path: str) -> Vocabulary:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    if tokenizer.normalizer is not None or "ByteLevel" not in repr(tokenizer.pre_tokenizer):
        raise ValueError(f"{path}: not a plain byte-level vocabulary")
    of = {c: b for b, c in byte_symbols().items()}
    names = tokenizer.get_vocab()
    out = [b""] * (max(names.values()) + 1)
    for name, i in names.items():
        out[i] = bytes(map(of.__getitem__, name)) if all(c in of for c in name) else name.encode()
    return Vocabulary(ChunkEncoder(tokenizer, lambda t: _CUT_A.findall(t), TAILS), out)


def piece_level(path: str) -> Vocabulary:
    model = Model(path)
    normal = [p for p, _, kind in model.pieces if kind == NORMAL]
    if not model.dummy_prefix or model.trim or model.charsmap:
        raise ValueError(f"{path}: the model rewrites texts")
    if any("\n" in p or (MARK in p.lstrip(MARK)) for p in normal):
        raise ValueError(f"{path}: a piece reaches across a space or a line end")
    apart = not any(x in SETTLED and y in TAILS for p in normal for x, y in zip(p, p[1:], strict=False))
    out = [bytes([int(p[3:-1], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() for p, _, kind in model.pieces]
    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    encoder = PieceEncoder(processor, lambda t: _CUT_B.findall(t), TAILS if apart else "")
    if apart:
        encoder.parts = PieceEncoder(processor, lambda _: [])
    return Vocabulary(encoder, out)


@lru_cache(maxsize=2)
def vocabularies(a_path: str, b_path: str) -> tuple[Vocabulary, Vocabulary]:
    return byte_level(a_path), piece_level(b_path)


# --- alignment ----------------------------------------------------------------

class Aligned:
    """A block of texts: token ids, common ends and groups of each text."""

    def __init__(self, a: Vocabulary, b: Vocabulary, texts: list[str | None], size: int = PIECE):
        spaced = [" " + t if t else "" for t in texts]
        whole = np.frombuffer("".join(spaced).encode("utf-8"), np.uint8)
        n_bytes = np.array([len(t) if t.isascii() else len(t.encode("utf-8")) for t in spaced], np.int64)
        self.a, self.b = a, b
        a_ids, a_n, a_bytes, a_len = a.tokens(spaced)
        b_ids, b_n, b_bytes, b_len = b.tokens(spaced)
        good = same_bytes(whole, n_bytes, a_bytes, a_len) & same_bytes(whole, n_bytes, b_bytes, b_len)
        self.a_ids, self.b_ids = a_ids[np.repeat(good, a_n)], b_ids[np.repeat(good, b_n)]
        self.n_a, self.n_b = np.where(good, a_n, 0), np.where(good, b_n, 0)
        a_ends, b_ends = np.cumsum(a.lens[self.a_ids]), np.cumsum(b.lens[self.b_ids])
        self.at_a, self.at_b = common_ends(a_ends, b_ends, size)
        # groups of each text: its common ends
        upto = np.searchsorted(self.at_a, np.cumsum(self.n_a))
        self.n_groups = np.diff(np.r_[0, upto])

    def groups(self) -> list[str]:
        """``a1,a2|b1;a3|b2`` of each text: ids of A and B by group."""
        na, nb = len(self.a_ids), len(self.b_ids)
        a_last, b_last = np.zeros(na, bool), np.zeros(nb, bool)
        a_last[self.at_a], b_last[self.at_b] = True, True
        # a token comes after the other tokenizer's tokens of all groups before its own
        a_group = np.cumsum(a_last) - a_last
        b_group = np.cumsum(b_last) - b_last
        place = np.empty(na + nb, np.int64)
        place[np.arange(na) + np.r_[0, self.at_b + 1][a_group]] = self.a_ids * 2 + a_last
        text_last = np.zeros(nb + 1, bool)
        text_last[np.cumsum(self.n_b)[self.n_b > 0] - 1] = True
        place[np.arange(nb) + (self.at_a + 1)[b_group]] = 2 * len(self.a.names) + self.b_ids * 3 + np.where(
            text_last[:nb], 2, b_last)
        words = list(map(self._names().__getitem__, place.tolist()))
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(words[s:e]) for s, e in zip([0, *ends[:-1]], ends, strict=True)]

    def _names(self) -> list[str]:
        return _names(self.a, self.b)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text its distinct linked pairs (A's id times 2^32 plus
        B's) and how often each is linked: offsets, pairs, times."""
        owner = np.repeat(np.arange(len(self.n_groups)), self.n_groups)
        width = len(self.b.names)
        cell = self.a_ids[self.at_a] * width + self.b_ids[self.at_b]
        span = len(self.a.names) * width
        if span * max(len(self.n_groups), 1) >= 1 << 63:
            raise ValueError("too many texts in a block for such vocabularies")
        key, times = np.unique(owner * span + cell, return_counts=True)
        pair = key % span
        offsets = np.searchsorted(key, np.arange(len(self.n_groups) + 1) * span)
        return offsets, (pair // width << 32) + pair % width, times


@lru_cache(maxsize=2)
def _names(a: Vocabulary, b: Vocabulary) -> list[str]:
    """Texts of all tokens with what follows each: a comma, the end of a
    group's side or, for B's last token of a text, nothing."""
    return ([n + s for n in a.names for s in (",", "|")] + [n + s for n in b.names for s in (",", ";", "")])


def same_bytes(whole: np.ndarray, sizes: np.ndarray, got: np.ndarray, got_sizes: np.ndarray) -> np.ndarray:
    """Which texts of ``whole`` have the same bytes in ``got``, and any at all."""
    alike = (sizes == got_sizes) & (sizes > 0)
    mine, other = np.repeat(alike, sizes), np.repeat(alike, got_sizes)
    differs = whole[mine] != got[other]
    bad = np.bincount(np.repeat(np.flatnonzero(alike), sizes[alike])[differs], minlength=len(sizes)) > 0
    return alike & ~bad


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          piece: int = PIECE) -> DataFrame:
    """``(_row, id, n_a, n_b, n_groups, groups, links)`` for each row: the groups
    as text, the links as ``(pair, times)``; ``_row`` tells rows apart."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"_row long, _id {kind}, n_a long, n_b long, n_groups long, groups string, "
              "links array<struct<pair: bigint, times: bigint>>")
    item = pa.struct([("pair", pa.int64()), ("times", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = vocabularies(a_path, b_path)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for lo, hi in blocks(texts, 1_000_000):
                found = Aligned(a, b, texts[lo:hi], piece)
                offsets, pairs, times = found.links()
                links = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(pairs), pa.array(times)], fields=list(item)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(found.n_a),
                     pa.array(found.n_b), pa.array(found.n_groups), pa.array(found.groups(), pa.string()), links],
                    names=["_row", "_id", "n_a", "n_b", "n_groups", "groups", "links"])

    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"),
                       F.col(text_col).alias("_t"))
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def pair_counts(linked: DataFrame) -> DataFrame:
    """``(pair, count, best, texts)``: how often each pair is linked over all
    texts, whether no pair of its B id is linked more often, and by how many texts."""
    counts = (linked.select(F.explode("links").alias("l")).groupBy(F.col("l.pair").alias("pair"))
              .agg(F.sum("l.times").alias("count"), F.count(F.lit(1)).alias("texts")))
    by_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    return counts.withColumn("best", F.col("count") == F.max("count").over(by_b))


def count_links(linked: DataFrame, keep: list[str], max_pairs: int = MAX_PAIRS) -> DataFrame:
    """``keep`` columns of ``linked`` (written already, with ``_row`` and ``links``) and, summed over each
    row's links, ``n_links``, ``n_best`` (links whose pair is its B id's most
    frequent) and ``count_sum`` (their pairs' counts)."""
    pairs = durable(pair_counts(linked), "pairs")
    size, large = pairs.count(), max(1000, linked.count() // 1000)
    each = linked.select("_row", *keep, F.explode("links").alias("l")).select(
        "_row", *keep, F.col("l.pair").alias("pair"), F.col("l.times").alias("times"))
    met = spread_join(each, pairs, "pair", size, F.col("texts") >= large, max_pairs)
    summed = met.groupBy("_row", *keep).agg(
        F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    none = linked.filter(F.size("links") == 0).select("_row", *keep)
    zeros = [F.lit(0).cast("long").alias(c) for c in ("n_links", "n_best", "count_sum")]
    return summed.unionByName(none.select("*", *zeros)).drop("_row")


def written(linked: DataFrame) -> DataFrame:
    """Alignments written once, in batches that bound a worker's memory."""
    with arrow_batches(linked.sparkSession, 1000):
        return durable(linked, "aligned")
