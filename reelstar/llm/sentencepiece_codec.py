"""SentencePiece models on the tokenizers library.

``Model`` parses the model's protobuf and rebuilds it from the library's
parts: the normaliser (dummy prefix, white space as the metaspace marker), the
unigram model from scores, or, for models trained by pair merging, the merges
that their scores order; byte fallback; and the decoder. Both kinds are built
the same way from the same file; which one applies is the file's own setting.

``encode`` cuts marked texts before each marker, where no piece reaches
across, and encodes distinct chunks in multithreaded batches. Each distinct
chunk is also encoded by the sentencepiece library, so ``parity`` covers every
chunk of every document, and decoded again by the tokenizers library.

Defined results: a null text counts as empty (no pieces, decodes to the empty
text); null ids and repeated rows pass through, one row out for each row in;
extra columns are ignored, whatever they are called.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from reelstar.llm.chunked import ChunkEncoder
from reelstar.llm.common import blocks, small_batches

MARK = "▁"
# Field numbers of the model file, as its public format defines them.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
MODEL_TYPE, BYTE_FALLBACK, UNK_ID = 3, 35, 40
CHARSMAP, DUMMY_PREFIX, TRIM_SPACES, ESCAPE_SPACES = 2, 3, 4, 5
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protobuf message, in order."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            if kind != 2:
                raise ValueError(f"field kind {kind} isn't part of the format")
            size = number()
        yield key >> 3, data[at:at + size]
        at += size


class Model:
    """A parsed model and its tokenizer."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = f.read()
        self.pieces: list[tuple[str, float, int]] = []
        trainer: dict = {}
        norm: dict = {}
        for field, value in _fields(data):
            if field == PIECES:
                p = dict(_fields(value))
                score = struct.unpack("<f", p[PIECE_SCORE])[0] if PIECE_SCORE in p else 0.0
                self.pieces.append((p[PIECE_TEXT].decode(), score, p.get(PIECE_TYPE, NORMAL)))
            elif field == TRAINER:
                trainer = dict(_fields(value))
            elif field == NORMALIZER:
                norm = dict(_fields(value))
        self.kind = trainer.get(MODEL_TYPE, UNIGRAM)
        self.byte_fallback = bool(trainer.get(BYTE_FALLBACK, 0))
        self.unk_id = trainer.get(UNK_ID, 0)
        self.charsmap = norm.get(CHARSMAP, b"")
        self.dummy_prefix = bool(norm.get(DUMMY_PREFIX, 1))
        self.trim = bool(norm.get(TRIM_SPACES, 1))
        if not norm.get(ESCAPE_SPACES, 1):
            raise ValueError("models that keep spaces unmarked aren't supported")
        if any(t == USER_DEFINED for _, _, t in self.pieces):
            raise ValueError("models with user-defined pieces aren't supported")
        self.core = Tokenizer(self._model())
        self.core.decoder = self._decoder(strip=False)

    def _merges(self) -> list[tuple[str, str]]:
        """Every way to put a piece together from two others, best score first.

        Runs of the marker share one score, and among equal scores the
        leftmost pair goes first: the run at the left end takes in what
        follows as long as that makes a piece. Longer left parts therefore
        rank before shorter ones.
        """
        normal = {p: (s, i) for i, (p, s, t) in enumerate(self.pieces) if t == NORMAL}
        found, runs = [], []
        for piece, (score, i) in normal.items():
            if set(piece) == {MARK}:
                runs += [(piece[:k], piece[k:]) for k in range(1, len(piece))
                         if piece[:k] in normal and piece[k:] in normal]
                continue
            for k in range(1, len(piece)):
                left, right = piece[:k], piece[k:]
                if left in normal and right in normal:
                    found.append((-score, i, normal[left][1], normal[right][1], left, right))
        runs.sort(key=lambda m: -len(m[0]))
        return [(m[-2], m[-1]) for m in sorted(found)] + runs

    def _model(self):
        if self.kind == UNIGRAM:
            return models.Unigram([(p, s) for p, s, _ in self.pieces], self.unk_id, self.byte_fallback)
        if self.kind == BPE:
            return models.BPE({p: i for i, (p, _, _) in enumerate(self.pieces)}, self._merges(),
                              unk_token=self.pieces[self.unk_id][0], fuse_unk=True,
                              byte_fallback=self.byte_fallback)
        raise ValueError(f"model type {self.kind} isn't supported")

    def _decoder(self, strip: bool):
        steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        if strip and self.dummy_prefix:
            steps.append(decoders.Strip(" ", 1, 0))
        return decoders.Sequence(steps)

    def tokenizer(self) -> Tokenizer:
        """The whole tokenizer, for single texts and for saving."""
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.trim:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARK))
        steps.append(normalizers.Replace(" ", MARK))
        out = Tokenizer(self._model())
        out.normalizer = normalizers.Sequence(steps)
        if self.kind == BPE:
            out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
        out.decoder = self._decoder(strip=True)
        return out

    def marked(self, text: str | None) -> str:
        """The normalised text with spaces as markers."""
        text = text or ""
        if self.charsmap:
            text = normalizers.Precompiled(self.charsmap).normalize_str(text)
        if self.trim:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return (MARK if self.dummy_prefix else "") + text.replace(" ", MARK)

    def can_cut(self) -> bool:
        """Whether no piece holds a marker after another character."""
        return not any(MARK in p.lstrip(MARK) for p, _, t in self.pieces if t == NORMAL)


_CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Codec:
    """Encodes and decodes batches of texts and holds them against sentencepiece."""

    def __init__(self, path: str, threads: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        self.model = Model(path)
        self.reference = sentencepiece.SentencePieceProcessor(model_file=path)
        self.threads = threads
        self.cut = self._chunks if self.model.can_cut() else self._whole
        self.encoder = _Checked(self)
        self.decoded: list[str] = []
        self.agrees = np.zeros(0, bool)
        types = np.array([t for _, _, t in self.model.pieces])
        self.is_byte, self.is_unk = types == BYTE, types == UNKNOWN

    def _chunks(self, text: str | None) -> list[str]:
        return _CHUNK.findall(self.model.marked(text))

    def _whole(self, text: str | None) -> list[str]:
        marked = self.model.marked(text)
        return [marked] if marked else []

    def check(self, fresh: list[str], ids: np.ndarray, lens: np.ndarray) -> None:
        """Decode new chunks, and hold their ids against sentencepiece's."""
        ends = np.cumsum(lens)
        spans = [ids[e - n:e].tolist() for e, n in zip(ends, lens, strict=True)]
        self.decoded += self.model.core.decode_batch(spans, skip_special_tokens=False)
        # sentencepiece adds the dummy prefix itself, so a chunk goes in without
        # its first marker; one without a marker follows other pieces
        prefix = self.model.dummy_prefix
        plain = [(c[1:] if prefix and c[0] == MARK else c).replace(MARK, " ") for c in fresh]
        theirs = self.reference.encode(plain, num_threads=1)
        own = [not prefix or c[0] == MARK and c != MARK for c in fresh]
        self.agrees = np.r_[self.agrees, [not o or t == s for o, t, s in zip(own, theirs, spans, strict=True)]]

    def __call__(self, texts: list[str | None]) -> pd.DataFrame:
        slots, sizes = self.encoder.slots(texts)
        ids, lens = self.encoder.gather(slots, sizes)
        ends, chunk_ends = np.cumsum(lens), np.cumsum(sizes)
        byte_sum = np.r_[0, np.cumsum(self.is_byte[ids])]
        unk_sum = np.r_[0, np.cumsum(self.is_unk[ids])]
        bad = np.r_[0, np.cumsum(~self.agrees[slots])]
        spans, back = [], []
        for e, n, ce, cn in zip(ends, lens, chunk_ends, sizes, strict=True):
            spans.append(ids[e - n:e])
            text = "".join(map(self.decoded.__getitem__, slots[ce - cn:ce].tolist()))
            back.append(text[1:] if self.model.dummy_prefix else text)
        return pd.DataFrame({
            "n_pieces": lens, "n_bytes_pieces": byte_sum[ends] - byte_sum[ends - lens],
            "n_unknown": unk_sum[ends] - unk_sum[ends - lens], "ids": spans, "decoded": back,
            "parity": bad[chunk_ends] == bad[chunk_ends - sizes]})


class _Checked(ChunkEncoder):
    """Chunks that are checked as they are learnt. Each carries its text and
    verdict, so fewer are remembered."""

    memory = 150_000

    def __init__(self, codec: Codec):
        super().__init__(codec.model.core, codec.cut)
        self.codec = codec

    def learn(self, fresh: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, lens = super().learn(fresh)
        self.codec.check(fresh, ids, lens)
        return ids, lens

    def forget(self) -> np.ndarray:
        kept = super().forget()
        self.codec.decoded = [self.codec.decoded[i] for i in kept.tolist()]
        self.codec.agrees = self.codec.agrees[kept]
        return kept


@lru_cache(maxsize=2)
def _codec(path: str, threads: int) -> Codec:
    return Codec(path, threads)


def encode(docs: DataFrame, model_path: str, threads: int = 2, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """A row for each document: number of pieces, of byte pieces and unknown
    ones, crc32 of the ids (as little-endian unsigned 32-bit integers), whether
    decoding gives the normalised text back, and whether sentencepiece gives
    the same ids (``ids`` themselves on request)."""
    small_batches(docs.sparkSession)
    extra = ", ids array<int>" if with_ids else ""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(model_path, threads)
        for pdf in batches:
            texts, keys = pdf["_t"].tolist(), pdf["_id"]
            for a, b in blocks(texts, 1_500_000):
                out = codec(texts[a:b])
                whole = [codec.model.marked(t).replace(MARK, " ") for t in texts[a:b]]
                cut = 1 if codec.model.dummy_prefix else 0
                out["round_trip"] = [w[cut:] == d for w, d in zip(whole, out["decoded"], strict=True)]
                out["ids_crc32"] = [zlib.crc32(x.astype("<u4").tobytes()) for x in out["ids"]]
                out.insert(0, "_id", keys.iloc[a:b].to_numpy())
                yield out.drop(columns=["decoded"] + ([] if with_ids else ["ids"]))

    text = F.coalesce(F.col(text_col), F.lit(""))
    schema = (f"_id {kind}, n_pieces long, n_bytes_pieces long, n_unknown long{extra}, parity boolean, "
              "round_trip boolean, ids_crc32 long")
    if with_ids:
        schema = (f"_id {kind}, n_pieces long, n_bytes_pieces long, n_unknown long, ids array<int>, "
                  "parity boolean, round_trip boolean, ids_crc32 long")
    return (docs.select(F.col(id_col).alias("_id"), text.alias("_t")).mapInPandas(run, schema)
            .withColumnRenamed("_id", id_col))


def decode(ids: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, text)`` from arrays of ids; null ids give a null text."""
    kind = ids.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        back = Model(model_path).tokenizer()
        for pdf in batches:
            texts = back.decode_batch([[] if x is None else list(map(int, x)) for x in pdf["_x"]],
                                      skip_special_tokens=False)
            yield pd.DataFrame({"_id": pdf["_id"],
                                "text": [None if x is None else t for x, t in zip(pdf["_x"], texts, strict=True)]})

    return (ids.select(F.col(id_col).alias("_id"), F.col(ids_col).alias("_x"))
            .mapInPandas(run, f"_id {kind}, text string").withColumnRenamed("_id", id_col))
