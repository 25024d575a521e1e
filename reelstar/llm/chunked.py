"""Encoding through a memory of distinct chunks.

Where a vocabulary never joins symbols across certain cuts (white space, or
the start of a marked word), a text's ids are the ids of its chunks in turn.
Each distinct chunk then goes through the library once per Python worker,
and a batch of texts is put together from arrays.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from tokenizers import Tokenizer

from reelstar.llm.common import Interner, ragged_gather

#: Distinct chunks remembered before the memory starts anew.
MEMORY = 400_000
#: Chunks handed to the library as one pre-tokenized sequence.
GROUP = 200
#: Characters that are letters or digits in every version of Unicode, and
#: stay single ones in lower case (a dotted capital I doesn't).
SETTLED = frozenset(c for c in map(chr, range(0x250)) if c.isalpha() and len(c.lower()) == 1) | frozenset("0123456789")


def encode_chunks(tokenizer: Tokenizer, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all chunks in one array, and the number of ids of each."""
    groups = [chunks[i:i + GROUP] for i in range(0, len(chunks), GROUP)]
    flat, lens = [], []
    for group, enc in zip(groups, tokenizer.encode_batch(
            groups, is_pretokenized=True, add_special_tokens=False), strict=True):
        flat.append(np.array(enc.ids, np.int64))
        lens.append(np.bincount(np.array(enc.word_ids, np.int64), minlength=len(group)))
    if not flat:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(flat), np.concatenate(lens)


class ChunkEncoder:
    """Token ids of texts. ``cut`` gives a text's chunks. With ``tails``, such
    marks at a chunk's end, after a letter or digit that the vocabulary never
    joins to them, are encoded on their own."""

    memory: int | None = None                                 # chunks remembered, else MEMORY

    def __init__(self, tokenizer: Tokenizer, cut: Callable[[str | None], list[str]], tails: str = ""):
        self.tokenizer, self.cut, self.tails = tokenizer, cut, tails
        self.known = Interner()
        self.ids = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.lens = np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)
        self.parts = None if not tails else ChunkEncoder(tokenizer, lambda _: [])

    def forget(self) -> np.ndarray:
        """Drop the chunks that were met only once; the slots kept, in order."""
        kept = np.flatnonzero(self.uses > 1)
        if len(kept) >= (self.memory or MEMORY) // 2:
            kept = kept[:0]
        names = list(self.known)
        self.known = Interner()
        self.known.slots([names[i] for i in kept.tolist()])
        self.known.take_fresh()
        lens = self.lens[kept]
        self.ids = ragged_gather(self.ids, self.starts[kept], lens)
        self.starts, self.lens, self.uses = np.cumsum(lens) - lens, lens, np.zeros(len(kept), np.int64)
        return kept

    def learn(self, fresh: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks not met before, and the number of ids of each."""
        if self.parts is None:
            return encode_chunks(self.tokenizer, fresh)
        pieces, sizes = [], np.ones(len(fresh), np.int64)
        for i, chunk in enumerate(fresh):
            core = chunk.rstrip(self.tails)
            if core and len(core) < len(chunk) and core[-1] in SETTLED:
                pieces.append(core)
                pieces.append(chunk[len(core):])
                sizes[i] = 2
            else:
                pieces.append(chunk)
        return self.parts.gather(self.parts.remember(pieces), sizes)

    def remember(self, chunks: list[str]) -> np.ndarray:
        """The slots of chunks, encoding those not met before."""
        slots = self.known.slots(chunks)
        self._settle()
        return slots

    def _settle(self) -> None:
        fresh = self.known.take_fresh()
        if not fresh:
            return
        ids, lens = self.learn(fresh)
        self.starts = np.r_[self.starts, len(self.ids) + np.cumsum(lens) - lens]
        self.lens = np.r_[self.lens, lens]
        self.ids = np.r_[self.ids, ids]
        self.uses = np.r_[self.uses, np.zeros(len(fresh), np.int64)]

    def slots(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Slots of the chunks of all texts, and how many each text has."""
        for memory in (self, self.parts):
            if memory is not None and len(memory.known) > (memory.memory or MEMORY):
                memory.forget()
        found, sizes = [np.zeros(0, np.int64)], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            parts = self.cut(t)
            sizes[i] = len(parts)
            found.append(self.known.slots(parts))
        self._settle()
        slots = np.concatenate(found)
        self.uses += np.bincount(slots, minlength=len(self.uses))
        return slots, sizes

    def gather(self, slots: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the number of ids of each text."""
        lens = self.lens[slots]
        total = np.r_[0, np.cumsum(lens)]
        ends = np.cumsum(sizes)
        return ragged_gather(self.ids, self.starts[slots], lens), total[ends] - total[ends - sizes]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        return self.gather(*self.slots(texts))
