"""Token counts by rank-synchronous array merging.

A byte-pair vocabulary is applied to a whole batch of pre-tokens at once.
The batch is one flat array of symbol ids cut into sequences (a ragged
array). In each round every sequence looks up the rank of its adjacent pairs,
finds its lowest, and merges all occurrences of that pair; sequences without a
known pair leave the batch with their number of surviving symbols.

Merging all occurrences of the lowest pair together equals merging them one
by one as long as no merge can create a pair of lower rank than itself, that
is, each merge comes after those that make its parts. ``load_rules`` checks
this and refuses other vocabularies, and those that normalise, cut or mark texts otherwise than by
NFC and lower case, one pattern, and special tokens matched as they stand.

Texts are cut at white space first, and each distinct chunk is counted once
per Python worker: the vocabulary drops white space, so chunks don't interact.

Defined results: a null text counts as empty (0 tokens); null ids and
repeated rows pass through, one row out for each row in; further columns are
ignored.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelstar.llm.common import Interner, blocks, small_batches

#: White space as the vocabulary's pattern understands it (Unicode White_Space).
_WHITE = regex.compile("[\t-\r \x85\xa0  -     　]+")
_CONTROL = regex.compile("[\x1c-\x1f]")
_LATER = regex.compile("[^\0-\u02ff\u0391-\u03c9\u0410-\u044f]")
#: Distinct chunks a worker remembers before it starts anew.
MEMORY = 500_000


def chunks(text: str | None) -> list[str]:
    """A text cut at white space."""
    if not text:
        return []
    if _CONTROL.search(text) is None:
        return text.split()
    return [c for c in _WHITE.split(text) if c]


def lower_each(text: str) -> str:
    """Lower case letter by letter (no rule for a sigma that ends a word)."""
    return text.replace("Σ", "σ").lower()


def byte_symbols() -> dict[int, str]:
    """The printable stand-in for each byte in byte-level vocabularies: the
    visible Latin-1 characters stand for themselves, the rest are dealt code
    points from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _refuse_unknown(path: str, spec: dict) -> None:
    """Raise for a vocabulary whose texts are prepared in another way than here."""
    steps = (spec.get("normalizer") or {}).get("normalizers") or [spec.get("normalizer") or {}]
    # turning white space into blanks changes nothing: texts are cut there
    blanks = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    if [n.get("type") for n in steps if n != blanks] != ["NFC", "Lowercase"]:
        raise ValueError(f"{path}: texts are not normalised by NFC and lower case")
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    if ([c["type"] for c in cuts] != ["Split", "ByteLevel"] or "Regex" not in cuts[0]["pattern"] or not cuts[0]["invert"]
            or cuts[0]["behavior"] != "Removed" or cuts[1]["add_prefix_space"] or cuts[1]["use_regex"]):
        raise ValueError(f"{path}: texts are not cut by one pattern of what to keep")
    for t in spec["added_tokens"]:
        if t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or _WHITE.search(t["content"]):
            raise ValueError(f"{path}: special token {t['content']!r} is matched in a way not known here")


class Rules:
    """Merge rules as sorted arrays, and the patterns that cut pre-tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, self.suffix = model["vocab"], model["end_of_word_suffix"] or ""
        if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError(f"{path}: not a plain byte-pair vocabulary")
        self.base = max(vocab.values()) + 1
        keys, made, born = [], [], {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            if max(born.get(left, -1), born.get(right, -1)) >= rank:
                raise ValueError("a merge comes before its parts")
            born.setdefault(left + right, rank)
            keys.append(vocab[left] * self.base + vocab[right])
            made.append(vocab[left + right])
        # a pair's parts must not be made again by a later merge
        last: dict[str, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            last[left + right] = rank
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            if max(last.get(left, -1), last.get(right, -1)) >= rank:
                raise ValueError("a merge creates a pair of lower rank than itself")
        keys = np.array(keys, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), np.array(made, np.int64)
        sym = byte_symbols()
        self.inner = np.array([vocab[sym[b]] for b in range(256)], np.int64)
        self.final = np.array([vocab[sym[b] + self.suffix] for b in range(256)], np.int64)
        _refuse_unknown(path, spec)
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None
        self.marks = {c[0] for c in specials}
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        full = Tokenizer.from_file(path)
        self.normalizer, self.splitter = full.normalizer, full.pre_tokenizer
        self.bytes_of = {ord(c): b for b, c in sym.items()}

    def cut(self, text: str) -> list[str]:
        """Pre-tokens of a text without special tokens. Letters are told from
        other characters by Unicode's tables, whose versions differ between
        libraries beyond the long-settled scripts: those go to the library."""
        if _LATER.search(text) is None:
            return self.pieces.findall(lower_each(unicodedata.normalize("NFC", text)))
        found = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))
        return [p.translate(self.bytes_of).encode("latin-1").decode("utf-8") for p, _ in found]

    def pre_tokens(self, chunk: str) -> tuple[list[str], int]:
        """The pre-tokens of a chunk and its number of special tokens."""
        if not any(m in chunk for m in self.marks):
            return self.cut(chunk), 0
        parts = self.special.split(chunk)
        return [p for s in parts[::2] for p in self.cut(s)], len(parts) // 2

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; the number of rules for a pair without one."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], len(self.keys))

    def count(self, pieces: list[str]) -> np.ndarray:
        """Surviving symbols of each pre-token."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        out = lens.copy()
        data = np.frombuffer(b"".join(raw), np.uint8)
        live = np.flatnonzero(lens > 1)
        keep = np.repeat(lens > 1, lens)
        sym = self.inner[data]
        ends = np.cumsum(lens)[lens > 0] - 1
        sym[ends] = self.final[data[ends]]
        sym = sym[keep]
        own = np.repeat(np.arange(len(live)), lens[live])     # sequence of each symbol
        none = len(self.keys)
        rank = np.full(len(sym), none, np.int64)              # of the pair that starts here
        inside = np.flatnonzero(own[:-1] == own[1:]) if len(own) else own
        rank[inside] = self.rank_of(sym[inside], sym[inside + 1])
        while len(sym):
            starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            low = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(sym)])
            open_ = low < none
            if not open_.all():                               # settled sequences leave
                out[live[~open_]] = sizes[~open_]
                stay = np.repeat(open_, sizes)
                live, low = live[open_], low[open_]
                sym, rank, sizes = sym[stay], rank[stay], sizes[open_]
                own = np.repeat(np.arange(len(live)), sizes)
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == low[own])
            # in a run of touching hits (a a a) every second one is taken
            run = np.r_[True, np.diff(hit) > 1]
            first = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - first) % 2 == 0]
            sym[hit] = self.made[rank[hit]]
            gone = np.zeros(len(sym), bool)
            gone[hit + 1] = True
            kept = ~gone
            new_at = np.cumsum(kept) - 1
            sym, own, rank = sym[kept], own[kept], rank[kept]
            at = new_at[hit]
            touched = np.unique(np.r_[at, at[at > 0] - 1])    # pairs with a new part
            rank[touched] = none
            pair = touched[touched + 1 < len(sym)]
            pair = pair[own[pair] == own[pair + 1]]
            rank[pair] = self.rank_of(sym[pair], sym[pair + 1])
        return out


@lru_cache(maxsize=4)
def load_rules(path: str) -> Rules:
    return Rules(path)


class Counter:
    """Token counts of chunks, each distinct chunk worked out once."""

    def __init__(self, rules: Rules):
        self.rules, self.known, self.counts = rules, Interner(), np.zeros(0, np.int64)

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if len(self.known) > MEMORY:
            self.known, self.counts = Interner(), np.zeros(0, np.int64)
        slots, sizes = [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            parts = chunks(t)
            sizes[i] = len(parts)
            slots.append(self.known.slots(parts))
        fresh = self.known.take_fresh()
        if fresh:
            pieces, owner = Interner(), []
            special = np.zeros(len(fresh), np.int64)
            nums = np.zeros(len(fresh), np.int64)
            for i, c in enumerate(fresh):
                found, special[i] = self.rules.pre_tokens(c)
                nums[i] = len(found)
                owner.extend(map(pieces.__getitem__, found))
            per_piece = self.rules.count(pieces.take_fresh())
            total = np.r_[0, np.cumsum(per_piece[np.array(owner, np.int64)])]
            ends = np.cumsum(nums)
            self.counts = np.r_[self.counts, special + total[ends] - total[ends - nums]]
        flat = np.concatenate(slots) if slots else np.zeros(0, np.int64)
        total = np.r_[0, np.cumsum(self.counts[flat])]
        ends = np.cumsum(sizes)
        return total[ends] - total[ends - sizes]


@lru_cache(maxsize=2)
def _worker_counter(path: str) -> Counter:
    return Counter(load_rules(path))


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` for each row of ``docs``.

    ``vocabulary`` is the path of a byte-level vocabulary with word ends, found
    at the same place on every executor.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _worker_counter(vocabulary)
        for pdf in batches:
            tokens = np.zeros(len(pdf), np.int64)
            texts = pdf["_t"].tolist()
            for a, b in blocks(texts):
                tokens[a:b] = counter(texts[a:b])
            yield pd.DataFrame({"_id": pdf["_id"], "n_bytes": pdf["_n"], "n_tokens": tokens})

    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = (docs.select(F.col(id_col).alias("_id"), text.alias("_t"), F.octet_length(text).cast("long").alias("_n"))
               .mapInPandas(run, f"_id {kind}, n_bytes long, n_tokens long"))
    return counted.select(F.col("_id").alias(id_col), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))
