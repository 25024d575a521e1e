"""Cross-tokenizer alignment against the libraries and plain loops."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelstar.llm import cross_tokenizer as ct
from reelstar.llm.token_counts import byte_symbols

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SYMBOLS = {c: b for b, c in byte_symbols().items()}


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain_tokens(libraries, text):
    """(ids, bytes) of A's and B's tokens, none where the contract says so."""
    a, b = libraries
    if not text:
        return [], []
    left = [(i, bytes(SYMBOLS[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        right.append((i, bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    want = (" " + text).encode()
    if b"".join(x for _, x in left) != want or b"".join(x for _, x in right) != want:
        return [], []
    return left, right


def plain_groups(left, right):
    """Groups of ids and the links between tokens that end together."""
    ends = lambda tokens: np.cumsum([len(x) for _, x in tokens]).tolist()
    ea, eb = ends(left), ends(right)
    both = sorted(set(ea) & set(eb))
    groups, links, last = [], [], 0
    for e in both:
        groups.append(",".join(str(i) for (i, _), x in zip(left, ea, strict=True) if last < x <= e) + "|"
                      + ",".join(str(i) for (i, _), x in zip(right, eb, strict=True) if last < x <= e))
        links += [(left[ea.index(e)][0], right[eb.index(e)][0])]
        last = e
    return ";".join(groups), links


def plain(libraries, rows):
    found = [plain_groups(*plain_tokens(libraries, t)) for _, t in rows]
    count = Counter(x for _, links in found for x in links)
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    out = []
    for (doc_id, text), (groups, links) in zip(rows, found, strict=True):
        left, right = plain_tokens(libraries, text)
        out.append((doc_id, len(left), len(right), groups.count(";") + 1 if groups else 0,
                    hashlib.sha256(groups.encode()).hexdigest() if groups else "", len(links),
                    sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links)))
    return out


def result(spark, rows, schema="doc_id long, text string", piece=ct.PIECE, max_pairs=ct.MAX_PAIRS):
    aligned = ct.align(spark.createDataFrame(rows, schema), A, B, piece=piece)
    hashed = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    linked = ct.written(aligned.withColumn("groups_sha256", hashed).drop("groups"))
    keep = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
    return [tuple(r) for r in ct.count_links(linked, keep, max_pairs).collect()]


EDGES = [None, "", " ", "  ", "\n", "\n\n a", " a", "a ", "a  b   c    d", "don't, won't; it's 3.14% of $5!", "x▁y", "▁",
         "<|endoftext|> and <s> </s> <unk> <0x41>", "tab\there\r\nline", "Größe straße naïve", "你好世界。今天天气很好", "สวัสดีครับ",
         "😀👩‍👩‍👧 ok", "a\xa0b c　d", "\x00\x01", "\x1cx\x85y z", "²., x². a²", "word,,,... ;;; #$%", "...", " ,", "é ﬁ Å"]


def some_texts(rng, n):
    alphabet = ["the", "thing", "tion", "Größe", "ñes", " ", "  ", "\n", ",", ".", "$$$", "1234", "'s", "é", "你", "\t", "▁", "\xa0", "A", "b"]
    return ["".join(rng.choice(alphabet[:-3] if rng.random() < .9 else alphabet) + rng.choice(["", " "])
                    for _ in range(rng.randint(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("piece", [1, 2, 7, ct.PIECE])
def test_equals_libraries_and_plain_loops(spark, libraries, piece):
    rows = list(enumerate(EDGES + some_texts(random.Random(piece), 120)))
    assert sorted(result(spark, rows, piece=piece)) == sorted(plain(libraries, rows))


def test_real_documents(spark, libraries):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)
    rows = [tuple(r) for r in docs.collect()]
    want = sorted(plain(libraries, rows))
    assert sorted(result(spark, rows)) == want
    assert sorted(result(spark, rows, max_pairs=0)) == want   # pairs shuffled, not broadcast


def test_merge_path_cuts_equal_pieces():
    rng = np.random.default_rng(1)
    for size in (1, 3, 64, 10_000):
        a, b = (np.unique(rng.integers(0, 5000, 1500)) for _ in range(2))
        ca, cb = ct.cut_points(a, b, size)
        assert set(np.diff(ca + cb)[:-1]) <= {size} and (ca[-1], cb[-1]) == (len(a), len(b))
        at_a, at_b = ct.common_ends(a, b, size)
        assert (a[at_a] == b[at_b]).all() and set(a[at_a]) == set(a) & set(b)
    assert [len(x) for x in ct.common_ends(np.zeros(0, np.int64), np.zeros(0, np.int64))] == [0, 0]


def test_long_text_repeats_nulls_and_clashing_columns(spark, libraries):
    long = "ab cde, fgh ijkl. " * 60_000
    rows = [("x", long, 1, 2), ("x", long, 1, 2), (None, "a b", 1, 2), ("y", None, 1, 2)]
    got = result(spark, rows, "doc_id string, text string, links int, _row int")
    by_id = sorted((g for g in got if g[0]), key=lambda g: g[:2])
    assert by_id[0] == by_id[1] and by_id[0][0] == "x" and by_id[2] == ("y", 0, 0, 0, "", 0, 0, 0)
    left, right = plain_tokens(libraries, long)
    assert by_id[0][1:3] == (len(left), len(right))
    assert sum(g[0] is None for g in got) == 1
    assert result(spark, [], "doc_id long, text string") == []
