"""Token counts, SentencePiece and token files against the libraries."""

from __future__ import annotations

import json
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelstar.llm import chunked, sentencepiece_codec, token_counts, token_files
from reelstar.llm.common import ship_package
from reelstar.session import scratch_path

WORD = P.path("word_bpe_49k.json")
PIECE = P.path("piece_bpe_32k.model")


def texts(seed=1, n=400):
    rnd = random.Random(seed)
    alpha = "aaabcdeéÉßΣσςİIıǅſ'’stremlld  \t\n\x1c\x1f\x85\xa0　  ​▁0123४½!?.,<|>endoftext́̇한글漢字🙂👨‍👩ﬁ"
    out = [None, "", "   ", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "<|EndOfText|>", "it's don't we'll I'M",
           "a" * 300, "ha" * 500, "word,word.word!! x|| y%%% don't, İ. ́!", "a" + " " * 17 + "b", "x" + " " * 40, "<s></s><0x0A>",
           "the " * 3000, "".join(rnd.choice("etaoin shr") for _ in range(20000)), "".join(rnd.choice("etaoinshr") for _ in range(3000))]
    out += ["".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 60))) for _ in range(n)]
    out += ["".join(rnd.choice("  a") for _ in range(rnd.randint(0, 60))) for _ in range(50)]
    out += ["".join(chr(rnd.choice([rnd.randint(32, 0x2FF), rnd.randint(0x300, 0x2FFF), rnd.randint(0x3000, 0xD7FF),
                                    rnd.randint(0xE000, 0x1FFFF)])) for _ in range(20)) for _ in range(n)]
    return out


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD)


def test_counts_match_the_library(spark, documents, library):
    ship_package(spark)
    rows = [*enumerate(texts()), (3, "again"), (3, "again"), (None, "no id")]
    df = documents(rows).withColumn("_t", F.lit(1)).withColumn("n_tokens", F.lit(1))
    got = token_counts.token_counts(df, WORD, limit=50).collect()
    want = []
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 50))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts.token_counts(documents([]), WORD).collect() == []


def test_counter_forgets_and_goes_on(monkeypatch, library):
    monkeypatch.setattr(token_counts, "MEMORY", 50)
    counter = token_counts.Counter(token_counts.load_rules(WORD))
    for _ in range(2):
        for t in texts(5, 60):
            assert counter([t])[0] == len(library.encode(t or "", add_special_tokens=False).ids)


def test_other_ways_with_texts_are_refused(tmp_path):
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    special = spec["added_tokens"][0]
    path = tmp_path / "changed.json"
    for change, why in (({"normalizer": None}, "normalised"), ({"normalizer": {"type": "NFC"}}, "normalised"),
                        ({"pre_tokenizer": {"type": "Whitespace"}}, "cut"),
                        ({"added_tokens": [{**special, "normalized": True}]}, "special"),
                        ({"added_tokens": [{**special, "content": "two words"}]}, "special")):
        path.write_text(json.dumps({**spec, **change}))
        with pytest.raises(ValueError, match=why):
            token_counts.Rules(str(path))
    # special tokens of any shape are read from the file
    path.write_text(json.dumps({**spec, "added_tokens": [{**t, "content": c} for t, c in zip(spec["added_tokens"], ("[x]", "ab#"))]}))
    rules, library = token_counts.Rules(str(path)), Tokenizer.from_file(str(path))
    texts = ["a [x] b[x]c ab# ab#[x]", "<|endoftext|>", "[x", "AB#"]
    assert token_counts.Counter(rules)(texts).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_files_round_trip(spark, documents, library, tmp_path):
    ship_package(spark)
    rows = list(enumerate(texts(2, 100)))
    random.Random(1).shuffle(rows)
    rows += [(7, "twice"), (7, "twice"), (None, "no id")]
    folder = scratch_path(spark, "tokens")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = token_files.write(documents(rows).repartition(7), WORD, folder, end_id=1)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = index.orderBy("part").collect()
    assert len(parts) > 1 and [p.base for p in parts] == [sum(q.n_tokens for q in parts[:i]) for i in range(len(parts))]
    got = token_files.read(index, folder, with_ids=True).orderBy("start").collect()
    start = 0
    for r, (i, t) in zip(got, sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, 0)), strict=True):
        assert r.doc_id == i and r.start == start
        if i != 7:
            ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
            assert list(r.ids) == ids and r.n_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += r.n_tokens
    empty = scratch_path(spark, "tokens")
    assert token_files.write_and_read(spark, documents([]), WORD, empty).collect() == []


def test_a_second_attempt_leaves_the_index_alone(spark, documents):
    ship_package(spark)
    folder = scratch_path(spark, "tokens")
    first = token_files.write(documents([(1, "one")]), WORD, folder)
    second = token_files.write(documents([(1, "one two")]), WORD, folder)   # other names in the same folder
    assert [r.n_tokens for r in token_files.read(first, folder).collect()] == [2]
    assert [r.n_tokens for r in token_files.read(second, folder).collect()] == [3]


def test_memory_keeps_frequent_chunks(monkeypatch, library):
    monkeypatch.setattr(chunked, "MEMORY", 40)
    enc = token_files._encoder.__wrapped__(WORD)
    for _ in range(2):
        for t in texts(6, 60):
            flat, lens = enc.encode([t, "the, the."])
            want = [library.encode(x or "", add_special_tokens=False).ids for x in (t, "the, the.")]
            assert lens.tolist() == list(map(len, want)) and flat.tolist() == [i for w in want for i in w]


def test_sentencepiece_parity(spark, documents):
    ship_package(spark)
    reference = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    rows = [*enumerate(texts(3)), (3, "again"), (3, "again"), (None, "no id")]
    df = documents(rows).withColumn("ids", F.lit(1)).withColumn("parity", F.lit(False))
    got = sentencepiece_codec.encode(df, PIECE, with_ids=True).collect()
    want = sorted(((i, reference.encode(t or "")) for i, t in rows), key=str)
    assert sorted(((r.doc_id, list(r.ids)) for r in got), key=str) == want
    assert all(r.parity and r.round_trip and r.n_pieces == len(r.ids) for r in got)
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    back = sentencepiece_codec.decode(sentencepiece_codec.encode(documents(rows), PIECE, with_ids=True), PIECE).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted(((i, reference.decode(x)) for i, x in want), key=str)
    assert sentencepiece_codec.encode(documents([]), PIECE).collect() == []


def test_whole_tokenizer_and_memory(monkeypatch):
    reference = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    model = sentencepiece_codec.Model(PIECE)
    some = [t or "" for t in texts(4, 150)]
    assert [e.ids for e in model.tokenizer().encode_batch(some, add_special_tokens=False)] == reference.encode(some)
    monkeypatch.setattr(chunked, "MEMORY", 40)
    codec = sentencepiece_codec.Codec(PIECE, 1)
    for _ in range(2):
        for t in some[::5]:
            out = codec([t])
            assert out.ids[0].tolist() == reference.encode(t) and out.parity[0]
            assert out.decoded[0] == t.replace("▁", " ")


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def message(*fields):
    out = b""
    for number, value in fields:
        if isinstance(value, int):
            out += varint(number << 3) + varint(value)
        elif isinstance(value, float):
            out += varint(number << 3 | 5) + np.float32(value).tobytes()
        else:
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def test_unigram_models(tmp_path):
    """A unigram model written by hand: scores, byte fallback, trimmed spaces."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    pieces += [("▁", -2.0, 1), ("a", -3.0, 1), ("b", -3.1, 1), ("ab", -4.0, 1), ("▁ab", -4.5, 1), ("▁a", -5.5, 1), ("c", -6.0, 1)]
    data = b"".join(message((1, message((1, p.encode()), (2, s), (3, t)))) for p, s, t in pieces)
    data += message((2, message((3, 1), (4, len(pieces)), (35, 1), (40, 0), (41, 1), (42, 2), (43, (1 << 64) - 1))),
                    (3, message((1, b"identity"), (2, b""), (3, 1), (4, 1), (5, 1))))
    path = str(tmp_path / "u.model")
    with open(path, "wb") as f:
        f.write(data)
    reference = sentencepiece.SentencePieceProcessor(model_file=path)
    some = ["", "ab", "ab ab", "  a  b ", "abc aab", "é ab", "bbb acab", "a漢"]
    model = sentencepiece_codec.Model(path)
    assert model.kind == sentencepiece_codec.UNIGRAM
    assert [e.ids for e in model.tokenizer().encode_batch(some, add_special_tokens=False)] == reference.encode(some)
    out = sentencepiece_codec.Codec(path, 1)(some)
    assert [x.tolist() for x in out.ids] == reference.encode(some) and out.parity.all()
