from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelstar.llm import substring_dedup
from reelstar.llm.fm_index import FMIndex, WaveletMatrix


def brute(rows, w):
    """(id, words, removed, sha) by a table of all windows."""
    big = 1 << 62
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    first: dict = {}
    for i, q in texts:
        for a in range(len(q) - w + 1):
            k = tuple(q[a:a + w])
            o = big if i is None else i
            first[k] = min(first.get(k, o), o)
    out = []
    for i, q in texts:
        gone = np.zeros(len(q), bool)
        for a in range(len(q) - w + 1):
            if first[tuple(q[a:a + w])] < (big if i is None else i):
                gone[a:a + w] = True
        kept = b" ".join(x for x, g in zip(q, gone) if not g)
        out.append((i, len(q), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(df, **kw):
    rows = substring_dedup.deduplicate(df, **kw).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=str)


def cases():
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(400)] + ["É", "a\xa0b", "x\x1cy"]
    passage = [rnd.choice(vocab) for _ in range(70)]
    rows = []
    for i in range(60):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(0, 160))]
        if i % 3 == 0:
            at = rnd.randint(0, len(words))
            words[at:at] = passage[rnd.randint(0, 10):rnd.randint(50, 70)]
        rows.append((i, rnd.choice([" ", "\n", " \t "]).join(words)))
    rows += [(60 + j, rows[40][1]) for j in range(5)]                      # copies
    rows += [(70 + j, " ".join(rows[41][1].split()[j:])) for j in range(4)]
    rows += [(80, "spam " * 500), (81, "ham " + "spam " * 300), (82, "a b " * 200), (83, "b a " * 100)]
    rows += [(84, None), (85, ""), (86, " \n"), (87, " ".join(passage[:50])), (88, " ".join(passage[:49]))]
    rows += [(None, " ".join(passage)), (None, " ".join(passage) + " end"), (40, rows[40][1]), (90, "a b " * 200),
             (90, "other text with the id of another " + " ".join(passage))]
    return rows


def test_matches_brute_force(documents):
    rows = cases()
    assert run(documents(rows)) == brute(rows, 50)


@pytest.mark.parametrize(("hot", "shard"), [(1, 4), (3, 1000)])
def test_hot_keys_are_dealt_on(documents, hot, shard):
    rows = cases()
    assert run(documents(rows), window=30, hot=hot, shard=shard) == brute(rows, 30)


def test_empty_table_clashing_columns_and_texts(documents):
    assert run(documents([])) == []
    df = documents(cases()[:20])
    for c in ("_d", "_r", "_t", "key", "words", "spans", "n_words", "s", "n"):
        df = df.withColumn(c, F.lit(1))
    assert run(df) == brute(cases()[:20], 50)
    words = " ".join(f"x{i}" for i in range(80))
    kept = substring_dedup.deduplicate(documents([(1, words), (2, "a " + words + " z")]), with_text=True).collect()
    assert {r.doc_id: r.text for r in kept} == {1: words, 2: "a z"}


def test_wavelet_ranks():
    rng = np.random.default_rng(3)
    seq = rng.integers(0, 37, 500)
    w = WaveletMatrix(seq, 36)
    c, i = rng.integers(0, 37, 300), rng.integers(0, 501, 300)
    want = [(seq[:b] == a).sum() for a, b in zip(c, i)]
    assert (w.place(c, i) - w.place(c, np.zeros(300, int))).tolist() == want


def test_matching_statistics():
    rnd = random.Random(4)
    for _ in range(30):
        parts = [[rnd.randint(1, rnd.choice([1, 2, 4])) for _ in range(rnd.randint(1, 30))] for _ in range(rnd.randint(1, 8))]
        owner = np.array([rnd.randint(0, 4) for _ in parts])
        sizes = np.array([len(p) for p in parts])
        text = np.array([x for p in parts for x in [*p, 0]])
        end = np.cumsum(sizes + 1) - 1
        index = FMIndex(text, np.repeat(owner, sizes + 1), int(sizes.max()))
        got = index.matching_statistics(text, end - sizes, end, owner)
        for p, s, o in zip(parts, end - sizes, owner):
            for a in range(len(p)):
                best = 0
                for q, r in zip(parts, owner):
                    if r < o:
                        for b in range(len(q)):
                            k = 0
                            while a + k < len(p) and b + k < len(q) and p[a + k] == q[b + k]:
                                k += 1
                            best = max(best, k)
                assert got[s + a] == best


def test_templates_with_equal_edges_are_spread(spark):
    # 3000 segments share their first and last twenty words; each has its own middle
    head, tail = " ".join(f"h{i}" for i in range(20)), " ".join(f"t{i}" for i in range(20))
    rows = [(i, f"{head} " + " ".join(f"m{i}x{k}" for k in range(10)) + f" {tail}") for i in range(3000)]
    rows += [(5000 + i, rows[i][1]) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = df.select(F.col("doc_id").alias("_d"), F.xxhash64("text").alias("_r"), F.col("text").alias("_t"))
    found = substring_dedup._find_segments(keyed, 50)
    owners = found.groupBy("key", "words").agg(F.min(F.struct("_d", "_r", "s", "n")).alias("o")).select("key", "words", "o.*")
    split = owners.join(owners.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / 100).cast("int").alias("split")), "key")
    largest = (substring_dedup._ship(split, keyed, 50, 40).groupBy("shard").count().agg(F.max("count")).first()[0])
    assert largest <= 400
    got = {r.doc_id: r.n_removed for r in substring_dedup.deduplicate(df, hot=100, shard=100).collect()}
    assert all(got[i] == 0 for i in range(3000)) and all(got[5000 + i] == 50 for i in range(20))
