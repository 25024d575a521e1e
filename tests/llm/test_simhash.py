from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from reelstar.llm import simhash


def slow_fingerprint(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w.decode() for w in t.encode().split()]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_roots(fps):
    n = len(fps)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


TEXTS = ["", None, " \n", "One", "one two", "One TWO three", "one two three four", "one  two\tthree\nfour",
         "É é É é", "a\xa0b c d", "x " * 3000, "ÀÉ A Z [ ` { @"]


def test_fingerprint():
    rnd = random.Random(3)
    texts = TEXTS + [" ".join(rnd.choice("ab cd EF gh ij".split()) for _ in range(rnd.randint(1, 40))) for _ in range(50)]
    assert [simhash.fingerprint(t) for t in texts] == [slow_fingerprint(t) for t in texts]


def flipped(rnd, x, k):
    for b in rnd.sample(range(64), k):
        x ^= 1 << b
    return x


@pytest.mark.parametrize("pairwise", [2000, 8, 2])
def test_links_of_one_list(pairwise):
    rnd = random.Random(pairwise)
    base = rnd.getrandbits(64)
    fps = {base}
    for _ in range(150):                               # all share the low four bytes
        x = rnd.choice(sorted(fps))
        for b in rnd.sample(range(32, 64), rnd.randint(1, 5)):
            x ^= 1 << b
        fps.add(x)
    fps = np.array(sorted(fps), np.uint64)
    a, b = simhash.list_links(fps, pairwise=pairwise)
    assert len(a) < len(fps)
    where = {int(x): i for i, x in enumerate(fps)}
    root = simhash._roots(len(fps), np.array([where[int(x)] for x in a], int), np.array([where[int(x)] for x in b], int))
    assert root.tolist() == brute_roots([int(x) for x in fps])


def test_components_of_fingerprints(spark):
    rnd = random.Random(7)
    fps = [rnd.getrandbits(64) for _ in range(150)]
    for _ in range(250):
        fps.append(flipped(rnd, rnd.choice(fps[-40:]), rnd.randint(1, 5)))
    fps = sorted(set(fps))
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    groups = {r.node: r.root for r in simhash.components(simhash.fingerprint_links(df)).collect()}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    want = brute_roots(fps)
    members: dict = {}
    for s, r in zip(signed, want):
        members.setdefault(r, []).append(s)
    for group in members.values():
        assert {groups.get(s, s) for s in group} == {min(group)}


def test_long_chain_and_star(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    chain = [(order[i], order[i + 1]) for i in range(n - 1)]
    star = [(5000, 5001 + i) for i in range(500)]
    df = spark.createDataFrame(chain + star + [(9, 9), (chain[0][1], chain[0][0])], "a long, b long")
    got = {r.node: r.root for r in simhash.components(df).collect()}
    assert got == {i: 0 for i in range(n)} | {5000 + i: 5000 for i in range(501)}


def test_documents(documents):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    base = [" ".join(rnd.choice(vocab) for _ in range(400)) for _ in range(8)]
    rows = list(enumerate(TEXTS))
    for k, t in enumerate(base):
        for j in range(6):
            words = t.split()
            if j:
                words[rnd.randrange(len(words))] = "changed"
            rows.append((100 + 10 * k + j, " ".join(words)))
    rows += [(None, "one two three four"), (None, "alone in a crowd of null ids"), (100, base[0]), (3, "One")]
    got = simhash.near_copies(documents(rows).withColumn("fp", F.lit(0)).withColumn("_id", F.lit(0))).collect()
    fps = [slow_fingerprint(t) for _, t in rows]
    root = brute_roots(fps)
    smallest: dict = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            smallest[r] = min(i, smallest.get(r, i))
    want = sorted(((i, f"{f:016x}", smallest.get(r)) for (i, _), f, r in zip(rows, fps, root)), key=str)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == want


def test_empty_table(documents):
    assert simhash.near_copies(documents([])).collect() == []
