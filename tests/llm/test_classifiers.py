from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelstar.llm import quality, toxicity
from reelstar.llm.common import ship_package


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def corpus(n=500, seed=1):
    """Clean prose, shouting, stutter and marks; some texts with insults."""
    rnd = random.Random(seed)
    syl = "an er the on re ti th ha of in".split()
    word = lambda: "".join(rnd.choice(syl) for _ in range(rnd.randint(1, 3)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rnd.randint(5, 120))]
        bad, kind = rnd.random() < 0.2, rnd.randrange(3)
        toxic = rnd.random() < 0.25
        if toxic:
            for _ in range(rnd.randint(1, 5)):
                words.insert(rnd.randrange(len(words)), rnd.choice(["idiot", "scum", "rotter", "rotten"]))
        if bad:
            words = [[w.upper() + "!!" for w in words], [w + "%%%" for w in words], [words[0]] * len(words)][kind]
            toxic = toxic and kind != 2
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark):
    ship_package(spark)
    rows, labels = corpus()
    docs = spark.createDataFrame([(i, t, "x", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return rows, labels, docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def plain_ftrl(rows, alpha=1.0, beta=1.0, l1=0.3, l2=0.02):
    """The updates one weight at a time, as published: z and n of each feature, weights worked out from them."""
    z, n = {}, {}

    def weight(i):
        bound = 0.0 if i == "intercept" else l1
        zi = z.get(i, 0.0)
        if abs(zi) <= bound:
            return 0.0
        sign = 1.0 if zi > 0 else -1.0
        return -(zi - sign * bound) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + l2)

    for slots, y in rows:
        x = {i: c * quality.SCALE / len(slots) for i, c in Counter(slots).items()} | {"intercept": 1.0}
        w = {i: weight(i) for i in x}
        p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
        for i, v in x.items():
            g = (p - y) * v
            z[i] = z.get(i, 0.0) + g - (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha * w[i]
            n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z if weight(i)}


def test_updates_match_a_plain_loop():
    rows, labels = corpus(150, seed=4)
    texts = [t for _, t in rows] + ["", "the the the the", "Ä ß 漢字 !!! ?"]
    slots, sizes = quality.features(texts)
    cut = [s.tolist() for s in np.split(slots, np.cumsum(sizes)[:-1])]
    ys = [q for _, q, _ in labels] + [1, 0, 1]
    model = quality.Ftrl()
    for own, y in zip(cut, ys, strict=True):
        model.update(np.array(own, np.int64), y)
    want = plain_ftrl(zip(cut, ys, strict=True))
    last = 1 << quality.BITS
    got = model.weight(np.arange(last + 1))
    found = {int(i) if i < last else "intercept": got[i] for i in np.flatnonzero(got)}
    assert len(want) > 20 and set(found) == set(want)
    assert all(math.isclose(found[i], want[i], rel_tol=1e-9, abs_tol=1e-12) for i in want)


def test_training_in_the_job_is_the_plain_loop_over_rows_in_hash_order(tables):
    rows, labels, docs, table = tables
    good = {i: q for i, q, _ in labels}
    order = (docs.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0)
             .orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id", "text").collect())
    cut = [(quality.features([r.text])[0].tolist(), good[r.doc_id]) for r in order]
    want, model = plain_ftrl(cut), quality.fit(docs, table)
    assert math.isclose(model.intercept, want.pop("intercept"), rel_tol=1e-9)
    assert model.slots.tolist() == sorted(want)
    assert np.allclose(model.weights, [want[i] for i in sorted(want)], rtol=1e-9)


def test_quality_on_held_out_rows(tables, documents):
    rows, labels, docs, table = tables
    model = quality.fit(docs, table)
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    assert len(got) == len(rows) and all(got[i].held_out == held(i) for i, _ in rows)
    test = [(got[i].predicted, q) for i, q, _ in labels if held(i)]
    assert np.mean([p == q for p, q in test]) >= 0.97
    # odd rows: empty texts score the intercept, repeated rows and null ids pass through
    odd = documents([(1, None), (2, ""), (2, ""), (None, "the an er")]).withColumn("_id", F.lit(1)).withColumn("score", F.lit(9))
    out = quality.score(odd, model).collect()
    assert len(out) == 4 and {r.score for r in out if r.doc_id} == {1 / (1 + np.exp(-model.intercept))}
    kept = quality.keep(docs, model)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {i for i in got if got[i].predicted}


def test_labels_of_the_held_out_fold_are_never_read(tables, spark):
    _, labels, docs, table = tables
    flipped = spark.createDataFrame([(i, 1 - q if held(i) else q, t) for i, q, t in labels], table.schema)
    a, b = quality.fit(docs, table), quality.fit(docs, flipped)
    assert a.intercept == b.intercept and np.array_equal(a.weights, b.weights)


def test_scores_are_sparse_dot_products():
    texts = ["the an. the an", "", "er er er", "x%%% y", None]
    slots, sizes = quality.features(texts)
    assert sizes.tolist() == [9, 0, 5, 5, 0]
    dense = np.random.default_rng(1).standard_normal(1 << quality.BITS)
    at, want = 0, []
    for n in sizes:
        own = slots[at:at + n]
        at += n
        x = np.bincount(own, minlength=1 << quality.BITS) * (quality.SCALE / n if n else 0)
        want.append(1 / (1 + np.exp(-(x @ dense + 0.3))))
    assert np.allclose(quality.score_texts(texts, dense, 0.3), want)
    # pairs don't reach across texts: scores don't depend on neighbours
    assert np.allclose([quality.score_texts([t], dense, 0.3)[0] for t in texts], want)


def test_no_labels(tables, spark, documents):
    _, _, docs, table = tables
    none = table.limit(0)
    assert {r.score for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    assert quality.score(documents([]), quality.fit(documents([]), none)).collect() == []
    assert toxicity.score(documents([]), toxicity.fit(documents([]), none)).collect() == []


def test_toxicity_on_held_out_rows(tables, documents):
    rows, labels, docs, table = tables
    model = toxicity.fit(docs, table)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    test = [(got[i].predicted, t) for i, _, t in labels if held(i)]
    assert np.mean([p == t for p, t in test]) >= 0.95
    assert all(got[i].held_out == held(i) and 0 <= got[i].score <= 1 for i, _ in rows)
    texts = dict(rows)
    for r in got.values():
        # evidence: examples outside the held-out fold, nearest first
        assert not any(held(i) for i in r.evidence_ids) and all(i in texts for i in r.evidence_ids)
        assert list(r.evidence_cosines) == sorted(r.evidence_cosines, reverse=True)
    odd = documents([(1, None), (2, ""), (2, ""), (None, "idiot")]).withColumn("_id", F.lit(1)).withColumn("ids", F.lit(9))
    out = toxicity.score(odd, model).collect()
    assert len(out) == 4 and all(r.score == model.base and r.evidence_ids == [] for r in out if r.doc_id)


def test_block_max_search_is_exact():
    rng = np.random.default_rng(5)
    vectors = []
    for _ in range(400):
        terms = np.sort(rng.choice(30, rng.integers(1, 6), replace=False))
        w = rng.choice([1.0, 2.0, 3.0], len(terms))
        vectors.append((terms, w / np.sqrt(w @ w)))
    dense = np.zeros((400, 30))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    index = toxicity.BlockMaxIndex(vectors, 30, block=16)
    for q in range(60):
        t, w = vectors[q]
        skip = q if q % 2 else -1
        docs, sims = index.nearest(t, w, 10, skip)
        full = np.round(dense @ dense[q], 12)
        if skip >= 0:
            full[skip] = 0
        best = np.lexsort((np.arange(400), -full))[:10]
        best = best[full[best] > 0]
        assert docs.tolist() == best.tolist() and np.allclose(sims, full[best])


def test_queries_worked_on_together_equal_single_ones():
    rng = np.random.default_rng(6)
    vectors = []
    for _ in range(300):
        terms = np.sort(rng.choice(40, rng.integers(1, 9), replace=False))
        w = rng.choice([1.0, 2.0, 5.0], len(terms))
        vectors.append((terms, w / np.sqrt(w @ w)))
    index = toxicity.BlockMaxIndex(vectors, 41, block=8)
    queries = [vectors[i] for i in range(0, 300, 3)] + [(np.zeros(0, np.int64), np.zeros(0)), (np.array([40]), np.ones(1))]
    offsets = np.cumsum([0, *(len(t) for t, _ in queries)])
    docs, sims = index.nearest_all(np.concatenate([t for t, _ in queries]), np.concatenate([w for _, w in queries]),
                                   offsets, 25)
    for (t, w), d, s in zip(queries, docs, sims, strict=True):
        one = index.nearest(t, w, 25)
        assert d[d < 300].tolist() == one[0].tolist() and s[d < 300].tolist() == one[1].tolist()


def test_very_long_texts(tables, documents):
    _, _, docs, table = tables
    long = documents([(1, "the an er " * 300_000 + "idiot scum"), (2, "idiot " * 200_000), (3, "the an er")])
    bad = {r.doc_id: r for r in toxicity.score(long, toxicity.fit(docs, table)).collect()}
    assert bad[2].predicted == 1 and bad[3].predicted == 0 and len(bad) == 3
    fine = {r.doc_id: r.score for r in quality.score(long, quality.fit(docs, table)).collect()}
    assert len(fine) == 3 and all(0 <= s <= 1 for s in fine.values())


def test_isotonic_rises():
    rng = np.random.default_rng(2)
    x = rng.choice(np.linspace(0, 1, 11), 500)
    steps, values = toxicity.isotonic(x, (rng.random(500) < x).astype(float))
    assert (np.diff(steps) > 0).all() and (np.diff(values) >= -0.5).all() and 0 < values.min() and values.max() < 1


def test_document_frequencies_are_counted_in_the_tasks(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("a row for each term of each text")

    monkeypatch.setattr(F, "explode", refuse)
    rows = [(1, [0, 2, 4]), (2, [4]), (3, []), (None, [2, 4]), (2, [4])]
    found = spark.createDataFrame(rows, "_id long, terms array<int>").repartition(3)
    n, df = toxicity.document_frequency(found, 6)
    assert n == 5 and df.tolist() == [1, 0, 2, 0, 4, 0]
    n, df = toxicity.document_frequency(found.limit(0), 2)
    assert n == 0 and df.tolist() == [0, 0]
