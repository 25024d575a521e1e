"""Quality rules against plain loops and a plain minimum covariance determinant."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelstar.llm import quality_rules as qr
from reelstar.llm.common import spread_join

SCHEMA = "doc_id long, text string, lang string, source string"


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def vector(s):
    n = max(s[0], 1)
    raw = (math.log(n), math.log(max(s[1], 1) / n), math.log1p(100 * s[2] / n), math.log1p(s[3]), math.log1p(100 * s[4] / n))
    return [math.floor(x * qr.GRID + 0.5) / qr.GRID for x in raw]


def moments(x, factor):
    cov = (x.T @ x / len(x) - np.outer(x.mean(0), x.mean(0))) * factor + np.diag(np.square(qr.FLOOR))
    return x.mean(0), cov


def distances(x, centre, cov):
    return np.einsum("ni,ij,nj->n", x - centre, np.linalg.inv(cov), x - centre)


def quartile(column, share):
    column = sorted(column)
    return column[math.ceil(share * len(column)) - 1]


def plain_estimate(x):
    """Two starts, concentration steps, the smaller determinant, one reweighting."""
    q = lambda s: np.array([quartile(x[:, i], s) for i in range(qr.DIM)])
    starts = {"medians": (q(.5), np.diag(((q(.75) - q(.25)) / 1.349) ** 2 + np.square(qr.FLOOR))),
              "moments": moments(x, 1.0)}
    for name, (centre, cov) in starts.items():
        for _ in range(qr.STEPS):
            bucket = np.floor(np.log2(np.maximum(distances(x, centre, cov), 1e-9)) * qr.BUCKETS)
            last = np.sort(bucket)[math.ceil(len(x) * qr.COVERAGE) - 1]
            centre, cov = moments(x[bucket <= last], qr.consistency(qr.COVERAGE))
        starts[name] = centre, cov
    centre, cov = min((np.linalg.slogdet(c)[1], k, m, c) for k, (m, c) in starts.items())[2:]
    near = x[distances(x, centre, cov) <= qr.chi2_quantile(0.975, qr.DIM)]
    return moments(near, qr.consistency(0.975)) if len(near) else (centre, cov)


def plain_judgement(rows, min_rows):
    stats = [plain_statistics(t) for _, t, _, _ in rows]
    failed = [s[0] < 10 or 100 * s[4] > 20 * s[0] for s in stats]
    x = np.array([vector(s) for s in stats])
    ok = [i for i in range(len(rows)) if not failed[i]]
    members = {}
    for i in ok:
        for k in ((rows[i][2], rows[i][3]), (rows[i][2],), ()):
            members.setdefault(k, []).append(i)
    cache, out = {}, []
    for i, r in enumerate(rows):
        k = next((k for k in ((r[2], r[3]), (r[2],)) if len(members.get(k, ())) >= min_rows), ())
        if failed[i]:
            out.append((stats[i], True, None, False))
            continue
        if k not in cache:
            cache[k] = plain_estimate(x[members[k]])
        d = float(distances(x[i:i + 1], *cache[k])[0])
        out.append((stats[i], False, d, d <= qr.chi2_quantile(1 - qr.TAIL, qr.DIM)))
    return out


def text_of(rng, junk):
    n = rng.choice([3, 9, 12, 40, 90, 200])
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 9))) for _ in range(n)]
    if junk:
        words = [w + "#$%" for w in words]
    if rng.random() < 0.2:
        words[n // 2:] = words[:n - n // 2]
    for i in range(0, n, 11):
        words[i] += rng.choice(["\n", "\n\n", "\t", "  ", "\x1c", "\xa0", ". "])
    return " ".join(words)


def judged(spark, rows, **kw):
    got = qr.judge(spark.createDataFrame(rows, SCHEMA), **kw).collect()
    return {r.doc_id: r for r in got}


def test_equals_plain_version(spark):
    rng = random.Random(3)
    rows = [(i, text_of(rng, rng.random() < 0.15), rng.choice(["en", "en", "de", None]), rng.choice(["a", "a", "b", None]))
            for i in range(400)]
    rows += [(1000, None, "en", "a"), (1001, "", "en", "a"), (1002, " \n\n ", "xx", "q"), (1003, "a b " * 30, "en", "a")]
    got = judged(spark, rows, min_rows=25)
    for r, (stats, failed, d, kept) in zip(rows, plain_judgement(rows, 25), strict=True):
        g = got[r[0]]
        assert tuple(g[s] for s in qr.STATISTICS) == stats
        assert (g.base_failed, g.kept) == (failed, kept)
        assert d is None and g.distance is None or g.distance == pytest.approx(d, rel=1e-6, abs=1e-5)


def test_masked_outliers_are_found_and_clean_texts_stay(spark):
    rng = random.Random(9)
    word = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    clean = [" ".join(word(rng.randint(2, 8)) for _ in range(rng.randint(20, 400))) for _ in range(300)]
    junk = [" ".join(word(rng.randint(2, 8)) + "&&&" for _ in range(rng.randint(50, 100))) for _ in range(60)]
    got = judged(spark, [(i, t, "en", "web") for i, t in enumerate(clean + junk)])
    assert not any(got[i].kept for i in range(300, 360))
    assert sum(got[i].kept for i in range(300)) >= 299


def test_chi_squared():
    # table values of the 95 % and 97.5 % points
    assert qr.chi2_quantile(0.95, 1) == pytest.approx(3.841, abs=1e-3)
    assert qr.chi2_quantile(0.95, 2) == pytest.approx(5.991, abs=1e-3)
    assert qr.chi2_quantile(0.975, 5) == pytest.approx(12.833, abs=1e-3)


def test_repeated_words_of_a_long_text():
    rng = random.Random(1)
    words = [str(rng.randint(0, 9)) for _ in range(3000)]
    assert qr.repeated_words([words, [], ["a"] * 4, ["a"] * 6]).tolist() == [
        plain_statistics(" ".join(words))[4], 0, 0, 6]


def test_repeated_rows_null_ids_clashing_columns_and_empty_table(spark):
    good = "one two three four five six seven eight nine ten eleven"
    rows = [(None, good, "en", "a", 1), (5, good, "en", "a", 2), (5, good, "en", "a", 2)]
    df = spark.createDataFrame(rows, SCHEMA + ", key int").withColumn("x0", F.lit("x")).withColumn("n_words", F.lit("y"))
    got = qr.judge(df).collect()
    assert sorted((r.doc_id is None, r.n_words, r.kept) for r in got) == [(False, 11, True)] * 2 + [(True, 11, True)]
    assert qr.judge(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [r.kept for r in qr.judge(spark.createDataFrame([(1, None, None, None)], SCHEMA)).collect()] == [False]


def test_spread_join_beyond_its_bound_equals_a_join(spark):
    rows = spark.range(1000).selectExpr("if(id < 400, 'hot', cast(id % 50 as string)) AS k", "id")
    side = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    want = sorted(map(tuple, rows.join(side, "k").collect()))
    assert sorted(map(tuple, spread_join(rows, side, "k", 51, F.col("n") >= 100, bound=0).collect())) == want
