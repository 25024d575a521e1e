"""Quality rules: base limits, then robust outliers by language and source.

Every text gives a vector of statistics, transformed so that ordinary texts lie in
one cloud: logarithms of the number of words, the mean word length, the rate of
symbols, the number of repeated lines and the share of words in repeated windows.
Vectors lie on a grid of ``1 / GRID``, so that sums over any number of rows are whole
numbers and don't depend on their order.

Texts within the base limits fit a minimum covariance determinant estimate for each
(language, source): from two starts, coordinate-wise medians with
quartile ranges and the classical moments, concentration steps take the
``COVERAGE`` share of rows of the least Mahalanobis distance and estimate centre and
covariance anew until nothing changes, ``STEPS`` times at most; the start of the smaller determinant
counts, and rows within its 97.5 % ellipsoid give the final estimate. All rows take
part in every step, as grouped sums by distance bucket; the share is met to
the resolution of a bucket (a sixteenth of an octave of the squared distance). A group of fewer than
``MIN_ROWS`` such texts is judged by the estimate of its language, a language of
fewer by that of all texts.

A text outside the base limits, or whose squared distance is beyond the
chi-squared quantile ``1 - TAIL``, is rejected. Every covariance has ``FLOOR`` squared added to
its diagonal: statistics that are zero in nearly all ordinary texts still have a scale.

Defined results: a null text has no words and fails the base limits; null languages
and sources are groups of their own; null ids and repeated rows pass through, one
row out for each row in; further columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelstar.llm.common import Interner, arrow_batches, ascii_words, blocks, durable, spread_join

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"

GRID = 256
#: Least standard deviation of each transformed statistic.
FLOOR = (0.25, 0.06, 0.5, 0.5, 0.75)
COVERAGE = 0.75
STEPS = 12
MIN_ROWS = 100
TAIL = 1e-7
DIM = len(FLOOR)
PAIRS = list(combinations_with_replacement(range(DIM), 2))
#: Buckets of squared distance per octave.
BUCKETS = 16
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


# --- statistics of texts ------------------------------------------------------

def repeated_words(words: list[list[str]]) -> np.ndarray:
    """For each text, its words in windows of five that it has twice or more."""
    sizes = np.array([len(w) for w in words], np.int64)
    out = np.zeros(len(words), np.int64)
    ids = Interner().slots([w for ws in words for w in ws])
    if not len(ids):
        return out
    owner = np.repeat(np.arange(len(words)), sizes)
    starts = np.flatnonzero(owner[:-WINDOW + 1] == owner[WINDOW - 1:]) if len(ids) >= WINDOW else ids[:0]
    if not len(starts):
        return out
    # ranks of ever longer runs of words: equal ranks are equal runs, exactly
    code = owner[starts]
    for k in range(WINDOW):
        code = np.unique(code * (ids.max() + 1) + ids[starts + k], return_inverse=True)[1]
    twice = starts[np.bincount(code)[code] > 1]
    steps = np.zeros(len(ids) + 1, np.int64)
    np.add.at(steps, twice, 1)
    np.add.at(steps, twice + WINDOW, -1)
    covered = np.cumsum(steps[:-1]) > 0
    return np.bincount(owner[covered], minlength=len(words))


def repeated_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    return len(lines) - len(set(lines))


def measure(texts: list[str]) -> dict[str, list | np.ndarray]:
    words = [ascii_words(t) for t in texts]
    return {"n_words": [len(w) for w in words], "word_chars": [sum(map(len, w)) for w in words],
            "n_symbols": [sum(map(t.count, SYMBOLS)) for t in texts],
            "n_dup_lines": [repeated_lines(t) if "\n" in t else 0 for t in texts],
            "n_repeat_words": repeated_words(words)}


def statistics(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """``(_id, lang, source, statistics, x0..x4, base_failed)``, written once."""
    kind = lambda c: docs.schema[c].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["_t"].tolist()
            for lo, hi in blocks(texts):
                rows = pdf.iloc[lo:hi]
                yield rows[["_id", "lang", "source"]].assign(**measure(texts[lo:hi]))

    schema = f"_id {kind(id_col)}, lang {kind(lang_col)}, source {kind(source_col)}, " + ", ".join(
        f"{s} long" for s in STATISTICS)
    with arrow_batches(docs.sparkSession, 2000):
        read = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                           F.coalesce(F.col(text_col), F.lit("")).alias("_t")).mapInPandas(run, schema)
        failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
        return durable(read.select("*", *[x.alias(f"x{i}") for i, x in enumerate(transformed())],
                                   failed.alias("base_failed")), "statistics")


def transformed() -> list[Column]:
    """The statistic vector in whole grid steps."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    raw = (F.log(words), F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
           F.log1p(F.col("n_symbols") * 100 / words), F.log1p(F.col("n_dup_lines").cast("double")),
           F.log1p(F.col("n_repeat_words") * 100 / words))
    return [F.round(x * GRID).cast("long") for x in raw]


# --- chi-squared --------------------------------------------------------------

def chi2_cdf(x: float, dim: int) -> float:
    """Distribution function, by the recurrence over dimensions."""
    if x <= 0:
        return 0.0
    k, out = (1, math.erf(math.sqrt(x / 2))) if dim % 2 else (2, 1 - math.exp(-x / 2))
    while k < dim:
        out -= math.exp((k / 2) * math.log(x / 2) - x / 2 - math.lgamma(k / 2 + 1))
        k += 2
    return out


def chi2_quantile(p: float, dim: int) -> float:
    lo, hi = 0.0, 1.0
    while chi2_cdf(hi, dim) < p:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, dim) < p else (lo, mid)
    return hi


def consistency(share: float) -> float:
    """Factor that makes the covariance of the ``share`` nearest rows of a
    normal cloud that of all."""
    return share / chi2_cdf(chi2_quantile(share, DIM), DIM + 2)


# --- estimates ----------------------------------------------------------------

ESTIMATE = "n long, centre array<double>, precision array<double>, det double"


def estimates(moments: DataFrame, keys: str, factor: float) -> DataFrame:
    """Centre, inverse covariance and log-determinant from grouped sums ``n, s0.., p00..``."""
    names = [k.split()[0] for k in keys.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n = pdf["n"].to_numpy(float)
            mean = pdf[[f"s{i}" for i in range(DIM)]].to_numpy(float) / n[:, None]
            cov = np.zeros((len(n), DIM, DIM))
            for i, j in PAIRS:
                cov[:, i, j] = cov[:, j, i] = pdf[f"p{i}{j}"].to_numpy(float) / n - mean[:, i] * mean[:, j]
            cov = cov / GRID ** 2 * factor + np.diag(np.square(FLOOR))
            inverse = np.linalg.inv(cov)
            # each pair once, off the diagonal counted twice
            precision = np.stack([inverse[:, i, j] * (1 if i == j else 2) for i, j in PAIRS], 1)
            yield pdf[names].assign(n=pdf["n"], centre=list(mean / GRID), precision=list(precision),
                                    det=np.linalg.slogdet(cov)[1])

    return moments.mapInPandas(run, f"{keys}, {ESTIMATE}")


def squared_distance() -> Column:
    """Of ``x0..`` from ``centre`` under ``precision``."""
    off = [F.col(f"x{i}") / GRID - F.col("centre")[i] for i in range(DIM)]
    return reduce(lambda a, b: a + b, [F.col("precision")[k] * off[i] * off[j] for k, (i, j) in enumerate(PAIRS)])


def sums() -> list[Column]:
    """Whole-number moments of the grid vectors."""
    x = [F.col(f"x{i}") for i in range(DIM)]
    return [F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(x)],
            *[F.sum(x[i] * x[j]).alias(f"p{i}{j}") for i, j in PAIRS]]


MOMENTS = ["n", *[f"s{i}" for i in range(DIM)], *[f"p{i}{j}" for i, j in PAIRS]]


def classical(rows: DataFrame) -> DataFrame:
    return estimates(rows.groupBy("key").agg(*sums()), "key string", 1.0).withColumn("start", F.lit("moments"))


def medians(rows: DataFrame) -> DataFrame:
    """Coordinate-wise medians, with quartile ranges as scales: exact, from counts of grid values."""
    cells = (rows.select("key", F.posexplode(F.array(*[F.col(f"x{i}") for i in range(DIM)])).alias("i", "x"))
             .groupBy("key", "i", "x").agg(F.count(F.lit(1)).alias("c")))
    each = Window.partitionBy("key", "i")
    run = cells.withColumn("upto", F.sum("c").over(each.orderBy("x"))).withColumn("n", F.sum("c").over(each))
    at = lambda share: F.min(F.when(F.col("upto") >= F.col("n") * share, F.col("x")))
    one = run.groupBy("key", "i").agg(F.max("n").alias("n"), *[at(q).alias(f"q{q * 4:.0f}") for q in (.25, .5, .75)])
    # a normal cloud's quartiles lie 1.349 deviations apart
    var = F.pow((F.col("q3") - F.col("q1")) / GRID / 1.349, 2)
    side = one.select("key", "n", F.struct("i", (F.col("q2") / GRID).alias("m"), var.alias("v")).alias("of"))
    flat = side.groupBy("key").agg(F.max("n").alias("n"), F.sort_array(F.collect_list("of")).alias("of"))
    floor = [F.lit(f * f) for f in FLOOR]
    spread = [F.col("of")[i]["v"] + floor[i] for i in range(DIM)]
    return flat.select(
        "key", "n", F.transform("of", lambda o: o["m"]).alias("centre"),
        F.array(*[1 / spread[i] if i == j else F.lit(0.0) for i, j in PAIRS]).alias("precision"),
        reduce(lambda a, b: a + b, [F.log(s) for s in spread]).alias("det"), F.lit("medians").alias("start"))


def _nearest(rows: DataFrame, params: DataFrame, count: int, large: int) -> DataFrame:
    """Moments of the nearest rows of each estimate, to the resolution of a bucket."""
    met = spread_join(rows, params.select("key", "start", "centre", "precision", "total"), "key", count,
                      F.col("total") >= large)
    d2 = F.greatest(squared_distance(), F.lit(1e-9))
    bucket = F.floor(F.log2(d2) * BUCKETS)
    by = met.withColumn("bucket", bucket).groupBy("key", "start", "bucket").agg(*sums(), F.max("total").alias("total"))
    before = (F.sum("n").over(Window.partitionBy("key", "start").orderBy("bucket")) - F.col("n"))
    inside = by.withColumn("before", before).filter(F.col("before") < F.ceil(F.col("total") * COVERAGE))
    return inside.groupBy("key", "start").agg(*[F.sum(m).alias(m) for m in MOMENTS])


def fit(rows: DataFrame) -> DataFrame:
    """``(key, total, centre, precision)`` from ``(keys, x0..)``, one row per key."""
    one = rows.select(F.explode("keys").alias("key"), *[f"x{i}" for i in range(DIM)])
    totals = durable(one.groupBy("key").agg(F.count(F.lit(1)).alias("total")), "totals")
    count = totals.count()
    if not count:
        return rows.sparkSession.createDataFrame([], "key string, total long, centre array<double>, precision array<double>")
    large = max(1000, rows.count() // 1000)
    params = durable(classical(one).unionByName(medians(one).select("key", "n", "centre", "precision", "det", "start"))
                     .join(totals, "key"), "estimates")
    for _ in range(STEPS):
        step = estimates(_nearest(one, params, 2 * count, large), "key string, start string", consistency(COVERAGE))
        new = durable(step.join(totals, "key"), "estimates")
        moved = new.alias("a").join(params.alias("b"), ["key", "start"]).filter("a.centre != b.centre OR a.det != b.det")
        params, settled = new, not moved.take(1)
        if settled:
            break
    best = durable(params.groupBy("key").agg(F.min_by("start", F.struct("det", "start")).alias("start"))
                   .join(params, ["key", "start"]), "best")
    met = spread_join(one, best.select("key", "centre", "precision", "total"), "key", count, F.col("total") >= large)
    near = met.filter(squared_distance() <= chi2_quantile(0.975, DIM)).groupBy("key").agg(*sums())
    final = estimates(near, "key string", consistency(0.975))
    # an estimate none of whose rows lie within its ellipsoid stays as it is
    return durable(best.select("key", "total", F.col("centre").alias("c0"), F.col("precision").alias("p0"))
                   .join(final.select("key", "centre", "precision"), "key", "left")
                   .select("key", "total", F.coalesce("centre", "c0").alias("centre"),
                           F.coalesce("precision", "p0").alias("precision")), "robust")


def key(level: int, *parts: str) -> Column:
    """Text key of a group; JSON tells nulls from empty texts."""
    return F.to_json(F.struct(F.lit(level).alias("level"), *parts))


def judged_by(stats: DataFrame, min_rows: int) -> DataFrame:
    """``(lang, source, n, own, keys)``: which estimate judges a group, and
    which estimates its rows take part in."""
    groups = durable(stats.groupBy("lang", "source").agg(F.sum(F.when(F.col("base_failed"), 0).otherwise(1)).alias("n")),
                     "groups")
    langs = groups.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.min("n").alias("least"))
    both = groups.join(langs.withColumnRenamed("lang", "_l"), F.col("lang").eqNullSafe(F.col("_l"))).drop("_l")
    all_needed = bool(langs.filter((F.col("least") < min_rows) & (F.col("lang_n") < min_rows)).take(1))
    own, lang, whole = key(0, "lang", "source"), key(1, "lang"), key(2)
    enough, lang_enough = F.col("n") >= min_rows, F.col("lang_n") >= min_rows
    lang_used = (F.col("least") < min_rows) & lang_enough
    keys = F.array_compact(F.array(F.when(enough, own), F.when(lang_used, lang), whole if all_needed else F.lit(None)))
    return durable(both.select("lang", "source", "n", F.when(enough, own).when(lang_enough, lang).otherwise(whole)
                               .alias("own"), keys.alias("keys")), "judged")


def by_group(stats: DataFrame, groups: DataFrame, columns: list[str], count: int, large: int) -> DataFrame:
    """Rows with columns of their (lang, source)."""
    marked = stats.withColumn("_g", key(0, "lang", "source"))
    side = groups.select(key(0, "lang", "source").alias("_g"), F.col("n").alias("_n"), *columns)
    return spread_join(marked, side, "_g", count, F.col("_n") >= large).drop("_g", "_n")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", min_rows: int = MIN_ROWS, tail: float = TAIL) -> DataFrame:
    """``(id, statistics, base_failed, distance, estimate, kept)`` for each row."""
    stats = statistics(docs, id_col, text_col, lang_col, source_col)
    groups = judged_by(stats, min_rows)
    count, large = groups.count(), max(1000, stats.count() // 1000)
    vectors = [f"x{i}" for i in range(DIM)]
    rows = by_group(stats.filter(~F.col("base_failed")), groups, ["keys"], count, large).select("keys", *vectors)
    robust = fit(rows)
    chosen = durable(groups.join(robust, groups["own"] == robust["key"], "left")
                     .select("lang", "source", "n", "own", "centre", "precision"), "chosen")
    met = by_group(stats, chosen, ["own", "centre", "precision"], count, large)
    distance = F.when(~F.col("base_failed"), F.round(squared_distance(), 6))
    limit = chi2_quantile(1 - tail, DIM)
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True))
    return (met.withColumn("distance", distance)
            .select(F.col("_id").alias(id_col), *STATISTICS, "base_failed", "distance", F.col("own").alias("estimate"),
                    kept.alias("kept")))
