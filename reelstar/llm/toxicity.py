"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

``fit`` takes at most ``EXAMPLES`` labelled rows (see ``labelled``). Terms are words
and their beginnings, so that inflected forms of a stem meet. All terms whose
frequency differs between the two labels by a chi-squared test become the
vocabulary; their document frequencies are counted over all documents. All other
words count as occurrences of one further term, which nearly every text has: it
holds a text's length against the few telling terms that chance brings. The
examples' normalised TF-IDF vectors go into an inverted index: postings by
term, cut into blocks of consecutive examples with the largest weight of each
term in each block. The index is bounded by the words of ``EXAMPLES`` texts, and is
broadcast.

Each text is cut into words once: ``vectors`` writes the terms of every text and
their counts, from which document frequencies and scores are taken.

A text's query bounds each block by its terms' largest weights and visits blocks
in falling order of that bound until it is below the k-th best cosine found;
blocks left out can't hold a nearer example, so neighbours are exact (ties go to
the example of the smaller place in the index). Queries are worked on together: in
each round every open query of a batch gathers the postings of its next block. Examples of
like vectors stand together, which keeps the bounds tight.

Neighbours vote with their cosine as weight. Shares of the vote are calibrated
by isotonic regression on the examples themselves, each scored without its own
vote, so scores read as probabilities.

Defined results: null and empty texts have no terms, hence no neighbours, and
score the rate of label 1 among all examples; without labelled rows all
scores are 0; null ids and repeated rows pass through; labels and all columns
but the text are no input of a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstar.llm.common import arrow_batches, durable, held_out
from reelstar.llm.labelled import training_rows

EXAMPLES = 12_000
#: Chi-squared value (one degree of freedom) that a term has to reach.
CHI2 = 15.14
MIN_DF = 5
NEIGHBOURS = 25
BLOCK = 64
#: Lengths of the beginnings that count as terms.
BEGINNINGS = (3, 4, 5, 6, 7)
#: Queries and words that a worker remembers, and queries worked on together.
REMEMBERED = 100_000
MEMORY = 500_000
TOGETHER = 256

_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def terms_of(word: str) -> list[str]:
    """A word and its beginnings, the latter with a mark."""
    return [word, *(word[:n] + "~" for n in BEGINNINGS if n <= len(word))]


class Terms(dict):
    """For each word met, the places of its terms in the vocabulary."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= MEMORY:
            self.clear()
        out = self[word] = tuple(v for v in map(self.vocabulary.get, terms_of(word)) if v is not None)
        return out

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Terms in a text, ascending, and how often each occurs; words
        without a term of their own count for the last one."""
        told = list(map(self.__getitem__, words(text)))
        found = Counter(chain.from_iterable(told))
        if others := told.count(()):
            found[len(self.vocabulary)] = others
        at = np.array(sorted(found), np.int64)
        return at, np.array([found[t] for t in at.tolist()], np.float64)


def unit(terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    w = (1 + np.log(counts)) * idf[terms]
    norm = np.sqrt(w @ w)
    return w / norm if norm > 0 else w


class BlockMaxIndex:
    """Postings of unit vectors by term, with block maxima."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK):
        self.block, self.n = block, len(vectors)
        self.n_blocks = -(-self.n // block)
        sizes = [len(t) for t, _ in vectors]
        doc = np.repeat(np.arange(self.n), sizes)
        term = np.concatenate([t for t, _ in vectors]) if vectors else np.zeros(0, np.int64)
        weight = np.concatenate([w for _, w in vectors]) if vectors else np.zeros(0)
        self.maxima = np.zeros((n_terms, self.n_blocks))
        np.maximum.at(self.maxima, (term, doc // block), weight)
        # terms that half of the examples have are kept as rows, not as postings
        self.row = np.full(n_terms, -1)
        common = np.flatnonzero(np.bincount(term, minlength=n_terms) * 2 > max(self.n, 1))
        self.row[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), self.n_blocks, block))
        inside = self.row[term] >= 0
        self.rows[self.row[term[inside]], doc[inside] // block, doc[inside] % block] = weight[inside]
        doc, term, weight = doc[~inside], term[~inside], weight[~inside]
        order = np.lexsort((doc, term))
        self.weight, doc = weight[order], doc[order]
        self.spot = doc % block                               # place within its block
        # where each (term, block) begins among the postings
        cell = term[order] * self.n_blocks + doc // block
        self.starts = np.searchsorted(cell, np.arange(n_terms * self.n_blocks + 1))

    def nearest_all(self, terms: np.ndarray, weights: np.ndarray, offsets: np.ndarray, k: int,
                    skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For each query (a range of ``terms``) the k examples of the largest cosines above zero, without the
        one in ``skip``, and their cosines; places left over hold ``n`` and 0."""
        sizes = np.diff(offsets)
        docs, sims = np.full((len(sizes), k), self.n), np.zeros((len(sizes), k))
        live = np.flatnonzero(sizes)
        if not len(live) or not self.n:
            return docs, sims
        bound = np.zeros((len(sizes), self.n_blocks))
        bound[live] = np.add.reduceat(self.maxima[terms] * weights[:, None], offsets[live], axis=0)
        order = np.argsort(-bound, axis=1, kind="stable")
        held = np.flatnonzero(self.row[terms] >= 0)
        common = np.zeros((len(sizes), len(self.rows)))
        common[np.repeat(np.arange(len(sizes)), sizes)[held], self.row[terms[held]]] = weights[held]
        for turn in range(self.n_blocks):
            block = order[live, turn]
            top, last = bound[live, block], sims[live, -1]
            # queries whose next block can't hold a nearer example are done
            go = (top > 0) & (top >= last - 1e-12)
            live, block, top, last = live[go], block[go], top[go], last[go]
            if not len(live):
                break
            # a tie at best, and ties go to smaller places: left out
            use = (last <= 0) | (top >= last + 1e-12) | (block * self.block <= docs[live, -1])
            self._visit(terms, weights, offsets, sizes, common, live[use], block[use], docs, sims, skip)
        return docs, sims

    def _visit(self, terms: np.ndarray, weights: np.ndarray, offsets: np.ndarray, sizes: np.ndarray,
               common: np.ndarray, query: np.ndarray, block: np.ndarray, docs: np.ndarray, sims: np.ndarray,
               skip: np.ndarray | None) -> None:
        """Take the examples of one block for each query into its best."""
        size = sizes[query]
        own = np.repeat(np.arange(len(query)), size)
        at = np.arange(len(own)) + np.repeat(offsets[query] - (np.cumsum(size) - size), size)
        cell = terms[at] * self.n_blocks + block[own]
        start = self.starts[cell]
        count = self.starts[cell + 1] - start
        there = np.flatnonzero(count)                         # a block has few of a query's terms
        start, count, own, at = start[there], count[there], own[there], at[there]
        posting = np.arange(count.sum()) + np.repeat(start - (np.cumsum(count) - count), count)
        spot = self.spot[posting] + np.repeat(own * self.block, count)
        score = np.bincount(spot, self.weight[posting] * np.repeat(weights[at], count), len(query) * self.block)
        score = score.astype(float).reshape(-1, self.block)   # without any posting they are whole numbers
        for weight, row in zip(common[query].T, self.rows, strict=True):
            score += weight[:, None] * row[block]
        # only queries whose best may change go on
        some = np.flatnonzero(score.max(axis=1) >= np.maximum(sims[query, -1], 1e-12) - 1e-11)
        q, block = query[some], block[some]
        # sums are rounded so that equal vectors tie whatever their order
        score, place = score[some].round(12), block[:, None] * self.block + np.arange(self.block)
        if skip is not None:
            score[place == skip[q][:, None]] = 0
        both = np.hstack([sims[q], score]), np.hstack([docs[q], np.where(score > 0, place, self.n)])
        best = np.lexsort((both[1], -both[0]), axis=1)[:, :sims.shape[1]]
        sims[q], docs[q] = np.take_along_axis(both[0], best, 1), np.take_along_axis(both[1], best, 1)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of the largest cosines above zero (not ``skip``), and their cosines."""
        docs, sims = self.nearest_all(terms, weights, np.array([0, len(terms)]), k, np.array([skip]))
        found = docs[0] < self.n
        return docs[0][found], sims[0][found]


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps of the best rising fit of y to x: left ends and values."""
    at, inverse = np.unique(x, return_inverse=True)
    means: list[list[float]] = []                            # left end, sum, count
    sums, counts = np.bincount(inverse, y, len(at)), np.bincount(inverse, minlength=len(at))
    for left, s, c in zip(at, sums, counts, strict=True):
        means.append([left, s, c])
        while len(means) > 1 and means[-2][1] / means[-2][2] >= means[-1][1] / means[-1][2]:
            _, s2, c2 = means.pop()
            means[-1][1] += s2
            means[-1][2] += c2
    # one pseudo-count of each label keeps scores off 0 and 1
    return np.array([m[0] for m in means]), np.array([(m[1] + 0.5) / (m[2] + 1) for m in means])


@dataclass
class Model:
    vocabulary: dict[str, int]
    idf: np.ndarray
    index: BlockMaxIndex
    ids: np.ndarray
    labels: np.ndarray
    k: int
    base: float
    steps: np.ndarray
    values: np.ndarray

    def votes(self, docs: np.ndarray, sims: np.ndarray) -> np.ndarray:
        """Share of label 1 among each query's neighbours, by cosine; -1 without any."""
        total = sims.sum(axis=1)
        share = (sims * np.append(self.labels, 0.0)[docs]).sum(axis=1) / np.where(total > 0, total, 1)
        return np.where(total > 0, share, -1.0)

    def calibrated(self, share: np.ndarray) -> np.ndarray:
        """Scores for shares of votes; the base rate for -1."""
        if not len(self.values):
            return np.where(share < 0, self.base, 0.0)
        step = np.maximum(np.searchsorted(self.steps, share, "right") - 1, 0)
        return np.where(share < 0, self.base, self.values[step])

    def scores(self, found: list[tuple[np.ndarray, np.ndarray]], known: dict) -> list[tuple[float, list[int], list[float]]]:
        """Score and evidence (ids and cosines of the neighbours) of texts with these terms and counts."""
        weights = [unit(t, c, self.idf) for t, c in found]
        keys = [(t.tobytes(), w.round(9).tobytes()) for (t, _), w in zip(found, weights, strict=True)]
        if len(known) >= REMEMBERED:
            known.clear()
        fresh = {key: i for i, key in enumerate(keys) if key not in known}
        at = list(fresh.values())
        for lo in range(0, len(at), TOGETHER):
            own = at[lo:lo + TOGETHER]
            offsets = np.cumsum([0, *(len(weights[i]) for i in own)])
            docs, sims = self.index.nearest_all(np.concatenate([found[i][0] for i in own]),
                                                np.concatenate([weights[i] for i in own]), offsets, self.k)
            score = self.calibrated(self.votes(docs, sims))
            for i, d, x, y in zip(own, docs, sims, score.tolist(), strict=True):
                n = int(np.searchsorted(-x, 0.0))             # cosines fall; those left over are zero
                known[keys[i]] = (y, self.ids[d[:n]].tolist(), x[:n].tolist())
        return [known[key] for key in keys]


def _place(terms: np.ndarray, weights: np.ndarray, rest: int) -> tuple:
    """Order of the examples in the index."""
    telling = weights[terms < rest]
    if not len(telling):
        return (rest, 0.0)
    best = int(np.argmax(telling))
    return (int(terms[best]), float(-telling[best]))


def choose_terms(rows: DataFrame, chi2: float, min_df: int) -> list[str]:
    """All terms of labelled rows whose presence goes with the label, best first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen: Counter = Counter()
            hits: Counter = Counter()
            for t, y in zip(pdf["_t"], pdf["_y"], strict=True):
                own = {x for w in set(words(t)) for x in terms_of(w)}
                seen.update(own)
                if y:
                    hits.update(own)
            yield pd.DataFrame({"term": list(seen), "df": list(seen.values()), "pos": [hits[w] for w in seen]})

    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("p")).first()
    n, p = totals.n, float(totals.p or 0)
    if not n or not 0 < p < n:
        return []
    found = (rows.select("_t", "_y").mapInPandas(run, "term string, df long, pos long")
             .groupBy("term").agg(F.sum("df").alias("df"), F.sum("pos").alias("pos"))
             .filter(F.col("df") >= min_df).filter(F.col("df") < n))
    # the chi-squared statistic of the table (term, no term) x (label 1, label 0)
    off = F.col("pos") * F.lit(float(n)) - F.col("df") * F.lit(p)
    value = off * off * F.lit(float(n)) / (F.col("df") * (F.lit(n) - F.col("df")) * F.lit(p) * F.lit(n - p))
    top = found.select("term", value.alias("chi2")).filter(F.col("chi2") >= chi2)
    return [r.term for r in top.orderBy(F.desc("chi2"), "term").collect()]


def vectors(docs: DataFrame, vocabulary: dict[str, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_id, terms, counts)`` of each text, written once."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Terms(vocabulary)
        for batch in batches:
            found = [of.counts(t) for t in batch.column(1).to_pylist()]
            offsets = pa.array(np.cumsum([0, *(len(t) for t, _ in found)]), pa.int32())
            flat = lambda k: np.concatenate([f[k] for f in found] or [np.zeros(0)]).astype(np.int64)  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(flat(0), pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(flat(1), pa.int64()))], ["_id", "terms", "counts"])

    read = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    with arrow_batches(docs.sparkSession, 2000):
        return durable(read.mapInArrow(run, f"_id {kind}, terms array<int>, counts array<long>"), "terms")


def document_frequency(found: DataFrame, terms: int) -> tuple[int, np.ndarray]:
    """Number of documents, and in how many each term occurs; all are read. A task
    counts its own documents (-1 for all of them), and only its counts are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(terms, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            df += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=terms)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at]), pa.array(np.r_[n, df[at]])], ["term", "df"])

    df, n = np.zeros(terms, np.int64), 0
    for r in (found.select("terms").mapInArrow(run, "term long, df long").groupBy("term")
              .agg(F.sum("df").alias("df")).collect()):
        if r.term < 0:
            n = r.df
        else:
            df[r.term] = r.df
    return n, df


def _learn(rows: DataFrame, vocabulary: dict[str, int], found: DataFrame, k: int) -> Model:
    """The index of the labelled rows and the calibration of their votes."""
    n, df = document_frequency(found, len(vocabulary) + 1) if vocabulary else (0, np.zeros(1, np.int64))
    idf = np.log((1 + n) / (1 + df)) + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = Terms(vocabulary)
        for pdf in batches:
            found = [of.counts(t) for t in pdf["_t"]]
            yield pd.DataFrame({"_id": pdf["_id"], "_y": pdf["_y"], "terms": [t for t, _ in found],
                                "counts": [c for _, c in found]})

    # vectors of the examples, not their texts: at most ``examples`` rows
    got = (rows.mapInPandas(run, "_id long, _y int, terms array<long>, counts array<double>")
           .orderBy("_id", "_y", "terms", "counts").collect())
    rate = (sum(r._y for r in got) + 0.5) / (len(got) + 1) if got else 0.0
    own = []
    for r in got:
        t = np.array(r.terms, np.int64)
        own.append((t, unit(t, np.array(r.counts), idf), r))
    # like vectors together: by their heaviest telling term, then its weight
    own = [v for v in own if len(v[0])]
    own.sort(key=lambda v: _place(v[0], v[1], len(vocabulary)))
    index = BlockMaxIndex([v[:2] for v in own], len(vocabulary) + 1)
    y = np.array([v[2]._y for v in own], np.float64)
    model = Model(vocabulary, idf, index, np.array([v[2]._id for v in own], np.int64), y, k, float(rate),
                  np.zeros(0), np.zeros(0))
    shares = np.full(len(own), -1.0)
    for lo in range(0, len(own), TOGETHER):
        some = own[lo:lo + TOGETHER]
        offsets = np.cumsum([0, *(len(t) for t, _, _ in some)])
        shares[lo:lo + TOGETHER] = model.votes(*index.nearest_all(
            np.concatenate([v[0] for v in some]), np.concatenate([v[1] for v in some]), offsets, k,
            np.arange(lo, lo + len(some))))
    if (shares >= 0).any():
        model.steps, model.values = isotonic(shares[shares >= 0], y[shares >= 0])
    return model


def _fit(docs: DataFrame, labels: DataFrame, label_col: str, examples: int, k: int, chi2: float, min_df: int,
         id_col: str, text_col: str) -> tuple[Model, DataFrame]:
    with arrow_batches(docs.sparkSession, 2000):
        rows = training_rows(docs, labels, label_col, examples, id_col, text_col)
        vocabulary = {t: i for i, t in enumerate(choose_terms(rows, chi2, min_df))}
        found = vectors(docs, vocabulary, id_col, text_col)
        return _learn(rows, vocabulary, found, k), found


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", examples: int = EXAMPLES,
        k: int = NEIGHBOURS, chi2: float = CHI2, min_df: int = MIN_DF, id_col: str = "doc_id",
        text_col: str = "text") -> Model:
    return _fit(docs, labels, label_col, examples, k, chi2, min_df, id_col, text_col)[0]


def _score(found: DataFrame, model: Model, threshold: float, id_col: str) -> DataFrame:
    spark = found.sparkSession
    kind = found.schema["_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, known = shared.value, {}
        for pdf in batches:
            out = m.scores([(np.asarray(t, np.int64), np.asarray(c, np.float64))
                            for t, c in zip(pdf["terms"], pdf["counts"], strict=True)], known)
            yield pd.DataFrame({"_id": pdf["_id"], "score": [o[0] for o in out], "ids": [o[1] for o in out],
                                "cosines": [o[2] for o in out]})

    scored = found.mapInPandas(run, f"_id {kind}, score double, ids array<long>, cosines array<double>")
    return scored.select(F.col("_id").alias(id_col), held_out(F.col("_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"),
                         F.col("ids").alias("evidence_ids"), F.col("cosines").alias("evidence_cosines"))


def score(docs: DataFrame, model: Model, threshold: float = 0.5, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``(id, held_out, score, predicted, evidence)``; evidence lists the
    neighbours' ids with their cosines."""
    return _score(vectors(docs, model.vocabulary, id_col, text_col), model, threshold, id_col)


def fit_score(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, label_col: str = "toxic",
              examples: int = EXAMPLES, k: int = NEIGHBOURS, chi2: float = CHI2, min_df: int = MIN_DF,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``score`` of the documents that the model is fitted on, cutting each text into words once."""
    model, found = _fit(docs, labels, label_col, examples, k, chi2, min_df, id_col, text_col)
    return _score(found, model, threshold, id_col)
