from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from reelstar.llm import exact_dedup


def brute(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    groups: dict[str, list] = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    out = []
    for i, t in norm:
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def run(df, **kw):
    rows = exact_dedup.duplicates(df, **kw).collect()
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows), key=str)


ROWS = [(1, "a b"), (2, "a \t\n b"), (3, "a  b "), (0, "a\x0bb"), (5, None), (6, ""), (7, "   "), (8, " "),
        (9, "a\xa0b"), (9, "a b"), (10, "x" * 200_000), (11, "x" * 200_000), (None, "a b"), (None, "lonely"),
        (None, "lonely"), (12, "unique"), (13, "a\x1cb"), (1, "a b")]


def test_matches_brute_force(documents):
    assert run(documents(ROWS)) == brute(ROWS)


def test_hot_group_and_tiny_filter(documents, monkeypatch):
    # a filter of 1024 cells suspects nearly all rows; results stay
    monkeypatch.setattr(exact_dedup, "MAX_BITS", 64)
    rows = [(i, "same" if i % 3 == 0 else f"text {i // 2}") for i in range(4000)]
    assert run(documents(rows)) == brute(rows)


def test_empty_table_and_clashing_columns(documents):
    assert run(documents([])) == []
    df = documents(ROWS[:6])
    for c in ("_id", "suspect", "bits", "word", "keep_id", "text_sha256", "group_size"):
        df = df.withColumn(c, F.lit(1))
    assert run(df) == brute(ROWS[:6])


def test_only_suspects_reach_the_grouping(spark, documents):
    df = documents([(i, f"text {i}") for i in range(500)] + [(900, "text 1")])
    hashes = df.select(F.col("doc_id").alias("_id"),
                       F.sha2(exact_dedup.normalised(F.col("text")), 256).alias("text_sha256"))
    bits = exact_dedup.filter_bits(501)
    marked = exact_dedup.mark_suspects(hashes, exact_dedup.repeated_cells(hashes, bits), bits)
    ids = {r._id for r in marked.filter("suspect").collect()}
    assert {1, 900} <= ids and len(ids) < 50


def test_keep_first_defines_ties_and_keeps_columns(spark):
    schema = "doc_id long, text string, lang string, _doc int, text_sha256 string, suspect int"
    rows = [(1, "a b", "y", 1, "q", 0), (1, "a  b", "x", 2, "q", 0), (1, "a  b", "w", 2, "q", 0), (2, "a b", "z", 3, "q", 0),
            (None, "n", "b", 4, None, 1), (None, "n", "a", 4, None, 1), (5, None, "c", 5, None, 1), (6, "", "d", 6, None, 1),
            (7, "alone", "e", 7, None, 1), (8, "alone 2", None, None, None, None), (8, "alone 2", None, None, None, None)]
    want = sorted([rows[2], rows[5], rows[6], rows[8], rows[9]], key=str)
    for order in (rows, rows[::-1]):
        kept = exact_dedup.keep_first(spark.createDataFrame(order, schema))
        assert kept.columns == ["doc_id", "text", "lang", "_doc", "text_sha256", "suspect"]
        assert sorted(map(tuple, kept.collect()), key=str) == want
    assert exact_dedup.keep_first(spark.createDataFrame([], schema)).collect() == []


def test_keep_first_passes_rows_beyond_suspicion_straight_through(spark, documents):
    df = documents([(i, f"text {i}") for i in range(2000)] + [(9000, "text 1")] * 3)
    plan = exact_dedup.keep_first(df)._jdf.queryExecution().executedPlan().toString()
    clear = plan[plan.index("Union"):].split("+- ", 1)[0]
    assert "Exchange" not in clear
    kept = exact_dedup.keep_first(df)
    assert kept.count() == 2000 and kept.filter("doc_id = 9000").count() == 0
    # a third of all rows are one text
    hot = documents([(i, "same" if i % 3 == 0 else f"t {i}") for i in range(6000)])
    assert exact_dedup.keep_first(hot).count() == 4001
