from pyspark.sql import functions as F
from hypothesis import given, settings, strategies as st

from reelstar.operators.dedupe import key_violations, latest_per_key


def test_latest_per_key_orders_then_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, "x", 10.0), ("a", 2, "y", 20.0), ("a", 2, "z", 5.0), ("b", None, "q", 1.0),
         ("b", None, "r", 2.0), (None, 1, "n", 0.0), (None, 3, "m", 1.0)],
        "k string, o int, t string, v double")
    out = {r.k: (r.o, r.t, r.v) for r in latest_per_key(df, "k", ["o", "t"]).collect()}
    assert out == {"a": (2, "z", 5.0), "b": (None, "r", 2.0), None: (3, "m", 1.0)}


def test_latest_per_key_keeps_column_order(spark):
    df = spark.createDataFrame([(1, "a", 2)], "x int, k string, o int")
    assert latest_per_key(df, ["k"], ["o"]).columns == ["x", "k", "o"]


def test_non_null_order_beats_null(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2)], "k string, o int, v int")
    assert latest_per_key(df, "k", ["o"]).first().v == 2


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3), st.integers(0, 50)),
                min_size=1, max_size=30))
def test_matches_brute_force_and_is_order_independent(spark, rows):
    df = spark.createDataFrame(rows, "k string, o int, v int")
    expect = {}
    for k, o, v in rows:
        if k not in expect or (o, v) > expect[k]:
            expect[k] = (o, v)
    got = {r.k: (r.o, r.v) for r in latest_per_key(df, "k", ["o"]).collect()}
    assert got == expect
    shuffled = df.repartition(3, F.rand(7))
    assert {r.k: (r.o, r.v) for r in latest_per_key(shuffled, "k", ["o"]).collect()} == expect


def test_key_violations(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [r.k for r in key_violations(df, ["k"]).collect()] == [1]
