import datetime as dt

from pyspark.sql import functions as F

from reelstar.functions import channel_of, parse_event_time, typed_select, utc


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("r")).first().r


def test_event_time_pattern_accepts_one_to_three_fraction_digits(spark):
    assert _one(spark, parse_event_time, "2024-03-01T01:30:00.123Z") == dt.datetime(2024, 3, 1, 1, 30, 0, 123000)
    assert _one(spark, parse_event_time, "2024-03-01T01:30:00.12Z") == dt.datetime(2024, 3, 1, 1, 30, 0, 120000)
    assert _one(spark, parse_event_time, "2024-03-01T01:30:00.1Z") == dt.datetime(2024, 3, 1, 1, 30, 0, 100000)


def test_event_time_pattern_rejects_other_shapes(spark):
    for bad in ("2024-03-01T01:30:00Z", "2024-03-01T01:30:00.123456Z", "2024-03-01T01:30:00.123",
                "junk", None):
        assert _one(spark, parse_event_time, bad) is None, bad


def test_utc_converts_zones_and_keeps_plain_times():
    plain = dt.datetime(2024, 3, 1, 1, 30)
    assert utc(plain) == plain
    assert utc(dt.datetime.fromisoformat("2023-12-02T00:00:00+01:00")) == dt.datetime(2023, 12, 1, 23, 0)


def test_session_zone_does_not_change_results(spark):
    from reelstar.session import configure
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert _one(spark, parse_event_time, "2024-03-01T01:30:00.123Z").hour == 1


def test_channel_rules(spark):
    rows = [("My FaceBook and YouTube clip",), ("YOUTUBE short",), ("other",), (None,)]
    got = [r.c for r in spark.createDataFrame(rows, "t string").select(channel_of("t").alias("c")).collect()]
    assert got == ["Facebook", "YouTube", "Other", "Other"]


def test_typed_select_is_try_cast(spark):
    df = spark.createDataFrame([("1.5", "x"), ("oops", "y")], "a string, b string")
    out = typed_select(df, [("a", "num", "double"), ("b", "name", None)]).collect()
    assert [(r.num, r.name) for r in out] == [(1.5, "x"), (None, "y")]


def test_event_time_is_what_the_pattern_reads(spark):
    from pyspark.sql import functions as F

    from reelstar.functions import EVENT_TIME_PATTERN, parse_event_time
    good = "2024-03-01T01:30:00.123Z"
    odd = [None, "", good, good[:-1], good + " ", " " + good[1:], good.lower(), "2024-02-30T01:30:00.123Z",
           "2024-02-29T23:59:59.999Z", "2023-02-29T00:00:00.000Z", "2024-03-01T24:00:00.000Z", "2024-03-01T23:59:60.000Z",
           "0000-01-01T00:00:00.000Z", "0001-01-01T00:00:00.000Z", "9999-12-31T23:59:59.999Z", "+202-03-01T01:30:00.123Z",
           "-202-03-01T01:30:00.123Z", "+12024-03-01T01:30:00.123Z", "12024-03-01T01:30:00.123Z", "2024- 3-01T01:30:00.123Z",
           "2024-03-01T 1:30:00.123Z", "2024-03-01T01:30:00.1 3Z", "2024-03-01T01:30:00.12ZZ", "2024-03-01 01:30:00.123Z",
           "2024-03-01T01:30:00.1234Z", "2024-03-01T01:30:00Z", "2024-03-01T01:30:00.+12Z", "2024-03-01T01:30:+1.123Z", "2024-03-01T01:30:0Z.123Z", "2024-03-01T01:+1:00.123Z", "2024-03-01T-1:30:00.123Z",
           "２024-03-01T01:30:00.123Z", "2024-03-31T02:30:00.123Z", "1800-01-01T00:00:00.001Z", "not-a-timestamp"]
    df = spark.createDataFrame([(t,) for t in odd], "t string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = df.select("t", parse_event_time("t").cast("double").alias("a"),
                            F.try_to_timestamp("t", F.lit(EVENT_TIME_PATTERN)).cast("double").alias("b")).collect()
            assert [r for r in got if r.a != r.b] == []
            assert sum(r.a is not None for r in got) >= 6
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    # the usual form doesn't wait for the pattern
    plan = df.select(parse_event_time("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "coalesce" in plan and "as timestamp" in plan
