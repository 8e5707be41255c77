import datetime as dt

from pyspark.sql import functions as F

from strata.functions import scalars as S
from strata.functions.exact import avg_fixed, sum_fixed


def test_epoch_to_date_edges(spark):
    df = spark.createDataFrame([(0,), (-1,), (1700006400,), (None,), (-86400,), (-86401,)], "s bigint")
    out = df.select("s", S.epoch_to_date("s").alias("d")).collect()
    got = {r.s: r.d for r in out}
    assert got[0] == dt.date(1970, 1, 1)
    assert got[-1] == dt.date(1969, 12, 31)
    assert got[1700006400] == dt.date(2023, 11, 15)
    assert got[None] is None
    assert got[-86400] == dt.date(1969, 12, 31)
    assert got[-86401] == dt.date(1969, 12, 30)


def test_epoch_to_date_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        d = spark.range(1).select(S.epoch_to_date(F.lit(1700006400)).alias("d")).first().d
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert d == dt.date(2023, 11, 15)


def test_review_repair_chain(spark):
    data = [(70.0, 0, 1), (95.0, 0, 0), (0.0, 9, 0), (50.0, None, 0), (None, 0, 0), (80.0, 12, 12),
            (94.99, 0, 1), (0.0, 0, 0)]
    df = spark.createDataFrame([(r, n) for r, n, _ in data], "rating double, n bigint")
    got = [r.x for r in df.select(S.repaired_review_count("n", "rating").alias("x")).collect()]
    assert got == [e for _, _, e in data]


def test_zero_if_null_and_id(spark):
    df = spark.createDataFrame([(None,), (3,), (300,)], "x bigint")
    assert [r[0] for r in df.select(S.zero_if_null("x")).collect()] == [0, 3, 300]
    assert df.select(S.as_id("x")).schema[0].dataType.simpleString() == "bigint"


def test_week_numbers_and_leap(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2023, 1, 1),), (dt.date(2024, 2, 29),),
                                (dt.date(2023, 3, 1),)], "d date")
    out = df.select(S.week_of_year_jan1("d").alias("w"), S.is_leap_year("d").alias("l"),
                    S.weekday_monday1("d").alias("dow")).collect()
    assert [r.w for r in out] == [53, 1, 9, 10]
    assert [r.l for r in out] == [True, False, True, False]
    assert [r.dow for r in out] == [1, 7, 4, 3]


def test_exact_fixed_decimal_sums(spark):
    vals = [0.1] * 10 + [0.2] * 5 + [None]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(7)
    r = df.agg(sum_fixed(F.col("x")).alias("s"), avg_fixed(F.col("x")).alias("a")).first()
    assert r.s == 2.0
    assert r.a == 2.0 / 15
    empty = df.filter("x is null").agg(avg_fixed(F.col("x")).alias("a")).first()
    assert empty.a is None


def test_timestamp_to_epoch_any_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),), (dt.datetime(1969, 12, 31, 23, 59, 59),)],
                               "ts timestamp_ntz")
    for tz in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", tz)
        try:
            got = [r[0] for r in df.select(S.timestamp_to_epoch("ts")).collect()]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == [1704067207, -1], tz


def test_partition_settings_scale():
    from strata.session import partition_settings

    big = partition_settings(100 * 1024 ** 4, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 416000
    small = partition_settings(10 * 1024 ** 2, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_get_spark_applies_sizing(spark):
    from strata.session import get_spark, partition_settings

    keys = list(partition_settings(1, 1))
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        s = get_spark(input_bytes=10 * 1024 ** 3, total_cores=8)  # reuses the running session
        assert s.conf.get("spark.sql.shuffle.partitions") == "40"
        assert s.conf.get("spark.sql.files.maxPartitionBytes") == str(512 * 1024 ** 2)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
