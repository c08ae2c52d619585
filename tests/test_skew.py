from pyspark.sql import functions as F

from pulselake.operators.skew import Hot, checked_broadcast, hot_keys, left_join, split_by_keys


def test_a_key_with_a_third_of_the_rows_is_found(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    hot = hot_keys(df, "k", min_rows=100)
    assert hot.keys == [7]
    assert hot.limit == 7500


def test_no_key_is_missed_with_many_hot_ones(spark):
    # 300 keys of 40 rows each among 8,000 single ones; hot means over 1/1000.
    df = spark.range(12_000).select((F.col("id") % 300).alias("k")).union(
        spark.range(1000, 9000).toDF("k"))
    hot = hot_keys(df, "k", min_rows=1, share=0.001)
    assert hot.keys == list(range(300))


def test_small_tables_and_nulls_are_never_hot(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k long")
    assert not hot_keys(df, "k")
    assert hot_keys(df, "k", min_rows=1, share=0.5).keys == [1]
    assert not hot_keys(df.limit(0), "k", min_rows=0)


def test_text_keys(spark):
    df = spark.createDataFrame([("a",)] * 9 + [("b",)], "k string")
    assert hot_keys(df, "k", min_rows=1, share=0.5).keys == ["a"]


def test_split_keeps_every_row(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (2,)], "k long")
    for keys in ([], [2], list(range(2, 1500))):
        cold, hot = split_by_keys(df, "k", keys)
        assert cold.count() + hot.count() == 4
        assert {r.k for r in hot.collect()} == ({2} if keys else set())


def test_split_join_equals_plain_join(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d"), (None, "e")], "k long, v string")
    dim = spark.createDataFrame([(1, "x"), (2, "y")], "k long, w string")
    plain = sorted(map(str, left_join(fact, dim, "k").collect()))
    assert sorted(map(str, left_join(fact, dim, "k", Hot([2, 3], 1)).collect())) == plain
    assert len(plain) == 5


def test_broadcast_only_below_the_bound(spark):
    dim = spark.range(10)

    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(checked_broadcast(dim, 10))
    assert not hinted(checked_broadcast(dim, 9))
