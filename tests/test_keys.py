import random

import pytest
from conftest import plain
from pyspark.sql import Window
from pyspark.sql import functions as F

from claimweave.operators.keys import (
    align_key,
    co_aggregate,
    duplicate_keys,
    full_outer_using,
    is_in,
    latest_per_key,
    not_in,
    numbering,
    rows_of_duplicates,
    rows_of_singles,
    surrogate_keys,
)


@pytest.mark.parametrize("values", [[], [None], [1, 3], [1, None, 3], [7]])
@pytest.mark.parametrize("probe", [[], [None], [1, 2, 2, None]])
def test_in_and_not_in_follow_sql(spark, probe, values):
    left = spark.createDataFrame([(v,) for v in probe], "k int")
    right = spark.createDataFrame([(v,) for v in values], "v int")
    for operator, text in ((is_in, "in"), (not_in, "not in")):
        expected = spark.sql(f"select * from {{l}} where k {text} (select v from {{r}})", l=left, r=right)
        assert plain(operator(left, "k", right, "v")) == plain(expected)


def test_duplicates_ignore_null(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    assert plain(duplicate_keys(df, "k")) == [(1, 2)]
    assert plain(rows_of_duplicates(df, "k")) == [(1, "a"), (1, "b")]
    assert plain(rows_of_singles(df, "k")) == [(2, "c")]


def test_latest_per_key(spark):
    rows = [
        (1, "2018-07-31 09:00:00", "morning"),
        (1, "2018-07-31 12:30:00", "noon"),
        (1, "2018-07-31 13:30:00", "afternoon"),
        (2, "2018-07-31 12:00:00", "b"),
        (2, "2018-07-31 12:00:00", "a"),
        (2, "2018-07-31 12:00:00", None),
        (3, "not a time", "x"),
        (3, "2001-01-01 00:00:00", "y"),
        (4, None, "only"),
        (None, "2018-07-31 12:00:00", "keyless"),
        (None, "2018-07-30 12:00:00", "keyless before"),
    ]
    df = spark.createDataFrame(rows, "k int, t string, v string")
    result = latest_per_key(df, ["k"], F.try_to_timestamp("t", F.lit("yyyy-MM-dd HH:mm:ss")), ["v"])
    assert result.columns == ["k", "t", "v"]
    assert plain(result) == plain(spark.createDataFrame([rows[2], rows[5], rows[7], rows[8], rows[9]], df.schema))


def test_latest_per_key_is_no_window(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), F.current_timestamp().alias("t"), "id")
    plan = latest_per_key(df, ["k"], F.col("t"), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan


@pytest.mark.parametrize("count", [0, 1, 3000])
def test_surrogate_keys_equal_global_row_number(spark, count):
    random.seed(count)
    # Many names share a prefix, some occur often, one is missing.
    names = [("shared prefix " if random.random() < 0.5 else "") + str(random.randrange(count)) for _ in range(count)]
    names += names[: count // 3] + ([None] if count else [])
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(5)
    expected = df.distinct().select(
        "name", (F.row_number().over(Window.orderBy("name")) + 41).cast("int").alias("key")
    )
    assert plain(surrogate_keys(df, "name", "key", F.lit(41))) == plain(expected)


def test_full_outer_keeps_null_keys_apart(spark):
    left = spark.createDataFrame([(1, "l"), (None, "l")], "k int, a string")
    right = spark.createDataFrame([(1, "r"), (None, "r"), (2, "r")], "k int, b string")
    assert plain(full_outer_using(left, right, ["k"])) == [
        (1, "l", "r"),
        (2, None, "r"),
        (None, "l", None),
        (None, None, "r"),
    ]


def test_co_aggregate_is_a_full_outer_join(spark):
    rows = [(1, "x", "l", 1), (1, "x", "r", 10), (2, None, "l", 2), (2, None, "r", 20), (3, "x", "l", None), (4, "x", "r", 40), (None, None, "r", 50), (5, "x", "o", 9), (6, "x", None, 1)]
    df = spark.createDataFrame(rows, "k int, j string, side string, v int")
    sides = {s: (F.col("side") == s, {s: lambda c: F.sum(c("v"))}) for s in ("l", "r")}
    left, right = (df.where(F.col("side") == s).select("k", "j", F.col("v").cast("bigint").alias(s)) for s in ("l", "r"))
    expected = plain(full_outer_using(left, right, ["k", "j"]))
    assert plain(co_aggregate(df, ["k", "j"], sides)) == expected and len(expected) == 6
    plan = co_aggregate(df, ["k", "j"], sides)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "partial_sum" in plan


@pytest.mark.parametrize("buckets", [1, 2, 64])
def test_numbering_has_no_gaps_for_any_buckets(spark, buckets):
    names = [f"é{k % 7}" if k % 5 == 0 else chr(0x4E00 + k) if k % 5 == 1 else f"n {k}" for k in range(300)] + [None, "", "n 2", "\U0001F600", "\uFFFD"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    found = [r for r in surrogate_keys(df, "name", "key", F.lit(0), numbering(df, "name", buckets)).orderBy("key").collect()]
    assert [r["key"] for r in found] == list(range(1, len(set(names)) + 1))
    assert [r.name for r in found] == [r.name for r in df.distinct().orderBy(F.col("name").asc_nulls_first()).collect()]


def test_align_key(spark):
    texts = spark.createDataFrame([("12",), ("x",), (None,)], "tin string")
    numbers = spark.createDataFrame([(12,)], "tin bigint")
    assert [r[0] for r in align_key(texts, "tin", numbers, "tin").collect()] == [12, None, None]
    assert align_key(numbers, "tin", numbers, "tin") is numbers
