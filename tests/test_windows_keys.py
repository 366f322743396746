import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators.keys import assign_dense_keys, next_key_start


def assign_keys_in_window(df, order, key_col, prefix=None, start=0):
    """Reference numbering for the tests: one global window (a single task)."""
    number = F.lit(start).cast("long") + F.row_number().over(Window.orderBy(*order)).cast("long")
    key = F.concat(F.lit(prefix), number.cast("string")) if prefix else number
    return df.withColumn(key_col, key)
from starloom.operators.windows import keep_last_by, lead_within_key, nulls_win


def test_dedupe_null_date_wins(spark):
    df = spark.createDataFrame(
        [("x", dt.date(2020, 1, 1), 1), ("x", None, 2), ("x", dt.date(2021, 1, 1), 3)], "k string, d date, id int"
    )
    got = keep_last_by(df, ["k"], nulls_win("d") + [F.col("id")]).collect()
    assert [(r.k, r.d, r.id) for r in got] == [("x", None, 2)]


def test_keep_last_hot_and_null_keys(spark):
    rows = [("hot", i) for i in range(3000)] + [(None, i) for i in range(500)] + [("cold", 7)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(8)
    got = {r.k: r.v for r in keep_last_by(df, ["k"], [F.col("v")]).collect()}
    assert got == {"hot": 2999, None: 499, "cold": 7}


def test_lead_within_key_matches_window_with_hot_key(spark):
    # one key holds most rows, so range partitioning splits it over several partitions
    rows = [("hot", i, i * 10) for i in range(4000)] + [(f"k{i % 50}", i, i) for i in range(1000)]
    rows += [(None, 1, 1), (None, 2, 2)]
    df = spark.createDataFrame(rows, "k string, o int, v int")
    got = lead_within_key(df, "k", [F.col("o")], "v", "nxt", num_partitions=8)
    w = Window.partitionBy("k").orderBy("o")
    ref = df.withColumn("nxt", F.when(F.col("k").isNotNull(), F.lead("v").over(w)))
    assert got.count() == df.count()
    assert got.exceptAll(ref.select(*got.columns)).count() == 0
    assert ref.select(*got.columns).exceptAll(got).count() == 0


def test_dense_keys_equal_window_numbering(spark):
    df = spark.range(0, 20000).select((F.col("id") * 7919 % 20000).alias("a"), (F.col("id") % 13).alias("b"))
    order = [F.asc_nulls_last("b"), F.asc_nulls_last("a")]
    got = assign_dense_keys(df, order, "sk", "SK", num_partitions=7)
    ref = assign_keys_in_window(df, order, "sk", "SK")
    assert got.exceptAll(ref).count() == 0
    assert got.select("sk").distinct().count() == 20000


def test_key_continuation(spark):
    snap = spark.createDataFrame([("CUST7",), ("CUST3",)], "customer_sk string")
    new = spark.createDataFrame([("a",), ("b",)], "k string")
    got = assign_dense_keys(new, [F.col("k")], "customer_sk", "CUST", next_key_start(snap, "customer_sk", "CUST"))
    assert sorted(r.customer_sk for r in got.collect()) == ["CUST8", "CUST9"]


def test_empty_snapshot_starts_at_one(spark):
    snap = spark.createDataFrame([], "customer_sk string")
    new = spark.createDataFrame([("a",), ("b",)], "k string")
    got = assign_dense_keys(new, [F.col("k")], "customer_sk", "CUST", next_key_start(snap, "customer_sk", "CUST"))
    assert sorted(r.customer_sk for r in got.collect()) == ["CUST1", "CUST2"]


def test_malformed_key_raises(spark):
    snap = spark.createDataFrame([("CUST7",), ("CUSTX",)], "customer_sk string")
    new = spark.createDataFrame([("a",)], "k string")
    with pytest.raises(Exception, match="malformed surrogate key"):
        assign_dense_keys(new, [F.col("k")], "customer_sk", "CUST", next_key_start(snap, "customer_sk", "CUST")).collect()


def test_dense_keys_over_thousands_of_partitions(spark):
    """The offsets stay one literal, also where most partitions are empty."""
    df = spark.range(0, 3000).select((F.col("id") * 7 % 3000).alias("a"))
    got = assign_dense_keys(df, [F.col("a")], "sk", None, 10, num_partitions=2500)
    ref = assign_keys_in_window(df, [F.col("a")], "sk", None, 10)
    assert got.exceptAll(ref).count() == 0 and got.count() == 3000
