"""Hot keys and as-of lookups against plain joins and a plain loop."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starloom.operators import asof, facts, skew
from starloom.operators.asof import as_of
from starloom.session import write_staged
from starloom.sources import schemas


def sales_of(spark, customers, products=None):
    rows = [(f"SO{i}", (products or ["P"])[i % len(products or ["P"])], c, 19980101, 19980105, 0, 1.0, 1, float(i)) for i, c in enumerate(customers)]
    return spark.createDataFrame(rows, schemas.CRM_SALES)


def test_profile_names_hot_keys(spark):
    customers = ["7"] * 3000 + [str(i) for i in range(100, 6100)]
    sales = sales_of(spark, customers, ["hot", "hot", "a", "b"])
    found = skew.profile_sales(sales, "AW")
    assert (found.n_rows, found.all_prefixed, found.latest_order) == (9000, False, dt.date(1998, 1, 1))
    assert set(found.hot_customers) == {"7"} and found.hot_customers["7"] >= 5
    assert {"hot", "a", "b"} == set(found.hot_products) and found.hot_products["hot"] > found.hot_products["a"]
    empty = skew.profile_sales(sales.limit(0), "AW")
    assert (empty.n_rows, empty.all_prefixed, empty.latest_order, empty.hot_customers) == (0, True, None, {})


def test_salted_lookup_spreads_a_hot_key(spark):
    """A third of the rows on one id: the same result, and no task far above the others."""
    customers = ["7"] * 3000 + [str(i % 900 + 100) for i in range(6000)] + [None] * 5
    sales = sales_of(spark, customers)
    dim = spark.createDataFrame([(f"AW{i:08d}", f"CUST{i}") for i in [7, *range(100, 1000, 2)]], "customer_key string, customer_sk string")
    padded = sales.withColumn("sls_cust_id", facts.customer_key_prefixed(sales, all_prefixed=False))
    hot = {facts.padded_id(k, False, False): n for k, n in skew.profile_sales(sales, "AW").hot_customers.items()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain, salted = (facts.lookup_customer_sk(padded, dim, h) for h in (None, hot))
        assert salted.columns == plain.columns
        assert plain.exceptAll(salted).count() == 0 and plain.count() == salted.count() == len(customers)
        sizes = {}
        for name, frame in (("plain", plain), ("salted", salted)):
            sizes[name] = sorted(r["count"] for r in frame.groupBy(F.spark_partition_id()).count().collect())
        assert sizes["plain"][-1] > 3 * sizes["plain"][len(sizes["plain"]) // 2]
        assert sizes["salted"][-1] < 2 * sizes["salted"][len(sizes["salted"]) // 2]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def plain_as_of(rows, versions):
    out = []
    for k, t, n in rows:
        found = [(s, tie if tie is not None else -1, v) for key, s, tie, v in versions if k is not None and t is not None and key == k and s is not None and s <= t]
        out.append((k, t, n, max(found)[2] if found else None))
    return Counter(out)


@pytest.mark.parametrize("seed", range(3))
def test_as_of_matches_a_plain_loop(spark, seed):
    """A hot key over all ranges, ties, missing keys and times."""
    rng = random.Random(seed)
    day = lambda: rng.choice([None, *[dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 300)) for _ in range(9)]])
    key = lambda: rng.choice(["hot", "hot", "a", "b", None, "no versions"])
    rows = [(key(), day(), n) for n in range(900)]
    versions = [(rng.choice(["hot", "a", "b", "c", None]), day(), n % 7, f"v{n}") for n in range(60)]
    versions = list({(k, s, t): (k, s, t, v) for k, s, t, v in versions}.values())
    left = spark.createDataFrame(rows, "k string, t date, n int")
    right = spark.createDataFrame(versions, "vk string, since date, tie int, v string")
    got = as_of(left, F.col("k"), F.col("t"), right, F.col("vk"), F.col("since"), F.col("tie"), "v")
    assert got.columns == ["k", "t", "n", "v"]
    assert Counter(map(tuple, got.collect())) == plain_as_of(rows, versions)
    assert as_of(left.limit(0), F.col("k"), F.col("t"), right, F.col("vk"), F.col("since"), F.col("tie"), "v").count() == 0


def test_as_of_plan_has_no_pairwise_join(spark):
    left = spark.createDataFrame([("a", dt.date(2020, 1, 1))], "k string, t date")
    right = spark.createDataFrame([("a", dt.date(2019, 1, 1), 1, "v")], "vk string, since date, tie int, v string")
    got = as_of(left, F.col("k"), F.col("t"), right, F.col("vk"), F.col("since"), F.col("tie"), "v")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert got.collect()[0].v == "v"


def test_as_of_pieces_move_once(spark, monkeypatch):
    """The events are shuffled once before they are staged, and a hot key spans several ranges."""
    staged = []

    def recorded(df, path):
        staged.append((df._jdf.queryExecution().executedPlan().toString(), write_staged(df, path)))
        return staged[-1][1]

    monkeypatch.setattr(asof, "write_staged", recorded)
    left = spark.range(4000).select(F.lit("hot").alias("k"), F.lit(dt.date(2020, 1, 2)).alias("t"), "id")
    right = spark.createDataFrame([("hot", dt.date(2020, 1, 1), 1, "v")], "vk string, since date, tie int, v string")
    got = as_of(left, F.col("k"), F.col("t"), right, F.col("vk"), F.col("since"), F.col("tie"), "v")
    assert got.where("v = 'v'").count() == 4000
    plan, events = staged[0]
    assert plan.split("Initial Plan")[-1].count("Exchange ") == 1
    sizes = [r["count"] for r in events.groupBy("_asof_p").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 2000
