"""What the fact build does per sale: few dates are parsed, not many codes; keys become integers in
the dimensions; runs are sorted by what tells order numbers apart."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.functions.dates import code_of_date, parse_yyyymmdd
from starloom.operators import audit, facts, keys
from starloom.sources import schemas
from tests.test_fact_numbering import fact_rows, numbered, rows_of

DAY = dt.date(2002, 1, 1)


def parser(c):
    return F.try_to_date(F.col(c).cast("string"), "yyyyMMdd")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_codes_are_read_as_the_parser_reads_them(spark):
    ints = [None, 0, 32154, -5, 9990101, 10000101, 20000229, 20010229, 19000229, 20021301, 20020100, 20020001, 20020431, 99991231, 99999999, 120020101, -20020101, -120020101, 2147483647, -2147483648]
    texts = [None, "", "x", "20020101", " 20020101", "20020101 ", "2002 101", "+2002010", "020020101", "-20020101", "2002-01-01", "20020101.0"]
    for kind, values in (("int", ints), ("long", [*ints, 12002010120020101]), ("string", texts), ("double", [20020101.0, None])):
        rows = spark.createDataFrame([(v,) for v in values], f"c {kind}")
        both = rows.select("c", parser("c").alias("a"), parse_yyyymmdd("c").alias("b"))
        assert both.where("NOT (a <=> b)").select(F.col("c").cast("string")).collect() == [], kind
    # days of years with and without a 29th of February, written as codes
    codes = spark.range(18_990_000, 19_050_000).union(spark.range(19_990_000, 20_010_000)).select(F.col("id").cast("int").alias("c"))
    assert codes.where(~parser("c").eqNullSafe(parse_yyyymmdd("c"))).count() == 0


def test_a_date_has_the_code_that_is_read_as_it(spark):
    days = spark.range(-2_000_000, 5_000_000, 7919).select(F.date_add(F.lit(dt.date(1970, 1, 1)), F.col("id").cast("int")).alias("d"))
    back = days.select("d", code_of_date("d").alias("c"))
    assert back.where("c IS NOT NULL").where(~parser("c").eqNullSafe(F.col("d"))).count() == 0
    assert back.where(F.year("d").between(1000, 9999) & F.col("c").isNull()).count() == 0
    assert back.where(F.year("d").between(-999, 999) & F.col("c").isNotNull()).count() == 0


def test_dates_are_looked_up_by_code(spark):
    """The same keys as by date, repeated and missing dates and keys included."""
    dim = spark.createDataFrame([(dt.date(2002, 1, 1), "DATE10"), (dt.date(2002, 1, 1), "DATE9"), (dt.date(2002, 1, 2), "X"), (dt.date(2002, 1, 3), None), (None, "DATE4")], "full_date date, date_sk string")
    codes = [20020101, 20020102, 20020103, 20020104, 0, 32154, 20020230, -20020101, None]
    sales = spark.createDataFrame([(c, codes[i - 1], codes[i - 2]) for i, c in enumerate(codes)], "sls_order_dt int, sls_ship_dt int, sls_due_dt int")
    by_code = facts.lookup_date_sks(sales, dim)
    as_text = [F.col(c).cast("string").alias(c) for c in sales.columns]
    by_date = facts.lookup_date_sks(sales.select(*as_text), dim)
    assert rows_of(by_code.select(*[F.col(c).cast("string") for c in by_code.columns])) == rows_of(by_date)
    assert "gettimestamp" not in plan_of(by_code).lower() and "gettimestamp" in plan_of(by_date).lower()


def dimensions(spark):
    customers = [("AW00000001", "CUST1"), ("AW00000002", "CUST02"), ("AW00000003", None), ("AW00000004", "odd")]
    products = [("A-B-FR-1", "PROD1"), ("A-B-FR-1", None), ("A-B-FR-2", "PROD2"), ("A-B-FR-2", "B"), ("A-B-FR-3", "PROD03"), (None, "PROD9")]
    dates = [(dt.date(2002, 1, d), k) for d, k in ((1, "DATE1"), (2, "DATE02"), (3, None))]
    cust = spark.createDataFrame(customers, "customer_key string, customer_sk string").withColumn("current_flag", F.lit("Y"))
    prod = spark.createDataFrame([(*p, DAY, i) for i, p in enumerate(products)], "product_key string, product_sk string, start_date date, product_id long")
    return cust, prod.withColumn("current_flag", F.lit("Y")), spark.createDataFrame(dates, "full_date date, date_sk string")


def feed(spark):
    rows = [(f"SO{i}" if i % 9 else None, f" FR-{i % 5}", str(i % 6), 20020101 + i % 4, 20020101 + i % 3, 0 if i % 2 else 20020103, 1.0, i % 4, 0.5) for i in range(120)]
    return spark.createDataFrame([*rows, (None,) * 9], schemas.CRM_SALES)


@pytest.mark.parametrize("one_version", [None, "latest_start", "as_of"])
def test_keys_become_integers_in_the_dimensions(spark, one_version):
    """Odd and missing keys of every dimension: the rows of the lookups without keys, and the same
    counts of what was not found."""
    options = {"one_version": one_version}
    plain = facts.build_fact_sales(feed(spark), *dimensions(spark), DAY, with_keys=False, **options)
    packed = facts.build_fact_sales(feed(spark), *dimensions(spark), DAY, packed=True, **options)
    kinds = dict(packed.dtypes)
    assert kinds["customer_sk"] == kinds["due_date_sk"] == "int" and kinds[facts.PRODUCTS] == "array<int>"
    assert rows_of(facts.unpacked_as_text(packed).select(*plain.columns)) == rows_of(plain)
    assert rows_of(facts.unpacked(facts.keys_as_text(packed)).select(*plain.columns)) == rows_of(plain)
    found = []
    for name, frame in (("plain", plain), ("packed", packed)):
        observed, counts = audit.observed_lookups(frame, f"work-{name}-{one_version}")
        observed.write.format("noop").mode("overwrite").save()
        found.append(counts.get)
    assert found[0] == found[1] and found[0]["unmatched_customer"] > 0
    whole = facts.build_fact_sales(feed(spark), *dimensions(spark), DAY, start=7, **options)
    expected = keys.assign_dense_keys(plain, facts.fact_order(), "sales_sk", "SALES", 7)
    assert whole.columns == expected.columns and numbered(whole) == numbered(expected)


def test_runs_are_sorted_by_what_tells_orders_apart(spark, monkeypatch):
    """The sort's first column is a part of the order number, also with rows that have none; those
    are a run of their own after all others."""
    monkeypatch.setattr(keys, "LEAST_RUN_ROWS", 50)
    for some in (False, True):
        orders = [None if some and i % 13 == 0 else "\U0010ffff" if i % 17 == 0 else f"SO{i * 37 % 211}" for i in range(1200)]
        packed = fact_rows(spark, orders)
        got = facts.number_facts(packed, 40, packed)
        sorts = [line.split("Sort [", 1)[1] for line in plan_of(got).splitlines() if "Sort [" in line]
        assert len(sorts) == 1 and not sorts[0].startswith("_spread"), sorts
        expected = numbered(keys.assign_dense_keys(facts.unpacked(packed), facts.fact_order(), "sales_sk", "SALES", 40))
        assert numbered(got) == expected
        assert numbered(got.where("sales_sk <> 'SALES41'")) == expected[1:]
        assert sorted(got.select("sales_sk").toPandas().sales_sk) == sorted(f"SALES{n}" for n, _ in expected)
    only = fact_rows(spark, [None] * 60)
    assert [n for n, _ in numbered(facts.number_facts(only, 0, only))] == list(range(1, facts.unpacked(only).count() + 1))


def test_runs_that_are_not_read_by_bucket_are_numbered_alike(spark, monkeypatch):
    monkeypatch.setattr(keys, "LEAST_RUN_ROWS", 50)
    packed = fact_rows(spark, [None if i % 13 == 0 else f"SO{i * 37 % 211}" for i in range(1200)])
    expected = numbered(keys.assign_dense_keys(facts.unpacked(packed), facts.fact_order(), "sales_sk", "SALES", 40))
    for setting, value in (("spark.sql.requireAllClusterKeysForDistribution", "true"), ("spark.sql.sources.bucketing.enabled", "false")):
        spark.conf.set(setting, value)
        try:
            assert numbered(facts.number_facts(packed, 40, packed)) == expected
        finally:
            spark.conf.unset(setting)
