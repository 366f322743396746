import datetime as dt

from pyspark.sql import functions as F

from starloom.operators import incremental
from starloom.operators.facts import lookup_date_sks, lookup_product_sk


def test_null_date_lookup_plain_vs_null_safe(spark):
    dim = spark.createDataFrame(
        [(None, "DATE1"), (None, "DATE2"), (None, "DATE3"), (dt.date(2020, 1, 1), "DATE4")], "full_date date, date_sk string"
    )
    fact = spark.createDataFrame([(0, 20200101, 20200101)], "sls_order_dt int, sls_ship_dt int, sls_due_dt int")
    plain = lookup_date_sks(fact, dim).collect()
    assert len(plain) == 1 and plain[0].order_date_sk is None and plain[0].ship_date_sk == "DATE4"
    assert lookup_date_sks(fact, dim, null_safe=True).count() == 3


def test_product_lookup_fans_out_over_versions(spark):
    dim = spark.createDataFrame(
        [("CO-RF-FR-1", "PROD1", dt.date(2000, 1, 1), 1), ("CO-RF-FR-1", "PROD2", dt.date(2001, 1, 1), 2)],
        "product_key string, product_sk string, start_date date, product_id long",
    )
    fact = spark.createDataFrame([(" FR-1 ",), ("FR-9",)], "sls_prd_key string")
    assert sorted((r.sls_prd_key, r.product_sk) for r in lookup_product_sk(fact, dim).collect()) == [
        ("FR-1", "PROD1"),
        ("FR-1", "PROD2"),
        ("FR-9", None),
    ]
    one = lookup_product_sk(fact, dim, one_version="latest_start").collect()
    assert sorted((r.sls_prd_key, r.product_sk) for r in one) == [("FR-1", "PROD2"), ("FR-9", None)]


def test_watermark_equal_to_date_not_loaded(spark):
    dates = spark.createDataFrame([(dt.date(2020, 1, 1),), (dt.date(2020, 1, 2),), (None,)], "full_date date")
    got = incremental.dates_after_watermark(dates, F.lit(dt.date(2020, 1, 1))).collect()
    assert [r.full_date for r in got] == [dt.date(2020, 1, 2)]


def test_antijoin_keeps_late_dates(spark):
    dates = spark.createDataFrame([(dt.date(2019, 1, 1),), (dt.date(2020, 1, 2),), (None,)], "full_date date")
    loaded = spark.createDataFrame([(dt.date(2020, 1, 1),)], "full_date date")
    got = sorted(r.full_date for r in incremental.dates_not_loaded(dates, loaded).collect())
    assert got == [dt.date(2019, 1, 1), dt.date(2020, 1, 2)]


def test_dim_filter_drops_same_day_new_members(spark):
    opened = spark.createDataFrame(
        [("A", dt.date(2002, 2, 1), True), ("B", dt.date(2002, 2, 1), False)], "k string, effective_date date, new boolean"
    )
    got = incremental.dim_load_filter(opened, F.lit(dt.date(2002, 2, 1))).collect()
    assert [r.k for r in got] == ["B"] and "new" not in got[0].asDict()


def test_fact_filter_null_watermark_loads_all(spark):
    fact = spark.createDataFrame([(dt.date(2002, 1, 1),)], "created_date date")
    assert incremental.fact_load_filter(fact, F.lit(None).cast("date")).count() == 1
    assert incremental.fact_load_filter(fact, F.lit(dt.date(2002, 1, 1))).count() == 0


def test_read_watermarks_defaults(spark):
    control = incremental.empty_control(spark)
    got = {r.table_name: r.watermark for r in incremental.read_watermarks(control, ["a", "b"]).collect()}
    assert got == {"a": dt.date(1900, 1, 1), "b": dt.date(1900, 1, 1)}


def test_csv_scan_nulls_na_tokens_and_keeps_blanks(spark, tmp_path):
    from starloom.sources import schemas
    from starloom.sources.feeds import read_csv_feed

    path = tmp_path / "cats.csv"
    path.write_text("ID,CAT,SUBCAT,MAINTENANCE\nAC_S0, Bikes ,NA,Yes\nAC_S1,null,N/A,\nAC_S2,nan,Road,No\n")
    rows = read_csv_feed(spark, str(path), schemas.ERP_CATEGORY).orderBy("ID").collect()
    assert [tuple(r) for r in rows] == [
        ("AC_S0", " Bikes ", None, "Yes"),
        ("AC_S1", None, None, None),
        ("AC_S2", None, "Road", "No"),
    ]
