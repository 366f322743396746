import datetime as dt

from pyspark.sql import functions as F

from starloom.functions.dates import clamp_future, month_name, parse_iso_date, parse_yyyymmdd
from starloom.functions.text import head_tokens, replace_literal, std_upper, strip_ws, tail_tokens, zfill
from starloom.operators.facts import customer_key_prefixed


def col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {typ}")


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(dt.date(2999, 1, 1),), (None,), (dt.date(2001, 1, 1),)], "d date")
    got = [r[0] for r in df.select(clamp_future("d", "2002-01-01")).collect()]
    assert got == [dt.date(2002, 1, 1), None, dt.date(2001, 1, 1)]


def test_only_valid_date_codes_parse(spark):
    df = col(spark, [0, 32154, 5489, 20101229, 20130231], "int")
    got = [r[0] for r in df.select(parse_yyyymmdd("c")).collect()]
    assert got == [None, None, None, dt.date(2010, 12, 29), None]


def test_iso_parse_bad_is_null(spark):
    df = col(spark, ["2020-01-05", "not-a-date", None, " 2020-01-05 "])
    got = [r[0] for r in df.select(parse_iso_date("c")).collect()]
    assert got == [dt.date(2020, 1, 5), None, None, dt.date(2020, 1, 5)]


def test_zfill_never_truncates(spark):
    df = col(spark, ["123", "123456789", "-1", "+12"])
    got = [r[0] for r in df.select(zfill("c", 8)).collect()]
    assert got == ["00000123", "123456789", "-0000001", "+0000012"]


def test_customer_key_padding_batch_wide(spark):
    df = col(spark, ["123", "123456789"]).withColumnRenamed("c", "sls_cust_id")
    got = [r[0] for r in df.select(customer_key_prefixed(df)).collect()]
    assert got == ["AW00000123", "AW123456789"]


def test_customer_key_padding_mixed_prefix(spark):
    df = col(spark, ["AW00000001", "2"]).withColumnRenamed("c", "sls_cust_id")
    ref = [r[0] for r in df.select(customer_key_prefixed(df)).collect()]
    per_row = [r[0] for r in df.select(customer_key_prefixed(df, per_row=True)).collect()]
    assert ref == ["AWAW00000001", "AW00000002"]  # reference: both rewritten
    assert per_row == ["AW00000001", "AW00000002"]


def test_customer_key_padding_all_prefixed_untouched(spark):
    df = col(spark, [" AW00000001", "AW00000002 "]).withColumnRenamed("c", "sls_cust_id")
    got = [r[0] for r in df.select(customer_key_prefixed(df)).collect()]
    assert got == ["AW00000001", "AW00000002"]


def test_category_and_short_key(spark):
    df = col(spark, ["CO-RF-FR-R92B-58", "A-B", "CO", None])
    rows = df.select(head_tokens("c"), tail_tokens("c")).collect()
    assert [tuple(r) for r in rows] == [("CO_RF", "FR-R92B-58"), ("A_B", ""), ("CO", ""), (None, None)]


def test_strip_unicode_whitespace(spark):
    df = col(spark, ["\ta\n", " b　", " c d "])
    got = [r[0] for r in df.select(strip_ws("c")).collect()]
    assert got == ["a", "b", "c d"]
    # F.trim only removes spaces
    assert df.select(F.trim("c")).first()[0] == "\ta\n"


def test_case_and_blank_only_normalise_equal(spark):
    df = spark.createDataFrame([("Ann ", "ANN")], "a string, b string")
    assert df.select(std_upper("a") == std_upper("b")).first()[0]


def test_literal_replace_and_month_name(spark):
    df = spark.createDataFrame([("AW-0001", dt.date(2020, 3, 1))], "k string, d date")
    r = df.select(replace_literal("k", "-", ""), month_name("d")).first()
    assert tuple(r) == ("AW0001", "March")
