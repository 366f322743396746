import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators import scd2
from starloom.sources import schemas

D1, D2 = dt.date(2002, 1, 1), dt.date(2002, 2, 1)
FEED = (
    "customer_id long, customer_key string, first_name string, last_name string, gender string, "
    "marital_status string, birth_date string, country string, customer_create_date date"
)


def feed(spark, rows):
    return spark.createDataFrame(rows, FEED)


def member(k, first="Ann", country="X", bdate="1980-01-01", cid=1):
    return (cid, k, first, "Lee", "F", "S", bdate, country, dt.date(2001, 1, 1))


@pytest.fixture()
def snap1(spark):
    return scd2.initial_load(feed(spark, [member("A"), member("B", cid=2), member("C", country=None, cid=3)]), scd2.CUSTOMER, D1)


def kinds(delta):
    return {r.customer_key: r.change_kind for r in delta.classified.collect()}


def test_initial_load(snap1):
    rows = snap1.collect()
    assert {r.current_flag for r in rows} == {"Y"}
    assert {r.effective_date for r in rows} == {D1}
    assert all(r.end_date is None for r in rows)
    assert sorted(r.customer_sk for r in rows) == ["CUST1", "CUST2", "CUST3"]


def test_case_blank_only_edit_is_not_a_change(spark, snap1):
    d = scd2.apply_batch(snap1, feed(spark, [member("A", first=" ANN "), member("B", cid=2)]), scd2.CUSTOMER, D2)
    assert kinds(d) == {"A": "same", "B": "same"}
    assert d.opened.count() == 0 and d.closed.count() == 0


def test_null_vs_null_same_null_vs_value_changed(spark, snap1):
    d = scd2.apply_batch(
        snap1, feed(spark, [member("C", country=None, cid=3), member("A", country=None)]), scd2.CUSTOMER, D2
    )
    assert kinds(d) == {"C": "same", "A": "changed"}


def test_birth_date_compared_as_date(spark, snap1):
    d = scd2.apply_batch(snap1, feed(spark, [member("A", bdate=" 1980-01-01 "), member("B", bdate="junk", cid=2)]), scd2.CUSTOMER, D2)
    assert kinds(d) == {"A": "same", "B": "changed"}


def test_change_closes_and_opens_abutting_version(spark, snap1):
    d = scd2.apply_batch(snap1, feed(spark, [member("A", country="Y"), member("Z", cid=9)]), scd2.CUSTOMER, D2)
    closed = d.closed.collect()
    assert [(r.customer_key, r.end_date, r.current_flag) for r in closed] == [("A", D2, "N")]
    opened = {r.customer_key: r for r in d.opened.collect()}
    assert opened["A"].effective_date == D2 and opened["A"].new is False
    assert opened["Z"].new is True
    assert sorted(r.customer_sk for r in opened.values()) == ["CUST4", "CUST5"]
    merged = d.merged.collect()
    assert len(merged) == 5
    # invariants: one current version per key, unique keys
    cur = [r.customer_key for r in merged if r.current_flag == "Y"]
    assert sorted(cur) == ["A", "B", "C", "Z"]
    assert len({r.customer_sk for r in merged}) == 5


def test_second_change_same_day_zero_length(spark, snap1):
    d = scd2.apply_batch(snap1, feed(spark, [member("A", country="Y")]), scd2.CUSTOMER, D2)
    d2 = scd2.apply_batch(d.merged, feed(spark, [member("A", country="Q")]), scd2.CUSTOMER, D2)
    a = sorted(
        ((r.effective_date, r.end_date, r.current_flag) for r in d2.merged.collect() if r.customer_key == "A"),
        key=lambda t: (t[0], t[1] or dt.date.max),
    )
    assert a == [(D1, D2, "N"), (D2, D2, "N"), (D2, None, "Y")]


def test_closed_member_ignored_or_reopened(spark, snap1):
    dormant = snap1.withColumn("current_flag", F.when(F.col("customer_key") == "B", "N").otherwise(F.col("current_flag")))
    f = feed(spark, [member("B", country="NEW", cid=2)])
    d = scd2.apply_batch(dormant, f, scd2.CUSTOMER, D2)
    assert kinds(d) == {"B": "ignore"} and d.opened.count() == 0
    d2 = scd2.apply_batch(dormant, f, scd2.CUSTOMER, D2, reopen=True)
    assert [(r.customer_key, r.new) for r in d2.opened.collect()] == [("B", False)]


def test_apply_twice_is_noop(spark, snap1):
    f = feed(spark, [member("A", country="Y"), member("Z", cid=9), member("B", cid=2)])
    d = scd2.apply_batch(snap1, f, scd2.CUSTOMER, D2)
    again = scd2.apply_batch(d.merged, f, scd2.CUSTOMER, D2)
    assert again.opened.count() == 0 and again.closed.count() == 0
    assert again.merged.exceptAll(d.merged).count() == 0


def test_null_natural_key_is_one_member(spark, snap1):
    d = scd2.apply_batch(snap1, feed(spark, [member(None, cid=5)]), scd2.CUSTOMER, D2)
    assert [r.change_kind for r in d.classified.collect()] == ["new"]
    again = scd2.apply_batch(d.merged, feed(spark, [member(None, cid=5)]), scd2.CUSTOMER, D2)
    assert [r.change_kind for r in again.classified.collect()] == ["same"]
    assert again.opened.count() == 0


def test_product_cost_numeric_compare(spark):
    rows = [(1, "AC-S0-FR-1", "P", 10.0, "M", "Bikes", "S", "Yes", dt.date(2000, 1, 1), None)]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.DIM_PRODUCT.fields[:10])
    f1 = spark.createDataFrame(rows, schema)
    snap = scd2.initial_load(f1, scd2.PRODUCT, D1)
    same = scd2.apply_batch(snap, f1, scd2.PRODUCT, D2)
    assert [r.change_kind for r in same.classified.collect()] == ["same"]
    f2 = f1.withColumn("product_cost", F.lit(11.0))
    changed = scd2.apply_batch(snap, f2, scd2.PRODUCT, D2)
    assert [r.change_kind for r in changed.classified.collect()] == ["changed"]
    assert [r.end_date_history for r in changed.closed.collect()] == [D2]
