"""Facts are numbered without moving the rows that a sale fans out to, and the feed lands once."""

import datetime as dt
import os

from pyspark.sql import functions as F

from starloom import session
from starloom.operators import audit, facts, keys
from starloom.operators.facts import lookup_product_sk
from starloom.plans.batch import read_warehouse, run_batch
from starloom.plans.context import FEED_NAMES, Scenario
from starloom.sources import derived, ledger, schemas, tables
from starloom.streaming import feed_stream
from tests.paths import SMALL

DIM = "product_key string, product_sk string, start_date date, product_id long"


def product_dim(spark, n):
    """n versions of FR-1 (one without a surrogate key), one of FR-2, one without a key."""
    rows = [("A-B-FR-1", f"PROD{i}" if i else None, None, i) for i in range(n)]
    return spark.createDataFrame([*rows, ("A-B-FR-2", "PROD999", None, 999), (None, "PROD998", None, 998)], DIM)


def sales(spark):
    return spark.createDataFrame([("1", " FR-1"), ("2", "FR-2"), ("2", "FR-2"), ("3", "FR-3"), (None, None)], "sls_ord_num string, sls_prd_key string")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_packed_lookup_is_the_plain_one(spark):
    for n in (1, 3, 64, 150):
        plain = lookup_product_sk(sales(spark), product_dim(spark, n))
        packed = facts.lookup_products_packed(sales(spark), product_dim(spark, n))
        assert rows_of(facts.unpacked(packed).select(*plain.columns)) == rows_of(plain), n
        # at most MOST_PACKED keys move with one row
        assert packed.agg(F.max(F.size(facts.PRODUCTS))).collect()[0][0] <= facts.MOST_PACKED
        assert packed.count() < plain.count() or n == 1
    hot = facts.lookup_products_packed(sales(spark), product_dim(spark, 3), hot={"FR-2": 3})
    assert rows_of(facts.unpacked(hot)) == rows_of(facts.unpacked(facts.lookup_products_packed(sales(spark), product_dim(spark, 3))))


def fact_rows(spark, orders):
    rows = [(o, f"CUST{i % 7}" if i % 11 else None, [f"PROD{i % 5}", f"PROD{i % 3}"] if i % 4 else None, None, f"DATE{i % 3}", "DATE1", i % 6, 1.5, i / 3) for i, o in enumerate(orders)]
    columns = [facts.PRODUCTS if c == "product_sk" else c for c in facts.FACT_COLUMNS]
    kinds = {facts.PRODUCTS: "array<string>", "sls_quantity": "int", "sls_price": "double", "sls_sales": "double"}
    return spark.createDataFrame(rows, ", ".join(f"{c} {kinds.get(c, 'string')}" for c in columns)).withColumn("created_date", F.lit(dt.date(2002, 1, 1)))


def numbered(df):
    return sorted((int(r.sales_sk[5:]), repr(tuple(r)[:-1])) for r in df.collect())


def test_runs_number_like_the_whole_order(spark, monkeypatch):
    """Many runs, null and repeated order numbers, non-ASCII ones: the keys of one sort of all rows."""
    monkeypatch.setattr(keys, "LEAST_RUN_ROWS", 50)
    orders = [None if i % 13 == 0 else "é" if i % 17 == 0 else "\U0001f600" if i % 19 == 0 else f"SO{i * 37 % 211}" for i in range(1200)]
    packed = fact_rows(spark, orders)
    plain = facts.unpacked(packed)
    expected = numbered(keys.assign_dense_keys(plain, facts.fact_order(), "sales_sk", "SALES", 40))
    got = facts.number_facts(packed, 40)
    assert got.columns == [*plain.columns, "sales_sk"]
    assert numbered(got) == expected
    assert got.rdd.getNumPartitions() > 3
    assert numbered(facts.number_facts(plain, 40)) == expected
    # one order number holds too many rows for a task: cut on the whole order
    monkeypatch.setattr(keys, "MOST_RUN_ROWS", 30)
    assert numbered(facts.number_facts(packed, 40)) == expected
    assert numbered(facts.number_facts(packed.limit(0))) == []


def test_expanded_rows_are_neither_staged_nor_shuffled(spark):
    got = facts.number_facts(fact_rows(spark, [f"SO{i}" for i in range(500)]))
    plan = got._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert next(i for i, line in enumerate(lines) if "Generate" in line) < exchange
    assert "Generate" not in "\n".join(lines[exchange:])


def test_runs_of_the_feed_are_staged_as_they_are_numbered(spark, monkeypatch):
    """With the feed's order numbers: the same keys, and no move after the lookups."""
    monkeypatch.setattr(keys, "LEAST_RUN_ROWS", 50)
    orders = [None if i % 13 == 0 else "é" if i % 17 == 0 else f"SO{i * 37 % 211}" for i in range(1200)]
    packed = fact_rows(spark, orders)
    expected = numbered(keys.assign_dense_keys(facts.unpacked(packed), facts.fact_order(), "sales_sk", "SALES", 40))
    tables_before = spark.catalog.listTables()
    got = facts.number_facts(packed, 40, packed)
    assert numbered(got) == expected
    assert got.rdd.getNumPartitions() > 3
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert spark.catalog.listTables() == tables_before
    # too few runs for what the rows stand for, and no rows at all
    monkeypatch.setattr(keys, "MOST_RUN_ROWS", 30)
    assert numbered(facts.number_facts(packed, 40, packed)) == expected
    assert numbered(facts.number_facts(packed.limit(0), 0, packed.limit(0))) == []


def test_keys_move_as_numbers(spark):
    """Keys that are no prefix and number stay what they are; the others are integers."""
    odd = ["CUST1", "CUST01", "X", "", None, "CUST99999999999", "CUST-5", "CUST", "DATE1", "CUST 1", "CUSTCUST1"]
    lists = [["PROD1", None], ["PROD2", "B"], [], None, [None], ["PROD-0"], ["PROD3"], ["PROD03"], [""], ["PROD 1"], ["PROD99999999999"]]
    rows = [("SO1", c, p, "DATE1", d, None, 1, 1.0, 1.0) for c, d, p in zip(odd, reversed(odd), lists, strict=True)]
    packed = fact_rows(spark, []).drop("created_date")
    packed = spark.createDataFrame(rows, packed.schema)
    moved = facts.keys_as_numbers(packed)
    kinds = dict(moved.dtypes)
    assert kinds["customer_sk"] == kinds["due_date_sk"] == "int" and kinds[facts.PRODUCTS] == "array<int>"
    back = facts.keys_as_text(moved)
    assert back.schema.simpleString() == packed.schema.simpleString()
    assert rows_of(back) == rows_of(packed)
    plain = facts.keys_as_numbers(fact_rows(spark, ["SO1"] * 20))
    assert plain.where(F.col(facts._TEXTS).isNotNull()).count() == 0


def test_packed_rows_are_counted_as_what_they_stand_for(spark):
    packed = fact_rows(spark, [f"SO{i}" for i in range(100)])
    counts = []
    for frame in (packed, facts.unpacked(packed)):
        observed, found = audit.observed_lookups(frame, f"lookups-{len(counts)}")
        observed.write.format("noop").mode("overwrite").save()
        counts.append(found.get)
    assert counts[0] == counts[1] and counts[0]["n_rows"] == 175 and counts[0]["unmatched_product"] == 25


def test_sales_of_both_batches_land_once(spark):
    s = Scenario(spark, SMALL)
    for batch in (1, 2):
        plain = derived.crm_sales(s.t, batch)
        landed = s.feed("sales_details", batch)
        assert landed.schema == plain.schema
        assert plain.count() == landed.count() and plain.exceptAll(landed).count() == 0
    assert len({os.path.dirname(f) for b in (1, 2) for f in s.feed("sales_details", b).inputFiles()}) == 1


def test_landed_feed_is_not_landed_again(spark, tmp_path, monkeypatch):
    s, wh = Scenario(spark, SMALL), str(tmp_path / "wh")
    monkeypatch.setattr(tables, "land_feeds", lambda *a: 1 / 0)
    feeds = {n: s.feed(n, 1) for n in FEED_NAMES}
    run_batch(spark, feeds, wh, "2002-01-01", landed=True)
    fact = read_warehouse(spark, wh)["fact_sales"]
    assert fact.count() == fact.select("sales_sk").distinct().count() > 0
    assert [r[0] for r in fact.select("created_date").distinct().collect()] == [dt.date(2002, 1, 1)]


def test_ledger_compares_sales_in_one_move(spark):
    """Equal, null and loaded sales; the feed's rows are shuffled once, by their digest."""
    rows = [("SO1", " FR-1", "7", 20020101, 20020102, 20020103, 1.0, 1, 1.0)] * 3
    rows += [("SO2", None, None, 0, None, 20020103, None, 2, -0.0), ("SO3", "FR-1", "8", 20020105, 0, 0, 2.0, None, float("nan"))]
    feed = spark.createDataFrame(rows, schemas.CRM_SALES)
    keyed = ledger.with_ledger_keys(feed)
    held = keyed.where("sls_ord_num <> 'SO2'").dropDuplicates(["d1", "d2"]).select("d1", "d2", F.lit(1).alias("copies"))
    fresh = ledger.not_loaded(keyed, held)
    assert set(fresh.columns) == {*keyed.columns, "copies"}
    got = {r.sls_ord_num: r for r in fresh.collect()}
    assert {k: r.copies for k, r in got.items()} == {"SO1": 2, "SO2": 1}
    assert got["SO1"].sls_prd_key == "FR-1" and got["SO1"].order_month == 200201 and got["SO1"].order_day == dt.date(2002, 1, 1)
    assert got["SO2"].sls_prd_key is None and got["SO2"].order_day is None and got["SO2"].order_month == 0
    moved = [x for x in fresh._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]
    assert moved and not any("sls_ord_num" in x.split("ENSURE")[0] for x in moved)


def test_stream_does_not_land_dropped_files_again(spark, tmp_path, monkeypatch):
    s = Scenario(spark, SMALL)
    monkeypatch.setattr(tables, "land_feeds", lambda *a: 1 / 0)
    feed_stream.drop_feeds({n: s.feed(n, 1) for n in FEED_NAMES}, f"{tmp_path}/in", derived.BATCH1_DATE)
    feed_stream.run_stream(spark, f"{tmp_path}/in", f"{tmp_path}/wh", f"{tmp_path}/ck")
    plain = str(tmp_path / "plain")
    run_batch(spark, {n: s.feed(n, 1) for n in FEED_NAMES}, plain, derived.BATCH1_DATE, landed=True)
    streamed, batch = (read_warehouse(spark, w)["fact_sales"] for w in (f"{tmp_path}/wh", plain))
    assert streamed.count() == batch.count() > 0 and streamed.exceptAll(batch).count() == 0


def test_staged_as_of_pieces_are_packed(spark):
    Scenario(spark, SMALL)
    from starloom.plans import catalog

    df = catalog.REGISTRY["lookup_product_sk_as_of"](spark, SMALL)
    files = [f for f in df.inputFiles() if "/as-of-" in f]
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_every_run_has_a_task_of_its_own(spark, monkeypatch):
    """Runs do not share buckets: no task has the rows of several while others have none."""
    monkeypatch.setattr(keys, "LEAST_RUN_ROWS", 50)
    packed = fact_rows(spark, [f"SO{1000 + i}" for i in range(4000)])
    got = facts.number_facts(packed, 0, packed)
    sizes = sorted(got.rdd.glom().map(len).collect())
    assert len(sizes) == 8 and sum(sizes) == facts.unpacked(packed).count()
    assert sizes[-1] < 2 * sizes[0]
    for buckets in (1, 7, 90):
        values = spark.createDataFrame([(v,) for v in session.spread_values(spark, buckets)], "v int")
        assert [r[0] for r in values.select(F.pmod(F.hash("v"), F.lit(buckets))).collect()] == list(range(buckets))


def test_shared_starts_of_runs():
    assert keys._shared_starts(["SO1", "SO399", "SO40", "SO41", "T"]) == [2, 2, 3, 0]
    assert keys._shared_starts(["", "SO1"]) == [0]
    assert keys._shared_starts(["SO\u00e91", "SO\u00e92"]) == [2]


def test_count_keys_counts_every_key_once(spark):
    """Repeated, missing, negative and odd keys, and numbers far apart: as a plain count, and
    without moving the keys."""
    some = ["SALES1", "SALES1", None, "SALES01", "SALES0", "SALES-7", "X", "X", "", "SALES32768", "SALES32769", "SALES9999999999", "SALES99999999999999999999"]
    for texts in (some, [None], [], ["X"]):
        rows = spark.createDataFrame([(t,) for t in texts], "k string")
        plain = rows.agg(F.count("*"), F.count_distinct("k"), F.max(keys.key_number("k", "SALES"))).collect()[0]
        assert tuple(keys.count_keys(rows, "k", "SALES").collect()[0]) == tuple(plain), texts
    many = spark.range(1, 100_001).select(F.concat(F.lit("SALES"), "id").alias("k"))
    counted = keys.count_keys(many, "k", "SALES")
    assert tuple(counted.collect()[0]) == (100_000, 100_000, 100_000)
    assert "distinct" not in counted._jdf.queryExecution().executedPlan().toString().lower()
