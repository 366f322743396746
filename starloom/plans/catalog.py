"""Registered queries: one per operator of the inventory. Each takes
``(spark, sf_dir)`` and returns a DataFrame over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import clamp_future, parse_iso_date, parse_yyyymmdd
from starloom.functions.text import head_tokens, std_upper, strip_ws
from starloom.operators import audit, conform, facts, incremental, scd2, skew
from starloom.operators.keys import assign_dense_keys, count_keys, key_number, next_key_start
from starloom.plans.batch import BatchOptions, StoppedBeforeCommit, read_warehouse, run_batch, run_csv_batch
from starloom.plans.context import FEED_NAMES, Scenario, loaded_warehouse
from starloom.session import scratch_path
from starloom.sources import feeds as feeds_io
from starloom.sources import dimensions, ledger, schemas, tables
from starloom.sources.derived import BATCH1_DATE, BATCH2_DATE

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: Callable[[Scenario], DataFrame]) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Scenario(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run

    return deco


# ---- scalar / cleaning -----------------------------------------------------------------


@query("std_text")
def _std_text(s: Scenario) -> DataFrame:
    """Unicode strip, upper-case, and the normalised compare form."""
    f = s.feed("customer_info", 2)
    return f.select(
        "cst_id",
        strip_ws("cst_key").alias("customer_key"),
        strip_ws("cst_firstname").alias("first_name"),
        strip_ws("cst_lastname").alias("last_name"),
        F.upper("cst_gndr").alias("gender"),
        F.upper("cst_marital_status").alias("marital_status"),
        std_upper("cst_firstname").alias("first_name_norm"),
    )


@query("safe_date_parse")
def _safe_date_parse(s: Scenario) -> DataFrame:
    """text -> DATE, bad -> NULL."""
    f = s.feed("customer_info", 2)
    return f.select("cst_id", "cst_create_date", parse_iso_date("cst_create_date").alias("create_date"))


@query("yyyymmdd_parse")
def _yyyymmdd_parse(s: Scenario) -> DataFrame:
    """integer YYYYMMDD codes -> DATE, bad codes -> NULL."""
    f = s.feed("sales_details", 2)
    return f.select(
        "sls_ord_num",
        "sls_order_dt",
        "sls_ship_dt",
        "sls_due_dt",
        parse_yyyymmdd("sls_order_dt").alias("order_date"),
        parse_yyyymmdd("sls_ship_dt").alias("ship_date"),
        parse_yyyymmdd("sls_due_dt").alias("due_date"),
    )


@query("clamp_future_dates")
def _clamp(s: Scenario) -> DataFrame:
    """Dates after the processing date become it; NULL stays NULL."""
    f = s.feed("customer_info", 2).select("cst_id", parse_iso_date("cst_create_date").alias("create_date"))
    return f.select("cst_id", "create_date", clamp_future("create_date", BATCH2_DATE).alias("create_date_clamped"))


@query("derive_category_key")
def _category_key(s: Scenario) -> DataFrame:
    """first two key tokens joined with '_'."""
    f = s.feed("product_info", 2)
    return f.select("prd_id", "prd_key", head_tokens("prd_key", "-", 2, "_").alias("cat_id"))


@query("derive_short_product_key")
def _short_key(s: Scenario) -> DataFrame:
    """key without its first two tokens."""
    f = s.feed("product_info", 2)
    return f.select("prd_id", "prd_key", facts.short_product_key("prd_key").alias("short_key"))


@query("pad_customer_key")
def _pad_key(s: Scenario) -> DataFrame:
    """F6-F8 + A3: batch-wide prefix decision, zfill that never truncates."""
    f = s.feed("sales_details", 2)
    return f.select(
        "sls_ord_num",
        "sls_cust_id",
        facts.customer_key_prefixed(f).alias("customer_key"),
        facts.customer_key_prefixed(f, per_row=True).alias("customer_key_per_row"),
    )


# ---- conform ----------------------------------------------------------------------------


@query("conform_customer")
def _conform_customer(s: Scenario) -> DataFrame:
    """J1, J2, standardise, parse + clamp."""
    return conform.conform_customer(
        s.feed("customer_info", 2), s.feed("customer", 2), s.feed("customer_location", 2), BATCH2_DATE
    )


@query("dedupe_latest_customer")
def _dedupe(s: Scenario) -> DataFrame:
    """Keep-last per key, NULL date wins, ties to the larger id."""
    return s.customers(2)


@query("product_validity")
def _validity(s: Scenario) -> DataFrame:
    """End date replaced by the next start of the same product key."""
    return conform.product_validity(s.feed("product_info", 2))


@query("conform_product")
def _conform_product(s: Scenario) -> DataFrame:
    """C2 up to SCD2: validity + category join + standardise."""
    return s.products(2)


@query("dim_date_build")
def _dim_date(s: Scenario) -> DataFrame:
    """Distinct role-playing dates, parts, calendar-ordered keys."""
    return conform.dim_date_build(s.feed("sales_details", 2))


@query("dim_date_with_unparsed")
def _dim_date_unparsed(s: Scenario) -> DataFrame:
    """C3 in reference mode: one NULL-date row per distinct unparseable code."""
    return conform.dim_date_build(s.feed("sales_details", 2), keep_unparsed=True)


# ---- keys ---------------------------------------------------------------------------------


@query("sk_assign_customer")
def _sk_customer(s: Scenario) -> DataFrame:
    """K1: CUST<n> in create-date order on the initial load."""
    return s.customer_snapshot_full.select("customer_key", "customer_id", "customer_sk")


@query("sk_assign_date")
def _sk_date(s: Scenario) -> DataFrame:
    """K2: DATE<n> for all dates."""
    return s.dim_date_full.select("full_date", "date_sk")


@query("sk_assign_fact")
def _sk_fact(s: Scenario) -> DataFrame:
    """K2 at fact scale: SALES<n> over every feed column (range-partitioned numbering)."""
    f = s.feed("sales_details", 2)
    return assign_dense_keys(f, [F.asc_nulls_last(c) for c in f.columns], "sales_sk", "SALES")


@query("sk_continue_sequence")
def _sk_continue(s: Scenario) -> DataFrame:
    """A2/F16: batch-2 keys continue after the snapshot's largest key."""
    out = []
    for spec, snap, delta in (
        (scd2.CUSTOMER, s.customer_snapshot_1, s.customer_delta_2),
        (scd2.PRODUCT, s.product_snapshot_1, s.product_delta_2),
    ):
        n = key_number(spec.sk_col, spec.prefix).alias("n")
        keys = snap.select(n, F.lit(False).alias("is_new")).unionByName(
            delta.opened.select(n, F.lit(True).alias("is_new"))
        )
        new_n = F.when(F.col("is_new"), F.col("n"))
        out.append(
            keys.agg(
                F.max(F.when(~F.col("is_new"), F.col("n"))).alias("last_key"),
                F.min(new_n).alias("first_new_key"),
                F.max(new_n).alias("last_new_key"),
                F.count(new_n).alias("n_new"),
            ).select(F.lit(spec.table).alias("table_name"), "*")
        )
    return out[0].unionByName(out[1])


@query("sk_unprefixed")
def _sk_unprefixed(s: Scenario) -> DataFrame:
    """K3: integer keys without a prefix."""
    rows = conform.dim_date_rows(s.feed("sales_details", 2))
    return assign_dense_keys(rows, conform.date_order(), "date_sk", None)


# ---- SCD2 -----------------------------------------------------------------------------------


@query("scd2_initial_customer")
def _scd2_initial(s: Scenario) -> DataFrame:
    """V1: initial load, every member new."""
    return s.customer_snapshot_full


@query("scd2_change_flags")
def _scd2_flags(s: Scenario) -> DataFrame:
    """V4: per-column normalised null-safe change flags."""
    c = s.customer_delta_2.classified
    return c.select("customer_key", "customer_id", *[f"chg_{x}" for x in scd2.CUSTOMER.tracked])


@query("scd2_classify_customer")
def _scd2_classify_c(s: Scenario) -> DataFrame:
    """V2/V3 for customers."""
    c = s.customer_delta_2.classified
    return c.select("customer_key", "customer_id", "customer_sk_old", "current_flag_old", "change_kind")


@query("scd2_classify_product")
def _scd2_classify_p(s: Scenario) -> DataFrame:
    """V2/V3 for products (match on product id)."""
    c = s.product_delta_2.classified
    return c.select("product_id", "product_key", "product_sk_old", "current_flag_old", "change_kind")


@query("scd2_close_customer")
def _scd2_close(s: Scenario) -> DataFrame:
    """V5/P10: versions closed by batch 2."""
    return s.customer_delta_2.closed


@query("scd2_open_customer")
def _scd2_open(s: Scenario) -> DataFrame:
    """V6: new versions with continued keys and the ``new`` marker."""
    return s.customer_delta_2.opened


@query("scd2_merge_customer")
def _scd2_merge_c(s: Scenario) -> DataFrame:
    """V7: unchanged ∪ closed ∪ opened."""
    return s.customer_delta_2.merged


@query("scd2_merge_product")
def _scd2_merge_p(s: Scenario) -> DataFrame:
    """V7 for products."""
    return s.product_delta_2.merged


@query("current_members")
def _current(s: Scenario) -> DataFrame:
    """V8: current versions."""
    return scd2.current_members(s.customer_delta_2.merged, scd2.CUSTOMER)


@query("expired_members")
def _expired(s: Scenario) -> DataFrame:
    """Versions with an end date."""
    return scd2.expired_members(s.customer_delta_2.merged, scd2.CUSTOMER)


@query("scd2_reapply_customer")
def _scd2_reapply(s: Scenario) -> DataFrame:
    """Applying batch 2 again to its own result: only 'ignore' and 'same' pairs."""
    d = scd2.apply_batch(s.customer_delta_2.merged, s.customers(2), scd2.CUSTOMER, BATCH2_DATE)
    return d.classified.select("customer_key", "customer_id", "customer_sk_old", "current_flag_old", "change_kind")


# ---- facts -------------------------------------------------------------------------------------


def _sales_prefixed(s: Scenario) -> DataFrame:
    f = s.feed("sales_details", 2)
    return f.withColumn("sls_cust_id", facts.customer_key_prefixed(f))


@query("lookup_customer_sk")
def _lk_customer(s: Scenario) -> DataFrame:
    """Padded customer id -> current customer_sk."""
    cur = scd2.current_members(s.customer_snapshot_full)
    return facts.lookup_customer_sk(_sales_prefixed(s), cur).select(
        "sls_ord_num", "sls_cust_id", "sls_ship_dt", "sls_sales", "customer_sk"
    )


@query("lookup_product_sk")
def _lk_product(s: Scenario) -> DataFrame:
    """Short product key -> current product_sk (fans out over versions)."""
    cur = scd2.current_members(s.product_snapshot_full)
    return facts.lookup_product_sk(s.feed("sales_details", 2), cur).select(
        "sls_ord_num", "sls_prd_key", "sls_ship_dt", "sls_sales", "product_sk"
    )


@query("lookup_product_sk_one_version")
def _lk_product_one(s: Scenario) -> DataFrame:
    """J7 with ``one_version='latest_start'``: no fan-out."""
    cur = scd2.current_members(s.product_snapshot_full)
    return facts.lookup_product_sk(s.feed("sales_details", 2), cur, one_version="latest_start").select(
        "sls_ord_num", "sls_prd_key", "sls_ship_dt", "sls_sales", "product_sk"
    )


@query("lookup_product_sk_as_of")
def _lk_product_as_of(s: Scenario) -> DataFrame:
    """J7 as of the sale: the product version that was valid ten years after the order date (the
    versions of the product feed start where its sales end)."""
    cur = scd2.current_members(s.product_snapshot_full)
    at = F.add_months(parse_yyyymmdd("sls_order_dt"), 120)
    sales = s.feed("sales_details", 2).select("sls_ord_num", "sls_prd_key", "sls_order_dt", "sls_ship_dt", "sls_sales")
    return facts.lookup_product_as_of(sales, cur, at)


@query("sales_profile")
def _sales_profile(s: Scenario) -> DataFrame:
    """J6/J7 skew: the one-pass profile of all sales: rows, prefix decision, latest order date."""
    found = skew.profile_sales(s.feed("sales_details", 2), facts.CUSTOMER_PREFIX)
    row = (found.n_rows, found.all_prefixed, found.latest_order)
    return s.spark.createDataFrame([row], "n_rows long, all_prefixed boolean, latest_order date")


@query("lookup_customer_sk_salted")
def _lk_customer_salted(s: Scenario) -> DataFrame:
    """J6 with its most frequent ids salted: the same rows as the plain lookup."""
    cur = scd2.current_members(s.customer_snapshot_full)
    sales = _sales_prefixed(s)
    found = sales.agg(skew.hot_key_sketch(F.col("sls_cust_id")).alias("x")).collect()[0].x
    hot = {r["item"]: 3 for r in found}
    return facts.lookup_customer_sk(sales, cur, hot).select(
        "sls_ord_num", "sls_cust_id", "sls_ship_dt", "sls_sales", "customer_sk"
    )


@query("lookup_date_sks")
def _lk_dates(s: Scenario) -> DataFrame:
    """Three role-playing lookups, plain equality."""
    return facts.lookup_date_sks(s.feed("sales_details", 2), s.dim_date_full).select(
        "sls_ord_num", "sls_order_dt", "sls_ship_dt", "sls_due_dt", "sls_sales", *[r[1] for r in facts.DATE_ROLES]
    )


@query("lookup_date_sks_nullsafe")
def _lk_dates_ns(s: Scenario) -> DataFrame:
    """J8-J10 in reference mode: NULL-date rows kept, NULL matches NULL (fan-out)."""
    dd = conform.dim_date_build(s.feed("sales_details", 2), keep_unparsed=True)
    return facts.lookup_date_sks(s.feed("sales_details", 2), dd, null_safe=True).select(
        "sls_ord_num", "sls_order_dt", "sls_ship_dt", "sls_due_dt", "sls_sales", *[r[1] for r in facts.DATE_ROLES]
    )


@query("fact_sales_full")
def _fact_full(s: Scenario) -> DataFrame:
    """C4 (flagship): fact over all sales with all lookups and SALES<n> keys."""
    return s.fact_full()


# ---- incremental loading -------------------------------------------------------------------------

WATERMARK_TABLES = ["dim_customer", "dim_product", "dim_date", "fact_sales", "dim_store"]


@query("watermark_read")
def _wm_read(s: Scenario) -> DataFrame:
    """Watermarks after batch 1 from the control log; unknown tables -> 1900-01-01."""
    control = tables.read_control(s.spark, loaded_warehouse(s.spark, s.sf_dir))
    return incremental.read_watermarks(control.where(F.col("version") <= 1), WATERMARK_TABLES)


@query("watermark_advance")
def _wm_advance(s: Scenario) -> DataFrame:
    """Watermarks after batch 2 advanced to the max of what was loaded."""
    control = tables.read_control(s.spark, loaded_warehouse(s.spark, s.sf_dir))
    return incremental.read_watermarks(control, WATERMARK_TABLES)


@query("scd2_load_filter_customer")
def _dim_filter(s: Scenario) -> DataFrame:
    """Reference dimension filter on a same-day rerun (watermark = D2):
    changed versions stay, new members drop out."""
    return incremental.dim_load_filter(s.customer_delta_2.opened, F.lit(BATCH2_DATE))


@query("incremental_dates")
def _inc_dates(s: Scenario) -> DataFrame:
    """I2 reference mode: only dates after the batch-1 watermark (late dates lost)."""
    rows = conform.dim_date_rows(s.feed("sales_details", 2))
    wm = s.dim_date_1.agg(F.max("full_date")).scalar()
    fresh = incremental.dates_after_watermark(rows, wm)
    start = next_key_start(s.dim_date_1, "date_sk", "DATE")
    return assign_dense_keys(fresh, conform.date_order(), "date_sk", "DATE", start)


@query("incremental_dates_antijoin")
def _inc_dates_anti(s: Scenario) -> DataFrame:
    """I2 default: every date not yet loaded, keys continuing."""
    return s.new_dates_2


@query("incremental_fact_by_created")
def _inc_fact_created(s: Scenario) -> DataFrame:
    """Batch-2 facts after the created_date watermark (D1), keys after batch 1's."""
    rows = incremental.fact_load_filter(s.fact_rows_2(packed=True), F.lit(BATCH1_DATE))
    start = next_key_start(s.fact_1, "sales_sk", "SALES")
    return facts.number_facts(rows, start, s.feed("sales_details", 2))


@query("incremental_fact_by_order_date")
def _inc_fact_order(s: Scenario) -> DataFrame:
    """I3 by order date (mapping-document variant): the sales of batch 2 that batch 1 did not
    have, with those ordered before its latest order date or without a readable one."""
    first, second = (ledger.with_ledger_keys(s.feed("sales_details", batch)) for batch in (1, 2))
    fresh = ledger.not_loaded(second, first.select("d1", "d2", F.lit(1).alias("copies")))
    return s.fact_rows_2(ledger.repeated(fresh).select(*s.feed("sales_details", 2).columns))


@query("batch_audit")
def _audit(s: Scenario) -> DataFrame:
    """Row counts per table and stage for batch 2."""
    frames = {(n, "extract"): s.feed(n, 2) for n in FEED_NAMES}
    frames[("dim_customer", "transform")] = s.customer_delta_2.opened
    frames[("dim_customer", "expire")] = s.customer_delta_2.closed
    frames[("dim_product", "transform")] = s.product_delta_2.opened
    frames[("dim_product", "expire")] = s.product_delta_2.closed
    frames[("dim_date", "transform")] = conform.dim_date_rows(s.feed("sales_details", 2))
    frames[("fact_sales", "transform")] = s.fact_rows_2()
    return audit.batch_audit(frames)


# ---- sources and sinks ------------------------------------------------------------------------------


@query("scan_csv_feed")
def _scan_csv(s: Scenario) -> DataFrame:
    """The product feed written as CSV and read back with its explicit schema."""
    path = scratch_path(s.spark, "product_info_csv")
    feeds_io.write_csv_feed(s.feed("product_info", 2), path)
    return feeds_io.read_csv_feed(s.spark, path, schemas.CRM_PRODUCT)


@query("scan_missing_feed")
def _scan_missing(s: Scenario) -> DataFrame:
    """The tolerant scan of the product feed beside one of a missing path."""
    path = scratch_path(s.spark, "product_info_csv")
    feeds_io.write_csv_feed(s.feed("product_info", 2), path)
    there = feeds_io.read_csv_feed(s.spark, path, schemas.CRM_PRODUCT, tolerant=True)
    absent = feeds_io.read_csv_feed(s.spark, f"{path}-absent", schemas.CRM_PRODUCT, tolerant=True)
    return there.unionByName(absent)


def _csv_folders(s: Scenario) -> dict[str, str]:
    """The feeds of batch 2 as folders of compressed CSV files that differ in their column order, with rows
    that fit no feed beside them: quantities that are no numbers (of a tenth of the sales) and
    files without most columns (of a tenth of the products)."""
    root = scratch_path(s.spark, "csv-folders")
    for name in FEED_NAMES:
        feed = s.feed(name, 2)
        half = F.pmod(F.xxhash64(*feed.columns), F.lit(2))
        feeds_io.write_csv_feed(feed.where(half == 0), f"{root}/{name}", compression="gzip")
        more = feed.where(half == 1).select(*reversed(feed.columns))
        feeds_io.write_csv_feed(more, f"{root}/{name}", "append", "gzip")
    sales = s.feed("sales_details", 2).where("sls_order_dt % 10 = 3")
    bad = sales.withColumn("sls_quantity", F.concat(F.lit("x"), F.col("sls_quantity").cast("string")))
    feeds_io.write_csv_feed(bad, f"{root}/sales_details", "append", "gzip")
    products = s.feed("product_info", 2).where("prd_id % 10 = 3").select("prd_id", "prd_nm")
    feeds_io.write_csv_feed(products, f"{root}/product_info", "append", "gzip")
    return {name: f"{root}/{name}" for name in FEED_NAMES}


def _csv_warehouse(s: Scenario) -> str:
    wh = scratch_path(s.spark, "warehouse-csv")
    run_csv_batch(s.spark, _csv_folders(s), wh, BATCH2_DATE)
    return wh


@query("csv_to_fact")
def _csv_to_fact(s: Scenario) -> DataFrame:
    """Six folders of CSV files through the whole job to fact_sales, in one batch."""
    return read_warehouse(s.spark, _csv_warehouse(s))["fact_sales"]


@query("csv_file_counts")
def _csv_file_counts(s: Scenario) -> DataFrame:
    """Rows read, kept and rejected by feed, and the reasons of the rejects, of a load
    from CSV files."""
    rejects, files = tables.read_extract_log(s.spark, _csv_warehouse(s))
    counted = files.groupBy("feed").agg(*[F.sum(c).alias(c) for c in ("n_read", "n_kept", "n_rejected")])
    why = F.regexp_replace("reason", ": x.*", "")
    reasons = rejects.groupBy("feed").agg(F.count("*").alias("n_logged"), F.max(why).alias("reason"))
    return counted.join(reasons, "feed", "left")


@query("dim_snapshot")
def _dim_snapshot(s: Scenario) -> DataFrame:
    """A stored dimension version read back from its live buckets and its history (version 2,
    all members)."""
    wh = loaded_warehouse(s.spark, s.sf_dir)
    return dimensions.read_dimension(s.spark, wh, "dim_customer", 2, schemas.DIM_CUSTOMER)


@query("dim_customer_full")
def _dim_customer_full(s: Scenario) -> DataFrame:
    """C1 + V7 via the batch job: current dim_customer after two batches."""
    return read_warehouse(s.spark, loaded_warehouse(s.spark, s.sf_dir))["dim_customer"]


@query("dim_product_full")
def _dim_product_full(s: Scenario) -> DataFrame:
    """C2 + V7 via the batch job: current dim_product after two batches."""
    return read_warehouse(s.spark, loaded_warehouse(s.spark, s.sf_dir))["dim_product"]


@query("dim_date_loaded")
def _dim_date_loaded(s: Scenario) -> DataFrame:
    """C3 + I2 via the batch job: dates of both batches, keys continuing."""
    return read_warehouse(s.spark, loaded_warehouse(s.spark, s.sf_dir))["dim_date"]


@query("fact_sales_loaded")
def _fact_loaded(s: Scenario) -> DataFrame:
    """fact_sales after two batches (appended per created_date)."""
    return read_warehouse(s.spark, loaded_warehouse(s.spark, s.sf_dir))["fact_sales"]


@query("batch_retry_after_crash")
def _retry(s: Scenario) -> DataFrame:
    """Batch 2 stops before its commit, once for its own day and once more, and is then
    retried: row and key counts of the growing tables, as if it had never stopped."""
    wh = scratch_path(s.spark, "warehouse-crash")
    run_batch(s.spark, {n: s.feed(n, 1) for n in FEED_NAMES}, wh, BATCH1_DATE, landed=True)
    feeds = {n: s.feed(n, 2) for n in FEED_NAMES}
    for stop in (True, True, False):
        try:
            run_batch(s.spark, feeds, wh, BATCH2_DATE, BatchOptions(stop_before_commit=stop), landed=True)
        except StoppedBeforeCommit:
            pass
    loaded = read_warehouse(s.spark, wh)
    out = []
    for table, key, prefix in (("fact_sales", "sales_sk", "SALES"), ("dim_date", "date_sk", "DATE")):
        counts = count_keys(loaded[table], key, prefix)
        out.append(counts.select(F.lit(table).alias("table_name"), "*"))
    return out[0].unionByName(out[1])


@query("fact_sales_loaded_by_order_date")
def _fact_loaded_order_date(s: Scenario) -> DataFrame:
    """I3 in the batch job: fact increments by order date; every sale is loaded once."""
    wh = scratch_path(s.spark, "warehouse-order-date")
    for batch, p in ((1, BATCH1_DATE), (2, BATCH2_DATE)):
        feeds = {n: s.feed(n, batch) for n in FEED_NAMES}
        run_batch(s.spark, feeds, wh, p, BatchOptions(fact_watermark="order_date"), landed=True)
    return read_warehouse(s.spark, wh)["fact_sales"]


# ---- streaming ----------------------------------------------------------------------------------------


@query("stream_fact_load")
def _stream_fact_load(s: Scenario) -> DataFrame:
    """Both batches dropped as daily feed folders and drained by Structured Streaming
    (availableNow + foreachBatch -> batch job): the loaded fact table."""
    from starloom.streaming.feed_stream import drop_feeds, run_stream

    root = scratch_path(s.spark, "stream")
    for batch, p in ((1, BATCH1_DATE), (2, BATCH2_DATE)):
        drop_feeds({n: s.feed(n, batch) for n in FEED_NAMES}, f"{root}/source", p)
    run_stream(s.spark, f"{root}/source", f"{root}/warehouse", f"{root}/checkpoint")
    return read_warehouse(s.spark, f"{root}/warehouse")["fact_sales"]


# ---- reference-compatible switches -----------------------------------------------------------------


@query("dedupe_nulls_lose")
def _dedupe_nulls_lose(s: Scenario) -> DataFrame:
    """O3 with ``null_dates='lose'``: a real create date beats a missing one."""
    return conform.latest_customers(
        s.feed("customer_info", 2), s.feed("customer", 2), s.feed("customer_location", 2), BATCH2_DATE, "lose"
    )


def _dormant_snapshot(s: Scenario) -> DataFrame:
    """The batch-2 dimension with every version of every 7th member closed."""
    n = F.substring("customer_key", 3, 1 << 20).try_cast("long")
    return s.customer_delta_2.merged.withColumn(
        "current_flag", F.when((n % 7) == 0, F.lit("N")).otherwise(F.col("current_flag"))
    )


@query("scd2_reopen_customer")
def _scd2_reopen(s: Scenario) -> DataFrame:
    """D11 switch: members whose versions are all closed get a new open version."""
    d = scd2.apply_batch(_dormant_snapshot(s), s.customers(2), scd2.CUSTOMER, BATCH2_DATE, reopen=True)
    return d.opened


@query("fact_sales_reference_mode")
def _fact_reference(s: Scenario) -> DataFrame:
    """Batch-2 facts the reference way: lookups against the pre-batch snapshot with this
    batch's closes applied (new and changed members get NULL keys), NULL-date rows kept
    and matched null-safely, date and fact keys restarting at 1."""
    sales = s.feed("sales_details", 2)
    cust = s.customer_delta_2.unchanged.unionByName(s.customer_delta_2.closed)
    prod = s.product_delta_2.unchanged.unionByName(s.product_delta_2.closed)
    dates = conform.dim_date_build(sales, keep_unparsed=True)
    return facts.build_fact_sales(sales, cust, prod, dates, BATCH2_DATE, null_safe=True)


@query("batch_audit_loaded")
def _audit_loaded(s: Scenario) -> DataFrame:
    """S10 inside the batch job: rows written per table and batch, counted by
    observations on the writes themselves."""
    return tables.read_audit(s.spark, loaded_warehouse(s.spark, s.sf_dir))
