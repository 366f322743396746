"""Conformed dimension builds up to (not including) SCD2: customer, product, date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import clamp_future, date_parts, parse_iso_date, parse_yyyymmdd
from starloom.functions.text import head_tokens, replace_literal, strip_ws
from starloom.operators.keys import assign_dense_keys
from starloom.operators.windows import keep_last_by, lead_within_key, nulls_lose, nulls_win

CUSTOMER_COLUMNS = [
    "customer_id",
    "customer_key",
    "first_name",
    "last_name",
    "gender",
    "marital_status",
    "birth_date",
    "country",
    "customer_create_date",
]
PRODUCT_COLUMNS = [
    "product_id",
    "product_key",
    "product_name",
    "product_cost",
    "product_line",
    "category",
    "subcategory",
    "maintenance",
    "start_date",
    "end_date",
]
DATE_COLUMNS = ["full_date", "day", "month", "month_name", "quarter", "year"]


def conform_customer(
    info: DataFrame, erp: DataFrame, location: DataFrame, processing_date: str | dt.date
) -> DataFrame:
    """CRM customers enriched with ERP birth date and country.

    Keys: CRM and ERP keys are stripped; the location key only loses its hyphens (it
    is not stripped, so a padded location key does not match). Names are stripped,
    gender and marital status upper-cased (stored form, not mapped). Create dates are
    parsed (bad -> NULL) and clamped to the processing date.
    """
    crm = info.withColumn("cst_key", strip_ws("cst_key"))
    erp_k = erp.select(strip_ws("CID").alias("_erp_cid"), F.col("BDATE"))
    loc_k = location.select(replace_literal("CID", "-", "").alias("_loc_cid"), F.col("CNTRY"))
    # Both joins use the same key, so the second one reuses the first one's
    # partitioning; AQE splits a hot key on the feed side and converts to a broadcast
    # join when a side turns out small at run time.
    joined = crm.join(erp_k, F.col("cst_key") == F.col("_erp_cid"), "left").join(
        loc_k, F.col("cst_key") == F.col("_loc_cid"), "left"
    )
    return joined.select(
        F.col("cst_id").alias("customer_id"),
        F.col("cst_key").alias("customer_key"),
        strip_ws("cst_firstname").alias("first_name"),
        strip_ws("cst_lastname").alias("last_name"),
        F.upper("cst_gndr").alias("gender"),
        F.upper("cst_marital_status").alias("marital_status"),
        F.col("BDATE").alias("birth_date"),
        F.col("CNTRY").alias("country"),
        clamp_future(parse_iso_date("cst_create_date"), processing_date).alias("customer_create_date"),
    )


def dedupe_latest_customer(conformed: DataFrame, null_dates: str = "win") -> DataFrame:
    """Keep the latest row per ``customer_key`` by create date.

    ``null_dates='win'`` (reference behaviour) makes a missing date beat every real
    date; ``'lose'`` makes it lose. Ties go to the larger ``customer_id``.
    """
    rank = nulls_win("customer_create_date") if null_dates == "win" else nulls_lose("customer_create_date")
    return keep_last_by(conformed, ["customer_key"], rank + [F.col("customer_id")])


def latest_customers(
    info: DataFrame,
    erp: DataFrame,
    location: DataFrame,
    processing_date: str | dt.date,
    null_dates: str = "win",
) -> DataFrame:
    """``dedupe_latest_customer(conform_customer(...))`` computed dedupe-first.

    Deduplicating the CRM rows before the joins lets Spark pre-aggregate map-side, so
    a hot or missing key shrinks to one row per map task before any shuffle (after the
    joins the aggregate would inherit the join's key partitioning and run a hot key in
    one task). The ERP and location sides are reduced to one row per key as well, so
    the joins are one-to-one. Same result whenever those keys are unique (a duplicate
    ERP key is a tie the reference also resolves arbitrarily).
    """
    p = processing_date
    crm = info.select(
        F.col("cst_id").alias("customer_id"),
        strip_ws("cst_key").alias("customer_key"),
        strip_ws("cst_firstname").alias("first_name"),
        strip_ws("cst_lastname").alias("last_name"),
        F.upper("cst_gndr").alias("gender"),
        F.upper("cst_marital_status").alias("marital_status"),
        clamp_future(parse_iso_date("cst_create_date"), p).alias("customer_create_date"),
    )
    rank = nulls_win("customer_create_date") if null_dates == "win" else nulls_lose("customer_create_date")
    crm = keep_last_by(crm, ["customer_key"], rank + [F.col("customer_id")])
    erp_k = erp.select(strip_ws("CID").alias("_erp_cid"), F.col("BDATE").alias("birth_date"))
    erp_k = keep_last_by(erp_k.where(F.col("_erp_cid").isNotNull()), ["_erp_cid"], nulls_lose("birth_date"))
    loc_k = location.select(replace_literal("CID", "-", "").alias("_loc_cid"), F.col("CNTRY").alias("country"))
    loc_k = keep_last_by(loc_k.where(F.col("_loc_cid").isNotNull()), ["_loc_cid"], nulls_lose("country"))
    joined = crm.join(erp_k, F.col("customer_key") == F.col("_erp_cid"), "left").join(
        loc_k, F.col("customer_key") == F.col("_loc_cid"), "left"
    )
    return joined.select(*CUSTOMER_COLUMNS)


def customer_order():
    """Total order used to number customer versions: create date (NULL last), key, id."""
    return [
        F.asc_nulls_last("customer_create_date"),
        F.asc_nulls_last("customer_key"),
        F.asc_nulls_last("customer_id"),
    ]


def product_validity(info: DataFrame) -> DataFrame:
    """Product feed with the category key, parsed start date, and the end date
    *replaced* by the next start date of the same product key (half-open intervals)."""
    df = info.withColumn("cat_id", head_tokens("prd_key", "-", 2, "_")).withColumn(
        "prd_start_dt", parse_iso_date("prd_start_dt")
    )
    df = df.drop("prd_end_dt")
    return lead_within_key(
        df,
        "prd_key",
        [F.asc_nulls_last("prd_start_dt"), F.asc_nulls_last("prd_id")],
        value="prd_start_dt",
        out="prd_end_dt",
    )


def latest_products(info: DataFrame) -> DataFrame:
    """One row per product id: the latest start date wins (a missing one loses), then the
    greater key and remaining columns. Rows without an id are one product, so matching a feed
    against a dimension pairs every feed row with one version at most."""
    rest = [c for c in info.columns if c not in ("prd_id", "prd_start_dt", "prd_key")]
    rank = [part for c in ("prd_start_dt", "prd_key", *rest) for part in nulls_lose(c)]
    return keep_last_by(info, ["prd_id"], rank)


def conform_product(info: DataFrame, categories: DataFrame) -> DataFrame:
    """Products, one row per product id, with derived validity and category attributes.

    The category table is joined without a broadcast hint: Spark broadcasts it only
    when its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and
    shuffles otherwise.
    """
    v = product_validity(latest_products(info))
    cat = categories.select(
        F.col("ID").alias("_cat_id"),
        F.col("CAT").alias("category"),
        F.col("SUBCAT").alias("subcategory"),
        F.col("MAINTENANCE").alias("maintenance"),
    )
    j = v.join(cat, v.cat_id == cat._cat_id, "left")
    return j.select(
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_key"),
        strip_ws("prd_nm").alias("product_name"),
        F.col("prd_cost").alias("product_cost"),
        F.upper("prd_line").alias("product_line"),
        "category",
        "subcategory",
        "maintenance",
        F.col("prd_start_dt").alias("start_date"),
        F.col("prd_end_dt").alias("end_date"),
    )


def product_order():
    """Total order used to number product versions: key, start date (NULL last), id."""
    return [
        F.asc_nulls_last("product_key"),
        F.asc_nulls_last("start_date"),
        F.asc_nulls_last("product_id"),
    ]


DATE_CODE_COLUMNS = ("sls_order_dt", "sls_ship_dt", "sls_due_dt")


def distinct_date_codes(sales: DataFrame, code_columns=DATE_CODE_COLUMNS) -> DataFrame:
    """Distinct date codes of the role-playing date columns, one pass over the fact
    (explode instead of a three-way union), pre-aggregated map-side."""
    return (
        sales.select(F.explode(F.array(*[F.col(c) for c in code_columns])).alias("date_code"))
        .where(F.col("date_code").isNotNull())
        .distinct()
    )


def dim_date_rows(sales: DataFrame, keep_unparsed: bool = False) -> DataFrame:
    """Date dimension rows (no key) from the sales date codes.

    By default unparseable codes are dropped. ``keep_unparsed=True`` keeps one
    NULL-date row per distinct bad code, as the reference does.
    """
    d = distinct_date_codes(sales).select(parse_yyyymmdd("date_code").alias("full_date"))
    if not keep_unparsed:
        d = d.where(F.col("full_date").isNotNull())
    parts = date_parts("full_date")
    return d.select("full_date", *[v.alias(k) for k, v in parts.items()])


def date_order():
    return [F.asc_nulls_last("full_date")]


def dim_date_build(sales: DataFrame, keep_unparsed: bool = False, start=0) -> DataFrame:
    """Date dimension with ``DATE<n>`` keys in calendar order."""
    rows = dim_date_rows(sales, keep_unparsed)
    return assign_dense_keys(rows, date_order(), "date_sk", "DATE", start)
