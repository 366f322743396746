"""Raw ERP/CRM feeds derived from the driver tables with pure column expressions.

The driver tables are clean, so the dirt the warehouse operators must handle is added
here by deterministic rules (no random values), which lets an independent SQL engine
build exactly the same rows. Every feed reads whole tables, so its size grows with
the scale factor. Batches: batch 1 is the initial extract, batch 2 the next day's
extract with edits (see ``BATCH2_EDITS``).

Column names and types are those of the raw feeds (``schemas.FEEDS``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import yyyymmdd_code
from starloom.sources import schemas
from starloom.sources.testdata import Tables

# Fixed values of the derivation.
BATCH1_DATE = dt.date(2002, 1, 1)  # processing date of batch 1 (D1)
BATCH2_DATE = dt.date(2002, 2, 1)  # processing date of batch 2 (D2)
BATCH1_SKIP_MOD = 13  # members/products with key % 13 = 0 only arrive in batch 2
SALES_BATCH1_BEFORE = dt.date(1999, 1, 1)  # batch 1 holds orders placed before this day
SALES_BATCH1_SHIPPED_BEFORE = dt.date(1999, 7, 1)  # ... whose lines shipped before this day
DEFAULT_CREATE_DATE = dt.date(1995, 1, 1)  # create date of a customer without orders
BATCH2_EDITS = {
    "country_changed_mod": 5,  # customer moves to the next nation
    "case_only_name_mod": 11,  # first name upper-cased: not a change
    "birth_date_nulled_mod": 17,
    "product_cost_changed_mod": 6,  # cost + 1.0
    "product_name_case_mod": 9,  # product name upper-cased: not a change
}
# product key prefixes by (part_key div 3) % 4, and the category rows that go with them
PRODUCT_FAMILIES = ("AC", "BI", "CL", "CO")
CATEGORY_ROWS = [
    # (ID, CAT, SUBCAT, MAINTENANCE); CO_S2 is missing on purpose, ZZ_S9 is never used
    ("AC_S0", "Accessories", "Standard", "No"),
    ("AC_S1", "Accessories", "Sport", "No"),
    ("AC_S2", "Accessories", "Special", "No"),
    ("BI_S0", "Bikes", "Standard", "Yes"),
    ("BI_S1", "Bikes", "Sport", "Yes"),
    ("BI_S2", "Bikes", "Special", "Yes"),
    ("CL_S0", "Clothing", "Standard", "No"),
    ("CL_S1", "Clothing", "Sport", "No"),
    ("CL_S2", "Clothing", "Special", "No"),
    ("CO_S0", "Components", "Standard", "Yes"),
    ("CO_S1", "Components", "Sport", "Yes"),
    ("ZZ_S9", "Unused", "Unused", "No"),
]


def _pad8(k: Column) -> Column:
    return F.lpad(k.cast("string"), 8, "0")


def _mod(k: Column, m: int) -> Column:
    return (k % m) == 0


def _div(k: Column, m: int) -> Column:
    """Exact integer division of a non-negative key."""
    return ((k - k % m) / m).cast("long")


def crm_customer(t: Tables, batch: int = 1) -> DataFrame:
    """CRM customer_info: padded keys, mixed case, duplicate keys, bad/future/null dates."""
    first_order = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").cast("date").alias("_first"))
    c = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    if batch == 1:
        c = c.where((F.col("c_custkey") % BATCH1_SKIP_MOD) != 0)
    base = c.join(first_order, c.c_custkey == first_order.o_custkey, "left")
    k = F.col("c_custkey")
    pad = _pad8(k)
    seg = F.col("c_mktsegment")
    proper = F.concat(F.upper(F.substring(seg, 1, 1)), F.lower(F.substring(seg, 2, 1 << 20)))
    first = F.when(_mod(k, 5), F.concat(F.lit(" "), proper, F.lit(" "))).otherwise(proper)
    if batch == 2:
        first = F.when(_mod(k, BATCH2_EDITS["case_only_name_mod"]), F.upper(first)).otherwise(first)
    last = F.replace(F.col("c_name"), F.lit("Customer#"), F.lit("Client "))
    last = F.when(_mod(k, 3), F.concat(last, F.lit("  "))).otherwise(last)
    created = F.coalesce(F.col("_first"), F.lit(DEFAULT_CREATE_DATE))
    create_txt = (
        F.when(_mod(k, 41), F.lit("not-a-date"))
        .when(_mod(k, 43), F.concat(F.lit("2999-"), F.lpad(((k % 12) + 1).cast("string"), 2, "0"), F.lit("-15")))
        .otherwise(created.cast("string"))
    )
    # Every member yields its own row, a later duplicate (every 10th: other surname,
    # created 30 days later, id + 1000000) and an undated third row (every 50th, id +
    # 2000000): one pass over the joined rows, copies made by exploding a copy index.
    copies = F.array(F.lit(0), F.when(_mod(k, 10), F.lit(1)), F.when(_mod(k, 50), F.lit(2)))
    base = base.select("*", F.explode(F.filter(copies, lambda c: c.isNotNull())).alias("_copy"))
    copy = F.col("_copy")
    out = base.select(
        (k + copy * 1000000).alias("cst_id"),
        F.when(_mod(k, 2), F.concat(F.lit(" AW"), pad, F.lit(" ")))
        .when(_mod(k, 3), F.concat(F.lit("AW"), pad, F.lit("\t")))
        .otherwise(F.concat(F.lit("AW"), pad))
        .alias("cst_key"),
        first.alias("cst_firstname"),
        F.when(copy == 1, F.concat(F.lit("Other "), last)).otherwise(last).alias("cst_lastname"),
        F.when((k % 3) == 0, F.lit("m")).when((k % 3) == 1, F.lit("s")).otherwise(F.lit("M")).alias(
            "cst_marital_status"
        ),
        F.when(_mod(k, 23), F.lit(None).cast("string"))
        .when((k % 2) == 0, F.lit("f"))
        .otherwise(F.lit("M"))
        .alias("cst_gndr"),
        F.when(copy == 1, F.date_add(created, 30).cast("string"))
        .when(copy == 2, F.lit(None).cast("string"))
        .otherwise(create_txt)
        .alias("cst_create_date"),
    )
    return _typed(out, schemas.CRM_CUSTOMER)


def erp_customer(t: Tables, batch: int = 1) -> DataFrame:
    """ERP customer: blanks around keys, every 7th member missing, text birth dates."""
    k = F.col("c_custkey")
    pad = _pad8(k)
    bdate = F.date_add(F.lit(dt.date(1950, 1, 1)), ((k * 37) % 18000).cast("int")).cast("string")
    if batch == 2:
        bdate = F.when(_mod(k, BATCH2_EDITS["birth_date_nulled_mod"]), F.lit(None).cast("string")).otherwise(bdate)
    out = (
        t.customer.select("c_custkey")
        .where((k % 7) != 0)
        .select(
            F.when((k % 2) == 0, F.concat(F.lit("AW"), pad, F.lit(" ")))
            .otherwise(F.concat(F.lit(" AW"), pad))
            .alias("CID"),
            bdate.alias("BDATE"),
            F.when((k % 2) == 0, F.lit("Female")).otherwise(F.lit("Male")).alias("GEN"),
        )
    )
    return _typed(out, schemas.ERP_CUSTOMER)


def erp_location(t: Tables, batch: int = 1) -> DataFrame:
    """ERP location: hyphenated keys (every 19th also has a trailing blank, so it never
    matches: the location key is not trimmed), country = nation name."""
    k = F.col("c_custkey")
    nk = F.col("c_nationkey")
    if batch == 2:
        nk = F.when(_mod(k, BATCH2_EDITS["country_changed_mod"]), (nk + 1) % 25).otherwise(nk)
    cust = t.customer.select(k, nk.alias("_nk"))
    # nation is a fixed 25-row domain table: broadcasting it is bounded
    nation = F.broadcast(t.nation.select("n_nationkey", "n_name"))
    key = F.concat(F.lit("AW-"), _pad8(k))
    out = cust.join(nation, cust._nk == nation.n_nationkey, "left").select(
        F.when(_mod(k, 19), F.concat(key, F.lit(" "))).otherwise(key).alias("CID"),
        F.col("n_name").alias("CNTRY"),
    )
    return _typed(out, schemas.ERP_LOCATION)


def product_categories(spark: SparkSession) -> DataFrame:
    """ERP category reference table (fixed rows, see ``CATEGORY_ROWS``)."""
    return spark.createDataFrame(CATEGORY_ROWS, schemas.ERP_CATEGORY)


def crm_product(t: Tables, batch: int = 1) -> DataFrame:
    """CRM product_info: three versions per product key whose start dates run against
    the id order, end dates that lie before the start, null costs and lines, blanks."""
    pk = F.col("p_partkey")
    g = _div(pk, 3)
    family = F.element_at(F.array(*[F.lit(x) for x in PRODUCT_FAMILIES]), (g % 4 + 1).cast("int"))
    prd_key = F.concat(family, F.lit("-S"), (g % 3).cast("string"), F.lit("-FR-"), g.cast("string"))
    start = F.date_add(F.lit(dt.date(2000, 1, 1)), ((g % 1000) + (2 - pk % 3) * 1000).cast("int"))
    name = F.when(_mod(pk, 5), F.concat(F.lit(" "), F.col("p_name"))).otherwise(F.col("p_name"))
    cost = F.when(_mod(pk, 100), F.lit(None).cast("double")).otherwise(F.col("p_retailprice"))
    if batch == 2:
        name = F.when(_mod(pk, BATCH2_EDITS["product_name_case_mod"]), F.upper(name)).otherwise(name)
        cost = F.when(_mod(pk, BATCH2_EDITS["product_cost_changed_mod"]), cost + F.lit(1.0)).otherwise(cost)
    first_letter = F.substring(F.col("p_type"), 1, 1)
    line = (
        F.when(_mod(pk, 37), F.lit(None).cast("string"))
        .when((pk % 2) == 0, F.concat(first_letter, F.lit(" ")))
        .otherwise(F.lower(first_letter))
    )
    p = t.part.select("p_partkey", "p_name", "p_type", "p_retailprice")
    if batch == 1:
        p = p.where((pk % BATCH1_SKIP_MOD) != 0)
    out = p.select(
        pk.alias("prd_id"),
        prd_key.alias("prd_key"),
        name.alias("prd_nm"),
        cost.alias("prd_cost"),
        line.alias("prd_line"),
        start.cast("string").alias("prd_start_dt"),
        F.date_sub(start, 100).cast("string").alias("prd_end_dt"),
    )
    return _typed(out, schemas.CRM_PRODUCT)


#: Whether batch 1 has a row of ``crm_sales_marked``.
IN_BATCH1 = "_in_batch1"


def crm_sales(t: Tables, batch: int = 1) -> DataFrame:
    """CRM sales_details: unprefixed customer ids, short product keys with blanks,
    integer YYYYMMDD date codes with the bad codes 0 and 32154."""
    return _crm_sales(t, batch).drop(IN_BATCH1)


def crm_sales_marked(t: Tables) -> DataFrame:
    """``crm_sales`` of batch 2, which has all rows of batch 1, with ``IN_BATCH1``."""
    return _crm_sales(t, 2)


def _crm_sales(t: Tables, batch: int) -> DataFrame:
    # dates are narrower than times where the rows move
    orders = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    if batch == 1:
        orders = orders.where(F.col("o_orderdate") < F.lit(SALES_BATCH1_BEFORE))
    shipped = F.col("l_shipdate").cast("date").alias("l_shipdate")
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", shipped)
    if batch == 1:
        li = li.where(F.col("l_shipdate") < F.lit(SALES_BATCH1_SHIPPED_BEFORE))
    # Hash-partition the line items on the join key: it is the shuffle a sort-merge join
    # with ``orders`` needs once ``orders`` is too big to broadcast, and it spreads the
    # downstream work over all tasks even when the source is one large row group.
    n = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    li = li.repartition(n, "l_orderkey")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
    ok = F.col("l_orderkey")
    g = _div(F.col("l_partkey"), 3).cast("string")
    prd = F.concat(F.lit("FR-"), g)
    ship = F.col("l_shipdate")
    cust = F.col("o_custkey").cast("string")
    out = j.select(
        F.concat(F.lit("SO"), ok.cast("string")).alias("sls_ord_num"),
        F.when((F.col("l_linenumber") % 4) == 0, F.concat(F.lit(" "), prd, F.lit(" "))).otherwise(prd).alias(
            "sls_prd_key"
        ),
        F.when((F.col("l_linenumber") % 5) == 0, F.concat(F.lit(" "), cust)).otherwise(cust).alias("sls_cust_id"),
        F.when(_mod(ok, 97), F.lit(0))
        .when(_mod(ok, 89), F.lit(32154))
        .otherwise(yyyymmdd_code(F.col("o_orderdate")))
        .alias("sls_order_dt"),
        yyyymmdd_code(ship).alias("sls_ship_dt"),
        yyyymmdd_code(F.date_add(ship, 7)).alias("sls_due_dt"),
        F.col("l_extendedprice").alias("sls_sales"),
        F.col("l_quantity").cast("int").alias("sls_quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("sls_price"),
        F.coalesce(
            (F.col("o_orderdate") < F.lit(SALES_BATCH1_BEFORE)) & (F.col("l_shipdate") < F.lit(SALES_BATCH1_SHIPPED_BEFORE)), F.lit(False)
        ).alias(IN_BATCH1),
    )
    return _typed(out, schemas.CRM_SALES, IN_BATCH1)


def feeds(spark: SparkSession, sf_dir: str, batch: int = 1) -> dict[str, DataFrame]:
    """All six raw feeds of one batch, keyed like ``schemas.FEEDS``. Lazy."""
    t = Tables(spark, sf_dir)
    return {
        "customer": erp_customer(t, batch),
        "customer_location": erp_location(t, batch),
        "customer_info": crm_customer(t, batch),
        "product_categories": product_categories(spark),
        "product_info": crm_product(t, batch),
        "sales_details": crm_sales(t, batch),
    }


def _typed(df: DataFrame, schema, *more: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *more)
