"""Explicit schemas of the six raw feeds and of the warehouse tables.

Types are declared, never inferred: a numeric column with one blank must not turn a key
into ``'11000.0'`` and a date column must not change type from run to run.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, L, I, D, DT, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.DateType(), T.BooleanType()

# ERP feeds
ERP_CUSTOMER = _schema(("CID", S), ("BDATE", S), ("GEN", S))
ERP_LOCATION = _schema(("CID", S), ("CNTRY", S))
ERP_CATEGORY = _schema(("ID", S), ("CAT", S), ("SUBCAT", S), ("MAINTENANCE", S))

# CRM feeds
CRM_CUSTOMER = _schema(
    ("cst_id", L),
    ("cst_key", S),
    ("cst_firstname", S),
    ("cst_lastname", S),
    ("cst_marital_status", S),
    ("cst_gndr", S),
    ("cst_create_date", S),
)
CRM_PRODUCT = _schema(
    ("prd_id", L),
    ("prd_key", S),
    ("prd_nm", S),
    ("prd_cost", D),
    ("prd_line", S),
    ("prd_start_dt", S),
    ("prd_end_dt", S),
)
CRM_SALES = _schema(
    ("sls_ord_num", S),
    ("sls_prd_key", S),
    ("sls_cust_id", S),
    ("sls_order_dt", I),
    ("sls_ship_dt", I),
    ("sls_due_dt", I),
    ("sls_sales", D),
    ("sls_quantity", I),
    ("sls_price", D),
)

FEEDS: dict[str, T.StructType] = {
    "customer": ERP_CUSTOMER,
    "customer_location": ERP_LOCATION,
    "customer_info": CRM_CUSTOMER,
    "product_categories": ERP_CATEGORY,
    "product_info": CRM_PRODUCT,
    "sales_details": CRM_SALES,
}

# Warehouse tables
DIM_CUSTOMER = _schema(
    ("customer_id", L),
    ("customer_key", S),
    ("first_name", S),
    ("last_name", S),
    ("gender", S),
    ("marital_status", S),
    ("birth_date", S),
    ("country", S),
    ("customer_create_date", DT),
    ("effective_date", DT),
    ("end_date", DT),
    ("current_flag", S),
    ("customer_sk", S),
)
DIM_PRODUCT = _schema(
    ("product_id", L),
    ("product_key", S),
    ("product_name", S),
    ("product_cost", D),
    ("product_line", S),
    ("category", S),
    ("subcategory", S),
    ("maintenance", S),
    ("start_date", DT),
    ("end_date", DT),
    ("effective_date", DT),
    ("end_date_history", DT),
    ("current_flag", S),
    ("product_sk", S),
)
DIM_DATE = _schema(
    ("full_date", DT),
    ("day", I),
    ("month", I),
    ("month_name", S),
    ("quarter", I),
    ("year", I),
    ("date_sk", S),
)
FACT_SALES = _schema(
    ("sls_ord_num", S),
    ("customer_sk", S),
    ("product_sk", S),
    ("order_date_sk", S),
    ("ship_date_sk", S),
    ("due_date_sk", S),
    ("sls_quantity", I),
    ("sls_price", D),
    ("sls_sales", D),
    ("created_date", DT),
    ("sales_sk", S),
)
CONTROL = _schema(("table_name", S), ("watermark", DT))

TABLES: dict[str, T.StructType] = {
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    "dim_date": DIM_DATE,
    "fact_sales": FACT_SALES,
    "etl_control": CONTROL,
}
