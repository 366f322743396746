"""The derived raw feeds, written independently as DuckDB SQL.

These are the SQL twins of ``starloom.sources.derived``; the oracle queries build on
them. Tables ``customer orders part lineitem nation`` are the driver's views.
"""

from __future__ import annotations

from starloom.sources.derived import (
    BATCH1_SKIP_MOD,
    BATCH2_EDITS,
    CATEGORY_ROWS,
    DEFAULT_CREATE_DATE,
    SALES_BATCH1_BEFORE,
    SALES_BATCH1_SHIPPED_BEFORE,
)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def crm_customer(batch: int) -> str:
    skip = f"WHERE c_custkey % {BATCH1_SKIP_MOD} <> 0" if batch == 1 else ""
    first = "CASE WHEN c_custkey % 5 = 0 THEN ' ' || proper || ' ' ELSE proper END"
    if batch == 2:
        first = f"CASE WHEN c_custkey % {BATCH2_EDITS['case_only_name_mod']} = 0 THEN upper({first}) ELSE {first} END"
    return f"""
    SELECT c_custkey AS cst_id,
           CASE WHEN c_custkey % 2 = 0 THEN ' AW' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') || ' '
                WHEN c_custkey % 3 = 0 THEN 'AW' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') || chr(9)
                ELSE 'AW' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS cst_key,
           {first} AS cst_firstname,
           CASE WHEN c_custkey % 3 = 0 THEN replace(c_name, 'Customer#', 'Client ') || '  '
                ELSE replace(c_name, 'Customer#', 'Client ') END AS cst_lastname,
           CASE c_custkey % 3 WHEN 0 THEN 'm' WHEN 1 THEN 's' ELSE 'M' END AS cst_marital_status,
           CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'f' ELSE 'M' END AS cst_gndr,
           CASE WHEN c_custkey % 41 = 0 THEN 'not-a-date'
                WHEN c_custkey % 43 = 0 THEN '2999-' || lpad(CAST(c_custkey % 12 + 1 AS VARCHAR), 2, '0') || '-15'
                ELSE CAST(created AS VARCHAR) END AS cst_create_date,
           created
    FROM (
      SELECT c.c_custkey, c.c_name,
             upper(substring(c.c_mktsegment, 1, 1)) || lower(substring(c.c_mktsegment, 2, 1048576)) AS proper,
             coalesce(f.first_dt, DATE '{DEFAULT_CREATE_DATE.isoformat()}') AS created
      FROM customer c
      LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_dt FROM orders GROUP BY o_custkey) f
        ON c.c_custkey = f.o_custkey
      {skip}
    ) b"""


def crm_customer_all(batch: int) -> str:
    return f"""
    SELECT cst_id, cst_key, cst_firstname, cst_lastname, cst_marital_status, cst_gndr, cst_create_date
    FROM crm_rows_b{batch}
    UNION ALL
    SELECT cst_id + 1000000, cst_key, cst_firstname, 'Other ' || cst_lastname, cst_marital_status, cst_gndr,
           CAST(created + 30 AS VARCHAR)
    FROM crm_rows_b{batch} WHERE cst_id % 10 = 0
    UNION ALL
    SELECT cst_id + 2000000, cst_key, cst_firstname, cst_lastname, cst_marital_status, cst_gndr, NULL
    FROM crm_rows_b{batch} WHERE cst_id % 50 = 0"""


def erp_customer(batch: int) -> str:
    bdate = "CAST(DATE '1950-01-01' + CAST((c_custkey * 37) % 18000 AS INTEGER) AS VARCHAR)"
    if batch == 2:
        bdate = f"CASE WHEN c_custkey % {BATCH2_EDITS['birth_date_nulled_mod']} = 0 THEN NULL ELSE {bdate} END"
    return f"""
    SELECT CASE WHEN c_custkey % 2 = 0 THEN 'AW' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') || ' '
                ELSE ' AW' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS "CID",
           {bdate} AS "BDATE",
           CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS "GEN"
    FROM customer WHERE c_custkey % 7 <> 0"""


def erp_location(batch: int) -> str:
    nk = "c_nationkey"
    if batch == 2:
        nk = f"CASE WHEN c_custkey % {BATCH2_EDITS['country_changed_mod']} = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END"
    return f"""
    SELECT CASE WHEN c.c_custkey % 19 = 0 THEN 'AW-' || lpad(CAST(c.c_custkey AS VARCHAR), 8, '0') || ' '
                ELSE 'AW-' || lpad(CAST(c.c_custkey AS VARCHAR), 8, '0') END AS "CID",
           n.n_name AS "CNTRY"
    FROM (SELECT c_custkey, {nk} AS nk FROM customer) c
    LEFT JOIN nation n ON c.nk = n.n_nationkey"""


def product_categories() -> str:
    rows = ",\n      ".join("(" + ", ".join(_q(v) for v in r) + ")" for r in CATEGORY_ROWS)
    return f"""
    SELECT * FROM (VALUES
      {rows}
    ) AS v("ID", "CAT", "SUBCAT", "MAINTENANCE")"""


def crm_product(batch: int) -> str:
    name = "CASE WHEN p_partkey % 5 = 0 THEN ' ' || p_name ELSE p_name END"
    cost = "CASE WHEN p_partkey % 100 = 0 THEN NULL ELSE p_retailprice END"
    if batch == 2:
        name = f"CASE WHEN p_partkey % {BATCH2_EDITS['product_name_case_mod']} = 0 THEN upper({name}) ELSE {name} END"
        cost = f"CASE WHEN p_partkey % {BATCH2_EDITS['product_cost_changed_mod']} = 0 THEN ({cost}) + 1.0 ELSE {cost} END"
    skip = f"WHERE p_partkey % {BATCH1_SKIP_MOD} <> 0" if batch == 1 else ""
    return f"""
    SELECT p_partkey AS prd_id,
           CASE g % 4 WHEN 0 THEN 'AC' WHEN 1 THEN 'BI' WHEN 2 THEN 'CL' ELSE 'CO' END
             || '-S' || CAST(g % 3 AS VARCHAR) || '-FR-' || CAST(g AS VARCHAR) AS prd_key,
           {name} AS prd_nm,
           CAST({cost} AS DOUBLE) AS prd_cost,
           CASE WHEN p_partkey % 37 = 0 THEN NULL
                WHEN p_partkey % 2 = 0 THEN substring(p_type, 1, 1) || ' '
                ELSE lower(substring(p_type, 1, 1)) END AS prd_line,
           CAST(start_d AS VARCHAR) AS prd_start_dt,
           CAST(start_d - 100 AS VARCHAR) AS prd_end_dt
    FROM (
      SELECT *, DATE '2000-01-01' + CAST(g % 1000 + (2 - p_partkey % 3) * 1000 AS INTEGER) AS start_d
      FROM (SELECT *, (p_partkey - p_partkey % 3) // 3 AS g FROM part {skip}) p0
    ) p"""


def crm_sales(batch: int) -> str:
    cut = f"WHERE o_orderdate < DATE '{SALES_BATCH1_BEFORE.isoformat()}'" if batch == 1 else ""
    ship_cut = f"WHERE l_shipdate < DATE '{SALES_BATCH1_SHIPPED_BEFORE.isoformat()}'" if batch == 1 else ""
    return f"""
    SELECT 'SO' || CAST(l_orderkey AS VARCHAR) AS sls_ord_num,
           CASE WHEN l_linenumber % 4 = 0 THEN ' ' || prd || ' ' ELSE prd END AS sls_prd_key,
           CASE WHEN l_linenumber % 5 = 0 THEN ' ' || CAST(o_custkey AS VARCHAR)
                ELSE CAST(o_custkey AS VARCHAR) END AS sls_cust_id,
           CASE WHEN l_orderkey % 97 = 0 THEN 0
                WHEN l_orderkey % 89 = 0 THEN 32154
                ELSE CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER)
           END AS sls_order_dt,
           CAST(year(ship) * 10000 + month(ship) * 100 + day(ship) AS INTEGER) AS sls_ship_dt,
           CAST(year(ship + 7) * 10000 + month(ship + 7) * 100 + day(ship + 7) AS INTEGER) AS sls_due_dt,
           l_extendedprice AS sls_sales,
           CAST(trunc(l_quantity) AS INTEGER) AS sls_quantity,
           l_extendedprice / l_quantity AS sls_price
    FROM (
      SELECT l.*, o.o_custkey, o.o_orderdate, CAST(l.l_shipdate AS DATE) AS ship,
             'FR-' || CAST((l.l_partkey - l.l_partkey % 3) // 3 AS VARCHAR) AS prd
      FROM (SELECT * FROM lineitem {ship_cut}) l
      JOIN (SELECT o_orderkey, o_custkey, o_orderdate FROM orders {cut}) o
        ON l.l_orderkey = o.o_orderkey
    ) s"""


def feed_ctes() -> list[tuple[str, str]]:
    """(name, body) pairs of every feed CTE for both batches."""
    out: list[tuple[str, str]] = [("erp_category", product_categories())]
    for b in (1, 2):
        out += [
            (f"crm_rows_b{b}", crm_customer(b)),
            (f"crm_customer_b{b}", crm_customer_all(b)),
            (f"erp_customer_b{b}", erp_customer(b)),
            (f"erp_location_b{b}", erp_location(b)),
            (f"crm_product_b{b}", crm_product(b)),
            (f"crm_sales_b{b}", crm_sales(b)),
        ]
    return out
