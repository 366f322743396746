"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written as plain SQL over the driver views: the feed CTEs of ``oracle_feeds`` and the
warehouse steps below. Nothing here calls the Spark operators.
"""

from __future__ import annotations

from starloom.plans import oracle_feeds
from starloom.sources.derived import BATCH1_DATE, BATCH2_DATE

D1 = f"DATE '{BATCH1_DATE.isoformat()}'"
D2 = f"DATE '{BATCH2_DATE.isoformat()}'"
# The code points that Python's str.strip() removes.
_SPACE_CODES = [
    9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760,
    8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199, 8200, 8201, 8202,
    8232, 8233, 8239, 8287, 12288,
]
_WS = " || ".join(f"chr({c})" for c in _SPACE_CODES)


def ws(x: str) -> str:
    """Python-style strip in DuckDB."""
    return f"trim({x}, {_WS})"


def norm(x: str) -> str:
    return f"upper({ws(x)})"


def pdate(x: str) -> str:
    return f"TRY_CAST({x} AS DATE)"


def ymd(x: str) -> str:
    return f"CAST(try_strptime(CAST({x} AS VARCHAR), '%Y%m%d') AS DATE)"


def short_key(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE array_to_string(string_split({ws(x)}, '-')[3:], '-') END"


def zfill8(x: str) -> str:
    return (
        f"CASE WHEN length({x}) >= 8 THEN {x} "
        f"WHEN {x} LIKE '-%' OR {x} LIKE '+%' THEN substring({x}, 1, 1) || lpad(substring({x}, 2), 7, '0') "
        f"ELSE lpad({x}, 8, '0') END"
    )


def padded_cust(src: str) -> str:
    """Reference mode: one batch-wide decision."""
    ids = ws("sls_cust_id")
    return (
        f"CASE WHEN (SELECT coalesce(bool_and(starts_with({ids}, 'AW')), true) FROM {src}) "
        f"THEN {ids} ELSE 'AW' || {zfill8(ids)} END"
    )


CUST_COLS = [
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
CUST_TRACKED = ["first_name", "last_name", "gender", "marital_status", "birth_date", "country"]
CUST_DIM = CUST_COLS + ["effective_date", "end_date", "current_flag", "customer_sk"]
CUST_ORDER = "customer_create_date ASC NULLS LAST, customer_key ASC NULLS LAST, customer_id ASC NULLS LAST"

PROD_COLS = [
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
PROD_TRACKED = [
    "product_name",
    "product_cost",
    "product_line",
    "category",
    "subcategory",
    "maintenance",
    "start_date",
    "end_date",
]
PROD_DIM = PROD_COLS + ["effective_date", "end_date_history", "current_flag", "product_sk"]
PROD_ORDER = "product_key ASC NULLS LAST, start_date ASC NULLS LAST, product_id ASC NULLS LAST"

FACT_COLS = [
    "sls_ord_num",
    "customer_sk",
    "product_sk",
    "order_date_sk",
    "ship_date_sk",
    "due_date_sk",
    "sls_quantity",
    "sls_price",
    "sls_sales",
]
FACT_ORDER = ", ".join(f"{c} ASC NULLS LAST" for c in FACT_COLS)


def _cols(cols, alias=None):
    return ", ".join(f"{alias}.{c}" if alias else c for c in cols)


def _cust_flag(c: str) -> str:
    if "date" in c:
        return f"({pdate(norm('f.' + c))} IS DISTINCT FROM {pdate(norm('s.' + c))})"
    return f"({norm('f.' + c)} IS DISTINCT FROM {norm('s.' + c)})"


def _prod_flag(c: str) -> str:
    if "date" in c:
        return f"(CAST(f.{c} AS DATE) IS DISTINCT FROM CAST(s.{c} AS DATE))"
    if c == "product_cost":
        return f"(CAST(f.{c} AS DOUBLE) IS DISTINCT FROM CAST(s.{c} AS DOUBLE))"
    return f"({norm('f.' + c)} IS DISTINCT FROM {norm('s.' + c)})"


def _kind(sk_old: str, tracked: list[str]) -> str:
    anyc = " OR ".join(f"chg_{c}" for c in tracked)
    return (
        f"CASE WHEN {sk_old} IS NULL THEN 'new' "
        f"WHEN current_flag_old IS NULL OR current_flag_old <> 'Y' THEN 'ignore' "
        f"WHEN {anyc} THEN 'changed' ELSE 'same' END"
    )


def _customer_ctes(b: int) -> list[tuple[str, str]]:
    p = D1 if b == 1 else D2
    conf = f"""
    SELECT i.cst_id AS customer_id, i.k AS customer_key,
           {ws('i.cst_firstname')} AS first_name, {ws('i.cst_lastname')} AS last_name,
           upper(i.cst_gndr) AS gender, upper(i.cst_marital_status) AS marital_status,
           e."BDATE" AS birth_date, l."CNTRY" AS country,
           CASE WHEN {pdate('i.cst_create_date')} > {p} THEN {p} ELSE {pdate('i.cst_create_date')} END
             AS customer_create_date
    FROM (SELECT *, {ws('cst_key')} AS k FROM crm_customer_b{b}) i
    LEFT JOIN (SELECT {ws('"CID"')} AS cid, "BDATE" FROM erp_customer_b{b}) e ON i.k = e.cid
    LEFT JOIN (SELECT replace("CID", '-', '') AS cid, "CNTRY" FROM erp_location_b{b}) l ON i.k = l.cid"""
    dedupe = f"""
    SELECT {_cols(CUST_COLS)} FROM (
      SELECT *, row_number() OVER (PARTITION BY customer_key
               ORDER BY customer_create_date DESC NULLS FIRST, customer_id DESC) AS rn
      FROM conf_customer_b{b}) x WHERE rn = 1"""
    return [(f"conf_customer_b{b}", conf), (f"cust_b{b}", dedupe)]


def _product_ctes(b: int) -> list[tuple[str, str]]:
    validity = f"""
    SELECT prd_id, prd_key, prd_nm, prd_cost, prd_line, start_d AS prd_start_dt,
           CASE WHEN prd_key IS NULL THEN NULL
                ELSE array_to_string(string_split(prd_key, '-')[1:2], '_') END AS cat_id,
           CASE WHEN prd_key IS NULL THEN NULL
                ELSE lead(start_d) OVER (PARTITION BY prd_key ORDER BY start_d ASC NULLS LAST, prd_id ASC) END
             AS prd_end_dt
    FROM (SELECT *, {pdate('prd_start_dt')} AS start_d FROM crm_product_b{b}) x"""
    conf = f"""
    SELECT v.prd_id AS product_id, v.prd_key AS product_key, {ws('v.prd_nm')} AS product_name,
           v.prd_cost AS product_cost, upper(v.prd_line) AS product_line,
           c."CAT" AS category, c."SUBCAT" AS subcategory, c."MAINTENANCE" AS maintenance,
           v.prd_start_dt AS start_date, v.prd_end_dt AS end_date
    FROM pv_b{b} v LEFT JOIN erp_category c ON v.cat_id = c."ID" """
    return [(f"pv_b{b}", validity), (f"prod_b{b}", conf)]


def _date_rows(src: str, keep_unparsed: bool) -> str:
    where = "" if keep_unparsed else "WHERE full_date IS NOT NULL"
    return f"""
    SELECT full_date, CAST(day(full_date) AS INTEGER) AS day, CAST(month(full_date) AS INTEGER) AS month,
           monthname(full_date) AS month_name, CAST(quarter(full_date) AS INTEGER) AS quarter,
           CAST(year(full_date) AS INTEGER) AS year
    FROM (SELECT {ymd('code')} AS full_date
          FROM (SELECT DISTINCT code FROM (
                  SELECT sls_order_dt AS code FROM {src} UNION ALL
                  SELECT sls_ship_dt FROM {src} UNION ALL
                  SELECT sls_due_dt FROM {src}) u WHERE code IS NOT NULL) c) d
    {where}"""


def _fact(sales: str, cust: str, prod: str, dates: str, p: str, null_safe: bool = False) -> str:
    eq = "IS NOT DISTINCT FROM" if null_safe else "="
    return f"""
    SELECT s.sls_ord_num, c.customer_sk, pr.product_sk,
           d1.date_sk AS order_date_sk, d2.date_sk AS ship_date_sk, d3.date_sk AS due_date_sk,
           s.sls_quantity, s.sls_price, s.sls_sales, {p} AS created_date
    FROM (SELECT sls_ord_num, {padded_cust(sales)} AS cust_id, {ws('sls_prd_key')} AS prd_key,
                 {ymd('sls_order_dt')} AS od, {ymd('sls_ship_dt')} AS sd, {ymd('sls_due_dt')} AS dd,
                 sls_quantity, sls_price, sls_sales FROM {sales}) s
    LEFT JOIN (SELECT {ws('customer_key')} AS k, customer_sk FROM {cust} WHERE current_flag = 'Y') c
      ON s.cust_id = c.k
    LEFT JOIN (SELECT {short_key('product_key')} AS k, product_sk FROM {prod} WHERE current_flag = 'Y') pr
      ON s.prd_key = pr.k
    LEFT JOIN {dates} d1 ON s.od {eq} d1.full_date
    LEFT JOIN {dates} d2 ON s.sd {eq} d2.full_date
    LEFT JOIN {dates} d3 ON s.dd {eq} d3.full_date"""


def _numbered(src: str, order: str, prefix: str, start: str = "0", col: str = "sk") -> str:
    return f"""
    SELECT *, '{prefix}' || CAST({start} + row_number() OVER (ORDER BY {order}) AS VARCHAR) AS {col} FROM {src}"""


def warehouse_ctes() -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for b in (1, 2):
        out += _customer_ctes(b)
        out += _product_ctes(b)
    # ---- batch 1: initial loads ----
    out.append(
        (
            "cust_snap1",
            f"""
    SELECT {_cols(CUST_COLS)}, {D1} AS effective_date, CAST(NULL AS DATE) AS end_date, 'Y' AS current_flag,
           'CUST' || CAST(row_number() OVER (ORDER BY {CUST_ORDER}) AS VARCHAR) AS customer_sk
    FROM cust_b1""",
        )
    )
    out.append(
        (
            "prod_snap1",
            f"""
    SELECT {_cols(PROD_COLS)}, {D1} AS effective_date, CAST(NULL AS DATE) AS end_date_history,
           'Y' AS current_flag,
           'PROD' || CAST(row_number() OVER (ORDER BY {PROD_ORDER}) AS VARCHAR) AS product_sk
    FROM prod_b1""",
        )
    )
    # ---- batch 2 vs snapshot 1 ----
    for name, feed, snap, cols, tracked, key, sk, flag_fn in (
        ("cust", "cust_b2", "cust_snap1", CUST_COLS, CUST_TRACKED, "customer_key", "customer_sk", _cust_flag),
        ("prod", "prod_b2", "prod_snap1", PROD_COLS, PROD_TRACKED, "product_id", "product_sk", _prod_flag),
    ):
        flags = ", ".join(f"{flag_fn(c)} AS chg_{c}" for c in tracked)
        olds = ", ".join(f"s.{c} AS {c}_old" for c in tracked)
        out.append(
            (
                f"{name}_pairs2",
                f"""
    SELECT *, {_kind(sk + '_old', tracked)} AS change_kind FROM (
      SELECT {_cols(cols, 'f')}, s.{sk} AS {sk}_old, {olds}, s.current_flag AS current_flag_old, {flags}
      FROM {feed} f LEFT JOIN {snap} s ON f.{key} IS NOT DISTINCT FROM s.{key}) x""",
            )
        )
    out.append(
        (
            "cust_closed2",
            f"""
    SELECT {_cols(CUST_COLS)}, effective_date, {D2} AS end_date, 'N' AS current_flag, customer_sk
    FROM cust_snap1 WHERE customer_sk IN (SELECT customer_sk_old FROM cust_pairs2 WHERE change_kind = 'changed')""",
        )
    )
    out.append(
        (
            "cust_unchanged2",
            """
    SELECT * FROM cust_snap1 s WHERE NOT EXISTS
      (SELECT 1 FROM cust_pairs2 p WHERE p.change_kind = 'changed' AND p.customer_sk_old = s.customer_sk)""",
        )
    )
    out.append(
        (
            "cust_opened2",
            f"""
    SELECT {_cols(CUST_COLS)}, {D2} AS effective_date, CAST(NULL AS DATE) AS end_date, 'Y' AS current_flag,
           'CUST' || CAST((SELECT coalesce(max(TRY_CAST(replace(customer_sk, 'CUST', '') AS BIGINT)), 0)
                           FROM cust_snap1) + row_number() OVER (ORDER BY {CUST_ORDER}) AS VARCHAR) AS customer_sk,
           change_kind = 'new' AS new
    FROM cust_pairs2 WHERE change_kind IN ('new', 'changed')""",
        )
    )
    out.append(
        (
            "cust_merged2",
            f"""
    SELECT {_cols(CUST_DIM)} FROM cust_unchanged2
    UNION ALL SELECT {_cols(CUST_DIM)} FROM cust_closed2
    UNION ALL SELECT {_cols(CUST_DIM)} FROM cust_opened2""",
        )
    )
    out.append(
        (
            "prod_opened2",
            f"""
    SELECT {_cols(PROD_COLS)}, {D2} AS effective_date, CAST(NULL AS DATE) AS end_date_history,
           'Y' AS current_flag,
           'PROD' || CAST((SELECT coalesce(max(TRY_CAST(replace(product_sk, 'PROD', '') AS BIGINT)), 0)
                           FROM prod_snap1) + row_number() OVER (ORDER BY {PROD_ORDER}) AS VARCHAR) AS product_sk,
           change_kind = 'new' AS new
    FROM prod_pairs2 WHERE change_kind IN ('new', 'changed')""",
        )
    )
    out.append(
        (
            "prod_merged2",
            f"""
    SELECT {_cols(PROD_COLS)}, effective_date,
           CASE WHEN closed THEN {D2} ELSE end_date_history END AS end_date_history,
           CASE WHEN closed THEN 'N' ELSE current_flag END AS current_flag, product_sk
    FROM (SELECT s.*, s.product_sk IN (SELECT product_sk_old FROM prod_pairs2 WHERE change_kind = 'changed')
                 AS closed FROM prod_snap1 s) x
    UNION ALL SELECT {_cols(PROD_DIM)} FROM prod_opened2""",
        )
    )
    out.append(
        (
            "prod_marked2",
            f"""
    SELECT {_cols(PROD_COLS)}, effective_date,
           CASE WHEN closed THEN {D2} ELSE end_date_history END AS end_date_history,
           CASE WHEN closed THEN 'N' ELSE current_flag END AS current_flag, product_sk
    FROM (SELECT s.*, s.product_sk IN (SELECT product_sk_old FROM prod_pairs2 WHERE change_kind = 'changed')
                 AS closed FROM prod_snap1 s) x""",
        )
    )
    out.append(
        ("cust_marked2", f"SELECT {_cols(CUST_DIM)} FROM cust_unchanged2 UNION ALL SELECT {_cols(CUST_DIM)} FROM cust_closed2")
    )
    # ---- dates and facts of batch 1 ----
    out.append(("date_rows1", _date_rows("crm_sales_b1", False)))
    out.append(("dim_date1", _numbered("date_rows1", "full_date ASC NULLS LAST", "DATE", col="date_sk")))
    out.append(("fact_rows1", _fact("crm_sales_b1", "cust_snap1", "prod_snap1", "dim_date1", D1)))
    out.append(("fact1", _numbered("fact_rows1", FACT_ORDER, "SALES", col="sales_sk")))
    # ---- a first load of the full feeds ----
    first = [("cust_full", CUST_COLS, "end_date", "CUST", CUST_ORDER, "customer_sk", "cust_b2")]
    first.append(("prod_full", PROD_COLS, "end_date_history", "PROD", PROD_ORDER, "product_sk", "prod_b2"))
    for name, cols, end, prefix, order, key, feed in first:
        out.append(
            (
                name,
                f"""
    SELECT {_cols(cols)}, {D2} AS effective_date, CAST(NULL AS DATE) AS {end}, 'Y' AS current_flag,
           '{prefix}' || CAST(row_number() OVER (ORDER BY {order}) AS VARCHAR) AS {key}
    FROM {feed}""",
            )
        )
    out.append(("dim_date_full", _numbered(f"({_date_rows('crm_sales_b2', False)}) r", "full_date ASC NULLS LAST", "DATE", col="date_sk")))
    out.append(("sales_padded", f"SELECT * REPLACE ({padded_cust('crm_sales_b2')} AS sls_cust_id) FROM crm_sales_b2"))
    out.append(("fact_rows_full", _fact("crm_sales_b2", "cust_full", "prod_full", "dim_date_full", D2)))
    out.append(("fact_full", _numbered("fact_rows_full", FACT_ORDER, "SALES", col="sales_sk")))
    # ---- dates and facts of batch 2 ----
    out.append(("date_rows2", _date_rows("crm_sales_b2", False)))
    out.append(
        (
            "new_dates2",
            _numbered(
                "(SELECT * FROM date_rows2 WHERE full_date NOT IN (SELECT full_date FROM dim_date1)) r",
                "full_date ASC NULLS LAST",
                "DATE",
                start=_max_key("dim_date1", "date_sk", "DATE"),
                col="date_sk",
            ),
        )
    )
    out.append(("dim_date2", "SELECT * FROM dim_date1 UNION ALL SELECT * FROM new_dates2"))
    out.append(("fact_rows2", _fact("crm_sales_b2", "cust_merged2", "prod_merged2", "dim_date2", D2)))
    out.append(
        (
            "fact2",
            _numbered("fact_rows2", FACT_ORDER, "SALES", start=_max_key("fact1", "sales_sk", "SALES"), col="sales_sk"),
        )
    )
    return out


def _max_key(table: str, col: str, prefix: str) -> str:
    return f"(SELECT coalesce(max(CAST(replace({col}, '{prefix}', '') AS BIGINT)), 0) FROM {table})"


def _plain_sales(src: str) -> str:
    """Sales without the blanks around ids and product keys."""
    return f"SELECT * REPLACE ({ws('sls_prd_key')} AS sls_prd_key, {ws('sls_cust_id')} AS sls_cust_id) FROM {src}"


#: The sales of batch 2 that batch 1 did not have, equal rows counted.
SALES_NOT_LOADED = f"({_plain_sales('crm_sales_b2')} EXCEPT ALL {_plain_sales('crm_sales_b1')})"


def _balance(fact: str, sales: str, version: int, day: str) -> str:
    """Audit rows of a fact load: sales in, fan-out, and lookups without a key."""
    n_in = f"(SELECT count(*) FROM {sales})"
    counts = {"in": f"count(*) * 0 + {n_in}", "fan_out": f"count(*) - {n_in}", "filtered": "count(*) * 0"}
    for name in ("customer", "product", "order_date", "ship_date", "due_date"):
        counts[f"unmatched_{name}"] = f"count(*) FILTER (WHERE {name}_sk IS NULL)"
    return " UNION ALL ".join(f"SELECT 'fact_sales', '{stage}', (SELECT {n} FROM {fact}), {version}, {day}" for stage, n in counts.items())


def prelude() -> str:
    ctes = oracle_feeds.feed_ctes() + warehouse_ctes()
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in ctes) + "\n"


# ---- final SELECTs per query ---------------------------------------------------------------

CUST_FLAGS = ", ".join(f"chg_{c}" for c in CUST_TRACKED)

FINAL: dict[str, str] = {
    "std_text": f"""
    SELECT cst_id, {ws('cst_key')} AS customer_key, {ws('cst_firstname')} AS first_name,
           {ws('cst_lastname')} AS last_name, upper(cst_gndr) AS gender,
           upper(cst_marital_status) AS marital_status, {norm('cst_firstname')} AS first_name_norm
    FROM crm_customer_b2""",
    "safe_date_parse": f"SELECT cst_id, cst_create_date, {pdate('cst_create_date')} AS create_date FROM crm_customer_b2",
    "yyyymmdd_parse": f"""
    SELECT sls_ord_num, sls_order_dt, sls_ship_dt, sls_due_dt, {ymd('sls_order_dt')} AS order_date,
           {ymd('sls_ship_dt')} AS ship_date, {ymd('sls_due_dt')} AS due_date FROM crm_sales_b2""",
    "clamp_future_dates": f"""
    SELECT cst_id, create_date, CASE WHEN create_date > {D2} THEN {D2} ELSE create_date END AS create_date_clamped
    FROM (SELECT cst_id, {pdate('cst_create_date')} AS create_date FROM crm_customer_b2) x""",
    "derive_category_key": """
    SELECT prd_id, prd_key, CASE WHEN prd_key IS NULL THEN NULL
           ELSE array_to_string(string_split(prd_key, '-')[1:2], '_') END AS cat_id FROM crm_product_b2""",
    "derive_short_product_key": f"SELECT prd_id, prd_key, {short_key('prd_key')} AS short_key FROM crm_product_b2",
    "pad_customer_key": f"""
    SELECT sls_ord_num, sls_cust_id, {padded_cust('crm_sales_b2')} AS customer_key,
           CASE WHEN starts_with({ws('sls_cust_id')}, 'AW') THEN {ws('sls_cust_id')}
                ELSE 'AW' || {zfill8(ws('sls_cust_id'))} END AS customer_key_per_row
    FROM crm_sales_b2""",
    "conform_customer": "SELECT * FROM conf_customer_b2",
    "dedupe_latest_customer": "SELECT * FROM cust_b2",
    "product_validity": "SELECT * FROM pv_b2",
    "conform_product": "SELECT * FROM prod_b2",
    "dim_date_build": "SELECT * FROM ("
    + _numbered(f"({_date_rows('crm_sales_b2', False)}) r", "full_date ASC NULLS LAST", "DATE", col="date_sk")
    + ") z",
    "dim_date_with_unparsed": "SELECT * FROM ("
    + _numbered(f"({_date_rows('crm_sales_b2', True)}) r", "full_date ASC NULLS LAST", "DATE", col="date_sk")
    + ") z",
    "sk_assign_customer": "SELECT customer_key, customer_id, customer_sk FROM cust_full",
    "sk_assign_date": "SELECT full_date, date_sk FROM dim_date_full",
    "sk_assign_fact": "SELECT * FROM ("
    + _numbered(
        "crm_sales_b2",
        ", ".join(
            f"{c} ASC NULLS LAST"
            for c in [
                "sls_ord_num",
                "sls_prd_key",
                "sls_cust_id",
                "sls_order_dt",
                "sls_ship_dt",
                "sls_due_dt",
                "sls_sales",
                "sls_quantity",
                "sls_price",
            ]
        ),
        "SALES",
        col="sales_sk",
    )
    + ") z",
    "sk_continue_sequence": """
    SELECT 'dim_customer' AS table_name,
           (SELECT max(CAST(replace(customer_sk, 'CUST', '') AS BIGINT)) FROM cust_snap1) AS last_key,
           min(n) AS first_new_key, max(n) AS last_new_key, count(n) AS n_new
    FROM (SELECT CAST(replace(customer_sk, 'CUST', '') AS BIGINT) AS n FROM cust_opened2) a
    UNION ALL
    SELECT 'dim_product',
           (SELECT max(CAST(replace(product_sk, 'PROD', '') AS BIGINT)) FROM prod_snap1),
           min(n), max(n), count(n)
    FROM (SELECT CAST(replace(product_sk, 'PROD', '') AS BIGINT) AS n FROM prod_opened2) b""",
    "sk_unprefixed": f"""
    SELECT *, row_number() OVER (ORDER BY full_date ASC NULLS LAST) AS date_sk
    FROM ({_date_rows('crm_sales_b2', False)}) r""",
    "scd2_initial_customer": "SELECT * FROM cust_full",
    "scd2_change_flags": f"SELECT customer_key, customer_id, {CUST_FLAGS} FROM cust_pairs2",
    "scd2_classify_customer": """
    SELECT customer_key, customer_id, customer_sk_old, current_flag_old, change_kind FROM cust_pairs2""",
    "scd2_classify_product": """
    SELECT product_id, product_key, product_sk_old, current_flag_old, change_kind FROM prod_pairs2""",
    "scd2_close_customer": "SELECT * FROM cust_closed2",
    "scd2_open_customer": "SELECT * FROM cust_opened2",
    "scd2_merge_customer": "SELECT * FROM cust_merged2",
    "scd2_merge_product": "SELECT * FROM prod_merged2",
    "current_members": "SELECT * FROM cust_merged2 WHERE current_flag = 'Y'",
    "expired_members": "SELECT * FROM cust_merged2 WHERE end_date IS NOT NULL",
    "scd2_reapply_customer": """
    SELECT f.customer_key, f.customer_id, s.customer_sk AS customer_sk_old, s.current_flag AS current_flag_old,
           CASE WHEN s.customer_sk IS NULL THEN 'new'
                WHEN s.current_flag IS NULL OR s.current_flag <> 'Y' THEN 'ignore'
                WHEN """
    + " OR ".join(_cust_flag(c) for c in CUST_TRACKED)
    + """ THEN 'changed' ELSE 'same' END AS change_kind
    FROM cust_b2 f LEFT JOIN cust_merged2 s ON f.customer_key IS NOT DISTINCT FROM s.customer_key""",
    "lookup_customer_sk": f"""
    SELECT s.sls_ord_num, s.sls_cust_id, s.sls_ship_dt, s.sls_sales, c.customer_sk
    FROM sales_padded s
    LEFT JOIN (SELECT {ws('customer_key')} AS k, customer_sk FROM cust_full WHERE current_flag = 'Y') c
      ON s.sls_cust_id = c.k""",
    "lookup_customer_sk_salted": f"""
    SELECT s.sls_ord_num, s.sls_cust_id, s.sls_ship_dt, s.sls_sales, c.customer_sk
    FROM sales_padded s
    LEFT JOIN (SELECT {ws('customer_key')} AS k, customer_sk FROM cust_full WHERE current_flag = 'Y') c
      ON s.sls_cust_id = c.k""",
    "lookup_product_sk": f"""
    SELECT s.sls_ord_num, {ws('s.sls_prd_key')} AS sls_prd_key, s.sls_ship_dt, s.sls_sales, p.product_sk
    FROM crm_sales_b2 s
    LEFT JOIN (SELECT {short_key('product_key')} AS k, product_sk FROM prod_full WHERE current_flag = 'Y') p
      ON {ws('s.sls_prd_key')} = p.k""",
    "lookup_product_sk_as_of": f"""
    SELECT s.sls_ord_num, {ws('s.sls_prd_key')} AS sls_prd_key, s.sls_order_dt, s.sls_ship_dt, s.sls_sales,
           (SELECT max_by(product_sk, (start_date, product_id)) FROM prod_full p
            WHERE p.current_flag = 'Y' AND {short_key('p.product_key')} = {ws('s.sls_prd_key')}
              AND p.start_date <= {ymd('s.sls_order_dt')} + INTERVAL 120 MONTH) AS product_sk
    FROM crm_sales_b2 s""",
    "sales_profile": f"""
    SELECT count(*) AS n_rows, bool_and(starts_with({ws('sls_cust_id')}, 'AW')) AS all_prefixed,
           max({ymd('sls_order_dt')}) AS latest_order FROM crm_sales_b2""",
    "lookup_product_sk_one_version": f"""
    SELECT s.sls_ord_num, {ws('s.sls_prd_key')} AS sls_prd_key, s.sls_ship_dt, s.sls_sales, p.product_sk
    FROM crm_sales_b2 s
    LEFT JOIN (SELECT k, product_sk FROM (
                 SELECT {short_key('product_key')} AS k, product_sk,
                        row_number() OVER (PARTITION BY {short_key('product_key')}
                                           ORDER BY start_date DESC NULLS LAST, product_id DESC) AS rn
                 FROM prod_full WHERE current_flag = 'Y') x WHERE rn = 1) p
      ON {ws('s.sls_prd_key')} = p.k""",
    "lookup_date_sks": f"""
    SELECT s.sls_ord_num, s.sls_order_dt, s.sls_ship_dt, s.sls_due_dt, s.sls_sales,
           d1.date_sk AS order_date_sk, d2.date_sk AS ship_date_sk, d3.date_sk AS due_date_sk
    FROM crm_sales_b2 s
    LEFT JOIN dim_date_full d1 ON {ymd('s.sls_order_dt')} = d1.full_date
    LEFT JOIN dim_date_full d2 ON {ymd('s.sls_ship_dt')} = d2.full_date
    LEFT JOIN dim_date_full d3 ON {ymd('s.sls_due_dt')} = d3.full_date""",
    "lookup_date_sks_nullsafe": f"""
    SELECT s.sls_ord_num, s.sls_order_dt, s.sls_ship_dt, s.sls_due_dt, s.sls_sales,
           d1.date_sk AS order_date_sk, d2.date_sk AS ship_date_sk, d3.date_sk AS due_date_sk
    FROM crm_sales_b2 s
    LEFT JOIN dd d1 ON {ymd('s.sls_order_dt')} IS NOT DISTINCT FROM d1.full_date
    LEFT JOIN dd d2 ON {ymd('s.sls_ship_dt')} IS NOT DISTINCT FROM d2.full_date
    LEFT JOIN dd d3 ON {ymd('s.sls_due_dt')} IS NOT DISTINCT FROM d3.full_date""",
    "fact_sales_full": "SELECT * FROM fact_full",
    "csv_to_fact": "SELECT * FROM fact_full",
    "csv_file_counts": """
    SELECT feed, n + bad AS n_read, n AS n_kept, bad AS n_rejected,
           CASE WHEN bad > 0 THEN bad END AS n_logged, CASE WHEN bad > 0 THEN reason END AS reason FROM (
      SELECT 'customer' AS feed, count(*) AS n, 0 AS bad, NULL AS reason FROM erp_customer_b2
      UNION ALL SELECT 'customer_location', count(*), 0, NULL FROM erp_location_b2
      UNION ALL SELECT 'customer_info', count(*), 0, NULL FROM crm_customer_b2
      UNION ALL SELECT 'product_categories', count(*), 0, NULL FROM erp_category
      UNION ALL SELECT 'product_info', count(*), count(*) FILTER (WHERE prd_id % 10 = 3),
             'the file has no column prd_key; the file has no column prd_cost; the file has no column prd_line; '
             || 'the file has no column prd_start_dt; the file has no column prd_end_dt' FROM crm_product_b2
      UNION ALL SELECT 'sales_details', count(*), count(*) FILTER (WHERE sls_order_dt % 10 = 3),
             'column sls_quantity holds a value that is no int' FROM crm_sales_b2) kept""",
    "watermark_read": f"""
    SELECT t.table_name, coalesce(w.watermark, DATE '1900-01-01') AS watermark
    FROM (VALUES ('dim_customer'), ('dim_product'), ('dim_date'), ('fact_sales'), ('dim_store')) t(table_name)
    LEFT JOIN (SELECT 'dim_customer' AS table_name, max(effective_date) AS watermark FROM cust_snap1
               UNION ALL SELECT 'dim_product', max(effective_date) FROM prod_snap1
               UNION ALL SELECT 'dim_date', max(full_date) FROM dim_date1
               UNION ALL SELECT 'fact_sales', max(created_date) FROM fact1) w
      ON t.table_name = w.table_name""",
    "watermark_advance": f"""
    SELECT t.table_name, coalesce(w.watermark, DATE '1900-01-01') AS watermark
    FROM (VALUES ('dim_customer'), ('dim_product'), ('dim_date'), ('fact_sales'), ('dim_store')) t(table_name)
    LEFT JOIN (SELECT 'dim_customer' AS table_name, max(effective_date) AS watermark FROM cust_merged2
               UNION ALL SELECT 'dim_product', max(effective_date) FROM prod_merged2
               UNION ALL SELECT 'dim_date', max(full_date) FROM dim_date2
               UNION ALL SELECT 'fact_sales', max(created_date) FROM fact2) w
      ON t.table_name = w.table_name""",
    "scd2_load_filter_customer": f"""
    SELECT {_cols(CUST_DIM)} FROM cust_opened2 WHERE (new AND effective_date > {D2}) OR NOT new""",
    "incremental_dates": "SELECT * FROM ("
    + _numbered(
        "(SELECT * FROM date_rows2 WHERE full_date > (SELECT max(full_date) FROM dim_date1)) r",
        "full_date ASC NULLS LAST",
        "DATE",
        start=_max_key("dim_date1", "date_sk", "DATE"),
        col="date_sk",
    )
    + ") z",
    "incremental_dates_antijoin": "SELECT * FROM new_dates2",
    "incremental_fact_by_created": f"SELECT * FROM fact2 WHERE created_date > {D1}",
    "incremental_fact_by_order_date": _fact(
        SALES_NOT_LOADED,
        "cust_merged2",
        "prod_merged2",
        "dim_date2",
        D2,
    ),
    "batch_audit": """
    SELECT 'customer' AS table_name, 'extract' AS stage, count(*) AS n_rows FROM erp_customer_b2
    UNION ALL SELECT 'customer_location', 'extract', count(*) FROM erp_location_b2
    UNION ALL SELECT 'customer_info', 'extract', count(*) FROM crm_customer_b2
    UNION ALL SELECT 'product_categories', 'extract', count(*) FROM erp_category
    UNION ALL SELECT 'product_info', 'extract', count(*) FROM crm_product_b2
    UNION ALL SELECT 'sales_details', 'extract', count(*) FROM crm_sales_b2
    UNION ALL SELECT 'dim_customer', 'transform', count(*) FROM cust_opened2
    UNION ALL SELECT 'dim_customer', 'expire', count(*) FROM cust_closed2
    UNION ALL SELECT 'dim_product', 'transform', count(*) FROM prod_opened2
    UNION ALL SELECT 'dim_product', 'expire', count(*) FROM prod_merged2 WHERE end_date_history IS NOT NULL
    UNION ALL SELECT 'dim_date', 'transform', count(*) FROM date_rows2
    UNION ALL SELECT 'fact_sales', 'transform', count(*) FROM fact_rows2""",
    "scan_csv_feed": "SELECT * FROM crm_product_b2",
    "scan_missing_feed": "SELECT * FROM crm_product_b2",
    "dim_snapshot": "SELECT * FROM cust_merged2",
    "dim_customer_full": "SELECT * FROM cust_merged2",
    "dim_product_full": "SELECT * FROM prod_merged2",
    "dim_date_loaded": "SELECT * FROM dim_date2",
    "fact_sales_loaded": "SELECT * FROM fact1 UNION ALL SELECT * FROM fact2",
    "stream_fact_load": "SELECT * FROM fact1 UNION ALL SELECT * FROM fact2",
    "batch_retry_after_crash": """
    SELECT 'fact_sales' AS table_name, count(*) AS n_rows, count(DISTINCT sales_sk) AS n_keys,
           max(CAST(replace(sales_sk, 'SALES', '') AS BIGINT)) AS last_key
    FROM (SELECT sales_sk FROM fact1 UNION ALL SELECT sales_sk FROM fact2) f
    UNION ALL
    SELECT 'dim_date', count(*), count(DISTINCT date_sk), max(CAST(replace(date_sk, 'DATE', '') AS BIGINT))
    FROM dim_date2""",
    "fact_sales_loaded_by_order_date": f"""
    SELECT * FROM fact1 UNION ALL
    SELECT * FROM ("""
    + _numbered(
        "("
        + _fact(
            SALES_NOT_LOADED,
            "cust_merged2",
            "prod_merged2",
            "dim_date2",
            D2,
        )
        + ") r",
        FACT_ORDER,
        "SALES",
        start=_max_key("fact1", "sales_sk", "SALES"),
        col="sales_sk",
    )
    + ") z",
    "batch_audit_loaded": f"""
    SELECT 'dim_customer' AS table_name, 'load' AS stage, count(*) AS n_rows, CAST(1 AS BIGINT) AS version,
           {D1} AS processing_date FROM cust_snap1
    UNION ALL SELECT 'dim_product', 'load', count(*), 1, {D1} FROM prod_snap1
    UNION ALL SELECT 'dim_date', 'load', count(*), 1, {D1} FROM dim_date1
    UNION ALL SELECT 'fact_sales', 'load', count(*), 1, {D1} FROM fact1
    UNION ALL SELECT 'dim_customer', 'load', count(*), 2, {D2} FROM cust_merged2
    UNION ALL SELECT 'dim_product', 'load', count(*), 2, {D2} FROM prod_merged2
    UNION ALL SELECT 'dim_date', 'load', count(*), 2, {D2} FROM new_dates2
    UNION ALL SELECT 'fact_sales', 'load', count(*), 2, {D2} FROM fact2
    UNION ALL """
    + _balance("fact1", "crm_sales_b1", 1, D1)
    + " UNION ALL "
    + _balance("fact2", "crm_sales_b2", 2, D2),
    "dedupe_nulls_lose": f"""
    SELECT {_cols(CUST_COLS)} FROM (
      SELECT *, row_number() OVER (PARTITION BY customer_key
               ORDER BY customer_create_date DESC NULLS LAST, customer_id DESC) AS rn
      FROM conf_customer_b2) x WHERE rn = 1""",
    "scd2_reopen_customer": f"""
    SELECT {_cols(CUST_COLS)}, {D2} AS effective_date, CAST(NULL AS DATE) AS end_date, 'Y' AS current_flag,
           'CUST' || CAST((SELECT max(CAST(replace(customer_sk, 'CUST', '') AS BIGINT)) FROM cust_merged2)
                          + row_number() OVER (ORDER BY {CUST_ORDER}) AS VARCHAR) AS customer_sk,
           false AS new
    FROM cust_b2 f
    WHERE f.customer_key IN (SELECT customer_key FROM cust_merged2 WHERE customer_key IS NOT NULL)
      AND f.customer_key NOT IN (
        SELECT customer_key FROM cust_merged2
        WHERE current_flag = 'Y' AND TRY_CAST(substring(customer_key, 3) AS BIGINT) % 7 <> 0
          AND customer_key IS NOT NULL)""",
    "fact_sales_reference_mode": "SELECT * FROM ("
    + _numbered(
        "(" + _fact("crm_sales_b2", "cust_marked2", "prod_marked2", "dd2u", D2, null_safe=True) + ") r",
        FACT_ORDER,
        "SALES",
        col="sales_sk",
    )
    + ") z",
}

# queries whose final SELECT needs an extra local CTE
LOCAL: dict[str, str] = {
    "fact_sales_reference_mode": "dd2u AS ("
    + _numbered(f"({_date_rows('crm_sales_b2', True)}) r", "full_date ASC NULLS LAST", "DATE", col="date_sk")
    + ")",
    "lookup_date_sks_nullsafe": "dd AS ("
    + _numbered(f"({_date_rows('crm_sales_b2', True)}) r", "full_date ASC NULLS LAST", "DATE", col="date_sk")
    + ")",
}


def oracle_sql() -> dict[str, str]:
    pre = prelude()
    out = {}
    for name, body in FINAL.items():
        local = LOCAL.get(name)
        head = pre.rstrip() + (",\n" + local + "\n" if local else "\n")
        out[name] = head + body
    return out
