"""Fact build: conformed lookup keys, surrogate-key lookups, role-playing dates."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.dates import code_of_date, lit_date, parse_yyyymmdd
from starloom.functions.text import strip_ws, tail_tokens, zfill
from starloom.operators import scd2
from starloom.operators.asof import as_of
from starloom.operators.keys import assign_expanded_keys
from starloom.operators.skew import SalesProfile, salted_left_join
from starloom.operators.windows import keep_last_by, nulls_lose

FACT_COLUMNS = [
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
DATE_ROLES = (("sls_order_dt", "order_date_sk"), ("sls_ship_dt", "ship_date_sk"), ("sls_due_dt", "due_date_sk"))
#: The surrogate keys of a fact row and what precedes their numbers.
KEY_PREFIXES = {"customer_sk": scd2.CUSTOMER.prefix, **{sk: "DATE" for _, sk in DATE_ROLES}}
#: Of a packed fact row: the product keys that the sale found, null for none. Every key is a row.
PRODUCTS = "_products"
#: Of a moved fact row, whose keys are integers: the keys that are no prefix and number, null where all are.
_TEXTS = "_key_texts"
#: Product keys that one packed row holds at most; a sale that found more has several.
MOST_PACKED = 64
CUSTOMER_PREFIX = "AW"
CUSTOMER_ID_WIDTH = 8


def customer_key_prefixed(sales: DataFrame, per_row: bool = False, all_prefixed: bool | None = None) -> Column:
    """The CRM customer key for ``sls_cust_id``: stripped, and when the ids are not all
    prefixed, ``'AW' + zfill(8)``.

    Reference mode (default) decides once for the whole batch -- if any id lacks the
    prefix, every id is rewritten (already prefixed ones become ``AWAW...``). The
    decision is a scalar subquery (one partial+final aggregate), not a driver loop, or
    ``all_prefixed`` where a profile of the feed knows it. ``per_row=True`` prefixes only
    the ids that lack it.
    """
    ids = strip_ws("sls_cust_id")
    padded = F.concat(F.lit(CUSTOMER_PREFIX), zfill(ids, CUSTOMER_ID_WIDTH))
    if per_row:
        return F.when(ids.startswith(CUSTOMER_PREFIX), ids).otherwise(padded)
    if all_prefixed is not None:
        return ids if all_prefixed else padded
    decided = sales.select(
        F.coalesce(F.bool_and(ids.startswith(CUSTOMER_PREFIX)), F.lit(True)).alias("_all")
    ).scalar()
    return F.when(decided, ids).otherwise(padded)


def padded_id(customer: str, per_row: bool, all_prefixed: bool) -> str:
    """``customer_key_prefixed`` of one stripped id."""
    keep = customer.startswith(CUSTOMER_PREFIX) if per_row else all_prefixed
    return customer if keep else CUSTOMER_PREFIX + customer.zfill(CUSTOMER_ID_WIDTH)


def _key_as_number(key: Column, prefix: str) -> Column:
    return F.replace(key, F.lit(prefix), F.lit("")).try_cast("int")


def _number_as_key(n: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), n.cast("string"))


def _odd(sk: str) -> str:
    """The column beside a key as integer with its text, where that is no prefix and number."""
    return f"_odd_{sk}"


def looked_up_key(sk: str, prefix: str, numbers: bool) -> list[Column]:
    """A dimension's key as its lookup gives it: as it is, or as integer and ``_odd`` text."""
    key = F.col(sk)
    if not numbers:
        return [key]
    n = _key_as_number(key, prefix)
    return [n.alias(sk), F.when(~_number_as_key(n, prefix).eqNullSafe(key), key).alias(_odd(sk))]


def lookup_customer_sk(
    fact: DataFrame, dim_current: DataFrame, hot: dict[str, int] | None = None, numbers: bool = False
) -> DataFrame:
    """Left join on the padded customer id. No broadcast hint: the dimension grows
    with the data; AQE broadcasts it only when its real size is small. ``hot`` names the
    padded ids whose rows are spread over several tasks (``operators.skew``). ``numbers``:
    see ``looked_up_key``."""
    d = dim_current.select(strip_ws("customer_key").alias("_cust_key"), *looked_up_key("customer_sk", scd2.CUSTOMER.prefix, numbers))
    return salted_left_join(fact, "sls_cust_id", d, "_cust_key", hot)


def short_product_key(c: Column | str) -> Column:
    """``'AC-S1-FR-17'`` -> ``'FR-17'``."""
    return tail_tokens(strip_ws(c), "-", 2)


def lookup_product_sk(
    fact: DataFrame, dim_current: DataFrame, one_version: str | None = None, hot: dict[str, int] | None = None
) -> DataFrame:
    """Left join on the shortened product key. Several current versions can share a
    short key (versions are keyed by product id), so the join fans out, as in the
    reference; ``one_version='latest_start'`` keeps only the version with the latest
    start date per short key, ``'as_of'`` the one that was valid on the sale's order date."""
    if one_version == "as_of":
        return lookup_product_as_of(fact, dim_current, parse_yyyymmdd("sls_order_dt"))
    d = dim_current.select(
        short_product_key("product_key").alias("_prd_key"), F.col("product_sk"), F.col("start_date"), F.col("product_id")
    )
    if one_version == "latest_start":
        d = keep_last_by(d, ["_prd_key"], nulls_lose("start_date") + [F.col("product_id")])
    d = d.select("_prd_key", "product_sk")
    f = fact.withColumn("sls_prd_key", strip_ws("sls_prd_key"))
    return salted_left_join(f, "sls_prd_key", d, "_prd_key", hot)


def lookup_products_packed(
    fact: DataFrame,
    dim_current: DataFrame,
    one_version: str | None = None,
    hot: dict[str, int] | None = None,
    numbers: bool = False,
) -> DataFrame:
    """``lookup_product_sk`` with one row per sale (and MOST_PACKED keys): ``PRODUCTS`` has the keys
    that the sale found. ``unpacked`` gives the same rows. ``numbers``: see ``looked_up_key``."""
    if one_version is not None:
        found = lookup_product_sk(fact, dim_current, one_version, hot).withColumn(PRODUCTS, F.array("product_sk"))
        return found.select(*[c for c in found.columns if c not in ("product_sk", PRODUCTS)], *_looked_up_products(numbers))
    keys = dim_current.groupBy(short_product_key("product_key").alias("_prd_key"))
    # a missing surrogate key is an entry, too
    d = keys.agg(F.collect_list("product_sk").alias("_sks"), F.count("*").alias("_n")).where(F.col("_prd_key").isNotNull())
    nulls = F.array_repeat(F.lit(None).cast("string"), (F.col("_n") - F.size("_sks")).cast("int"))
    every = F.concat(F.col("_sks"), nulls)
    piece = F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / MOST_PACKED).cast("int")))
    d = d.select("_prd_key", every.alias("_all"), piece.alias("_piece"))
    d = d.select("_prd_key", F.slice("_all", F.col("_piece") * MOST_PACKED + 1, MOST_PACKED).alias(PRODUCTS))
    d = d.select("_prd_key", *_looked_up_products(numbers))
    f = fact.withColumn("sls_prd_key", strip_ws("sls_prd_key"))
    return salted_left_join(f, "sls_prd_key", d, "_prd_key", hot)


def _looked_up_products(numbers: bool) -> list[Column]:
    """``looked_up_key`` of packed keys: all of a row are text where one is."""
    if not numbers:
        return [F.col(PRODUCTS)]
    n = F.transform(PRODUCTS, lambda k: _key_as_number(k, scd2.PRODUCT.prefix))
    same = F.transform(n, lambda k: _number_as_key(k, scd2.PRODUCT.prefix)).eqNullSafe(F.col(PRODUCTS))
    return [n.alias(PRODUCTS), F.when(~same, F.col(PRODUCTS)).alias(_odd(PRODUCTS))]


def n_packed(fact: DataFrame) -> Column:
    """The rows that a packed row stands for; a row that is not packed is one."""
    return F.greatest(F.coalesce(F.size(PRODUCTS), F.lit(1)), F.lit(1)) if PRODUCTS in fact.columns else F.lit(1)


def unpacked(fact: DataFrame) -> DataFrame:
    """Packed rows as fact rows: one per product key found, one without a key where none was."""
    columns = [F.explode_outer(PRODUCTS).alias("product_sk") if c == PRODUCTS else F.col(c) for c in fact.columns]
    return fact.select(*columns)


def lookup_product_as_of(fact: DataFrame, dim_current: DataFrame, at: Column) -> DataFrame:
    """One row per sale: the version of its short product key whose validity interval holds ``at``,
    the latest one that has started (an interval ends where the next begins). A sale before its
    product's first version, or without a readable date, has none."""
    f = fact.withColumn("sls_prd_key", strip_ws("sls_prd_key"))
    versions = dim_current.select(short_product_key("product_key").alias("_prd_key"), "start_date", "product_id", "product_sk")
    return as_of(f, F.col("sls_prd_key"), at, versions, F.col("_prd_key"), F.col("start_date"), F.col("product_id"), "product_sk")


def lookup_date_sks(fact: DataFrame, dim_date: DataFrame, null_safe: bool = False, numbers: bool = False) -> DataFrame:
    """Three role-playing lookups (order, ship, due) against one date dimension.

    Plain equality takes one row per ``full_date``, so a repeated date cannot fan a sale out.
    Spark broadcasts the dates while they are under its size limit (one row per calendar day
    always is) and builds the exchange once for all three roles. ``null_safe=True`` lets
    unparseable codes match NULL-date rows (the reference's fan-out); those rows are one per
    distinct bad code. ``numbers``: see ``looked_up_key``.
    """
    dates = dim_date.select("full_date", "date_sk")
    if not null_safe:
        dates = dates.where(F.col("full_date").isNotNull()).groupBy("full_date").agg(F.min("date_sk").alias("date_sk"))
    dates = dates.select("full_date", *looked_up_key("date_sk", "DATE", numbers))
    out = fact
    for code_col, sk_col in DATE_ROLES:
        at = f"_{sk_col}_at"
        named = [F.col(c).alias(c.replace("date_sk", sk_col)) for c in dates.columns if c != "full_date"]
        if not null_safe and isinstance(fact.schema[code_col].dataType, T.IntegerType):
            # few dates become codes instead of many codes dates
            d = dates.select(code_of_date("full_date").alias(at), *named)
            out = out.join(d, out[code_col] == d[at], "left").drop(at)
            continue
        parsed = f"_{code_col}_date"
        out = out.withColumn(parsed, parse_yyyymmdd(code_col))
        d = dates.select(F.col("full_date").alias(at), *named)
        cond = out[parsed].eqNullSafe(d[at]) if null_safe else out[parsed] == d[at]
        out = out.join(d, cond, "left").drop(at, parsed)
    return out


def fact_order() -> list[Column]:
    """Numbering order of fact rows: every output column. Rows that tie on all of
    them are identical, so which of them gets which key does not matter."""
    return [F.asc_nulls_last(c) for c in FACT_COLUMNS]


def build_fact_sales(
    sales: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_date: DataFrame,
    processing_date: str | dt.date,
    per_row: bool = False,
    null_safe: bool = False,
    one_version: str | None = None,
    start: Column | int = 0,
    with_keys: bool = True,
    profile: SalesProfile | None = None,
    packed: bool = False,
) -> DataFrame:
    """fact_sales rows: lookups against the *current* dimension versions. ``profile`` (see
    ``operators.skew``) spares the pass that decides on the prefix and spreads hot keys.
    ``packed`` leaves the rows without keys packed (``PRODUCTS``), for ``number_facts``, and their
    surrogate keys integers, which the dimensions' rows are given before the lookups (``_TEXTS``)."""
    decided = profile.all_prefixed if profile is not None else None
    s = sales.withColumn("sls_cust_id", customer_key_prefixed(sales, per_row, decided))
    hot_customers = {padded_id(k, per_row, decided): n for k, n in profile.hot_customers.items()} if profile else None
    cust = dim_customer.where(F.col("current_flag") == "Y")
    prod = dim_product.where(F.col("current_flag") == "Y")
    numbers = packed or with_keys
    f = lookup_customer_sk(s, cust, hot_customers, numbers)
    f = lookup_products_packed(f, prod, one_version, profile.hot_products if profile else None, numbers)
    f = lookup_date_sks(f, dim_date, null_safe, numbers)
    columns = [PRODUCTS if c == "product_sk" else c for c in FACT_COLUMNS]
    if not numbers:
        return unpacked(f.select(*columns).withColumn("created_date", lit_date(processing_date)))
    odd = _texts({c: F.col(_odd(c)) for c in (*KEY_PREFIXES, PRODUCTS)})
    out = f.select(*columns, lit_date(processing_date).alias("created_date"), odd.alias(_TEXTS))
    return out if packed else number_facts(out, start, sales)


def _texts(odd: dict[str, Column]) -> Column:
    """``_TEXTS`` of a row's ``_odd`` texts."""
    some = reduce(lambda a, b: a | b, [c.isNotNull() for c in odd.values()])
    return F.when(some, F.struct(*[c.alias(k) for k, c in odd.items()]))


def odd_text(fact: DataFrame, column: str) -> Column:
    """The text of a key (or of packed keys) that the integer in ``column`` does not stand for."""
    kind = "array<string>" if column == PRODUCTS else "string"
    return F.col(f"{_TEXTS}.{column}") if _TEXTS in fact.columns else F.lit(None).cast(kind)


def keys_as_numbers(fact: DataFrame) -> DataFrame:
    """Packed rows with surrogate keys as integers, half as wide where rows move. A key that its
    prefix and number do not give again stays as text in ``_TEXTS``; ``keys_as_text`` undoes it."""
    found = {c: looked_up_key(c, p, True) for c, p in KEY_PREFIXES.items()} | {PRODUCTS: _looked_up_products(True)}
    numbers, odd = ({c: pair[i] for c, pair in found.items()} for i in (0, 1))
    return fact.select(*[numbers.get(c, F.col(c)) for c in fact.columns], _texts(odd).alias(_TEXTS))


def keys_as_text(fact: DataFrame) -> DataFrame:
    """``keys_as_numbers`` undone."""
    texts = {c: _number_as_key(F.col(c), p) for c, p in KEY_PREFIXES.items()}
    texts[PRODUCTS] = F.transform(PRODUCTS, lambda n: _number_as_key(n, scd2.PRODUCT.prefix))
    whole = lambda c: F.coalesce(F.col(f"{_TEXTS}.{c}"), texts[c]).alias(c)
    return fact.select(*[whole(c) if c in texts else F.col(c) for c in fact.columns if c != _TEXTS])


def unpacked_as_text(fact: DataFrame) -> DataFrame:
    """``unpacked(keys_as_text(fact))``: the product keys become text one by one."""
    rest = [c for c in fact.columns if c != PRODUCTS]
    rows = fact.select(*rest, F.posexplode_outer(PRODUCTS).alias("_at", "_product"))
    text = F.when(F.col(_TEXTS).isNotNull(), F.get(F.col(f"{_TEXTS}.{PRODUCTS}"), F.col("_at")))
    product = F.coalesce(text, _number_as_key(F.col("_product"), scd2.PRODUCT.prefix)).alias("product_sk")
    return keys_as_text(rows.select(*[product if c == PRODUCTS else F.col(c) for c in fact.columns]))


def number_facts(fact: DataFrame, start: Column | int = 0, sales: DataFrame | None = None) -> DataFrame:
    """Fact rows, packed or not, with dense ``sales_sk``; the lookups behind them run once, and
    packed rows are unpacked by the tasks that number them. ``sales``: the feed they were made of,
    whose order numbers tell beforehand which rows are numbered together."""
    if PRODUCTS not in fact.columns:
        fact = fact.select(*[F.array(c).alias(PRODUCTS) if c == "product_sk" else F.col(c) for c in fact.columns])
    if _TEXTS not in fact.columns:
        fact = keys_as_numbers(fact)
    # the number of the run is carried along
    return assign_expanded_keys(fact, "sls_ord_num", n_packed(fact), unpacked_as_text, fact_order(), "sales_sk", "SALES", start, sales)
