"""Hot keys: found by a mergeable sketch in one pass, and salted before their join alone.

``profile_sales`` reads the landed feed once for everything a batch must know of it beforehand: the
number of rows, the batch-wide prefix decision, the latest order date, and, by sketches that tasks
merge, the keys that hold most rows. ``salted_left_join`` spreads the rows of those keys over as many
tasks as their share asks for and repeats the few matching dimension rows; all other keys are joined
as ever. A sketch may miss no key above its error bound (rows / 4,096), far below what counts as hot.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import parse_yyyymmdd
from starloom.functions.text import strip_ws

#: Keys named at most, and items that a sketch tracks.
MOST_KEYS, TRACKED = 64, 16_384
#: A key is hot when it holds this many times an average task's rows; no key gets more salts.
HOT, MOST_SALTS = 0.5, 1_024
#: Salts per average task's rows: they are dealt by hash, and few large ones fall unevenly.
SALTS = 16
_SALT = "_salt"


@dataclass(frozen=True)
class SalesProfile:
    n_rows: int
    all_prefixed: bool
    latest_order: dt.date | None
    #: hot key -> salts
    hot_customers: dict[str, int] = field(default_factory=dict)
    hot_products: dict[str, int] = field(default_factory=dict)


def hot_key_sketch(key: Column) -> Column:
    """The most frequent values of ``key`` with their estimated counts (missing ones apart)."""
    return F.call_function("approx_top_k", key, F.lit(MOST_KEYS), F.lit(TRACKED))


def salts_of(found: list, n_rows: int, tasks: int) -> dict[str, int]:
    """Salts of the keys that hold more than ``HOT`` times the rows of an average task."""
    share = max(n_rows / max(tasks, 1), 1.0)
    return {r["item"]: min(MOST_SALTS, 1 + int(SALTS * r["count"] / share)) for r in found or [] if r["item"] is not None and r["count"] > HOT * share}


def profile_sales(sales: DataFrame, prefix: str) -> SalesProfile:
    """One pass over four columns of the feed; one row comes back."""
    customer, product = strip_ws("sls_cust_id"), strip_ws("sls_prd_key")
    row = sales.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.bool_and(customer.startswith(prefix)), F.lit(True)).alias("all_prefixed"),
        F.max(parse_yyyymmdd("sls_order_dt")).alias("latest_order"),
        hot_key_sketch(customer).alias("customers"),
        hot_key_sketch(product).alias("products"),
    ).collect()[0]
    tasks = int(sales.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    customers, products = (salts_of(found, row.n_rows, tasks) for found in (row.customers, row.products))
    return SalesProfile(row.n_rows, row.all_prefixed, row.latest_order, customers, products)


def salted_left_join(rows: DataFrame, key: str, lookup: DataFrame, lookup_key: str, hot: dict[str, int] | None) -> DataFrame:
    """Left join on ``key = lookup_key`` (which is dropped), hot keys spread over their salts."""
    if not hot:
        return rows.join(lookup, rows[key] == lookup[lookup_key], "left").drop(lookup_key)
    salts = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
    own = lambda c: F.coalesce(F.element_at(salts, F.col(c)), F.lit(1))
    # consecutive rows go to different salts; a task that is run again deals them alike
    left = rows.withColumn(_SALT, F.pmod(F.monotonically_increasing_id(), own(key)).cast("int"))
    right = lookup.withColumn("_of_salt", F.explode(F.sequence(F.lit(0), own(lookup_key) - 1)))
    same = (left[key] == right[lookup_key]) & (left[_SALT] == right["_of_salt"])
    return left.join(right, same, "left").drop(lookup_key, _SALT, "_of_salt")
