"""Slowly-changing-dimension type 2, set-based.

One generic implementation configured by ``SCD2Spec``:

* ``classify``: the feed is left-joined to **all** versions of its natural key; every
  (feed row, version) pair gets a kind: ``new`` (no version), ``ignore`` (version not
  current, NULL flag included), ``changed`` (a tracked column differs after
  normalisation) or ``same``.
* ``close``: versions with a ``changed`` pair get ``end = p`` and flag ``N``.
* ``open``: ``new`` and ``changed`` rows become versions with ``effective = p``, open
  end, flag ``Y``, and fresh keys that continue the snapshot's sequence.
* ``merge``: ``unchanged ∪ closed ∪ opened`` -- the next snapshot, written whole.

Change detection is null-safe and normalised: strings are stripped and upper-cased,
columns whose name contains ``date`` are parsed (unparseable -> NULL), listed numeric
columns are compared as doubles, and NULL equals NULL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.dates import lit_date, parse_iso_date
from starloom.functions.text import std_upper
from starloom.operators import conform
from starloom.operators.keys import assign_dense_keys, next_key_start

NEW, IGNORE, CHANGED, SAME = "new", "ignore", "changed", "same"


@dataclass(frozen=True)
class SCD2Spec:
    table: str
    natural_key: str
    tracked: tuple[str, ...]
    columns: tuple[str, ...]  # conformed feed columns, in table order
    sk_col: str
    prefix: str
    end_col: str
    order: Callable[[], list[Column]]  # total order for numbering new versions
    numeric: tuple[str, ...] = ()
    effective_col: str = "effective_date"
    flag_col: str = "current_flag"

    @property
    def table_columns(self) -> list[str]:
        return [*self.columns, self.effective_col, self.end_col, self.flag_col, self.sk_col]


CUSTOMER = SCD2Spec(
    table="dim_customer",
    natural_key="customer_key",
    tracked=("first_name", "last_name", "gender", "marital_status", "birth_date", "country"),
    columns=tuple(conform.CUSTOMER_COLUMNS),
    sk_col="customer_sk",
    prefix="CUST",
    end_col="end_date",
    order=conform.customer_order,
)

PRODUCT = SCD2Spec(
    table="dim_product",
    natural_key="product_id",
    tracked=(
        "product_name",
        "product_cost",
        "product_line",
        "category",
        "subcategory",
        "maintenance",
        "start_date",
        "end_date",
    ),
    columns=tuple(conform.PRODUCT_COLUMNS),
    sk_col="product_sk",
    prefix="PROD",
    end_col="end_date_history",
    order=conform.product_order,
    numeric=("product_cost",),
)


def _old(c: str) -> str:
    return f"{c}_old"


def normalised(c: Column, name: str, dtype: T.DataType, spec: SCD2Spec) -> Column:
    """The form a tracked value is compared in."""
    if "date" in name.lower():
        if isinstance(dtype, T.StringType):
            return parse_iso_date(std_upper(c))
        return c.cast("date")
    if isinstance(dtype, T.StringType):
        return std_upper(c)
    if name in spec.numeric or isinstance(dtype, T.NumericType):
        return c.cast("double")
    return c


def stamp_open(feed: DataFrame, spec: SCD2Spec, processing_date) -> DataFrame:
    """Open-version columns: effective = p, end = NULL, flag = 'Y'."""
    return (
        feed.withColumn(spec.effective_col, lit_date(processing_date))
        .withColumn(spec.end_col, F.lit(None).cast("date"))
        .withColumn(spec.flag_col, F.lit("Y"))
    )


def initial_load(feed: DataFrame, spec: SCD2Spec, processing_date, start: Column | int = 0) -> DataFrame:
    """No snapshot: every row is a new member."""
    rows = stamp_open(feed.select(*spec.columns), spec, processing_date)
    return assign_dense_keys(rows, spec.order(), spec.sk_col, spec.prefix, start).select(*spec.table_columns)


def classify(feed: DataFrame, snapshot: DataFrame, spec: SCD2Spec) -> DataFrame:
    """Every (feed row, snapshot version) pair with per-column change flags
    (``chg_<column>``), the version's key and flag (``<sk>_old``, ``current_flag_old``)
    and ``change_kind``."""
    key = spec.natural_key
    old = snapshot.select(
        F.col(key).alias("_match_key"),
        F.col(spec.sk_col).alias(_old(spec.sk_col)),
        *[F.col(c).alias(_old(c)) for c in spec.tracked],
        F.col(spec.flag_col).alias(_old(spec.flag_col)),
    )
    # natural keys match null-safely: a missing key is one member, so re-applying a
    # batch stays a no-op (the reference's missing keys match each other too)
    pairs = feed.join(old, feed[key].eqNullSafe(old["_match_key"]), "left").drop("_match_key")
    types = {f.name: f.dataType for f in feed.schema.fields}
    flags = {
        c: ~normalised(F.col(c), c, types[c], spec).eqNullSafe(normalised(F.col(_old(c)), c, types[c], spec))
        for c in spec.tracked
    }
    pairs = pairs.select(*pairs.columns, *[v.alias(f"chg_{c}") for c, v in flags.items()])
    any_change = reduce(lambda a, b: a | b, [F.col(f"chg_{c}") for c in spec.tracked])
    kind = (
        F.when(F.col(_old(spec.sk_col)).isNull(), F.lit(NEW))
        .when(~F.col(_old(spec.flag_col)).eqNullSafe(F.lit("Y")), F.lit(IGNORE))
        .when(any_change, F.lit(CHANGED))
        .otherwise(F.lit(SAME))
    )
    return pairs.withColumn("change_kind", kind)


def classify_current(feed: DataFrame, snapshot: DataFrame, spec: SCD2Spec) -> DataFrame:
    """The part of ``classify`` that can produce output, without pairing a feed row
    with every closed version of its key.

    Feed rows are joined to the *current* versions only; a second join to the distinct
    natural keys of the snapshot tells a member with only closed versions (``ignore``)
    from a brand-new one. Both joins are on the natural key (null-safe), so they share
    one partitioning. Kinds agree with ``classify`` for every pair that can open or
    close a version.
    """
    key = spec.natural_key
    current = snapshot.where(F.col(spec.flag_col) == "Y").select(
        F.col(key).alias("_match_key"),
        F.col(spec.sk_col).alias(_old(spec.sk_col)),
        *[F.col(c).alias(_old(c)) for c in spec.tracked],
    )
    known = snapshot.select(F.col(key).alias("_known_key"), F.lit(True).alias("_known")).distinct()
    pairs = feed.join(current, feed[key].eqNullSafe(current["_match_key"]), "left").drop("_match_key")
    pairs = pairs.join(known, pairs[key].eqNullSafe(known["_known_key"]), "left")
    types = {f.name: f.dataType for f in feed.schema.fields}
    any_change = reduce(
        lambda a, b: a | b,
        [
            ~normalised(F.col(c), c, types[c], spec).eqNullSafe(normalised(F.col(_old(c)), c, types[c], spec))
            for c in spec.tracked
        ],
    )
    kind = (
        F.when(F.col(_old(spec.sk_col)).isNotNull(), F.when(any_change, F.lit(CHANGED)).otherwise(F.lit(SAME)))
        .when(F.col("_known").isNotNull(), F.lit(IGNORE))
        .otherwise(F.lit(NEW))
    )
    return pairs.select(*feed.columns, F.col(_old(spec.sk_col)), kind.alias("change_kind"))


@dataclass
class Delta:
    """The outputs of applying one batch to a snapshot."""

    classified: DataFrame
    closed: DataFrame  # versions closed by this batch (end = p, flag N)
    unchanged: DataFrame  # snapshot versions this batch does not touch
    opened: DataFrame  # new versions with keys and the ``new`` column
    merged: DataFrame  # the next snapshot


def mark_closed(snapshot: DataFrame, changed_sks: DataFrame, spec: SCD2Spec, processing_date) -> DataFrame:
    """The snapshot with this batch's closes applied (end = p, flag N), plus a boolean
    ``_closed``: one left join against the distinct replaced keys, so the snapshot is
    scanned once and no row fans out. Set-based version of the keyed UPDATE."""
    changed = (
        changed_sks.where(F.col("_closed_sk").isNotNull()).distinct().withColumn("_closed", F.lit(True))
    )
    j = snapshot.join(changed, snapshot[spec.sk_col] == changed["_closed_sk"], "left")
    hit = F.col("_closed").isNotNull()
    return j.select(
        *[
            F.when(hit, lit_date(processing_date)).otherwise(F.col(c)).alias(c)
            if c == spec.end_col
            else F.when(hit, F.lit("N")).otherwise(F.col(c)).alias(c)
            if c == spec.flag_col
            else F.col(c)
            for c in spec.table_columns
        ],
        hit.alias("_closed"),
    )


def open_versions(
    classified: DataFrame,
    snapshot: DataFrame,
    spec: SCD2Spec,
    processing_date,
    reopen: bool = False,
    start: Column | int | None = None,
) -> DataFrame:
    """New versions for ``new`` and ``changed`` rows, keyed after the snapshot's max.

    The result also carries ``<sk>_old``, the version a changed row replaces, so the
    close step reads it from the staged rows instead of classifying a second time.
    ``reopen=True`` also opens a version for a member whose versions are all closed
    (the reference ignores such members forever).
    """
    old_sk = _old(spec.sk_col)
    kinds = [NEW, CHANGED, IGNORE] if reopen else [NEW, CHANGED]
    rows = classified.where(F.col("change_kind").isin(*kinds)).select(
        *spec.columns, (F.col("change_kind") == NEW).alias("new"), F.col(old_sk)
    )
    rows = stamp_open(rows, spec, processing_date)
    if start is None:
        start = next_key_start(snapshot, spec.sk_col, spec.prefix)
    keyed = assign_dense_keys(rows, spec.order(), spec.sk_col, spec.prefix, start)
    return keyed.select(*spec.table_columns, "new", old_sk)


def apply_batch(
    snapshot: DataFrame,
    feed: DataFrame,
    spec: SCD2Spec,
    processing_date: str | dt.date,
    reopen: bool = False,
    start: Column | None = None,
) -> Delta:
    """Apply one conformed batch to a dimension snapshot (all versions)."""
    feed = feed.select(*spec.columns)
    snapshot = snapshot.select(*spec.table_columns)
    # the staged (keyed) new versions carry the key of the version each one replaces,
    # so the classification join runs once for both the open and the close side
    current_kinds = classify_current(feed, snapshot, spec)
    staged = open_versions(current_kinds, snapshot, spec, processing_date, reopen, start)
    old_sk = _old(spec.sk_col)
    changed = staged.where(~F.col("new")).select(F.col(old_sk).alias("_closed_sk"))
    marked = mark_closed(snapshot, changed, spec, processing_date)
    closed = marked.where(F.col("_closed")).drop("_closed")
    unchanged = marked.where(~F.col("_closed")).drop("_closed")
    opened = staged.drop(old_sk)
    merged = marked.drop("_closed").unionByName(opened.drop("new"))
    # the pair-level listing (every version of the key) is only built when asked for
    return Delta(classify(feed, snapshot, spec), closed, unchanged, opened, merged)


def current_members(dim: DataFrame, spec: SCD2Spec | None = None) -> DataFrame:
    flag = spec.flag_col if spec else "current_flag"
    return dim.where(F.col(flag) == "Y")


def expired_members(dim: DataFrame, spec: SCD2Spec) -> DataFrame:
    return dim.where(F.col(spec.end_col).isNotNull())
