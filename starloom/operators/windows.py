"""Per-key ordered operators that stay correct and balanced when one key is hot.

A key may hold a third of all rows (for example a missing natural key). A plain
``Window.partitionBy(key)`` would stream that whole group through one task, so:

* ``keep_last_by`` is an aggregation (``max_by`` over a rank struct), which Spark
  pre-aggregates map-side: a hot key is reduced to one row per map task before the
  shuffle.
* ``lead_within_key`` range-partitions on (key, order), so a hot key is spread over
  several partitions; the window runs per (partition, key) piece and the last row of
  each piece is patched with the first row of the next piece of the same key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import scratch_path, write_staged

_P, _LAST, _RN, _NEXT = "_lk_part", "_lk_last", "_lk_rn", "_lk_next"


def nulls_win(c: Column | str) -> list[Column]:
    """Rank parts under which a NULL beats every value, then larger values win."""
    c = F.col(c) if isinstance(c, str) else c
    return [c.isNull(), c]


def nulls_lose(c: Column | str) -> list[Column]:
    """Rank parts under which any value beats NULL, then larger values win."""
    c = F.col(c) if isinstance(c, str) else c
    return [c.isNotNull(), c]


def keep_last_by(df: DataFrame, keys: Sequence[str], rank: Sequence[Column]) -> DataFrame:
    """One row per key: the row with the greatest ``rank`` (compared left to right).

    Rows whose key is NULL form one group, like any other key value.
    """
    cols = df.columns
    rest = [c for c in cols if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*rank)).alias("_best")
    # the grouping keys pass through as themselves, so the result keeps the key
    # partitioning and a following join on the same key needs no new shuffle
    return df.groupBy(*keys).agg(best).select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in cols])


def lead_within_key(
    df: DataFrame,
    key: str,
    order: Sequence[Column],
    value: str,
    out: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """``out`` = ``value`` of the next row of the same ``key`` under ``order`` (NULL on
    the last row). Rows with a NULL key are not a group: their ``out`` is NULL.

    ``order`` must be total within a key.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    vtype = df.schema[value].dataType
    k = F.col(key)

    nulls = df.where(k.isNull()).withColumn(out, F.lit(None).cast(vtype))
    piece = Window.partitionBy(_P, key).orderBy(*order)
    local = (
        df.where(k.isNotNull())
        .repartitionByRange(n, k, *order)
        .withColumn(_P, F.spark_partition_id())
        .withColumn(out, F.lead(value).over(piece))
        .withColumn(_LAST, F.lead(F.lit(1)).over(piece).isNull())
        .withColumn(_RN, F.row_number().over(piece))
    )
    # Stage the pieces once (shared checkpoint folder): the three branches below must
    # see the same piece ids, and a re-sampled range partitioning over a shuffled
    # input could draw different bounds.
    local = write_staged(local, scratch_path(spark, "lead-pieces"))
    # first value of every piece; a key has at most n pieces, so this window is bounded
    pieces = local.where(F.col(_RN) == 1).select(_P, key, F.col(value).alias("_first"))
    nexts = pieces.select(
        _P, key, F.lead("_first").over(Window.partitionBy(key).orderBy(_P)).alias(_NEXT)
    )
    inner = local.where(~F.col(_LAST))
    tails = (
        local.where(F.col(_LAST))
        .drop(out)
        .join(nexts, [_P, key], "left")
        .withColumnRenamed(_NEXT, out)
    )
    cols = df.columns + [out]
    return inner.select(*cols).unionByName(tails.select(*cols)).unionByName(nulls.select(*cols))
