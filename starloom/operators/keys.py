"""Dense surrogate keys that follow a named total order and can continue a sequence.

Spark rows have no order, so every use names one. The numbering never funnels rows
through a single partition:

1. range-partition on the order and sort inside each partition, so partition ``i``
   holds a contiguous run of the order and a hot value spans several partitions;
2. record each row's partition and position, and write them with the rows to a
   Parquet table in the shared checkpoint folder (``spark.checkpoint.dir``): the
   lineage is cut, so counting and numbering see the same partitioning even after an
   executor is lost, and the sorted data is computed once (a reliable RDD checkpoint
   would compute it twice);
3. count rows per partition -- one number per partition, so a bounded result, the
   same step ``zipWithIndex`` runs -- and turn the counts into offsets. Numbering is
   then a projection of the staged Parquet (offset of the row's partition + its
   position): consumers of the keyed frame run no joins, windows or subqueries.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import SPREAD, buckets_stay, scratch_path, write_bucketed, write_staged

_PART, _POS, _N, _TIE, _OFF = "_sk_part", "_sk_pos", "_sk_n", "_sk_tie", "_sk_off"


def key_number(key: Column | str, prefix: str | None) -> Column:
    """``'CUST12'`` -> 12; unprefixed numeric keys pass through."""
    k = F.col(key) if isinstance(key, str) else key
    if prefix:
        k = F.replace(k.cast("string"), F.lit(prefix), F.lit(""))
    return k.cast("string").try_cast("long")


def count_keys(keyed: DataFrame, key_col: str, prefix: str) -> DataFrame:
    """One row: ``n_rows``, ``n_keys`` (distinct ones) and ``last_key``. Keys are counted as bits of
    their numbers, 32,768 to a group, so that few bytes move; a key that prefix and number do not
    give again is a group of its own."""
    n, key = key_number(key_col, prefix), F.col(key_col)
    plain = n.isNotNull() & (F.concat(F.lit(prefix), n.cast("string")) == key)
    at, odd = F.when(plain, n), F.when(~plain, key)
    grouped = keyed.groupBy(F.bitmap_bucket_number(at).alias("_bits"), odd.alias("_odd")).agg(
        F.count("*").alias("_rows"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(at))).alias("_set"),
        F.max(n).alias("_last"),
    )
    keys = F.when(F.col("_bits").isNotNull(), F.col("_set")).when(F.col("_odd").isNotNull(), 1).otherwise(0)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("long"))
    return grouped.agg(total("_rows").alias("n_rows"), total(keys).alias("n_keys"), F.max("_last").alias("last_key"))


def next_key_start(existing: DataFrame | None, key_col: str, prefix: str | None) -> Column:
    """Largest key number already used (0 when there are none), as a scalar subquery.

    A key that does not parse after removing the prefix is a broken table: the
    subquery raises instead of silently restarting the sequence.
    """
    if existing is None or key_col not in existing.columns:
        return F.lit(0).cast("long")
    n = key_number(key_col, prefix)
    agg = existing.select(
        F.when(
            F.sum(F.when(n.isNull() & F.col(key_col).isNotNull(), 1).otherwise(0)) > 0,
            F.raise_error(F.lit(f"malformed surrogate key in column {key_col}")),
        )
        .otherwise(F.coalesce(F.max(n), F.lit(0).cast("long")))
        .cast("long")
        .alias("_start")
    )
    return agg.scalar()


def assign_dense_keys(
    df: DataFrame,
    order: Sequence[Column],
    key_col: str,
    prefix: str | None = None,
    start: Column | int = 0,
    num_partitions: int | None = None,
    stage_input: bool = False,
) -> DataFrame:
    """Append ``key_col`` = ``prefix`` + (start + 1, start + 2, ...) following ``order``.

    ``order`` must be total over the rows whose outputs differ; rows that tie on it
    are interchangeable. The numbered rows are staged once as Parquet.

    Range partitioning runs its input twice, once for a sample of the order columns. Where that
    input is more than a scan (lookups, joins), ``stage_input`` writes it first: it then runs once,
    and the sample reads the order columns of the written rows.
    """
    spark = df.sparkSession
    if stage_input:
        df = write_staged(df, scratch_path(spark, f"unnumbered-{key_col}"))
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, f"dense-keys-{key_col}")
    # A random last range column lets rows that tie on the whole order (and are
    # therefore interchangeable) spread over several partitions instead of one.
    # No fixed partition count unless asked: AQE may merge adjacent range partitions
    # of a small input (each stays a contiguous run of the order); at most ``n``.
    ranged_df = df.withColumn(_TIE, F.rand(17))
    ranged_df = (
        ranged_df.repartitionByRange(num_partitions, *order, F.col(_TIE))
        if num_partitions
        else ranged_df.repartitionByRange(*order, F.col(_TIE))
    )
    staged = (
        ranged_df
        .sortWithinPartitions(*order)
        .drop(_TIE)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_POS, F.monotonically_increasing_id() - F.col(_PART).cast("long") * F.lit(1 << 33))
    )
    ranged = write_staged(staged, path)
    counts = dict(ranged.groupBy(_PART).agg(F.count(F.lit(1)).alias(_N)).collect())
    offsets, acc = [], 0
    for part in range(max(n, max(counts, default=-1) + 1)):
        offsets.append(acc)
        acc += counts.get(part, 0)
    base = _scalar_value(spark, start)
    numbered = ranged.withColumn(_OFF, _offset(offsets, F.col(_PART)))
    return numbered.withColumn(key_col, _key(F.lit(base).cast("long") + F.col(_OFF) + F.col(_POS) + 1, prefix)).drop(_PART, _POS, _OFF)


def _offset(offsets: list[int], part: Column) -> Column:
    # one literal, whatever the number of partitions: folded to an array when the plan is made
    return F.element_at(F.split(F.lit(",".join(map(str, offsets))), ",").cast("array<bigint>"), part + 1)


def _key(number: Column, prefix: str | None) -> Column:
    return F.concat(F.lit(prefix), number.cast("string")) if prefix else number.cast("long")


#: Numbered rows that a run should hold, that make a run of their own worth a task, and that a run
#: may hold at most: beyond that the rows are cut on the whole order.
RUN_ROWS, LEAST_RUN_ROWS, MOST_RUN_ROWS = 1_000_000, 20_000, 4_000_000
#: Packed rows that a run should hold, where the rows they stand for are not counted yet.
RUN_PACKED_ROWS = 400_000
#: Sampled values per run, from which the cuts between runs are taken.
RUN_SAMPLE = 200


def _cuts(values: list[str], runs: int) -> list[str]:
    """At most ``runs - 1`` ascending values that cut the sampled ones into equal parts."""
    ordered = sorted(values, key=lambda v: v.encode("utf-8", "surrogatepass"))
    picked = [ordered[len(ordered) * i // runs] for i in range(1, runs)] if ordered else []
    return list(dict.fromkeys(picked))


def _sampled_cuts(rows: DataFrame, lead: str, n: int, run_rows: int, weight: int | None = None) -> list[str]:
    """Cuts of ``lead`` into runs of ``run_rows``, from a bounded sample of the ``n`` rows, which
    stand for ``weight`` rows (each for one unless given)."""
    tasks, weight = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), n if weight is None else weight
    runs = max(1, -(-weight // run_rows), min(tasks, -(-weight // LEAST_RUN_ROWS)))
    if runs == 1:
        return []
    sample = rows.select(lead).where(F.col(lead).isNotNull()).sample(min(1.0, RUN_SAMPLE * runs / n), 17)
    return _cuts([r[0] for r in sample.collect()], runs)


def _shared_starts(bounds: list[str]) -> list[int]:
    """Between each bound and the next, the characters with which all values there start."""
    starts = [os.path.commonprefix(pair) for pair in zip(bounds, bounds[1:], strict=False)]
    # up to what is not ASCII: bytes that are no UTF-8 reach the driver as another character
    return [len(re.match("[\0-\x7f]*", s)[0]) for s in starts]


def _offsets(counts: dict[int, int], runs: int) -> list[int]:
    """The rows before each run."""
    offsets, acc = [], 0
    for run in range(runs):
        offsets.append(acc)
        acc += counts.get(run, 0)
    return offsets


def _run_of(lead: str, cuts: list[str], nulls: int | None = None) -> Column:
    """``cuts_passed`` by ``lead``; a null is after all, or in the run ``nulls``."""
    found = cuts_passed(F.col(lead), [F.lit(c) for c in cuts])
    return F.when(F.col(lead).isNull(), F.lit(len(cuts) if nulls is None else nulls)).otherwise(found)


def cuts_passed(value: Column, cuts: list[Column]) -> Column:
    """How many of the ascending ``cuts`` are not after ``value``, by halving."""
    if not cuts:
        return F.lit(0)
    n, array = len(cuts), F.array(*cuts)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length()))])
    here = lambda at, step: (at + step <= n) & (F.element_at(array, F.least(at + step, F.lit(n))) <= value)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(here(at, step), at + step).otherwise(at))


def assign_expanded_keys(
    packed: DataFrame,
    lead: str,
    size: Column,
    expand: Callable[[DataFrame], DataFrame],
    order: Sequence[Column],
    key_col: str,
    prefix: str | None = None,
    start: Column | int = 0,
    leads: DataFrame | None = None,
) -> DataFrame:
    """``assign_dense_keys`` of ``expand(packed)``, whose rows move before they are expanded.

    Every packed row becomes ``size`` rows, and ``order`` starts with the text column ``lead``
    (ascending, nulls last), which expanding leaves as it is. The packed rows are staged once; cuts
    of ``lead`` from a bounded sample give runs of the order, one pass counts the rows of each run,
    and the runs then go to a task each, which expands, sorts and numbers its rows after those of
    the runs before. So the expanded rows are neither moved nor staged. Where one value of ``lead``
    holds too many rows for a task, they are, range-partitioned on the whole order.

    ``leads`` has the values of ``lead`` before what ``packed`` does to its rows: with cuts from
    them the rows are staged by run, as a bucketed table, and need no move after that.
    """
    spark = packed.sparkSession
    if leads is not None:
        # the cuts are values of ``leads``, so these hold them, too
        known = leads.agg(F.count("*").alias("n"), F.count(lead).alias("led"), F.min(lead).alias("low"), F.max(lead).alias("high")).collect()[0]
        cuts = _sampled_cuts(leads, lead, known.n, RUN_PACKED_ROWS)
        # rows without a lead are a run of their own, the last one
        runs = len(cuts) + (1 if known.led == known.n else 2)
        placed = packed.withColumn(_PART, _run_of(lead, cuts, runs - 1))
        placed = write_bucketed(placed, _PART, runs, scratch_path(spark, f"runs-{key_col}"))
        counts = dict(placed.groupBy(_PART).agg(F.sum(size)).collect())
        if max(counts.values(), default=0) > MOST_RUN_ROWS:
            return assign_expanded_keys(placed.drop(_PART, SPREAD), lead, size, expand, order, key_col, prefix, start)
        # Spark sorts by the first bytes of the first column before it looks at rows: those that all
        # of a run have in common, which tell nothing apart, are left out of it
        shared = [*_shared_starts([known.low or "", *cuts, known.high or ""]), 0]
        telling = F.substr(F.col(lead), _offset(shared, F.col(_PART)).cast("int") + 1)
        base = F.lit(_scalar_value(spark, start)).cast("long") + _offset(_offsets(counts, runs), F.col(_PART))
        rows = expand(placed)
        if not buckets_stay(spark):
            in_run = F.row_number().over(Window.partitionBy(SPREAD).orderBy(F.asc_nulls_last(telling), *order))
            return rows.withColumn(key_col, _key(base + in_run, prefix)).drop(_PART, SPREAD)
        # one value of ``lead`` at a time, so that the sort begins with what tells values apart and a
        # window holds few rows. The window has each bucket read as it lies, as a partition that
        # comes out in order: a row's place in it is its place in the run
        rows = rows.withColumn(_POS, F.row_number().over(Window.partitionBy(telling, SPREAD).orderBy(*order)))
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
        return rows.withColumn(key_col, _key(base + F.greatest(place, F.col(_POS)), prefix)).drop(_PART, _POS, SPREAD)
    staged = write_staged(packed, scratch_path(spark, f"unnumbered-{key_col}"))
    held = staged.agg(F.count("*").alias("packed"), F.coalesce(F.sum(size), F.lit(0)).alias("rows")).collect()[0]
    cuts = _sampled_cuts(staged, lead, held.packed, RUN_ROWS, held.rows)
    runs = len(cuts) + 1
    placed = staged.withColumn(_PART, _run_of(lead, cuts))
    # a number per run comes back
    counts = dict(placed.groupBy(_PART).agg(F.sum(size)).collect())
    if max(counts.values(), default=0) > MOST_RUN_ROWS:
        return assign_dense_keys(expand(staged), order, key_col, prefix, start)
    offsets = _offsets(counts, runs)
    base = _scalar_value(spark, start)
    # run i is partition i; a fixed number of partitions is never merged. A lone run
    # has an empty partition beside it: no plan gathers rows in a single partition
    rows = expand(placed.repartitionById(max(runs, 2), F.col(_PART))).sortWithinPartitions(*order)
    rows = rows.withColumn(_POS, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    number = F.lit(base).cast("long") + _offset(offsets, F.col(_PART)) + F.col(_POS) + 1
    return rows.withColumn(key_col, _key(number, prefix)).drop(_PART, _POS)


def _scalar_value(spark, start: Column | int) -> int:
    """Evaluate the starting key once (a scalar subquery column or a number)."""
    if isinstance(start, int):
        return start
    value = spark.range(1).select(start.cast("long")).first()[0]
    return int(value or 0)
