"""As-of lookups: for every row the latest value of its key that was valid at its time.

Versions and rows are put into one order by key and time, in which a row's version is the last one
before it. The order is cut into ranges by a bounded sample, so a key that holds a third of all rows
spans several tasks, and the pieces move once; each piece of a key carries its last version on to the
pieces after it. One row comes out per row that went in, and nothing is compared pair by pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.keys import cuts_passed
from starloom.session import scratch_path, write_staged

_K, _T, _KIND, _TIE, _SPREAD, _V, _ROW, _P, _IN = (f"_asof_{c}" for c in ("k", "t", "kind", "tie", "spread", "v", "row", "p", "in"))

#: Sampled events per range, from which the cuts between ranges are taken.
RANGE_SAMPLE = 200


def _ranges(events: DataFrame, by: list[str]) -> Column:
    """The range of the order by ``by`` that an event falls in: as many as there are tasks."""
    n = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.struct(*by)
    sample = events.select(place.alias("at")).orderBy(F.rand(3)).limit(RANGE_SAMPLE * n).orderBy("at").collect()
    kinds = {f.name: f.dataType for f in events.schema.fields}
    picked = [sample[len(sample) * i // n].at for i in range(1, n)] if sample else []
    cuts = [F.struct(*[F.lit(at[c]).cast(kinds[c]).alias(c) for c in by]) for at in picked]
    return cuts_passed(place, cuts)


def as_of(rows: DataFrame, key: Column, at: Column, versions: DataFrame, version_key: Column, since: Column, tie: Column, value: str) -> DataFrame:
    """``rows`` with ``value``: that of the version of ``key`` with the latest ``since`` that is not
    after ``at`` (of equal ones the one with the greatest ``tie``), else null.

    Rows without a key or a time match nothing; versions without a key or a start are never valid.
    """
    spark, kind = rows.sparkSession, versions.schema[value].dataType
    here = rows.select(F.struct("*").alias(_ROW), key.alias(_K), at.alias(_T))
    timed = F.col(_K).isNotNull() & F.col(_T).isNotNull()
    null = F.lit(None).cast(kind)
    # rows spread at random among equal keys and times; versions come before the rows of their time
    asked = here.where(timed).select(_K, _T, F.lit(1).alias(_KIND), F.lit(0).cast("long").alias(_TIE), F.rand(7).alias(_SPREAD), null.alias(_V), _ROW)
    known = versions.select(version_key.alias(_K), since.alias(_T), F.lit(0).alias(_KIND), tie.cast("long").alias(_TIE), F.lit(0.0).alias(_SPREAD), F.col(value).alias(_V))
    known = known.where(timed).withColumn(_ROW, F.lit(None).cast(asked.schema[_ROW].dataType))
    order = [F.col(_T), F.col(_KIND), F.asc_nulls_first(_TIE), F.col(_SPREAD)]
    piece = Window.partitionBy(_P, _K).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    events = known.unionByName(asked)
    events = events.withColumn(_P, _ranges(events, [_K, _T, _KIND, _TIE, _SPREAD]))
    staged = write_staged(events.withColumn(_IN, F.last(_V, ignorenulls=True).over(piece)), scratch_path(spark, "as-of"))
    # the last version of every piece that has one; a key has at most a piece per range
    last = staged.where(F.col(_KIND) == 0).groupBy(_P, _K).agg(F.max_by(_V, F.struct(_T, _TIE)).alias(_V))
    pieces = staged.select(_P, _K).distinct().join(last, [_P, _K], "left")
    earlier = Window.partitionBy(_K).orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.select(_P, _K, F.last(_V, ignorenulls=True).over(earlier).alias("_asof_carry")).where("_asof_carry IS NOT NULL")
    found = staged.where(F.col(_KIND) == 1).join(carried, [_P, _K], "left")
    found = found.select(f"{_ROW}.*", F.coalesce(_IN, "_asof_carry").alias(value))
    return found.unionByName(here.where(~timed).select(f"{_ROW}.*", null.alias(value)))
