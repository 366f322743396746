"""Exact top-k search by inner product with a pivot table.

Vectors are the integers floor(64 x). For a query q and a candidate c, both lifted by one
coordinate ``sqrt(M - |c|^2)`` (the query by 0, M the largest candidate norm squared),
``|q - c|^2 = |q|^2 + M - 2 q.c``, so a large score is a small distance. Distances of all
candidates and queries to the pivots are computed once and stored beside the vectors. By the triangle
inequality ``max over p of |d(q, p) - d(c, p)|`` bounds the distance from below and the score
from above.

Queries are shared in chunks of at most about CHUNK rows and candidates in runs of about as many; every
chunk meets every run in a cell of its own, which one task searches. Within a cell candidates lie in
groups of GROUP rows with like distances to their nearest pivot, and the least and largest distance of a
group to each pivot bound the scores of all its rows. A tile of queries takes the groups in the order of
that bound, in growing batches, each with one matrix product for the queries whose k-th best score is
not above the bound, until every k-th best score is above every bound left. Bounds are loosened by a
rounding margin, and ties with the k-th score are evaluated, so the result is exact.

A cell returns its best k per query above a floor known beforehand (the k-th best among the pivots'
own sample), which are then merged by an aggregation that keeps k per query in each partial step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.session import scratch_path, write_staged

SCALE = 64
#: The largest norm squared, and so score, that doubles hold exactly.
MOST = float(1 << 53)
PIVOTS = 24
#: Rows of the sample that pivots are chosen from.
PIVOT_SAMPLE = 1_000
#: Query rows of a chunk and, at most, their components in all.
CHUNK, CHUNK_VALUES = 100_000, 6_400_000
#: Candidates of a run at least, and runs that are made for any number of queries.
BLOCK, RUNS = 8_192, 16
#: Candidates of a group, and queries of a tile.
GROUP, TILE = 64, 512
#: Groups evaluated first per tile; doubles each turn up to the second number.
FIRST, LARGEST = 4, 64


def integers(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: floor(64 x) of the vectors that take part (not null, no null or
    non-finite component)."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    finite = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf")))
    kept = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    return kept.select("vec_id", F.transform(x, lambda e: F.floor(e * SCALE)).alias("v"))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first pivots out of a sample of lifted vectors."""
    if not len(sample):
        return sample
    chosen, nearest = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(count, len(sample)):
        nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
        chosen.append(int(nearest.argmax()))
    return sample[chosen]


def lift(vectors: np.ndarray, largest: float) -> np.ndarray:
    """Candidates with the coordinate that makes all norms squared ``largest``."""
    rest = np.sqrt(np.maximum(largest - (vectors**2).sum(axis=1), 0.0))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squared = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * a @ b.T
    return np.sqrt(np.maximum(squared, 0.0))


def exact_kind(largest: float) -> str:
    """The float type in which all inner products are exact: they stay within ``largest``, the
    largest norm squared, so do their partial sums up to sign and order."""
    return "<f4" if largest < 1 << 22 else "<f8"


def group_ranges(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per pivot (rows) the least and the largest distance of each group of GROUP candidates."""
    starts = np.arange(0, len(table), GROUP)
    return np.minimum.reduceat(table, starts).T, np.maximum.reduceat(table, starts).T


def by_pivot(table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The order of the nearest pivot, the distance to it and the id."""
    return np.lexsort((ids, table.min(axis=1), table.argmin(axis=1)))


def score_bounds(norms, to_pivots, low, high, largest: float) -> np.ndarray:
    """For each query (rows) what no score in a group (columns) exceeds."""
    gap = np.zeros((len(to_pivots), low.shape[1]), np.float32)
    for p in range(len(low)):
        np.maximum(gap, low[p] - to_pivots[:, p, None], out=gap)
        np.maximum(gap, to_pivots[:, p, None] - high[p], out=gap)
    both = (norms + largest)[:, None]
    # distances are kept in single precision: loosen them by far more than its rounding
    gap = np.maximum(gap - (1e-3 + 1e-6 * np.sqrt(both)), 0.0)
    return (both - gap**2) / 2 + 1e-6 * both + 1e-3


def search_tile(query_ids, queries, to_pivots, floors, ids, vectors, ranges, largest, k):
    """The best ``k`` of the candidates for every query of a tile as (place of the query, score, id),
    ties to smaller ids, and the number of scores computed.

    Candidates lie in groups, whose distances to the pivots are within ``ranges``; scores below
    ``floors`` are not wanted (k better ones are known elsewhere).
    """
    norms = (queries.astype(np.float64) ** 2).sum(axis=1)
    bound = score_bounds(norms, to_pivots, *ranges, largest)
    floor = floors.astype(vectors.dtype)
    last, full = np.zeros(len(queries), np.int64), np.zeros(len(queries), bool)
    places, scores, found = np.empty(0, np.int64), np.empty(0, vectors.dtype), np.empty(0, np.int64)
    left, step, computed = np.argsort(-bound.max(axis=0), kind="stable"), FIRST, 0
    while True:
        left = left[(bound[:, left] >= floor[:, None]).any(axis=0)]
        if not len(left):
            return places, scores, found, computed
        part, left, step = left[:step], left[step:], min(2 * step, LARGEST)
        rows = np.flatnonzero((bound[:, part] >= floor[:, None]).any(axis=1))
        those = (part[:, None] * GROUP + np.arange(GROUP)).ravel()
        those = those[those < len(ids)]
        product = queries[rows] @ vectors[those].T
        computed += product.size
        at = np.flatnonzero(product >= floor[rows, None])
        r, i, s = rows[at // len(those)], ids[those[at % len(those)]], product.ravel()[at]
        # of ties with the k-th best only smaller ids count
        new = (i != query_ids[r]) & ((s > floor[r]) | ~full[r] | (i < last[r]))
        places, scores, found = np.concatenate([places, r[new]]), np.concatenate([scores, s[new]]), np.concatenate([found, i[new]])
        order = np.lexsort((found, -scores, places))
        places, scores, found = places[order], scores[order], found[order]
        keep = np.arange(len(places)) - np.searchsorted(places, places) < k
        places, scores, found = places[keep], scores[keep], found[keep]
        counts = np.bincount(places, minlength=len(queries))
        full = counts == k
        ends = np.cumsum(counts)[full] - 1
        floor[full], last[full] = scores[ends], found[ends]


def search(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best rows of ``vectors`` but its own.

    ``vectors`` and ``queries`` have ``vec_id`` and ``embedding``; other columns are not
    carried. Null vectors and ids, and vectors with a null or non-finite component, take no
    part. Vectors of different dimensions have no inner product: such tables raise, as do vectors
    whose scores could leave 2^53, beyond which doubles are not exact. Ties go to smaller ids; repeated rows count each, among the
    candidates and among the queries: every query row gets its own ``k`` best. A query with
    fewer candidates gets all; empty tables give no rows.
    """
    spark = vectors.sparkSession
    columns = [F.col("vec_id").cast("long").alias("vec_id"), "v", F.size("v").alias("dim")]
    wide = integers(vectors).select(*columns, F.lit(False).alias("asks"))
    both = wide.unionByName(integers(queries).select(*columns, F.lit(True).alias("asks")))
    # floor() of a double beyond the long range saturates, so the bound is taken before it is squared
    square = F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double"))
    sums = [F.min("dim").alias("low"), F.max("dim").alias("high"), F.max(square).alias("largest")]
    found = both.agg(*sums, F.count_if("asks").alias("asked"), F.count_if(~F.col("asks")).alias("rows")).collect()[0]
    if not found["rows"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if found.low != found.high:
        raise ValueError(f"vectors of {found.low} to {found.high} dimensions have no common inner product")
    if found.largest > MOST:
        raise ValueError("scores beyond 2^53 are not exact")
    if not found.asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    largest, dim = float(found.largest), found.high
    sample = wide.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).toArrow()
    sampled_ids = sample.column("vec_id").to_numpy()
    sampled = np.array(sample.column("v").to_pylist(), np.float64).reshape(sample.num_rows, dim)
    pivots = choose_pivots(lift(sampled, largest), PIVOTS)
    kind, stored_kind = exact_kind(largest), "<i2" if largest < 1 << 30 else "<i4"

    def floors_of(ids: np.ndarray, v: np.ndarray) -> np.ndarray:
        """The k-th best score of each query among the sampled rows but its own."""
        floors = np.full(len(ids), -np.inf)
        for i in range(0, len(ids) if len(sampled) >= k else 0, TILE):
            scores = v[i : i + TILE] @ sampled.T
            scores[ids[i : i + TILE, None] == sampled_ids] = -np.inf
            floors[i : i + TILE] = np.partition(scores, len(sampled) - k, axis=1)[:, -k]
        return floors

    def tabulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, asks = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("vec_id", "asks"))
            v = batch.column("v").flatten().to_numpy().astype(np.float64).reshape(len(ids), dim)
            lifted = lift(v, largest)
            lifted[asks, -1] = 0.0
            table = distances(lifted, pivots).astype("<f4")
            floors = np.full(len(ids), -np.inf)
            floors[asks] = floors_of(ids[asks], v[asks])
            cells = [pa.array([row.tobytes() for row in x], pa.binary()) for x in (v.astype(stored_kind), table)]
            yield pa.RecordBatch.from_arrays([*batch.select(["vec_id", "asks"]).columns, *cells, pa.array(floors)], ["vec_id", "asks", "vector", "table", "floor"])

    schema = "vec_id long, asks boolean, vector binary, table binary, floor double"
    stored = both.select("vec_id", "asks", "v").mapInArrow(tabulate, schema)
    # every row has a number of its own, since ids may repeat; written, so the numbers stay
    stored = write_staged(stored.withColumn("number", F.monotonically_increasing_id()), scratch_path(spark, "pivot-table"))

    chunks = -(-found.asked // max(1, min(CHUNK, CHUNK_VALUES // max(dim, 1))))
    # as many copies of queries as of candidates, but no shorter runs than a block
    runs = min(-(-found["rows"] // BLOCK), max(RUNS, found["rows"] * chunks // found.asked))
    own = lambda n: F.pmod("number", F.lit(n)).cast("int")
    each = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    cell = F.when(F.col("asks"), F.transform(each(runs), lambda r: own(chunks) * runs + r)).otherwise(F.transform(each(chunks), lambda c: c * runs + own(runs)))
    cells = stored.withColumn("cell", F.explode(cell)).repartitionById(max(chunks * runs, 2), F.col("cell"))

    def search_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        for batch in batches:
            table, vectors = (b"".join(batch.column(n).to_pylist()) for n in ("table", "vector"))
            table = np.frombuffer(table, "<f4").reshape(batch.num_rows, len(pivots))
            vectors = np.frombuffer(vectors, stored_kind).reshape(batch.num_rows, dim).astype(kind)
            parts.append((*(batch.column(n).to_numpy(zero_copy_only=False) for n in ("cell", "asks", "vec_id", "number", "floor")), table, vectors))
        if not parts:
            return
        cell, asks, ids, numbers, floors, table, vectors = map(np.concatenate, zip(*parts, strict=True))
        del parts
        for c in np.unique(cell):
            rest, tiles = (np.flatnonzero((cell == c) & (asks == a)) for a in (False, True))
            rest, tiles = (x[by_pivot(table[x], ids[x])] for x in (rest, tiles))
            if not len(rest):
                continue
            ranges, there, those = group_ranges(table[rest]), vectors[rest], ids[rest]
            for i in range(0, len(tiles), TILE):
                q = tiles[i : i + TILE]
                places, scores, found, _ = search_tile(ids[q], vectors[q], table[q], floors[q], those, there, ranges, largest, k)
                columns = numbers[q][places], ids[q][places], found, scores.astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["number", "query_id", "vec_id", "score"])

    best = cells.mapInArrow(search_cells, "number long, query_id long, vec_id long, score long")
    order = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_topk_search(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    """Queries: the rows whose vec_id is divisible by 20; their 20 best among all rows."""
    return search(embeddings, embeddings.where(F.col("vec_id") % 20 == 0), 20)
