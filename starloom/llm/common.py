"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Entries a worker's memo may hold before it starts again from empty.
MEMO_ENTRIES = 600_000
#: Bytes that the memo of one tokenizer's pieces may hold, and what an entry takes beside its
#: characters and ids (the dictionary's slot and two object headers).
MEMO_BYTES = 180_000_000
ENTRY_BYTES = 200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows that go to a Python worker together in the pipeline.
BATCH_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    """From now on rows go to Python workers BATCH_ROWS at a time, unless the session has a number of
    its own: the JVM and the worker each hold a batch of whole texts (of pairs, both), and where
    stages share executors this comes on top of what the stages before have left there."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_ROWS))


def crc32_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds`` (null id: null)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    in_training: Column,
    per_label: int,
    max_chars: int,
) -> DataFrame:
    """A bounded training sample ``doc_id, text, y``.

    At most ``per_label`` documents of each of the labels 0 and 1, the first by the
    xxhash64 of their id, so the choice depends on the ids alone. Rows with a null id or
    label take no part, nor do texts above ``max_chars`` characters (this bounds the
    sample in bytes). Repeated ids count once, with their smallest text.
    """
    known = labels.where(in_training).select("doc_id", F.col(label).cast("int").alias("y"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = None
    for y in (0, 1):
        chosen = known.where(F.col("y") == y).distinct().orderBy(*order).limit(per_label)
        ids = chosen if ids is None else ids.unionByName(chosen)
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.where(F.length("text") <= max_chars)
    # at most 2 * per_label ids are broadcast
    found = texts.join(F.broadcast(ids), "doc_id")
    return found.groupBy("doc_id", "y").agg(F.min("text").alias("text"))


def train_in_task(sample: DataFrame, train: Callable[[list[tuple[str, int]]], object]) -> object:
    """``train([(text, label)])`` in one task over a bounded sample, in the order of ids.

    The task reruns elsewhere if its executor is lost; only the fitted model comes back.
    """

    def run(batches):
        forget_worker_state()
        rows = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        rows.sort(key=lambda r: (r[0], r[1]))
        model = train([(text, y) for _, y, text in rows])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    fitted = sample.select("doc_id", "y", "text").repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(fitted[0].model) if fitted else train([])


class Memo(dict):
    """word -> value, filled by ``make`` on a miss; starts again beyond MEMO_ENTRIES."""

    def __init__(self, make: Callable):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value

    def trim(self) -> None:
        if len(self) > MEMO_ENTRIES:
            self.clear()


#: Per worker process: the model or memo of the operator that runs.
_WORKER: dict = {}


def worker_state(key, make: Callable):
    """What ``make`` returned the first time this worker asked for ``key``.

    A worker holds one state: stages follow each other in reused workers, and what an earlier
    operator remembered must not stay beside the next one's.
    """
    if key not in _WORKER:
        forget_worker_state()
        _WORKER[key] = make()
    return _WORKER[key]


def forget_worker_state() -> None:
    """Drop what an earlier operator left in this worker, before work that needs the room."""
    _WORKER.clear()
    pa.default_memory_pool().release_unused()


def text_slices(texts: pa.Array, size: int) -> Iterator[tuple[int, int, list[str]]]:
    """``start, stop, texts`` of consecutive texts of about ``size`` bytes together, null as
    empty; only one slice is held as Python strings."""
    if not len(texts):
        return
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    number = np.cumsum(lengths) // size
    starts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(texts)]
    for i, j in zip(starts, starts[1:], strict=False):
        yield i, j, [t or "" for t in texts[i:j].to_pylist()]


def texts_of(array) -> Iterator[str]:
    """The strings of an Arrow array, null as empty."""
    for value in array:
        yield value.as_py() or ""
