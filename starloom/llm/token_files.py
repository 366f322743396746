"""Token-id files: one zstandard frame per document, a shared dictionary, an offset index.

Format (a Parquet dataset, so any store that Spark writes will do, with its commit protocol):

* ``dictionary``: one row ``hash long, width int, data binary`` - the zstandard dictionary
  trained on serialized id arrays (empty: frames use none), its crc32, and the bytes per id;
* ``segments``: rows in ascending ``doc_id`` order by (``part``, ``segment``), each with the
  concatenated frames of consecutive documents (``payload``), the parallel arrays ``doc_ids``,
  ``offsets`` (of the frames in the payload) and ``counts`` (ids per document), the ids of this
  part's earlier segments (``tokens_before``), ``n_tokens``, ``first_doc``, ``last_doc`` (nulls
  first) and the ``dictionary`` hash.

A short document is read by pruning segments on ``first_doc``/``last_doc`` and decompressing
its frame alone. Ids are serialized little-endian, 16 bits wide if the vocabulary fits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import train_in_task, worker_state
from starloom.llm.pieces import PieceIds, WordIds, drops_spaces, library_encoder, slices
from starloom.session import scratch_path

#: Bounds of the dictionary and of the sample that trains it.
DICTIONARY_BYTES = 64_000
SAMPLE_DOCUMENTS = 2_000
SAMPLE_CHARS = 100_000
SEGMENT_BYTES = 4_000_000
SEGMENT_DOCUMENTS = 20_000
LEVEL = 3


def serialize(ids: bytes, width: int) -> bytes:
    """Ids of 32 bits to ``width`` bytes each."""
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def restore(data: bytes, width: int) -> bytes:
    return data if width == 4 else np.frombuffer(data, "<u2").astype("<u4").tobytes()


def train_dictionary(arrays: list[bytes]) -> bytes:
    """A zstandard dictionary, or empty bytes where the sample is too small to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [a for a in arrays if len(a) >= 8]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


class Codec:
    """Compresses and restores one document at a time."""

    def __init__(self, dictionary: bytes, width: int):
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.width = width
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=False)
        self.decompressor = zstandard.ZstdDecompressor(dict_data=shared)

    def pack(self, ids: bytes) -> bytes:
        return self.compressor.compress(serialize(ids, self.width))

    def unpack(self, frame: bytes) -> bytes:
        return restore(self.decompressor.decompress(frame), self.width)


class Tokenizer:
    """Ids of whole texts with the end id, from a tokenizer definition."""

    def __init__(self, definition: bytes, end_id: int):
        self.pieces = WordIds(definition) if drops_spaces(definition) else PieceIds(library_encoder(definition))
        self.end = np.array([end_id], "<u4").tobytes()

    def ids(self, texts: list[str]) -> list[bytes]:
        return [i + self.end for i in self.pieces.ids(texts)]


def id_width(definition: bytes, end_id: int) -> int:
    from tokenizers import Tokenizer as Library

    return 2 if max(Library.from_buffer(definition).get_vocab_size(), end_id + 1) <= 1 << 16 else 4


def dictionary_sample(documents: DataFrame) -> DataFrame:
    """Up to SAMPLE_DOCUMENTS texts, the first by the xxhash64 of their id; texts above
    SAMPLE_CHARS take no part (the sample trains the dictionary only)."""
    ids = documents.where(F.col("doc_id").isNotNull()).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = ids.limit(SAMPLE_DOCUMENTS).distinct()
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= SAMPLE_CHARS)
    # at most SAMPLE_DOCUMENTS ids are broadcast
    found = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    return found.select("doc_id", F.lit(0).alias("y"), "text")


def write_tokens(documents: DataFrame, path: str, tokenizer_file: str, end_id: int) -> None:
    """Write every document's ids, with ``end_id`` after them, under ``path``.

    Null and empty texts are the end id alone. Null ids come first. Repeated rows are each
    written; rows of one id stand in the order of their frames' hash. Other columns are not
    carried. An empty table gives a dictionary row and no segments. Frames are staged once in
    the shared checkpoint folder, so that sampling the id ranges does not encode twice.
    """
    spark = documents.sparkSession
    with open(tokenizer_file, "rb") as f:
        definition = f.read()
    width = id_width(definition, end_id)
    shared = spark.sparkContext.broadcast(definition)
    key = ("token_files", zlib.crc32(definition), end_id)

    def tokenizer() -> Tokenizer:
        return worker_state(key, lambda: Tokenizer(shared.value, end_id))

    def train(sample: list[tuple[str, int]]) -> bytes:
        if not sample:
            return b""
        return train_dictionary([serialize(i, width) for i in tokenizer().ids([t for t, _ in sample])])

    dictionary = train_in_task(dictionary_sample(documents), train)
    dict_hash = zlib.crc32(dictionary)
    spark.createDataFrame([(dict_hash, width, dictionary)], "hash long, width int, data binary").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/dictionary")

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, encoder = Codec(dictionary, width), tokenizer()
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for i, j in slices(texts):
                ids = encoder.ids(texts[i:j])
                columns = [
                    batch.column(0)[i:j],
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([codec.pack(x) for x in ids], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "frame"])

    id_type = documents.schema["doc_id"].dataType.simpleString()
    staged = scratch_path(spark, "token-frames")
    documents.select("doc_id", "text").mapInArrow(frames, f"doc_id {id_type}, n_tokens long, frame binary").write.option(
        "compression", "none"
    ).parquet(staged)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before = TaskContext.get().partitionId(), 0, 0
        ids, counts, held, size = [], [], [], 0

        def row(kind: pa.DataType) -> pa.RecordBatch:
            offsets = np.cumsum([0, *map(len, held)])[:-1].tolist()
            values = [part, number, before, sum(counts), ids[0], ids[-1], dict_hash, ids, offsets, counts, b"".join(held)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), kind, kind, pa.int64(), pa.list_(kind), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], SEGMENT_NAMES)

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for doc_id, n, frame in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids.append(doc_id)
                counts.append(n)
                held.append(frame)
                size += len(frame)
                if size >= SEGMENT_BYTES or len(ids) >= SEGMENT_DOCUMENTS:
                    yield row(kind)
                    number, before = number + 1, before + sum(counts)
                    ids, counts, held, size = [], [], [], 0
        if ids:
            yield row(kind)

    tie = F.xxhash64("frame")
    ordered = spark.read.parquet(staged).repartitionByRange(F.col("doc_id").asc_nulls_first(), tie)
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
    ordered.mapInArrow(segments, segment_schema(id_type)).write.option("compression", "none").mode("overwrite").parquet(
        f"{path}/segments"
    )


SEGMENT_NAMES = ["part", "segment", "tokens_before", "n_tokens", "first_doc", "last_doc", "dictionary", "doc_ids", "offsets", "counts", "payload"]


def segment_schema(id_type: str) -> str:
    kinds = ["int", "int", "long", "long", id_type, id_type, "long", f"array<{id_type}>", "array<long>", "array<long>", "binary"]
    return ", ".join(f"{n} {k}" for n, k in zip(SEGMENT_NAMES, kinds, strict=True))


def read_tokens(spark: SparkSession, path: str, wanted: list | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of the files' documents (``wanted``: of these ids only).

    ``start`` counts the ids of all documents before. Fails if a segment names another
    dictionary than the one stored. With ``wanted``, segments outside its range are pruned and
    only the wanted frames are decompressed.
    """
    stored = spark.read.parquet(f"{path}/dictionary").collect()[0]  # one row of bounded size
    segments = spark.read.parquet(f"{path}/segments")
    id_type = segments.schema["first_doc"].dataType.simpleString()
    # one row per written partition; its running total is the only single-task step
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    base = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    if wanted is not None:
        low, high = (min(wanted), max(wanted)) if wanted else (None, None)
        segments = segments.where((F.col("last_doc") >= F.lit(low)) & (F.col("first_doc") <= F.lit(high)))
    only = None if wanted is None else frozenset(wanted)
    dictionary, width, expected = bytes(stored.data), stored.width, stored.hash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(dictionary, width)
        for batch in batches:
            for i in range(batch.num_rows):
                part_base, before, dict_hash, doc_ids, offsets, counts = (batch.column(c)[i].as_py() for c in range(6))
                if dict_hash != expected:
                    raise ValueError(f"segment of dictionary {dict_hash}, stored is {expected}")
                payload = batch.column(6)[i].as_buffer()
                stops = [*offsets[1:], payload.size]
                starts = (part_base + before + np.cumsum([0, *counts])[:-1]).tolist()
                at = [k for k, d in enumerate(doc_ids) if only is None or d in only]
                for a in range(0, len(at), 512):
                    some = at[a : a + 512]
                    ids = [codec.unpack(payload[offsets[k] : stops[k]]) for k in some]
                    columns = [
                        pa.array([doc_ids[k] for k in some], batch.schema.field(3).type.value_type),
                        pa.array([starts[k] for k in some], pa.int64()),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])

    rows = segments.join(base, "part").select("base", "tokens_before", "dictionary", "doc_ids", "offsets", "counts", "payload")
    return rows.mapInArrow(run, f"doc_id {id_type}, start long, n_tokens long, ids binary")


def op10_token_files(spark: SparkSession, documents: DataFrame, tokenizer_file: str, end_id: int = 2) -> DataFrame:
    """Write all documents' ids, read the files back, digest them; the contract's columns."""
    path = scratch_path(spark, "token-files")
    write_tokens(documents, path, tokenizer_file, end_id)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
