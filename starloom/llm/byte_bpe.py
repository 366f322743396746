"""Byte-level BPE encoding and decoding on padded numpy matrices.

Distinct pre-tokens (matches of the pattern) are encoded in buckets of similar byte length,
one row each. Every round each unfinished row merges its leftmost pair of minimum rank; the
pair ranks come from an open-addressed hash table over ``(left id, right id)``, and the merged
row is compacted by one column. After a merge only the two neighbouring pairs are looked up
again. Rows above ``LONG`` bytes follow the same rule with a heap, since a padded matrix would
cost the square of their length.

A text's ids are its pre-tokens' ids in order, so a worker keeps the ids of pieces it has met
in a bounded memo (``pieces.PieceIds``).
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import text_slices, worker_state
from starloom.llm.pieces import PieceIds

LONG = 512
#: Cells of one padded matrix.
CELLS = 500_000
#: Bytes of text that a worker handles at once.
SLICE = 2_000_000
NONE = np.int32(1 << 30)


def read_ranks(data: bytes) -> dict[bytes, int]:
    """token bytes -> rank, from the text of a rank file."""
    pairs = (line.split() for line in data.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def token_list(ranks: dict[bytes, int]) -> list[bytes]:
    """The bytes of each token, by rank."""
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def joined(tokens: list[bytes], ids: bytes) -> bytes:
    """The bytes that ids stand for."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class PairTable:
    """Hash table (left id, right id) -> rank of the joined bytes, by linear probing."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        self.bits = max(4, int(np.ceil(np.log2(2 * len(keys) + 2))))
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.values = np.full(size, NONE, np.int32)
        key, value = np.array(keys, np.int64), np.array(values, np.int32)
        slot = self._slot(key)
        while len(key):
            free = self.keys[slot] < 0
            _, first = np.unique(np.where(free, slot, -1), return_index=True)
            take = np.zeros(len(key), bool)
            take[first] = True
            take &= free
            self.keys[slot[take]], self.values[slot[take]] = key[take], value[take]
            key, value, slot = key[~take], value[~take], (slot[~take] + 1) & (size - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where no token joins it (negative ids: padding)."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        out = np.full(key.shape, NONE, np.int32)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        key = key.ravel()[at]
        flat, slot = out.ravel(), self._slot(key)
        while len(at):
            found = self.keys[slot]
            hit = found == key
            flat[at[hit]] = self.values[slot[hit]]
            more = ~hit & (found >= 0)
            at, key, slot = at[more], key[more], (slot[more] + 1) & (len(self.keys) - 1)
        return flat.reshape(out.shape)


class Encoder:
    """Encodes strings by ranks; decodes ids to bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.whole = ranks
        self.pattern = regex.compile(pattern)
        self.pairs = PairTable(ranks)
        self.byte_rank = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.tokens = token_list(ranks)

    def matrix(self, tokens: list[bytes], width: int) -> list[bytes]:
        """Ids of tokens of at most ``width`` bytes, one padded row each."""
        n = len(tokens)
        lengths = np.array([len(t) for t in tokens])
        flat = self.byte_rank[np.frombuffer(b"".join(tokens), np.uint8)]
        ids = np.full((n, width), -1, np.int32)
        ids[np.arange(width) < lengths[:, None]] = flat
        rank = np.full((n, width), NONE, np.int32)
        rank[:, :-1] = self.pairs.ranks(ids[:, :-1], ids[:, 1:])
        out: list[bytes] = [b""] * n
        row = np.arange(n)
        columns = np.arange(width)
        while True:
            at = rank.argmin(axis=1)  # the leftmost of equal ranks
            line = np.arange(len(row))
            best = rank[line, at]
            done = best == NONE
            if done.any():
                ended = ids[done]
                kept = ended >= 0
                ends = np.cumsum(kept.sum(axis=1) * 4).tolist()
                packed, begin = ended[kept].astype("<u4").tobytes(), 0
                for r, end in zip(row[done].tolist(), ends, strict=True):
                    out[r] = packed[begin:end]
                    begin = end
                more = ~done
                if not more.any():
                    return out
                ids, rank, row, at, best = ids[more], rank[more], row[more], at[more], best[more]
                line = np.arange(len(row))
            ids[line, at] = best
            # compact: what stood after the merged pair moves one column to the left
            source = np.minimum(columns + (columns > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, source, 1)
            ids[:, -1] = -1
            rank = np.take_along_axis(rank, source, 1)
            rank[:, -1] = NONE
            following = np.minimum(at + 1, width - 1)
            right = np.where(at + 1 < width, ids[line, following], -1)
            rank[line, at] = self.pairs.ranks(best, right)
            before = np.maximum(at - 1, 0)
            left = np.where(at > 0, ids[line, before], -1)
            new = self.pairs.ranks(left, best)
            rank[line, before] = np.where(at > 0, new, rank[line, before])

    def by_heap(self, token: bytes) -> bytes:
        """The same merges for one long row, with a heap of (rank, place)."""
        ids = self.byte_rank[np.frombuffer(token, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.pairs.ranks(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32))
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r < NONE]
        heapq.heapify(heap)
        join, tokens = self.whole.get, self.tokens
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # one of the two has merged since
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n:
                    new = join(tokens[ids[a]] + tokens[ids[b]])
                    if new is not None:
                        heapq.heappush(heap, (new, a, ids[a], ids[b]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def pretokens(self, tokens: list[bytes]) -> dict[bytes, bytes]:
        """token bytes -> ids of distinct pre-tokens."""
        out, buckets = {}, {}
        for t in tokens:
            rank = self.whole.get(t)
            if rank is not None:
                out[t] = np.array([rank], "<u4").tobytes()
            elif len(t) > LONG:
                out[t] = self.by_heap(t)
            else:
                width = len(t) if len(t) <= 16 else 1 << (len(t) - 1).bit_length()
                buckets.setdefault(width, []).append(t)
        for width, members in buckets.items():
            step = max(1, CELLS // width)
            for i in range(0, len(members), step):
                part = members[i : i + step]
                out.update(zip(part, self.matrix(part, width), strict=True))
        return out

    def strings(self, strings: list[str]) -> list[bytes]:
        """Ids of each string, every match of the pattern by itself."""
        matches = [[m.encode() for m in self.pattern.findall(s)] for s in strings]
        ids = self.pretokens(list({m for ms in matches for m in ms}))
        return [b"".join([ids[m] for m in ms]) for ms in matches]

    def decode(self, ids: bytes) -> bytes:
        """The bytes that the ids stand for."""
        return joined(self.tokens, ids)


def _shared(frame: DataFrame, rank_file: str, pattern: str):
    """A function that gives a worker its encoder and piece memo. The rank file, of a fixed size,
    is read on the driver and broadcast."""
    with open(rank_file, "rb") as f:
        data = f.read()
    shared = frame.sparkSession.sparkContext.broadcast(data)
    key = ("byte_bpe", zlib.crc32(data), pattern)

    def make():
        encoder = Encoder(read_ranks(shared.value), pattern)
        return encoder, PieceIds(encoder.strings)

    return lambda: worker_state(key, make)


def encode(documents: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` of every document; ids are little-endian unsigned 32-bit.

    Null and empty texts have no ids (an empty binary). Repeated rows are encoded each. Other
    columns of the input are not carried. Texts are cut whole, never shortened, in one pass
    without a shuffle.
    """
    state = _shared(documents, rank_file, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, piece_ids = state()
        for batch in batches:
            for i, j, texts in text_slices(batch.column(1), SLICE):
                ids = pa.array(piece_ids.ids(texts), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], ids], ["doc_id", "ids"])

    return documents.select("doc_id", "text").mapInArrow(run, _id_schema(documents, "ids binary"))


def decode(encoded: DataFrame, rank_file: str) -> DataFrame:
    """``doc_id, ids, decoded`` of ``encoded``: the bytes its ``ids`` stand for (null: empty)."""
    with open(rank_file, "rb") as f:
        data = f.read()
    shared = encoded.sparkSession.sparkContext.broadcast(data)
    key = ("byte_bpe_tokens", zlib.crc32(data))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_state(key, lambda: token_list(read_ranks(shared.value)))
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                out = pa.array([joined(tokens, v.as_py() or b"") for v in part.column("ids")], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), out], ["doc_id", "ids", "decoded"])

    schema = _id_schema(encoded, "ids binary, decoded binary")
    return encoded.select("doc_id", "ids").mapInArrow(run, schema)


def round_trip(documents: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``doc_id, ids, decoded``: ``decode`` of ``encode`` in one pass, with one Python worker per
    task instead of one for each; the bytes come from the ids alone."""
    state = _shared(documents, rank_file, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, piece_ids = state()
        for batch in batches:
            for i, j, texts in text_slices(batch.column(1), SLICE):
                ids = piece_ids.ids(texts)
                columns = [batch.column(0)[i:j], pa.array(ids, pa.binary()), pa.array(map(encoder.decode, ids), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    return documents.select("doc_id", "text").mapInArrow(run, _id_schema(documents, "ids binary, decoded binary"))


def _id_schema(documents: DataFrame, rest: str) -> str:
    return f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, {rest}"


def digest(decoded: DataFrame) -> DataFrame:
    """The contract's columns."""
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_byte_bpe(spark: SparkSession, documents: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Encode every whole text, decode the ids, digest both."""
    return digest(round_trip(documents, rank_file, pattern))
