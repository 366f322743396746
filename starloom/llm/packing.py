"""Order-preserving packing of token streams by dynamic programming.

The documents of an input partition form one stream in their order. Windows of at most
``length`` tokens are cut from it at document ends (free), after sentences and lines (a small
penalty) or, inside a sentence, at a regular grid (a larger one). The cut points
minimise the sum of padding and penalties:

    cost(j) = penalty(j) + length - at(j) + min over i, at(j) - at(i) <= length, of cost(i) + at(i)

The minimum slides with j, so a monotone queue of candidates gives every transition in
amortised constant time. The program runs over blocks of about ``BLOCK_BYTES`` bytes of text;
each block hands its last window on to the next, so a task holds one block whatever its
partition. No row is shuffled: partitions pack independently, and each leaves at most one
partly filled window. Sequence ids hold the partition in their upper bits, so they are unique
and a rerun task produces the same rows.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from starloom.llm.common import MEMO_BYTES, text_slices, worker_state
from starloom.llm.pieces import PieceIds, library_encoder, plain

BLOCK_BYTES = 2_000_000
SENTENCE_PENALTY = 1.0
GRID_PENALTY = 50.0
#: Distance of the grid cuts inside a sentence; shorter sentences than 1.5 of it have none.
GRID = 32
SCHEMA = "start long, length long, doc_tokens long, sequence_id long, offset long"


class Document:
    """A document, or what a window has left of it: its ids from token ``start`` on."""

    __slots__ = ("doc_id", "start", "total", "ids")

    def __init__(self, doc_id, start: int, total: int, ids: bytes):
        self.doc_id, self.start, self.total, self.ids = doc_id, start, total, ids


class Block:
    """Consecutive documents, the places in their stream where it may be cut (ascending, the
    last one its end) and the penalty of each cut."""

    def __init__(self, documents: list[Document], at: np.ndarray, penalties: np.ndarray):
        self.documents, self.at, self.penalties = documents, at, penalties

    def then(self, other: Block) -> Block:
        shift = int(self.at[-1]) if len(self.at) else 0
        at, penalties = np.concatenate([self.at, other.at + shift]), np.concatenate([self.penalties, other.penalties])
        return Block(self.documents + other.documents, at, penalties)


EMPTY = Block([], np.empty(0, np.int64), np.empty(0))


def sentence_ends(text: str, pieces: list[str]) -> np.ndarray:
    """For each piece whether a sentence or line ends with it (the last one's does not count)."""
    if plain(text):
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        gaps = np.flatnonzero((data == 32) | (data == 10))
        before = data[gaps - 1]
        ends = (data[gaps] == 10) | (before == 46) | (before == 33) | (before == 63)
        return np.append(ends, False)
    return np.array([p[-1:] in (".", "!", "?", "\n") for p in pieces[:-1]] + [False])


def read_block(doc_ids: list, texts: list[str], ids: PieceIds, end: bytes) -> Block:
    """The documents' ids, ``end`` after each, and their cut places: document ends, ends of
    sentences and lines, and a grid inside longer sentences."""
    documents, lengths, ends = [], [], []
    for doc_id, text, pieces, parts in zip(doc_ids, texts, *ids.parts(texts), strict=True):
        parts.append(end)
        whole = b"".join(parts)
        documents.append(Document(doc_id, 0, len(whole) // 4, whole))
        lengths.append(np.fromiter(map(len, parts), np.int64, len(parts)))
        ends.append(sentence_ends(text, pieces))
        ends.append(np.ones(1, bool))
    if not documents:
        return EMPTY
    after = np.cumsum(np.concatenate(lengths)) // 4
    last = np.cumsum([d.total for d in documents])
    at = np.union1d(after[np.concatenate(ends)], last)
    at = at[at > 0]
    penalties = np.full(len(at), SENTENCE_PENALTY)
    penalties[np.searchsorted(at, last)] = 0.0
    edges = np.concatenate([[0], at])
    wide = np.flatnonzero(np.diff(edges) > 1.5 * GRID)
    begin, count = edges[wide] + GRID, (edges[wide + 1] - edges[wide] - GRID // 2 - 1) // GRID
    grid = np.repeat(begin - GRID * (np.cumsum(count) - count), count) + GRID * np.arange(count.sum())
    order = np.argsort(np.concatenate([at, grid]), kind="stable")
    penalties = np.concatenate([penalties, np.full(len(grid), GRID_PENALTY)])[order]
    return Block(documents, np.concatenate([at, grid])[order], penalties)


def windows(at: np.ndarray, penalties: np.ndarray, length: int) -> list[int]:
    """Indices into ``at`` of the chosen window ends; neighbours in ``at`` (which starts with
    0 and ends with the stream's end) lie at most ``length`` apart."""
    place, extra = at.tolist(), penalties.tolist()
    cost, parent = [0.0] * len(place), [0] * len(place)
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])  # (cost + place, place, index)
    for j in range(1, len(place)):
        here = place[j]
        while here - queue[0][1] > length:
            queue.popleft()
        best, _, parent[j] = queue[0]
        cost[j] = best + length - here + extra[j]
        key = cost[j] + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, here, j))
    ends, j = [], len(place) - 1
    while j > 0:
        ends.append(j)
        j = parent[j]
    return ends[::-1]


def pack_block(block: Block, length: int, first_sequence: int, last: bool):
    """Pack a block; unless it is the last, its last window is handed back unpacked.

    Returns piece columns (document index, start, length, sequence, offset, ids), the number
    of sequences, and the block handed back.
    """
    documents, at = block.documents, block.at
    begins = np.cumsum([0, *(len(d.ids) // 4 for d in documents)])
    chosen = windows(np.concatenate([[0], at]), np.concatenate([[0.0], block.penalties]), length)
    ends = np.concatenate([[0], at[np.array(chosen, np.int64) - 1]])
    if not last:
        ends = ends[:-1]
    stop = int(ends[-1])
    edges = np.unique(np.concatenate([ends, begins[begins < stop]]))
    left, right = edges[:-1], edges[1:]
    doc = np.searchsorted(begins, left, side="right") - 1
    window = np.searchsorted(ends, left, side="right") - 1
    inside = left - begins[doc]
    starts = inside + np.array([d.start for d in documents], np.int64)[doc]
    ids = [documents[d].ids[4 * a : 4 * (a + n)] for d, a, n in zip(doc.tolist(), inside.tolist(), (right - left).tolist(), strict=True)]
    columns = (doc, starts, right - left, first_sequence + window, left - ends[window], ids)
    if last:
        return columns, len(ends) - 1, EMPTY
    keep = int(np.searchsorted(begins, stop, side="right") - 1)
    rest, cut = documents[keep:], stop - int(begins[keep])
    if rest and cut:
        d = rest[0]
        rest[0] = Document(d.doc_id, d.start + cut, d.total, d.ids[4 * cut :])
    kept = at > stop
    return columns, len(ends) - 1, Block(rest, at[kept] - stop, block.penalties[kept])


def pack(
    documents: DataFrame, tokenizer_file: str, end_id: int = 0, length: int = 1024, pattern: str | None = None, hashed: bool = False,
    memo_bytes: int = MEMO_BYTES,
) -> DataFrame:
    """Pieces ``doc_id, start, length, doc_tokens, sequence_id, offset, ids`` of all documents;
    ``hashed`` gives ``ids_crc32`` (unsigned) in the place of ``ids``.

    Each document's ids are followed by ``end_id``; a null or empty text is that id alone.
    Every id lies in exactly one piece, sequences hold at most ``length`` ids without gaps, and
    a document's pieces follow each other. Repeated rows are packed each; other columns are not
    carried. An empty table gives no pieces. ``pattern``: see ``pieces.library_encoder``;
    ``memo_bytes``: what a worker may remember of pieces.
    """
    with open(tokenizer_file, "rb") as f:
        data = f.read()
    shared = documents.sparkSession.sparkContext.broadcast(data)
    key = ("packing", zlib.crc32(data), memo_bytes)
    end = np.array([end_id], "<u4").tobytes()
    id_type = documents.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32" if hashed else "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = worker_state(key, lambda: PieceIds(library_encoder(shared.value, pattern), memo_bytes))
        sequence, waiting, kind = TaskContext.get().partitionId() << 40, EMPTY, None

        def rows(last: bool) -> pa.RecordBatch:
            nonlocal sequence, waiting
            held = waiting.documents
            (doc, start, size, seq, offset, parts), n, waiting = pack_block(waiting, length, sequence, last)
            sequence += n
            columns = [
                pa.array([held[d].doc_id for d in doc.tolist()], kind),
                *(pa.array(x, pa.int64()) for x in (start, size, np.array([held[d].total for d in doc.tolist()], np.int64), seq, offset)),
                pa.array(map(zlib.crc32, parts), pa.int64()) if hashed else pa.array(parts, pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            kind = batch.column(0).type
            for i, j, texts in text_slices(batch.column(1), BLOCK_BYTES):
                waiting = waiting.then(read_block(batch.column(0)[i:j].to_pylist(), texts, ids, end))
                yield rows(last=False)
        if waiting.documents:
            yield rows(last=True)

    last = "ids_crc32 long" if hashed else "ids binary"
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, {SCHEMA}, {last}")


def op8_packing(spark: SparkSession, documents: DataFrame, tokenizer_file: str, pattern: str, memo_bytes: int = MEMO_BYTES) -> DataFrame:
    """Pack all documents into sequences of at most 1024 ids."""
    pieces = pack(documents, tokenizer_file, pattern=pattern, hashed=True, memo_bytes=memo_bytes)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
