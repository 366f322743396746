"""Aligning the tokens of two tokenizers over the same bytes.

Tokenizer A (byte-level BPE) encodes a blank and the text, tokenizer B (sentencepiece with byte
fallback) the text, to which it adds the blank itself; so the tokens of both tile the same bytes.
Per batch, ``pandas.merge_asof`` keyed by document finds for every token start the covering
token of the other side, once from A to B and once from B to A. The union of both directions
are the overlaps, and overlaps whose tokens end together close a group.

All pairs of an A and a B token of one group are links. How many documents hold an id pair
linked is counted in two steps:

1. The texts are read in blocks of about ``BLOCK_BYTES``. A block lists its distinct id pairs
   once, with the number of its documents that hold each, and keeps for every document the places
   of its pairs in that list. Blocks are written to the shared folder.
2. The lists are summed over all blocks by id pair; a pair has at most one row per block, so a
   pair that every document holds is no hot key. Each block gets the counts of its own list back
   and sums them over its documents' links.

No block grows with the corpus, and nothing is broadcast but the two tokenizer files.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import text_slices, worker_state
from starloom.llm.pieces import PieceIds, library_encoder, ranks_of
from starloom.session import scratch_path

#: Bytes of text whose tokens are matched at once, and of a block.
MATCH_BYTES = 1_500_000
BLOCK_BYTES = 12_000_000
#: Links expanded at once.
LINKS = 4_000_000
#: Bytes that a worker's memo of pieces may hold, for each tokenizer.
MEMO_BYTES = 100_000_000
#: Groups of more links than this are first reduced to distinct ids with their numbers.
DENSE = 64
BLANK = "▁"


class PieceTokens:
    """Ids of texts by a sentencepiece model, piece by piece (``pieces.cut``) through a memo.

    No token of the model may cross a piece's start: none holds a line feed, and none the mark
    of a blank after another character. A model that has such tokens is used on whole texts.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(size)]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(names)
        ]
        plain = [p for i, p in enumerate(names) if not self.model.is_byte(i) and not self.model.is_control(i)]
        self.cuts = not any("\n" in p or BLANK in p.lstrip(BLANK) for p in plain)
        self.lengths = np.array([len(t) for t in self.bytes], np.int64)
        self.blank = np.array([self.model.piece_to_id(BLANK)], "<u4").tobytes()
        #: ids by piece, and whether the piece is a text's first, which always has the blank
        self.memo: dict[tuple[str, bool] | str, bytes] = {"": self.blank}
        #: pieces whose tokens do not give their bytes back
        self.lossy: set = set()

    def _encode(self, texts: list[str]) -> tuple[list[bytes], np.ndarray]:
        """The ids of each text, and the bytes that its tokens stand for in all."""
        found = self.model.encode(texts, num_threads=1)
        flat = np.fromiter(chain.from_iterable(found), "<u4")
        edges = np.cumsum([0, *map(len, found)])
        packed, ends = flat.tobytes(), (4 * edges).tolist()
        sizes = np.diff(np.concatenate([[0], np.cumsum(self.lengths[flat])])[edges])
        return [packed[i:j] for i, j in zip(ends, ends[1:], strict=False)], sizes

    def joined(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def _learn(self, pieces: list) -> None:
        for i in range(0, len(pieces), 20_000):
            part = pieces[i : i + 20_000]
            plain = [p if isinstance(p, str) else p[0] for p in part]
            found, sizes = self._encode(plain)
            expected = [b" " + p.encode() for p in plain]
            lengths = np.fromiter(map(len, expected), np.int64, len(part))
            same = (sizes == lengths).all() and self.joined(b"".join(found)) == b"".join(expected)
            if not same:
                self.lossy.update(k for k, ids, e in zip(part, found, expected, strict=True) if self.joined(ids) != e)
            for key, ids in zip(part, found, strict=True):
                if isinstance(key, str) and key[0] == "\n" and ids[:4] == self.blank:  # no blank stands before it
                    ids = ids[4:]
                self.memo[key] = ids

    def forget(self, kept: dict) -> None:
        """Go on with the pieces in ``kept`` alone, beside those that begin texts."""
        self.memo = {k: v for k, v in self.memo.items() if k in kept}
        self.memo[""] = self.blank
        self.lossy.intersection_update(self.memo)

    def ids(self, spaced: list[str], cuts: list[list[str]], learned: set[str]) -> list[bytes | None]:
        """Ids of texts, each given with a blank before it and as the pieces of that; None where
        the tokens do not give these bytes back. ``learned``: the pieces that may be new."""
        if not self.cuts:
            found, _ = self._encode([s[1:] for s in spaced])
            return [i if self.joined(i) == s.encode() else None for s, i in zip(spaced, found, strict=True)]
        # the first piece is empty where the text begins with a word, else it starts with the blank
        cuts = [(c[1:] if c[0] == "" else [(c[0][1:], True), *islice(c, 1, None)]) for c in cuts]
        missing = learned.difference(self.memo)
        missing.update(c[0] for c in cuts if c[0] not in self.memo)
        self._learn(list(missing))
        get = self.memo.__getitem__
        out: list[bytes | None] = []
        for s, c in zip(spaced, cuts, strict=True):
            ids = b"".join(map(get, c))
            lossy = not self.lossy.isdisjoint(c) and self.joined(ids) != s.encode()
            out.append(None if lossy else ids)
        return out


def asof(left: pd.DataFrame, right: pd.DataFrame, place: str) -> np.ndarray:
    """For every row of ``left`` the ``place`` of the row of ``right`` that covers its start, in
    the same document."""
    return pd.merge_asof(left[["at", "doc"]], right, on="at", by="doc")[place].to_numpy().astype(np.int64)


def groups(doc_a, start_a, end_a, doc_b, start_b, end_b) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A token and of every B token, counted from 0 over the whole batch.

    Tokens lie in the order of documents and places, and both sides tile the same bytes.
    """
    a = pd.DataFrame({"at": start_a, "doc": doc_a, "i": np.arange(len(doc_a))})
    b = pd.DataFrame({"at": start_b, "doc": doc_b, "j": np.arange(len(doc_b))})
    n = max(len(b), 1)
    # each start finds the other side's covering token; together these are all overlaps
    both = np.concatenate([a["i"].to_numpy() * n + asof(a, b, "j"), asof(b, a, "i") * n + b["j"].to_numpy()])
    both.sort(kind="stable")  # two ascending runs
    overlaps = both[np.diff(both, prepend=-1) > 0]
    i, j = np.divmod(overlaps, n)
    closes = end_a[i] == end_b[j]
    group = np.cumsum(closes) - closes
    # both sides ascend, so a token's first overlap is where its number changes
    return group[np.diff(i, prepend=-1) > 0], group[np.diff(j, prepend=-1) > 0]


def _side(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``group, id, times``: the distinct ids of each group with their number."""
    key, times = np.unique(group << 32 | ids, return_counts=True)
    return key >> 32, key & 0xFFFFFFFF, times


def _summed(doc: np.ndarray, pair: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``document, pair``, ascending, with the sum of their times (None: 1 each)."""
    if times is None and len(pair) and pair.max() < 1 << 48 and (pair & 0xFFFFFFFF).max() < 1 << 16 and doc[-1] < 1 << 31:
        # the usual vocabularies: document and pair in one number
        key, times = np.unique(doc << 32 | pair >> 16 | pair & 0xFFFF, return_counts=True)
        return key >> 32, (key & 0xFFFF0000) << 16 | key & 0xFFFF, times
    if times is None:
        times = np.ones(len(pair), np.int64)
    order = np.lexsort((pair, doc))
    doc, pair = doc[order], pair[order]
    new = np.ones(len(order), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])
    at = np.flatnonzero(new)
    return doc[at], pair[at], np.add.reduceat(times[order], at) if len(at) else times[:0]


def _expanded(side_a, side_b, doc_of_group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Links of the groups of two sides ``group, id, times`` (times None: 1), about LINKS at once."""
    (ga, a, times_a), (gb, b, times_b) = side_a, side_b
    count = np.bincount(gb, minlength=len(doc_of_group))
    first = (np.cumsum(count) - count)[ga]
    count = count[ga]
    done = np.cumsum(count)
    i = 0
    while i < len(ga):
        j = max(i + 1, int(np.searchsorted(done, (done[i - 1] if i else 0) + LINKS, side="right")))
        n = count[i:j]
        row = np.repeat(np.arange(i, j), n)
        other = np.repeat(first[i:j] - (np.cumsum(n) - n), n) + np.arange(len(row))
        times = None if times_a is None else times_a[row] * times_b[other]
        yield _summed(doc_of_group[ga[row]], a[row] << 32 | b[other], times)
        i = j


def links(group_a, ids_a, group_b, ids_b, doc_of_group) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``document, pair, times``: the links of every document by id pair (A id in the
    upper, B id in the lower 32 bits).

    A group of many links is reduced to distinct ids first, so repeated tokens do not multiply;
    links are expanded ``LINKS`` at a time.
    """
    n_groups = len(doc_of_group)
    dense = np.bincount(group_a, minlength=n_groups) * np.bincount(group_b, minlength=n_groups) > DENSE
    if dense.any():
        in_a, in_b = dense[group_a], dense[group_b]
        parts = list(_expanded((group_a[~in_a], ids_a[~in_a], None), (group_b[~in_b], ids_b[~in_b], None), doc_of_group))
        parts += _expanded(_side(group_a[in_a], ids_a[in_a]), _side(group_b[in_b], ids_b[in_b]), doc_of_group)
    else:
        parts = list(_expanded((group_a, ids_a, None), (group_b, ids_b, None), doc_of_group))
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    return _summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def id_table(sizes: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of both sides as text with each mark that can follow them ("," or "|" after an A id,
    "," or ";" after a B id): a row of bytes for each, and which of them count."""
    words = [b"%d%s" % (i, mark) for n, marks in zip(sizes, (b",|", b",;"), strict=True) for i in range(n) for mark in (marks[:1], marks[1:])]
    width = max(map(len, words))
    table = np.frombuffer(b"".join(w.ljust(width) for w in words), np.uint8).reshape(-1, width)
    return table, table != ord(" ")


class Aligner:
    """Both tokenizers with their tokens' lengths and the strings of their ids."""

    def __init__(self, definition: bytes, model: bytes, pattern: str):
        ranks = ranks_of(definition)
        if ranks is None:
            raise ValueError("the first tokenizer is not byte-level BPE by ranks")
        self.a = PieceIds(library_encoder(definition, pattern), budget=MEMO_BYTES)
        self.b = PieceTokens(model)
        self.held = 0
        self.len_a = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.len_a[i] = len(token)
        self.len_b = self.b.lengths
        self.shift = 2 * len(self.len_a)
        self.table, self.counts = id_table((len(self.len_a), len(self.len_b)))

    def batch(self, texts: list[str]):
        """Per text ``n_a, n_b, n_groups, n_links, digest``, and ``links`` of all texts."""
        n = len(texts)
        spaced = [" " + t if t else "" for t in texts]
        asked = [k for k, s in enumerate(spaced) if s]
        cuts, ids = self.a.parts([spaced[k] for k in asked])
        if self.a.held < self.held:  # it went back to the frequent pieces
            self.b.forget(self.a.after)
        self.held = self.a.held
        found_b = self.b.ids([spaced[k] for k in asked], cuts, self.a.learned)
        parts_a, parts_b = [b""] * n, [b""] * n
        for k, a, b in zip(asked, ids, found_b, strict=True):
            if b is not None:
                parts_a[k], parts_b[k] = b"".join(a), b
        n_a, n_b = (np.array([len(x) // 4 for x in parts], np.int64) for parts in (parts_a, parts_b))
        ids_a, ids_b = (np.frombuffer(b"".join(parts), "<u4").astype(np.int64) for parts in (parts_a, parts_b))
        doc_a, doc_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
        length_a, length_b = self.len_a[ids_a], self.len_b[ids_b]
        # the places of all documents one after the other: both sides have the same bytes
        end_a, end_b = np.cumsum(length_a), np.cumsum(length_b)
        group_a, group_b = groups(doc_a, end_a - length_a, end_a, doc_b, end_b - length_b, end_b)
        n_groups = int(group_a[-1]) + 1 if len(group_a) else 0
        size_a, size_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
        doc_of_group = doc_a[np.cumsum(size_a) - size_a] if n_groups else np.empty(0, np.int64)
        last = np.searchsorted(doc_of_group, np.arange(n + 1))
        linked = np.concatenate([[0], np.cumsum(size_a * size_b)])[last]
        # the groups as text: A ids of a group, then its B ids
        order = np.empty(len(ids_a) + len(ids_b), np.int64)
        before_b, through_a = np.cumsum(size_b) - size_b, np.cumsum(size_a)
        ends_a, ends_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        ends_a[np.cumsum(size_a) - 1], ends_b[np.cumsum(size_b) - 1] = 1, 1
        order[np.arange(len(ids_a)) + before_b[group_a]] = 2 * ids_a + ends_a
        order[np.arange(len(ids_b)) + through_a[group_b]] = self.shift + 2 * ids_b + ends_b
        counts = self.counts[order]
        written = self.table[order][counts].tobytes()
        sizes = np.concatenate([[0], np.cumsum(counts.sum(axis=1))])
        edges = sizes[np.concatenate([[0], np.cumsum(n_a + n_b)])].tolist()
        digests = [hashlib.sha256(written[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(edges, edges[1:], strict=False)]
        return (n_a, n_b, np.diff(last), np.diff(linked), digests), links(group_a, ids_a, group_b, ids_b, doc_of_group)


class Block:
    """What a block has gathered: its documents' columns and their links by id pair."""

    def __init__(self):
        self.ids: list = []
        self.columns: list[list] = [[], [], [], [], []]
        self.docs, self.pairs, self.times = [], [], []
        self.size = 0

    def add(self, ids: list, columns, found, size: int) -> None:
        doc, pair, times = found
        self.docs.append(doc + len(self.ids))
        self.pairs.append(pair)
        self.times.append(times)
        self.ids += ids
        for mine, new in zip(self.columns, columns, strict=True):
            mine += new if isinstance(new, list) else new.tolist()
        self.size += size

    def record(self, number: int, kind: pa.DataType) -> pa.RecordBatch:
        docs, times = np.concatenate(self.docs), np.concatenate(self.times)
        pairs, at, held = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        count = np.bincount(docs, minlength=len(self.ids))
        packed = zstandard.ZstdCompressor(level=1).compress(
            count.astype("<u4").tobytes() + at.astype("<u4").tobytes() + times.astype("<u8").tobytes()
        )
        lists = [
            (self.ids, kind), *((c, pa.int64()) for c in self.columns[:4]), (self.columns[4], pa.string()),
            (pairs >> 32, pa.int64()), (pairs & 0xFFFFFFFF, pa.int64()), (held, pa.int64()),
        ]
        arrays = [pa.array([v], pa.list_(t)) if isinstance(v, list) else _one_list(v) for v, t in lists]
        names = ["block", "doc_id", *COLUMNS, "pair_a", "pair_b", "pair_docs", "links"]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *arrays, pa.array([packed], pa.binary())], names)


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
LISTS = "n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>"
PAIRS = "pair_a array<long>, pair_b array<long>, pair_docs array<long>, links binary"


def _one_list(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values.astype(np.int64)))


def blocks(documents: DataFrame, definition_file: str, model_file: str, pattern: str) -> DataFrame:
    """One row per block: its documents' columns as lists, its distinct id pairs with the number
    of its documents that hold them, and the packed links."""
    contents = []
    for path in (definition_file, model_file):
        with open(path, "rb") as f:
            contents.append(f.read())
    shared = documents.sparkSession.sparkContext.broadcast(tuple(contents))
    key = ("token_alignment", zlib.crc32(contents[0]), zlib.crc32(contents[1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_state(key, lambda: Aligner(*shared.value, pattern))
        number, block, kind = TaskContext.get().partitionId() << 32, Block(), None
        for batch in batches:
            kind = batch.column(0).type
            for i, j, texts in text_slices(batch.column(1), MATCH_BYTES):
                columns, found = aligner.batch(texts)
                block.add(batch.column(0)[i:j].to_pylist(), columns, found, sum(map(len, texts)))
                if block.size >= BLOCK_BYTES:
                    yield block.record(number, kind)
                    number, block = number + 1, Block()
        if block.ids:
            yield block.record(number, kind)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"block long, doc_id array<{kind}>, {LISTS}, {PAIRS}")


def pair_counts(staged: DataFrame) -> DataFrame:
    """``of_block, pos, n, best`` of every place in every block's list of id pairs: the number of
    documents corpus-wide that hold the pair linked, and whether no pair of its A id has more."""
    pairs = staged.select(F.col("block").alias("of_block"), F.posexplode(F.arrays_zip("pair_a", "pair_b", "pair_docs")).alias("pos", "p"))
    pairs = pairs.select("of_block", "pos", F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"), F.col("p.pair_docs").alias("docs"))
    counts = pairs.groupBy("a", "b").agg(F.sum("docs").alias("n"))
    # an A id's pairs are at most the other vocabulary
    highest = F.max("n").over(Window.partitionBy("a"))
    counts = counts.select("a", "b", "n", (F.col("n") == highest).alias("best"))
    return pairs.join(counts, ["a", "b"]).select("of_block", "pos", "n", "best")


def align(documents: DataFrame, definition_file: str, model_file: str, pattern: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum`` of every document.

    ``n_best`` counts the links whose id pair is linked in as many documents as any pair of its
    A id (ties included), ``count_sum`` sums that number over all links. Null and empty texts,
    and texts that the second tokenizer does not give back byte for byte, have no tokens: zeros
    and an empty digest. Repeated rows, also of one id, count as documents each; a null id stays
    null; an empty table gives no rows. Other columns are not carried. Texts are used whole.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "aligned-blocks")
    blocks(documents, definition_file, model_file, pattern).write.parquet(path)
    staged = spark.read.parquet(path)
    kind = documents.schema["doc_id"].dataType
    names = ["doc_id", *COLUMNS, "n_best", "count_sum"]

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        docs = [left.column(c).combine_chunks().flatten() for c in ("doc_id", *COLUMNS)]
        n_docs = len(docs[0])
        pos = right.column("pos").to_numpy()
        count, best = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
        count[pos], best[pos] = right.column("n").to_numpy(), right.column("best").to_numpy()
        raw = zstandard.ZstdDecompressor().decompress(left.column("links")[0].as_py())
        per_doc = np.frombuffer(raw, "<u4", n_docs).astype(np.int64)
        n = int(per_doc.sum())
        at, times = np.frombuffer(raw, "<u4", n, 4 * n_docs), np.frombuffer(raw, "<u8", n, 4 * (n_docs + n)).astype(np.int64)
        edges = np.concatenate([[0], np.cumsum(per_doc)])
        sums = [np.diff(np.concatenate([[0], np.cumsum(times * v[at])])[edges]) for v in (best, count)]
        return pa.Table.from_arrays([*docs, *(pa.array(s, pa.int64()) for s in sums)], names)

    schema = f"doc_id {kind.simpleString()}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    kept = staged.select("block", "doc_id", *COLUMNS, "links")
    return kept.groupBy("block").cogroup(pair_counts(staged).groupBy("of_block")).applyInArrow(finish, schema)


def op13_token_alignment(spark: SparkSession, documents: DataFrame, definition_file: str, model_file: str, pattern: str) -> DataFrame:
    """The contract's columns."""
    return align(documents, definition_file, model_file, pattern).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
