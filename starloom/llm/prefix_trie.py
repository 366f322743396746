"""The prefix trie of conversations, with subtree totals by time-forward processing.

A trie node is a sequence of turns that some conversation begins with. It is named by its depth
and 128 bits: the exclusive or of hashes of (place, role, text) over its turns. Such hashes of
prefixes join like sums, so the prefixes of one conversation can be hashed in pieces by several
tasks: conversations are range-partitioned by id and turn, every piece of a conversation is
hashed by itself, and each gets the hash of the pieces before it.

Subtree totals (leaves, saved tokens) flow from the deepest nodes up:

* Shards: a node with more than ``HEAVY`` members stands alone; below such nodes a subtree is cut
  every ``BAND`` levels. So the paths through a shard and their length are bounded, whatever is hot.
* Across shard roots: shards without further shards below pass their sums to their parent shard by
  aggregation. The others, few by construction, are processed in reverse level order.
* Within shards: nodes come externally sorted in reverse level order. A node takes the totals
  addressed to it from a priority queue, adds its own and sends the sum to its parent. The queue
  keeps ``QUEUE`` messages in memory and spills sorted runs beyond.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
FAMILY = 20
HEADS = 4
#: A node with more members stands alone, and other subtrees are cut every so many levels. Both
#: grow with the table where it has more than SKELETON times as many conversations or turns, so
#: that what one task processes across shard roots stays within a few times SKELETON nodes.
HEAVY = 500
BAND = 500
SKELETON = 100_000
#: Messages of a priority queue held in memory, and read from a spilled run at once.
QUEUE = 200_000
RUN_ROWS = 4_096
#: Bytes of conversation ids hashed as one chunk.
CHUNK = 1_000_000
KEY = ["depth", "k1", "k2"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _stored(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, f"trie-{name}")
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


# ---- conversations as paths -------------------------------------------------------------------


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, t1, t2, words, part, pos``: turns in the order of conversation and turn, each
    with its partition and its place there. Turns that tie are ordered by the hashes of their role
    and text, and rows that still tie are equal."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.xxhash64(F.lit(1), role, text).alias("t1"),
        F.xxhash64(text, F.lit(2), role).alias("t2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("t1"), F.col("t2")]
    # equal rows spread over several ranges
    ranged = rows.withColumn("tie", F.rand(17)).repartitionByRange(*order, F.col("tie")).sortWithinPartitions(*order)
    part = F.spark_partition_id()
    pos = F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)
    return _stored(ranged.select("conv_id", "t1", "t2", "words", part.alias("part"), pos.alias("pos")), "turns")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(paths, convs)``: every rebuilt conversation's prefixes ``conv_id, depth, k1, k2, p1, p2,
    words, last`` (p: the prefix without its last turn), and ``conv_id, length``."""
    turns = ordered_turns(conversations)
    pieces = turns.groupBy("conv_id", "part").agg(F.min("pos").alias("first"), F.count("*").alias("n"))
    by_part = Window.partitionBy("conv_id").orderBy("part")  # a row per partition at most
    pieces = _stored(pieces.withColumn("before", F.sum("n").over(by_part) - F.col("n")), "pieces")
    convs = pieces.groupBy("conv_id").agg(F.sum("n").alias("n"))
    base = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    kept = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    convs = convs.select("*", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), kept.alias("h")).join(base, "base", "left")
    convs = convs.withColumn("m", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = convs.withColumn("length", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = _stored(convs.select("conv_id", "base", "h", "m", "length"), "convs")

    # a conversation's own turns after its first h; a long one is joined piece by piece
    placed = pieces.join(convs, "conv_id").drop("n")
    own = turns.join(placed, ["part", "conv_id"]).withColumn("at", F.col("pos") - F.col("first") + F.col("before") + 1)
    own = own.where(F.col("at") > F.col("h")).withColumn("depth", F.col("at") - F.col("h") + F.col("m"))
    own = _stored(_tagged(own, "conv_id", "part"), "own")
    # the first turns of the family's first conversation
    first = turns.where(F.col("conv_id") % FAMILY == 0).join(pieces, ["part", "conv_id"])
    first = first.withColumn("depth", F.col("pos") - F.col("first") + F.col("before") + 1).where(F.col("depth") < HEADS)
    first = first.select(F.col("conv_id").alias("base"), "depth", "t1", "t2", "words")
    heads = first.join(convs, "base").where(F.col("depth") <= F.col("h"))
    heads = _stored(_tagged(heads, "conv_id"), "heads")

    def xor(frame: DataFrame, *by: str) -> DataFrame:
        return frame.groupBy(*by).agg(F.bit_xor("g1").alias("x1"), F.bit_xor("g2").alias("x2"))

    head = xor(heads, "conv_id").select("conv_id", F.col("x1").alias("head1"), F.col("x2").alias("head2"))
    earlier = by_part.rowsBetween(Window.unboundedPreceding, -1)
    carry = xor(own, "conv_id", "part").join(head, "conv_id", "left")
    carry = carry.select(
        "conv_id",
        "part",
        *[F.coalesce(F.bit_xor(f"x{i}").over(earlier), F.lit(0)).bitwiseXOR(F.coalesce(f"head{i}", F.lit(0))).alias(f"c{i}") for i in (1, 2)],
    )
    own = own.join(carry, ["conv_id", "part"])
    heads = heads.select("*", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("c1"), F.lit(0).cast("long").alias("c2"))
    running = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    paths = own.unionByName(heads)
    paths = paths.select("*", *[F.bit_xor(f"g{i}").over(running).bitwiseXOR(F.col(f"c{i}")).alias(f"k{i}") for i in (1, 2)])
    before = [F.col(f"k{i}").bitwiseXOR(F.col(f"g{i}")).alias(f"p{i}") for i in (1, 2)]
    return _stored(paths.select("conv_id", *KEY, *before, "words", "last"), "paths"), convs


def _tagged(rows: DataFrame, *names: str) -> DataFrame:
    """Turns with the hash of their place and content."""
    g1, g2 = F.xxhash64(F.lit(11), "depth", "t1", "t2"), F.xxhash64("t2", F.lit(12), "t1", "depth")
    last = F.col("depth") == F.col("length")
    return rows.select(*names, F.col("depth").cast("long").alias("depth"), g1.alias("g1"), g2.alias("g2"), "words", last.alias("last"))


# ---- the conversations that end at a node -----------------------------------------------------


def end_digests(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """``depth, k1, k2, ends_sha256`` of the nodes where conversations end.

    Ids are range-partitioned by node and number and written as chunks of text; only the chunks of
    a node meet, in order, and are hashed as they come.
    """
    zero = F.lit(0).cast("long")
    ends = paths.where("last").select(*KEY, "conv_id")
    ends = ends.unionByName(convs.where("length = 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id"))
    order = [*KEY, "conv_id"]

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, ids, size = None, 0, [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(KEY, key, strict=True), first=first, ids=",".join(ids))], CHUNKS)

        for batch in batches:
            for *new, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ids and (new != key or size > CHUNK):
                    yield row()
                    ids, size = [], 0
                if not ids:
                    key, first = new, conv_id
                ids.append(str(conv_id))
                size += len(ids[-1]) + 1
        if ids:
            yield row()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None

        def row() -> dict:
            return dict(zip(KEY, key, strict=True), ends_sha256=sha.hexdigest())

        for batch in batches:
            done = []
            for *new, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids")), strict=True):
                if new == key:
                    sha.update(b"," + ids.encode())
                    continue
                if key is not None:
                    done.append(row())
                key, sha = new, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_pylist(done, DIGESTS)
        if key is not None:
            yield pa.RecordBatch.from_pylist([row()], DIGESTS)

    names = "depth long, k1 long, k2 long"
    ranged = ends.repartitionByRange(*order).sortWithinPartitions(*order)
    joined = _stored(ranged.mapInArrow(chunks, f"{names}, first long, ids string"), "end-chunks")
    return joined.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digests, f"{names}, ends_sha256 string")


LONGS = [pa.field(k, pa.int64()) for k in KEY]
CHUNKS = pa.schema([*LONGS, pa.field("first", pa.int64()), pa.field("ids", pa.string())])
DIGESTS = pa.schema([*LONGS, pa.field("ends_sha256", pa.string())])


# ---- time-forward processing ------------------------------------------------------------------


class SpillingQueue:
    """A priority queue of messages (place in the order, totals), the smallest place first.

    Beyond ``limit`` messages the larger half is written as a sorted run to an unnamed temporary
    file: like a sort's spill it belongs to this task alone, and a task that is run again starts
    its own. Messages to one place are added up before they are written.
    """

    def __init__(self, limit: int | None = None):
        self.limit = limit or QUEUE
        self.heap: list[tuple] = []
        self.runs: list[tuple[tuple, int, Iterator[tuple]]] = []
        self.spilled = 0

    def push(self, place: tuple[int, int, int], totals: tuple[int, int]) -> None:
        heapq.heappush(self.heap, (*place, *totals))
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        self.heap.sort()
        half = len(self.heap) // 2
        rows = np.array(self.heap[half:], np.int64)
        new = np.ones(len(rows), bool)
        new[1:] = np.any(rows[1:, :3] != rows[:-1, :3], axis=1)
        at = np.flatnonzero(new)
        rows = np.concatenate([rows[at, :3], np.add.reduceat(rows[:, 3:], at)], axis=1)
        del self.heap[half:]
        where = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        file = tempfile.TemporaryFile(dir=where if os.path.isdir(where) else None)
        rows.tofile(file)
        file.seek(0)
        self._next(self.spilled, self._read(file))
        self.spilled += 1

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while data := file.read(RUN_ROWS * 40):
                yield from map(tuple, np.frombuffer(data, np.int64).reshape(-1, 5).tolist())

    def _next(self, number: int, run: Iterator[tuple]) -> None:
        for row in run:
            heapq.heappush(self.runs, (row, number, run))
            return

    def take(self, place: tuple[int, int, int]) -> tuple[int, int]:
        """The sum of all messages to ``place``, which are the smallest ones if there are any."""
        one = two = 0
        while self.heap and self.heap[0][:3] == place:
            *_, a, b = heapq.heappop(self.heap)
            one, two = one + a, two + b
        while self.runs and self.runs[0][0][:3] == place:
            (*_, a, b), number, run = heapq.heappop(self.runs)
            one, two = one + a, two + b
            self._next(number, run)
        return one, two

    def __len__(self) -> int:
        return len(self.heap) + len(self.runs)


def time_forward(rows: DataFrame) -> DataFrame:
    """``rows`` with ``leaves`` and ``saved`` summed over what lies below them in their group.

    ``rows`` have ``group`` columns ``g0, g1, g2``, a key ``depth, k1, k2``, their parent's key
    ``q0, q1, q2`` (null: sends nothing) and their own ``leaves`` and ``saved``, and come
    partitioned by group and sorted by group, ``depth`` descending, ``k1, k2``.
    """
    names = rows.columns
    place = {c: names.index(c) for c in ("g0", "g1", "g2", *KEY, "q0", "q1", "q2", "leaves", "saved")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, queue = None, SpillingQueue()
        for batch in batches:
            leaves, saved = [], []
            for g0, g1, g2, d, k1, k2, q0, q1, q2, own, kept in zip(*(batch.column(i).to_pylist() for i in place.values()), strict=True):
                if (g0, g1, g2) != group:
                    if len(queue):
                        raise RuntimeError("messages to nodes that did not come")
                    group, queue = (g0, g1, g2), SpillingQueue()
                one, two = queue.take((-d, k1, k2))
                one, two = one + own, two + kept
                if q0 is not None:
                    queue.push((-q0, q1, q2), (one, two))
                leaves.append(one)
                saved.append(two)
            columns = list(batch.columns)
            columns[place["leaves"]], columns[place["saved"]] = pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, rows.schema)


def _on(left: str, right: str) -> list[Column]:
    """Equality of two keys of three columns, by their names' first letters."""
    names = {"node": KEY, "q": ["q0", "q1", "q2"], "g": ["g0", "g1", "g2"], "m": ["m0", "m1", "m2"]}
    pairs = zip(names[left], names[right], strict=True)
    return [F.col(a) == F.col(b) for a, b in pairs]


def _and(parts: list[Column]) -> Column:
    return parts[0] & parts[1] & parts[2]


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    Rows with a null ``conv_id`` take no part; a null role or text is empty; a null turn comes
    first. Turns of one number are ordered by a hash of role and text, repeated rows are turns of
    their own. ``c % 20`` has the sign of c. Conversations without turns after rebuilding are
    members of the root. Other columns are not carried; an empty table gives no rows.
    """
    paths, convs = rebuilt(conversations)
    total = convs.agg(F.count("*").alias("convs"), F.coalesce(F.sum("length"), F.lit(0)).alias("turns")).collect()[0]
    most, levels = max(HEAVY, total.convs // SKELETON), max(BAND, total.turns // SKELETON)
    zero = F.lit(0).cast("long")
    nodes = paths.groupBy(*KEY).agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("words").alias("words")
    )
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    root = root.select(*[zero.alias(c) for c in (*KEY, "p1", "p2", "words")], "n_convs", "conv_id")
    nodes = _stored(nodes.unionByName(root), "nodes")

    # parents and children: the parent of a node at depth d has depth d - 1 and its key without the last turn
    upper = nodes.select(F.col("depth").alias("q0"), F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id"), F.col("n_convs").alias("parent_n"))
    own = nodes.select("*", (F.col("depth") - 1).alias("r0"))
    children = own.where("depth > 0").groupBy(F.col("r0").alias("m0"), F.col("p1").alias("m1"), F.col("p2").alias("m2")).agg(F.count("*").alias("n_children"))
    own = own.join(upper, (F.col("r0") == F.col("q0")) & (F.col("p1") == F.col("q1")) & (F.col("p2") == F.col("q2")), "left")
    own = own.join(children, _and(_on("node", "m")), "left")
    heavy, light_parent = (F.col("depth") == 0) | (F.col("n_convs") > most), (F.col("q0") > 0) & (F.col("parent_n") <= most)
    own = own.select(
        *KEY, "q0", "q1", "q2", "conv_id", "parent_conv_id", "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        heavy.alias("heavy"),
        (heavy | ~light_parent | (F.col("depth") % levels == 0)).alias("top"),
    )
    own = _stored(own, "own-nodes")

    # every light node's shard: the one top of its band on the path of its smallest member
    tops = own.where("top and not heavy").select(F.col("depth").alias("g0"), F.col("k1").alias("g1"), F.col("k2").alias("g2"))
    band = F.floor(F.col("depth") / levels)
    shard_of = paths.join(tops, _and(_on("node", "g"))).select(F.col("conv_id").alias("member"), band.alias("of_band"), "g0", "g1", "g2")
    light = own.where("not heavy").join(shard_of, (F.col("conv_id") == F.col("member")) & (band == F.col("of_band"))).drop("member", "of_band")
    alone = own.where("heavy").select("*", F.col("depth").alias("g0"), F.col("k1").alias("g1"), F.col("k2").alias("g2"))
    own = _stored(light.unionByName(alone), "shard-nodes")

    # shards: their sums, and the node and shard above them
    sums = own.groupBy("g0", "g1", "g2").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    top = own.where("top").select("g0", "g1", "g2", "q0", "q1", "q2")
    above = own.select(*[F.col(c).alias(f"m{i}") for i, c in enumerate(KEY)], *[F.col(f"g{i}").alias(f"u{i}") for i in range(3)])
    shards = top.join(above, _and(_on("q", "m")), "left").drop("m0", "m1", "m2").join(sums, ["g0", "g1", "g2"])
    shards = _stored(shards, "shards")
    # shards with others below them; what the rest sums up to is added to the shard above
    inner = shards.where("u0 is not null").select(*[F.col(f"u{i}").alias(f"g{i}") for i in range(3)]).distinct()
    lowest = shards.join(inner, ["g0", "g1", "g2"], "left_anti")
    given = lowest.where("u0 is not null").groupBy(*[F.col(f"u{i}").alias(f"g{i}") for i in range(3)])
    given = given.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    skeleton = shards.join(inner, ["g0", "g1", "g2"]).join(given, ["g0", "g1", "g2"], "left")
    skeleton = skeleton.select(
        *[zero.alias(f"g{i}") for i in range(3)],
        *[F.col(f"g{i}").alias(k) for i, k in enumerate(KEY)],
        *[F.col(f"u{i}").alias(f"q{i}") for i in range(3)],
        *[F.col(f"q{i}").alias(f"n{i}") for i in range(3)],
        *[(F.col(c) + F.coalesce(f"more_{c}", zero)).alias(c) for c in ("leaves", "saved")],
    )
    # one task: only heavy nodes and shards cut by a band, at most a row per so many turns
    skeleton = time_forward(skeleton.repartition(1).sortWithinPartitions(F.desc("depth"), "k1", "k2"))
    totals = skeleton.select("n0", "n1", "n2", "leaves", "saved")
    totals = totals.unionByName(lowest.select(*[F.col(f"q{i}").alias(f"n{i}") for i in range(3)], "leaves", "saved"))
    # a shard's total is sent to the node above its top
    sent = totals.where("n0 is not null").groupBy("n0", "n1", "n2").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    sent = _stored(sent, "sent")

    ends = _stored(end_digests(paths, convs), "ends").withColumnsRenamed({k: f"m{i}" for i, k in enumerate(KEY)})
    own = own.join(sent, (F.col("depth") == F.col("n0")) & (F.col("k1") == F.col("n1")) & (F.col("k2") == F.col("n2")), "left")
    own = own.join(ends, _and(_on("node", "m")), "left")
    inside = ~F.col("top")
    own = own.select(
        "g0", "g1", "g2", *KEY, *[F.when(inside, F.col(f"q{i}")).alias(f"q{i}") for i in range(3)],
        *[(F.col(c) + F.coalesce(f"more_{c}", zero)).alias(c) for c in ("leaves", "saved")],
        "conv_id", "parent_conv_id", "n_convs", "n_children", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    group = ["g0", "g1", "g2"]
    own = own.repartition(*group).sortWithinPartitions(*group, F.desc("depth"), "k1", "k2")
    return time_forward(own).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256"
    )


def op12_prefix_trie(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The contract's columns."""
    return trie(conversations)
