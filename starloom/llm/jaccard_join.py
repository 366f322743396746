"""Exact n-gram Jaccard join with adaptive multi-match prefixes, and its components.

Two documents link when their sets of word shingles have a Jaccard similarity of 0.8 or more.
With t = ceil(0.8 n) for a set of n shingles, linked documents share at least both their t. In
any order of shingles common to all documents, the first ``n - t + l`` shingles of one and of
the other then share at least ``l`` (the l-prefix). So a pair needs verification only if it
shares ``min(l1, l2)`` shingles of the prefixes of that length.

* Order: rare before frequent. Estimated frequencies come from every eighth distinct document
  (by a hash of its text); they steer cost alone, since any order gives the same links. The
  frequent shingles fill a table of a checked size (``FREQUENT``): where they would not fit,
  the frequency that counts as frequent doubles until they do.
* Adaptive l: a document whose prefix is estimated to meet many candidates gets a longer prefix
  and needs correspondingly more shared shingles.
* Copies: equal sets are one node, so copies never pair. A set is named by its smallest doc_id,
  which no other set has while ids are unique, else by a number; components always get their
  smallest doc_id.
* Large groups of near copies: before pairs are listed, star rounds verify every node against
  one pivot per shingle bucket, and buckets that lie in one component are dropped. The pairs
  listed afterwards are those between different components, with none left out. Links inside
  a component would not change the result, which is a component per document. Pairs that exact
  bounds on the overlap rule out are not listed: sizes, rare and frequent shingles apart, a
  512-bit signature of each set, and the places of shared shingles in both orders.
* Verification is exact, on the sets of the whole texts of both documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import worker_state
from starloom.llm.components import components
from starloom.session import scratch_path

WORDS = 5
#: Sampled documents (by a hash of the text): one in SAMPLE; a shingle in FREQUENT_IN of them or more is frequent.
SAMPLE = 8
FREQUENT_IN = 3
#: Most entries of the table of frequent shingles (16 bytes each).
FREQUENT = 2_000_000
#: Ids that may be shared to filter texts before their shuffle; beyond, the join shuffles.
SHARED_IDS = 2_000_000
ROUNDS = 2
LONGEST_L = 30_000
#: What checking a pair costs, in postings met (most pairs fall to the bounds before their texts).
CHECK_COST = 2
SET_SCHEMA = "n_shingles long, set_hi long, set_lo long, l int, rare long, bits array<long>, tokens array<long>"


class WordHashes:
    """Hashes of the words of a text, without making the words.

    A word's bytes b0, b1, ... hash to the sum of T[bi] * P^i in 64 bits, T a table of random
    numbers that is equal for A-Z and a-z, P odd. Sums over all bytes of a text then hold every
    word's, shifted by the power of its place, which the inverse of P takes back.
    """

    P = 0x9E3779B97F4A7C15

    def __init__(self):
        self.table = np.random.default_rng(5).integers(0, 1 << 64, 256, np.uint64)
        self.table[65:91] = self.table[97:123]
        self.blank = np.zeros(256, bool)
        self.blank[[32, *range(9, 14)]] = True
        self.powers = self.inverse = np.ones(1, np.uint64)

    def of(self, data: bytes) -> np.ndarray:
        """One hash per word of UTF-8 ``data``; about BYTES of them are looked at together."""
        parts, begin = [], 0
        while begin < len(data):
            end = begin + BYTES
            if end < len(data):  # up to the next blank
                found = WORD_END.search(data, end)
                end = found.start() if found else len(data)
            parts.append(self._part(np.frombuffer(data, np.uint8, min(end, len(data)) - begin, begin)))
            begin = end
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)

    def _part(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if n > len(self.powers):
            size = max(n, 1 << 16)
            for name, factor in (("powers", self.P), ("inverse", pow(self.P, -1, 1 << 64))):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        blank = self.blank[data]
        edges = np.flatnonzero(np.diff(blank, prepend=True, append=True))
        starts, ends = edges[::2], edges[1::2]  # where words begin, and the blanks after them
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[data] * self.powers[:n], out=sums[1:])
        h = (sums[ends] - sums[starts]) * self.inverse[starts]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))


#: Bytes whose words are hashed together, and where a word ends.
BYTES = 1 << 17
WORD_END = re.compile(rb"[\x20\x09-\x0D]")


def shingles(text: str, hashes: WordHashes) -> np.ndarray:
    """Distinct 64-bit shingle hashes of a text, ascending; none without words. Fewer words
    than five make one shingle."""
    h = hashes.of(text.encode("utf-8", "surrogatepass"))
    if not len(h):
        return h
    width = min(WORDS, len(h))
    n = len(h) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = (out ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(found: np.ndarray) -> np.ndarray:
    """512 bits, one set for the top nine bits of every shingle hash, as eight integers."""
    flags = np.zeros(512, np.uint8)
    flags[(found >> np.uint64(55)).astype(np.int64)] = 1
    return np.packbits(flags).view("<i8")


def digest(found: np.ndarray) -> list[int]:
    """The 128-bit hash of a set as two integers."""
    return np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), "<i8").tolist()


def hasher() -> WordHashes:
    return worker_state("shingle_words", WordHashes)


def needed(n):
    """ceil(0.8 n): the shingles that a linked document must share."""
    return (4 * n + 4) // 5


def prefix(found: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> tuple[int, int, np.ndarray]:
    """``l``, the number of rare shingles, and the l-prefix of an ascending set, rare first.

    A longer prefix meets more postings, S(l) by the estimated frequencies, but at most S(l) / l
    documents can share l of them and need a check: l is the power of two, up to a tenth of the
    set, of least ``S(l) * (1 + CHECK_COST / l)``. Where the 1-prefix holds rare shingles alone,
    hardly anything can meet it, and l stays 1.
    """
    n = len(found)
    t = needed(n)
    at = np.searchsorted(frequent, found)
    known = np.minimum(at, max(len(frequent) - 1, 0))
    often = (frequent[known] == found) if len(frequent) else np.zeros(n, bool)
    weight = np.where(often, counts[known] if len(frequent) else 0, 0)
    if often.any():
        order = np.lexsort((found, weight))
        found, weight = found[order], weight[order]
    l, base = 1, n - t + 1  # noqa: E741
    if weight[base - 1]:
        met = np.cumsum(np.maximum(SAMPLE * weight, 1))
        tries = 2 ** np.arange(max(1, min(t, 1 + n // 10, LONGEST_L).bit_length()))
        l = int(tries[np.argmin(met[base + tries - 2] * (1 + CHECK_COST / tries))])  # noqa: E741
    return l, int((weight == 0).sum()), found[: n - t + l]


def _sets(documents: DataFrame, frequent: tuple[np.ndarray, np.ndarray] | None) -> DataFrame:
    """``doc_id`` and SET_SCHEMA; without a table of frequent shingles, whole sets."""
    shared = documents.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = hasher()
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                found = shingles(text.as_py() or "", hashes)
                hi, lo = digest(found)
                if shared.value is None:
                    if not len(found):
                        continue
                    l, rare, tokens = 0, 0, found  # noqa: E741
                else:
                    l, rare, tokens = prefix(found, *shared.value) if len(found) else (0, 0, found)  # noqa: E741
                rows.append((doc_id.as_py(), len(found), hi, lo, l, rare, signature(found), tokens.view(np.int64)))
                if len(rows) >= 1000:
                    yield record(rows, batch.schema.field(0).type)
                    rows = []
            if rows:
                yield record(rows, batch.schema.field(0).type)

    def record(rows: list, kind: pa.DataType) -> pa.RecordBatch:
        ids, n, hi, lo, l, rare, bits, tokens = zip(*rows, strict=True)  # noqa: E741
        offsets = np.cumsum([0, *map(len, tokens)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(tokens)))
        columns = [pa.array(ids, kind), *(pa.array(x, pa.int64()) for x in (n, hi, lo)), pa.array(l, pa.int32()), pa.array(rare, pa.int64()), pa.array(bits, pa.list_(pa.int64())), lists]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_hi", "set_lo", "l", "rare", "bits", "tokens"])

    id_type = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, {SET_SCHEMA}")


def frequent_shingles(documents: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in FREQUENT_IN or more of the sampled distinct sets, ascending, and in how many."""
    sampled = documents.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    sets = _sets(sampled, None).dropDuplicates(["set_hi", "set_lo"])
    counted = sets.select(F.explode("tokens").alias("tok")).groupBy("tok").agg(F.count("*").alias("n"))
    stored = _stored(counted.where(F.col("n") >= FREQUENT_IN), "frequent-shingles")
    least = FREQUENT_IN
    while stored.where(F.col("n") >= least).count() > FREQUENT:
        least *= 2
    rows = stored.where(F.col("n") >= least).toArrow()  # at most FREQUENT rows
    token = rows.column("tok").to_numpy().view(np.uint64)
    order = np.argsort(token)
    return token[order], rows.column("n").to_numpy()[order]


def _stored(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


@F.arrow_udf(T.ArrayType(T.LongType()))
def set_key(texts: pa.Array) -> pa.Array:
    """``[set_hi, set_lo]`` of the texts."""
    hashes = hasher()
    return pa.array([digest(shingles(text.as_py() or "", hashes)) for text in texts], pa.list_(pa.int64()))


@F.arrow_udf(T.BooleanType())
def similar(left: pa.Array, right: pa.Array) -> pa.Array:
    """Whether 100 * intersection >= 80 * union of the shingle sets of two texts."""
    hashes, recent, out = hasher(), {}, []

    def found(text: str) -> np.ndarray:
        if text not in recent:
            if len(recent) >= 32:
                recent.clear()
            recent[text] = shingles(text, hashes)
        return recent[text]

    for a, b in zip(left, right, strict=True):
        x, y = found(a.as_py() or ""), found(b.as_py() or "")
        both = len(np.intersect1d(x, y, assume_unique=True))
        out.append(both > 0 and 100 * both >= 80 * (len(x) + len(y) - both))
    return pa.array(out, pa.bool_())


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose texts (``node, text``) are similar, written to the shared folder."""
    pairs = _stored(pairs.select("a", "b").distinct(), "candidate-pairs")
    ids = _stored(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "candidate-ids")
    if ids.count() <= SHARED_IDS:
        ids = F.broadcast(ids)
    texts = texts.join(ids, "node", "left_semi")
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b")
    return _stored(both.where(similar("text_a", "text_b")).select("a", "b").distinct(), "links")


def _of_nodes(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row of ``sets`` for every node."""
    return sets.join(nodes, sets.doc_id.eqNullSafe(nodes.least_id) & (sets.set_hi == nodes.hi) & (sets.set_lo == nodes.lo))


def _postings(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """``tok, node, n, l, rare, pos`` of the shingles that two or more nodes have in their prefix;
    ``pos`` is the place in the node's order, from 0.

    What is found out about a shingle is written before it is joined to the postings again: Spark
    splits a hot key's side of a join only where both sides are plain exchanges.
    """
    rows = _of_nodes(sets, nodes).select("node", F.col("n_shingles").alias("n"), "l", "rare", F.posexplode("tokens").alias("pos", "tok"))
    shared = rows.groupBy("tok").agg(F.count("*").alias("df")).where(F.col("df") >= 2).select("tok")
    return _stored(rows.join(_stored(shared, "shared-shingles"), "tok"), "postings")


def _open(postings: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Postings with their node's component, of shingles that meet two components or more."""
    if comps is None:
        return postings.withColumn("comp", F.col("node"))
    rows = postings.drop("comp").join(comps, "node", "left")
    rows = rows.withColumn("comp", F.coalesce(F.col("component"), F.col("node"))).drop("component")
    mixed = rows.groupBy("tok").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("tok")
    return _stored(rows.join(_stored(mixed, "open-shingles"), "tok"), "open-postings")


def _stars(postings: DataFrame, turn: int) -> DataFrame:
    """One pair per node at most: with the pivot it shares most shingles with, out of the one
    pivot of every bucket: first the node with the least share of rare shingles (the middle of a
    large group of near copies), in later turns one by hash."""
    share = (F.col("rare") / F.col("n")) if turn == 0 else F.lit(0.0)
    order = F.struct(share.alias("rare"), F.xxhash64("node", F.lit(turn)).alias("h"), "node", "comp", "n")
    pivots = postings.groupBy("tok").agg(F.min(order).alias("p"))
    pivots = _stored(pivots.select("tok", *[F.col(f"p.{c}").alias(f"p_{c}") for c in ("node", "comp", "n")]), "pivots")
    met = postings.join(pivots, "tok").where((F.col("comp") != F.col("p_comp")) & _sizes(F.col("n"), F.col("p_n")))
    shared = met.groupBy("node", F.col("p_node").alias("pivot")).agg(F.count("*").alias("c"), F.max("l").alias("l"))
    best = shared.where(2 * F.col("c") >= F.col("l")).groupBy("node").agg(F.max(F.struct("c", "pivot")).alias("best"))
    return best.select(F.col("node").alias("a"), F.col("best.pivot").alias("b"))


def _level(pos, n):
    """The smallest l whose prefix holds the shingle at ``pos``."""
    return F.greatest(F.lit(1), pos - n + F.floor((4 * n + 4) / 5) + 1)


def _possible(c, n, pos, m, at):
    """Whether sets of n and m shingles can be similar, if ``c`` shingles are shared up to the
    places ``pos`` and ``at`` of the last of them (both orders agree, so none before is left)."""
    return 9 * (c + F.least(n - pos, m - at) - 1) >= 4 * (n + m)


def _sizes(n, m):
    """Whether sets of these sizes can be similar enough."""
    return (5 * n >= 4 * m) & (5 * m >= 4 * n)


def _meetings(postings: DataFrame, signatures: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of postings of one shingle, from different components, that the bounds on
    overlap do not rule out.

    In each bucket the nodes outside its largest component meet all nodes, so a bucket that a
    large component dominates is not squared. ``signatures`` has the bits of every node; they
    join the postings here alone, so that no other shuffle carries them.
    """
    sizes = postings.groupBy("tok", "comp").agg(F.count("*").alias("m"))
    major = sizes.groupBy("tok").agg(F.max(F.struct("m", "comp")).alias("x")).select("tok", F.col("x.comp").alias("major"))
    rows = _stored(postings.join(_stored(major, "major-components"), "tok"), "meeting-postings")
    left = rows.where(F.col("comp") != F.col("major")).join(signatures, "node").alias("x")
    right = rows.join(signatures, "node").alias("y")
    apart = (F.col("x.comp") != F.col("y.comp")) & _sizes(F.col("x.n"), F.col("y.n"))
    once = (F.col("y.comp") == F.col("y.major")) | (F.col("x.node") < F.col("y.node"))
    l = F.least("x.l", "y.l")  # noqa: E741
    inside = F.greatest(_level(F.col("x.pos"), F.col("x.n")), _level(F.col("y.pos"), F.col("y.n"))) <= l
    # at most min(pos) + 1 shingles are shared up to here: too few already rules the pair out
    upto = F.least("x.pos", "y.pos") + 1
    chance = _possible(upto, F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos"))
    # a rare shingle is rare in both sets, so rare and frequent ones overlap by themselves
    rare, often = F.least("x.rare", "y.rare"), F.least(F.col("x.n") - F.col("x.rare"), F.col("y.n") - F.col("y.rare"))
    kinds = 9 * (rare + often) >= 4 * (F.col("x.n") + F.col("y.n"))
    # a signature bit that only one set has stands for a shingle that the other lacks
    only = [F.lit(0), F.lit(0)]
    for i in range(8):
        a, b = F.get(F.col("x.bits"), F.lit(i)), F.get(F.col("y.bits"), F.lit(i))
        only = [only[0] + F.bit_count(a.bitwiseAND(F.bitwise_not(b))), only[1] + F.bit_count(b.bitwiseAND(F.bitwise_not(a)))]
    bits = 9 * F.least(F.col("x.n") - only[0], F.col("y.n") - only[1]) >= 4 * (F.col("x.n") + F.col("y.n"))
    met = left.join(right, (F.col("x.tok") == F.col("y.tok")) & apart & once & inside & chance & kinds & bits)
    x, y = (F.struct(*[F.col(f"{side}.{c}") for c in ("node", "n", "pos")]) for side in "xy")
    return met.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), l.alias("l"))  # by node


def _pairs(postings: DataFrame, signatures: DataFrame) -> DataFrame:
    """All pairs of nodes in different components that share enough prefix shingles."""
    met = _meetings(postings, signatures).groupBy("a.node", F.col("b.node").alias("other")).agg(
        F.count("*").alias("c"),
        F.max("l").alias("l"),
        *[F.max(f"{side}.{c}").alias(f"{c}_{side}") for side in "ab" for c in ("n", "pos")],
    )
    met = met.where((F.col("c") >= F.col("l")) & _possible(*map(F.col, ("c", "n_a", "pos_a", "n_b", "pos_b"))))
    return met.select(F.col("node").alias("a"), F.col("other").alias("b"))


def join(documents: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
    """``(sets, members, plain)``: sets with ``doc_id, n_shingles, set_hi, set_lo`` per row; of
    every distinct set ``hi, lo, family, component`` (its component, and that one's smallest
    doc_id); and whether every row with words has an id of its own.

    Every distinct set is a node, also where rows of one id differ in text or have no id.
    """
    documents = documents.select("doc_id", "text")
    sets = _stored(_sets(documents, frequent_shingles(documents)), "shingle-sets")
    real = sets.where(F.col("n_shingles") > 0)
    counts = sets.agg(F.count("*").alias("rows"), F.count_distinct("doc_id").alias("ids")).collect()[0]
    plain = counts.rows == counts.ids
    nodes = real.groupBy(F.col("set_hi").alias("hi"), F.col("set_lo").alias("lo")).agg(F.min("doc_id").alias("least_id"))
    if plain:
        nodes = _stored(nodes.withColumn("node", F.col("least_id")), "nodes")
        texts = documents.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("node"), "text")
        rows = sets
    else:
        nodes = _stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
        texts = _texts_of_sets(documents, nodes)
        rows = real.dropDuplicates(["doc_id", "set_hi", "set_lo"])
    postings = _postings(rows, nodes)
    links, comps = None, None
    for turn in range(ROUNDS + 1):
        postings = _open(postings, comps)
        pairs = _stars(postings, turn) if turn < ROUNDS else _pairs(postings, _of_nodes(rows, nodes).select("node", "bits"))
        found = verified(pairs, texts)
        links = found if links is None else links.unionByName(found)
        comps = components(links)
    members = nodes.join(comps, "node", "left").withColumn("family", F.coalesce("component", "node"))
    if plain:
        members = members.withColumn("component", F.col("family"))
    else:
        least = members.groupBy("family").agg(F.min("least_id").alias("least"))
        members = members.join(least, "family").withColumn("component", F.col("least"))
    return sets, members.select("hi", "lo", "family", "component"), plain


def _texts_of_sets(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, text``: one text of every distinct set."""
    rows = documents.select("text", set_key("text").alias("key"))
    rows = rows.groupBy(F.col("key")[0].alias("hi"), F.col("key")[1].alias("lo")).agg(F.min("text").alias("text"))
    return _stored(rows.join(nodes, ["hi", "lo"]).select("node", "text"), "set-texts")


def with_components(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    Null and empty texts, and texts without words, have an empty set and link with nothing;
    their component is their own id. Repeated rows get the same component, rows of one id with
    different texts the component of their own text. Rows with a null id have a null component.
    Other columns are not carried; an empty table gives no rows.
    """
    return _rows_with_components(*join(documents)[:2])


def _rows_with_components(sets: DataFrame, members: DataFrame) -> DataFrame:
    rows = sets.join(members, (sets.set_hi == members.hi) & (sets.set_lo == members.lo), "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.col("component"), F.col("doc_id")))
    component = F.when(F.col("n_shingles") > 0, own).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"))


def _unused(documents: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``documents`` has."""
    taken = {c.lower() for c in documents.columns}
    while name in taken:
        name += "_"
    return name


def one_per_group(documents: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns: of each component one row, one with the
    smallest id. Rows without an id belong to the component of their text, and stay only where no
    row with an id is in it. Of rows that repeat an id and a text one stays, of rows of one id with
    different texts those whose own component keeps them. Documents without words all stay."""
    sets, members, plain = join(documents)
    if not plain:
        return _one_row_per_family(documents, members)
    rows = _rows_with_components(sets, members)
    name = _unused(documents, "gone_id")
    gone = _stored(rows.where(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias(name)), "copies")
    if gone.count() <= SHARED_IDS:
        gone = F.broadcast(gone)
    return documents.join(gone, F.col("doc_id") == F.col(name), "left_anti")


def _one_row_per_family(documents: DataFrame, members: DataFrame) -> DataFrame:
    """``one_per_group`` for rows that ids do not tell apart: they are written with a number."""
    rows = documents.select(F.struct("*").alias("row"), set_key("text").alias("key"), F.monotonically_increasing_id().alias("number"))
    rows = _stored(rows, "numbered-rows")
    families = rows.select("number", F.col("row.doc_id").alias("id"), F.col("key")[0].alias("hi"), F.col("key")[1].alias("lo")).join(members, ["hi", "lo"])
    order = F.struct(F.col("id").isNull(), "id", "hi", "lo", "number")
    kept = _stored(families.groupBy("family").agg(F.min(order).alias("x")).select(F.col("x.number").alias("number")), "kept-rows")
    gone = _stored(families.select("number").join(kept, "number", "left_anti"), "copies")
    if gone.count() <= SHARED_IDS:
        gone = F.broadcast(gone)
    return rows.join(gone, "number", "left_anti").select("row.*")


def op7_jaccard_join(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """The contract's columns."""
    return with_components(documents)
