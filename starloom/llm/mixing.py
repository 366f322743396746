"""Mixing overlapping sources to target weights by min-cost flow.

1. Documents are aggregated by membership pattern, the set of sources they belong to. What comes
   to the driver is one row per pattern; their number is checked (``MAX_PATTERNS``).
2. Words flow from patterns to the sources' quotas. A pattern gives its words once for free, a
   second time and a third time at rising (convex) costs, and a quota that stays open costs more
   than any repetition; the flow of least cost says how many words of which pattern serve which
   source. ``min_cost_flow`` solves it by phases of equal shortest distance.
3. Documents of a pattern stand in a seeded order, by a hash of their id and size. A flow of q
   whole rounds and a rest takes every document q times and the documents up to the rest once
   more. Where a rest ends in that order is found by radix selection: sums by the next bits of
   the hash, of the rows still in question, until few are left. No pattern is sorted or gathered,
   whatever its share of the rows. What the order leaves open, less than one document, is filled
   from the documents that still fit, in the same order: those not yet taken in this round, then
   any of them once more, and at last the smallest one if that comes nearer.
"""

from __future__ import annotations

import heapq
from collections import deque
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import scratch_path

WEIGHTS = (5, 2, 1)
#: Times that a document may be used, and what a word costs each time.
COSTS = (0, 1, 3)
#: What an open word of a quota costs: more than any repetition.
OPEN_COST = 1000
MAX_PATTERNS = 10_000
SEED = 11
#: Radix selection: bits of a step and rows that may be ranked by a window per cut.
BITS, FEW = 9, 50_000
#: How often a rest is filled again from documents that still fit.
FILLS = 3
KEY_BITS = 63
LAST = (1 << KEY_BITS) - 1
WORD = r"[^\x20\x09-\x0D]+"


# ---- targets and flow (on the driver, over patterns and sources) ------------------------------


def water_fill(total: float, sizes: list[int], weights: list[float], most: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; what stops there is
    shared again by weight among the others."""
    out, open_ = [0.0] * len(sizes), list(range(len(sizes)))
    left = float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        above = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not above:
            for i in open_:
                out[i] = left * weights[i] / weight
            return out
        for i in above:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in above)
        open_ = [i for i in open_ if i not in set(above)]
    return out


class Network:
    """Arcs with capacities and costs; arc ``a ^ 1`` is the way back of arc ``a``."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to, self.room, self.cost = [], [], []

    def arc(self, a: int, b: int, room: int, cost: int) -> int:
        for start, end, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[start].append(len(self.to))
            self.to.append(end)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def min_cost_flow(self, source: int, sink: int) -> None:
        """The largest flow of least cost. Each phase takes the shortest distances with reduced
        costs and saturates all shortest paths (blocking flows by levels), so the number of phases
        is that of different path costs, not of paths."""
        height = [0] * len(self.out)
        while True:
            far = self._distances(source, height)
            if far[sink] is None:
                return
            reach = max(d for d in far if d is not None)
            for v, d in enumerate(far):
                height[v] += reach if d is None else d
            while self._blocking(source, sink, height):
                pass

    def _distances(self, source: int, height: list[int]) -> list[int | None]:
        far: list[int | None] = [None] * len(self.out)
        heap = [(0, source)]
        while heap:
            d, v = heapq.heappop(heap)
            if far[v] is not None:
                continue
            far[v] = d
            for a in self.out[v]:
                if self.room[a] and far[self.to[a]] is None:
                    heapq.heappush(heap, (d + self.cost[a] + height[v] - height[self.to[a]], self.to[a]))
        return far

    def _blocking(self, source: int, sink: int, height: list[int]) -> bool:
        """One blocking flow over the arcs without reduced cost; whether anything flowed."""

        def tight(v: int, a: int) -> bool:
            return self.room[a] > 0 and self.cost[a] + height[v] - height[self.to[a]] == 0

        level, queue = {source: 0}, deque([source])
        while queue:
            v = queue.popleft()
            for a in self.out[v]:
                if tight(v, a) and self.to[a] not in level:
                    level[self.to[a]] = level[v] + 1
                    queue.append(self.to[a])
        if sink not in level:
            return False
        at, path, v = dict.fromkeys(level, 0), [], source
        while True:
            if v == sink:
                push = min(self.room[a] for a in path)
                for a in path:
                    self.room[a] -= push
                    self.room[a ^ 1] += push
                first = next(k for k, a in enumerate(path) if not self.room[a])
                path, v = path[:first], self.to[path[first] ^ 1]
                continue
            while at[v] < len(self.out[v]):
                a = self.out[v][at[v]]
                if tight(v, a) and level.get(self.to[a], -1) == level[v] + 1:
                    break
                at[v] += 1
            else:
                if not path:
                    return True
                v = self.to[path.pop() ^ 1]
                at[v] += 1
                continue
            path.append(a)
            v = self.to[a]


def route(patterns: list[tuple[tuple, int]], quotas: dict, costs: tuple[int, ...] = COSTS) -> list[list[tuple[object, int]]]:
    """For every pattern ``(sources, words)`` the words that serve each of its sources."""
    names = list(quotas)
    node = {s: 2 + len(patterns) + k for k, s in enumerate(names)}
    net = Network(2 + len(patterns) + len(names))
    routes = []
    for p, (sources, words) in enumerate(patterns):
        for cost in costs:
            net.arc(0, 2 + p, words, cost)
        routes.append([(s, net.arc(2 + p, node[s], len(costs) * words, 0)) for s in sources])
    for s, quota in quotas.items():
        net.arc(0, node[s], quota, OPEN_COST)
        net.arc(node[s], 1, quota, 0)
    net.min_cost_flow(0, 1)
    return [[(s, net.room[a ^ 1]) for s, a in arcs if net.room[a ^ 1]] for arcs in routes]


# ---- the documents of a pattern in their seeded order -----------------------------------------


@dataclass
class Cut:
    """A place in a pattern's order: the rows before it have ``want`` words or fewer."""

    pattern: int
    rounds: int
    want: int
    #: rows taken beyond the whole rounds: (largest size, first key, last key), a key being (h, rn)
    spans: list[tuple[int, tuple[int, int], tuple[int, int]]] = field(default_factory=list)
    #: rows taken once more than that
    again: list[tuple[int, tuple[int, int], tuple[int, int]]] = field(default_factory=list)


SPAN = "struct<size:long,h0:long,rn0:long,h1:long,rn1:long>"
STEP = f"cut int, pattern int, want long, size_limit long, depth int, h_head long, rn_head long, spans array<{SPAN}>"


def _taken(spans: Column) -> Column:
    """Whether a row lies in one of the spans."""
    size, h, rn = F.col("size"), F.col("h"), F.col("rn")

    def inside(s: Column) -> Column:
        after = (h > s["h0"]) | ((h == s["h0"]) & (rn >= s["rn0"]))
        before = (h < s["h1"]) | ((h == s["h1"]) & (rn <= s["rn1"]))
        return (size <= s["size"]) & after & before

    return F.exists(spans, inside)


def _flat(spans) -> list[tuple]:
    return [(size, *first, *last) for size, first, last in spans]


def _at_head(depth: int) -> Column:
    """Whether a row's key begins with the cut's head of ``depth`` steps."""
    known = min(depth * BITS, KEY_BITS)
    same = F.shiftrightunsigned("h", KEY_BITS - known) == F.col("h_head")
    if depth * BITS > KEY_BITS:
        same &= F.shiftrightunsigned("rn", 2 * KEY_BITS - depth * BITS) == F.col("rn_head")
    return same


def _digit(depth: int) -> Column:
    """The key's bits of the next step: first those of the hash, then those of the row number."""
    key, rest = ("h", KEY_BITS - (depth + 1) * BITS) if depth * BITS < KEY_BITS else ("rn", 2 * KEY_BITS - (depth + 1) * BITS)
    return F.shiftrightunsigned(F.col(key), rest).bitwiseAND(F.lit((1 << BITS) - 1))


def _fill(rows: DataFrame, cuts: list[Cut], limits: list[int], wants: list[int]) -> list[int]:
    """Extend every cut, in its order, by the rows not yet taken of at most ``limits`` words while
    they fit into ``wants``; returns the words added."""
    spark = rows.sparkSession
    added = [0] * len(cuts)
    #: cut -> depth, head of the hash, head of the row number, words before the head
    open_ = {k: (0, 0, 0, 0) for k, w in enumerate(wants) if w > 0 and limits[k] > 0}
    ranked: dict[int, tuple[int, int, int, int]] = {}
    ends: dict[int, tuple[int, int]] = {}

    def table(states: dict) -> DataFrame:
        steps = [(k, cuts[k].pattern, wants[k] - s[3], limits[k], s[0], s[1], s[2], _flat(cuts[k].spans)) for k, s in states.items()]
        held = spark.createDataFrame(steps, STEP)  # one row per cut: at most one per route
        left = rows.join(F.broadcast(held), "pattern").where((F.col("size") <= F.col("size_limit")) & ~_taken(F.col("spans")))
        return left

    while open_:
        depth = next(iter(open_.values()))[0]
        cells = table(open_).where(_at_head(depth)).groupBy("cut", "want", _digit(depth).alias("digit"))
        cells = cells.agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        # 512 cells a cut at most
        cells = cells.selectExpr("*", "sum(words) over (partition by cut order by digit) as upto")
        summed = cells.groupBy("cut").agg(
            F.max("upto").alias("all"),
            F.min(F.when(F.col("upto") > F.col("want"), F.struct("digit", (F.col("upto") - F.col("words")).alias("before"), "n"))).alias("over"),
        )
        found, following = {r.cut: r for r in summed.collect()}, {}
        for k, (_, h_head, rn_head, before) in open_.items():
            r = found.get(k)
            if r is None or r.over is None:  # everything that is left fits
                added[k], ends[k] = before + (r.all if r else 0), (LAST, LAST)
                continue
            if depth * BITS < KEY_BITS:
                h_head = h_head << BITS | r.over.digit
            else:
                rn_head = rn_head << BITS | r.over.digit
            state = (depth + 1, h_head, rn_head, before + r.over.before)
            deeper = r.over.n > FEW and (depth + 1) * BITS < 2 * KEY_BITS
            (following if deeper else ranked)[k] = state
        open_ = following
    for depth in sorted({s[0] for s in ranked.values()}):
        states = {k: s for k, s in ranked.items() if s[0] == depth}
        few = table(states).where(_at_head(depth))  # at most FEW rows a cut
        few = few.selectExpr("cut", "want", "size", "h", "rn", "sum(size) over (partition by cut order by h, rn rows unbounded preceding) as upto")
        last = few.where("upto <= want").groupBy("cut").agg(F.max(F.struct("h", "rn", "upto")).alias("x"))
        found = {r.cut: r.x for r in last.collect()}
        for k, (_, h_head, rn_head, before) in states.items():
            if k in found:
                added[k], ends[k] = before + found[k].upto, (found[k].h, found[k].rn)
            elif depth * BITS <= KEY_BITS:
                added[k], ends[k] = before, ((h_head << (KEY_BITS - depth * BITS)) - 1, LAST)
            else:
                added[k], ends[k] = before, (h_head, (rn_head << (2 * KEY_BITS - depth * BITS)) - 1)
    for k, end in ends.items():
        cuts[k].spans.append((limits[k], (0, 0), end))
    return added


def place_cuts(rows: DataFrame, cuts: list[Cut], exact: set[int], most: int) -> None:
    """Find every cut's end in its pattern's order; the cuts in ``exact`` are then brought as near
    to their words as whole documents, none more than ``most`` times, allow."""
    wants = [c.want for c in cuts]
    left = [w - a for w, a in zip(wants, _fill(rows, cuts, [LAST] * len(cuts), wants), strict=True)]
    left = [w if k in exact else 0 for k, w in enumerate(left)]
    left = _fill_rest(rows, cuts, left)
    # the same documents once more, as a round of their own
    twice = [c.rounds + 2 <= most for c in cuts]
    more = [Cut(c.pattern, 0, 0) for c in cuts]
    rest = _fill_rest(rows, more, [w if t else 0 for w, t in zip(left, twice, strict=True)])
    _nearest(rows, more, rest)
    for cut, extra in zip(cuts, more, strict=True):
        cut.again = extra.spans
    _nearest(rows, cuts, [0 if t else w for w, t in zip(left, twice, strict=True)])


def _fill_rest(rows: DataFrame, cuts: list[Cut], left: list[int]) -> list[int]:
    """Fill what is open from the documents that fit, a few times; returns what stays open."""
    for _ in range(FILLS):
        if any(left):
            added = _fill(rows, cuts, left, left)
            left = [w - a for w, a in zip(left, added, strict=True)]
    return left


def _nearest(rows: DataFrame, cuts: list[Cut], left: list[int]) -> None:
    """Take the smallest document that is left where that comes nearer to what is open."""
    steps = [(k, cuts[k].pattern, w, LAST, 0, 0, 0, _flat(cuts[k].spans)) for k, w in enumerate(left) if w > 0]
    if not steps:
        return
    held = F.broadcast(rows.sparkSession.createDataFrame(steps, STEP))
    near = rows.join(held, "pattern").where((F.col("size") > 0) & (F.col("size") < 2 * F.col("want")) & ~_taken(F.col("spans")))
    for r in near.groupBy("cut").agg(F.min(F.struct("size", "h", "rn")).alias("x")).collect():
        cuts[r.cut].spans.append((r.x.size, (r.x.h, r.x.rn), (r.x.h, r.x.rn)))


# ---- the mix -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Source:
    name: str | None
    size: int
    target: float


def _tagged(name: Column) -> Column:
    """A source's name as text that is never null and sorts null last."""
    return F.when(name.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), name))


def _name(tag: str) -> str | None:
    return tag[1:] if tag.startswith("0") else None


def mix(
    documents: DataFrame, sources: Column, weights: tuple[float, ...] = WEIGHTS, costs: tuple[int, ...] = COSTS, seed: int = SEED
) -> tuple[DataFrame, list[Source]]:
    """``doc_id, sources, size, copies, uses`` of every document, and the sources with their sizes
    and targets.

    ``sources`` is an array column: the sources a document belongs to, null being one of them.
    ``weights`` repeat over the sources in the order of their names by code point, null last; they
    share all words of documents that have a source, and no target is above ``len(costs)`` times
    its source's size. ``copies`` counts how often a document is taken (at most ``len(costs)``),
    ``uses`` splits that by the source served (``source, copies``).

    A null text has no words; documents without words are taken like others of their pattern and
    add nothing. A null or empty array is no source: never taken. Repeated rows are documents each,
    rows with a null id too. Other columns are not carried; an empty table gives an empty mix. The
    same table gives the same mix: equal hashes mean equal id and size, so which of such rows is
    taken changes no result.
    """
    spark = documents.sparkSession
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    tags = F.array_sort(F.array_distinct(F.transform(F.coalesce(sources, F.array().cast("array<string>")), _tagged)))
    rows = documents.select("doc_id", tags.alias("tags"), size.alias("size"))
    h = F.xxhash64(F.lit(seed), "doc_id", "size").bitwiseAND(F.lit(LAST))
    path = scratch_path(spark, "mix-documents")
    rows.select("*", h.alias("h"), F.monotonically_increasing_id().alias("rn")).write.parquet(path)
    rows = spark.read.parquet(path)

    found = rows.groupBy("tags").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    found = sorted((tuple(r.tags), r.size) for r in found if r.tags)
    names = sorted({t for tags, _ in found for t in tags})
    sizes = [sum(n for tags, n in found if name in tags) for name in names]
    shares = [weights[k % len(weights)] for k in range(len(names))]
    targets = water_fill(sum(n for _, n in found), sizes, shares, len(costs))
    routes = route(found, {s: round(t) for s, t in zip(names, targets, strict=True)}, costs)

    patterns, cuts, ends, exact = [], [], [], set()
    for p, ((tags, words), flows) in enumerate(zip(found, routes, strict=True)):
        upto, mine = 0, []
        for name, flow in flows:
            upto += flow
            mine.append((name, len(cuts)))
            cuts.append(Cut(p, upto // words, upto % words))
        if mine:
            exact.add(mine[-1][1])
        patterns.append((p, list(tags)))
        ends.append(mine)
    keyed = rows.join(F.broadcast(spark.createDataFrame(patterns, "pattern int, tags array<string>")), "tags", "left")
    place_cuts(keyed, cuts, exact, len(costs))

    plan = [(p, [(_name(s), cuts[k].rounds, _flat(cuts[k].spans), _flat(cuts[k].again)) for s, k in mine]) for p, mine in enumerate(ends)]
    schema = f"pattern int, cuts array<struct<source:string,rounds:int,spans:array<{SPAN}>,again:array<{SPAN}>>>"
    keyed = keyed.join(F.broadcast(spark.createDataFrame(plan, schema)), "pattern", "left")
    # copies up to each cut, then the difference from cut to cut
    keyed = keyed.withColumn("upto", F.transform("cuts", lambda c: c["rounds"] + _taken(c["spans"]).cast("int") + _taken(c["again"]).cast("int")))
    before = lambda i: F.when(i > 0, F.get(F.col("upto"), i - 1)).otherwise(0)
    uses = F.transform("cuts", lambda c, i: F.struct(c["source"].alias("source"), (F.get(F.col("upto"), i) - before(i)).alias("copies")))
    copies = F.coalesce(F.get("upto", F.size("upto") - 1), F.lit(0))
    out = keyed.select(
        "doc_id",
        F.transform("tags", lambda t: F.when(t.startswith("0"), F.substring(t, F.lit(2), F.length(t)))).alias("sources"),
        "size",
        copies.alias("copies"),
        F.filter(F.coalesce(uses, F.array().cast("array<struct<source:string,copies:int>>")), lambda u: u["copies"] > 0).alias("uses"),
    )
    return out, [Source(_name(s), n, t) for s, n, t in zip(names, sizes, targets, strict=True)]


def op11_mixing(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """The contract's columns: every document belongs to the one source it names."""
    mixed, sources = mix(documents, F.array(F.col("source").cast("string")))
    held = spark.createDataFrame([(s.name, s.size, s.target) for s in sources], "source string, source_size long, target double")
    mixed = mixed.withColumn("source", F.get("sources", F.lit(0)))
    joined = mixed.join(F.broadcast(held.withColumnRenamed("source", "of")), F.col("source").eqNullSafe(F.col("of")))
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
