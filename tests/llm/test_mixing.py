"""Mixing against plain water filling, a plain min-cost flow and plain sums."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from starloom.llm import mixing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    """Targets by pouring in small steps: sizes by source name, in order."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, left = dict.fromkeys(names, 0.0), float(sum(sizes.values()))
    while left > 1e-9:
        open_ = [s for s in names if target[s] < 3 * sizes[s] - 1e-9]
        step = min([left / sum(weights[s] for s in open_)] + [(3 * sizes[s] - target[s]) / weights[s] for s in open_])
        for s in open_:
            target[s] += step * weights[s]
            left -= step * weights[s]
    return target


def plain_cost(patterns, quotas, costs):
    """Least cost by Bellman-Ford, one path at a time."""
    arcs = []  # to, room, cost, back
    out = defaultdict(list)

    def arc(a, b, room, cost):
        out[a].append(len(arcs))
        arcs.append([b, room, cost])
        out[b].append(len(arcs))
        arcs.append([a, 0, -cost])

    for p, (sources, words) in enumerate(patterns):
        for c in costs:
            arc("s", ("p", p), words, c)
        for s in sources:
            arc(("p", p), ("q", s), 10**9, 0)
    for s, quota in quotas.items():
        arc("s", ("q", s), quota, mixing.OPEN_COST)
        arc(("q", s), "t", quota, 0)
    total = 0
    while True:
        far, via, changed = {"s": 0}, {}, True
        while changed:
            changed = False
            for v in list(far):
                for a in out[v]:
                    to, room, cost = arcs[a]
                    if room and far[v] + cost < far.get(to, 10**12):
                        far[to], via[to], changed = far[v] + cost, (v, a), True
        if "t" not in far:
            return total
        path, v = [], "t"
        while v != "s":
            v, a = via[v]
            path.append(a)
        push = min(arcs[a][1] for a in path)
        for a in path:
            arcs[a][1] -= push
            arcs[a ^ 1][1] += push
        total += push * far["t"]


def used_cost(patterns, quotas, routes, costs):
    total, served = 0, Counter()
    for (_, words), flows in zip(patterns, routes, strict=True):
        left = sum(n for _, n in flows)
        served.update(dict(flows))
        for c in costs:
            total += c * min(left, words)
            left -= min(left, words)
        assert left == 0
    for s, quota in quotas.items():
        assert served[s] <= quota
        total += mixing.OPEN_COST * (quota - served[s])
    return total


@pytest.mark.parametrize("seed", range(40))
def test_flow_has_least_cost(seed):
    rng = random.Random(seed)
    names = "abcde"[: rng.randint(1, 5)]
    patterns = [(tuple(sorted(rng.sample(names, rng.randint(1, len(names))))), rng.randint(0, 30)) for _ in range(rng.randint(1, 8))]
    quotas = {s: rng.randint(0, 80) for s in names}
    costs = rng.choice([(0, 1, 3), (0,), (0, 2, 5, 9)])
    routes = mixing.route(patterns, quotas, costs)
    assert used_cost(patterns, quotas, routes, costs) == plain_cost(patterns, quotas, costs)


def check(rows, got):
    """The contract against plain sums; returns taken and target by source."""
    sizes = [(d, s, len(WORDS.findall(t or ""))) for d, t, s in rows]
    by_source = Counter()
    for _, s, n in sizes:
        by_source[s] += n
    target = plain_targets(by_source)
    assert sorted(map(repr, ((r.doc_id, r.size, r.source_size) for r in got))) == sorted(map(repr, ((d, n, by_source[s]) for d, s, n in sizes)))
    for r in got:
        assert r.taken % r.size == 0 and r.taken <= 3 * r.size if r.size else r.taken == 0
    expected = Counter((d, round(target[s], 6)) for d, s, _ in sizes)
    assert Counter((r.doc_id, round(r.target, 6)) for r in got) == expected
    taken = Counter()
    source = {d: s for d, s, _ in sizes if d is not None}
    for r in got:
        if r.doc_id is not None:
            taken[source[r.doc_id]] += r.taken
    return taken, target


def test_whole_table(spark, documents):
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    got = mixing.op11_mixing(spark, documents).collect()
    taken, target = check(rows, got)
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.04 * t + 20, (s, taken[s], t)  # ten documents a source
    again = mixing.op11_mixing(spark, documents.repartition(5)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_edges(spark, edge):
    rows = [(r.doc_id, r.text, r.source) for r in edge.collect()]
    check(rows, mixing.op11_mixing(spark, edge).collect())
    assert mixing.op11_mixing(spark, edge.limit(0)).count() == 0
    bare = edge.withColumn("text", F.lit(None).cast("string"))
    assert {r.taken for r in mixing.op11_mixing(spark, bare).collect()} == {0}


def test_hot_source_and_repeated_rows(spark, monkeypatch):
    """Few rows a step: a hot source, and one id on a third of the rows, with equal hashes."""
    monkeypatch.setattr(mixing, "FEW", 5)
    rng = random.Random(5)
    rows = [(k, "w " * rng.randint(0, 60), "hot" if k % 3 else rng.choice(["b", "c", None])) for k in range(600)]
    rows += [(7777, "same words here", "hot")] * 300
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.op11_mixing(spark, frame).collect()
    taken, target = check(rows, got)
    for s, t in target.items():
        assert abs(taken[s] - t) <= 30


def test_overlapping_sources(spark):
    """Documents of several sources serve the source whose quota needs them; uses add up."""
    rng = random.Random(8)
    rows = [(k, "w " * rng.randint(1, 40), rng.sample(["a", "b", "c", None], rng.randint(0, 3)) or None) for k in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, of array<string>")
    mixed, sources = mixing.mix(frame, F.col("of"))
    got = mixed.collect()
    member = {k: set(of or []) for k, _, of in rows}
    served = Counter()
    for r in got:
        assert r.copies == sum(u.copies for u in r.uses) and 0 <= r.copies <= 3
        assert {u.source for u in r.uses} <= member[r.doc_id] == set(r.sources)
        for u in r.uses:
            served[u.source] += u.copies * r.size
    assert len(sources) == 4
    for s in sources:
        assert s.size == sum(len(t.split()) for k, t, _ in rows if s.name in member[k])
        assert abs(served[s.name] - s.target) <= 0.02 * s.target + 40
