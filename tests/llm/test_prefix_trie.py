"""The prefix trie against a trie of plain dictionaries."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from starloom.llm import prefix_trie
from starloom.llm.common import table

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append(((t is not None, t or 0), role or "", text or ""))
    own = {c: [(r, x) for _, r, x in sorted(ts, key=lambda t: t[0])] for c, ts in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole = own.get(c - c % 20, [])[:h] + ts[h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append(c)
        ends[tuple(whole)].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        if node:
            children[node[:-1]] += 1
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not children[node]
        saved[node] += (len(members[node]) - 1) * len(WORDS.findall(node[-1][1])) if node else 0
        if node:
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    return sorted(
        repr((
            min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), children[n], leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest(),
        ))
        for n in members
    )


def run(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return sorted(repr(tuple(r)) for r in prefix_trie.op12_prefix_trie(spark, frame).collect())


def random_rows(seed, convs=300):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(0, 900), convs):
        for t in range(rng.choice([1, 2, 3, 5, 9])):
            rows.append((c, t, rng.choice(["user", None, "a"]), rng.choice(["hot turn here", "x y", "", None, f"t{rng.randint(0, 3)}"])))
    return rows


def test_whole_table(spark):
    frame = table(spark, "/root/testdata/sf0.001", "conversations")
    got = sorted(repr(tuple(r)) for r in prefix_trie.op12_prefix_trie(spark, frame).collect())
    assert got == plain([tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()])


def test_many_shards_spills_and_chunks(spark, monkeypatch):
    """Heavy nodes, bands, spilling queues and chunks of ids, all at small sizes."""
    rows = random_rows(3)
    rows += [(2000 + 20 * k, t, "user", "the same") for k in range(40) for t in range(12)]  # one hot path
    rows += [(5000, t, "user", f"turn {t} of a long one") for t in range(400)]
    expected = plain(rows)
    monkeypatch.setattr(prefix_trie, "HEAVY", 8)
    monkeypatch.setattr(prefix_trie, "BAND", 3)
    assert run(spark, rows) == expected
    monkeypatch.setattr(prefix_trie, "HEAVY", 10**9)
    monkeypatch.setattr(prefix_trie, "BAND", 10**9)
    assert run(spark, rows) == expected


def test_edges(spark):
    rows = [
        (0, 0, "user", "a b"), (0, 1, "user", "c"), (0, 2, None, None),
        (1, None, "user", "null turn first"), (1, 0, "user", "then this"), (1, 1, "user", "d"), (1, 2, "x", ""), (1, 3, "x", "e"),
        (45, 0, "user", "no first conversation"), (46, 0, "u", "x"), (46, 0, "u", "x"), (46, 0, "u", "x"), (46, 0, "u", "x"), (46, 0, "u", "x"),
        (None, 0, "user", "no id"), (60, 5, "user", "w " * 50_000), (61, 0, "user", "w " * 50_000),
        (-7, 1, "user", "a"), (-7, 2, "user", "b"), (-7, 3, "user", "c"), (-7, 4, "user", "d"),
    ]
    got = run(spark, [r for r in rows if r[0] != -7])
    assert got == plain([r for r in rows if r[0] != -7])
    assert run(spark, [r for r in rows if r[0] is None]) == []
    assert len(run(spark, rows)) >= len(got)
    wide = spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA + ", depth int, k1 string")
    assert sorted(repr(tuple(r)) for r in prefix_trie.trie(wide).collect()) == run(spark, rows)


@pytest.mark.parametrize("limit", [2, 5, 64])
def test_spilling_queue(limit):
    rng = random.Random(limit)
    queue, held = prefix_trie.SpillingQueue(limit), defaultdict(lambda: [0, 0])
    for _ in range(600):
        place = (-rng.randint(0, 6), rng.randint(0, 4), 0)
        if rng.random() < 0.7:
            totals = (rng.randint(0, 9), rng.randint(0, 10**12))
            queue.push(place, totals)
            held[place] = [a + b for a, b in zip(held[place], totals, strict=True)]
        elif held:
            first = min(held)
            assert list(queue.take(first)) == held.pop(first)
            assert queue.take((first[0] - 1, 0, 0)) == (0, 0)
    while held:
        first = min(held)
        assert list(queue.take(first)) == held.pop(first)
    assert not len(queue) and (queue.spilled or limit > 60)


def test_totals_through_a_spilling_queue(monkeypatch):
    """Subtree sizes of a random tree with a queue of a few messages."""
    n = 500
    parent = [None] + [random.Random(k).randint(max(0, k - 60), k - 1) for k in range(1, n)]
    depth = [0] * n
    for k in range(1, n):
        depth[k] = depth[parent[k]] + 1
    total = [1] * n
    for k in sorted(range(n), key=lambda k: -depth[k]):
        if parent[k] is not None:
            total[parent[k]] += total[k]
    monkeypatch.setattr(prefix_trie, "QUEUE", 7)
    queue, got = prefix_trie.SpillingQueue(), {}
    for k in sorted(range(n), key=lambda k: (-depth[k], k)):
        one, _ = queue.take((-depth[k], k, 0))
        got[k] = one + 1
        if parent[k] is not None:
            queue.push((-depth[parent[k]], parent[k], 0), (got[k], 0))
    assert [got[k] for k in range(n)] == total and queue.spilled
