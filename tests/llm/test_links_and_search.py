"""Jaccard join, components, top-k search and the pipeline against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm import jaccard_join as jj
from starloom.llm import topk_search as tk
from starloom.llm.common import table
from starloom.llm.components import components


def shingle_set(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text)]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_components(texts):
    """doc id -> smallest id reachable over links of similarity 0.8 or more."""
    sets = {d: shingle_set(t) for d, t in texts.items()}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for d in sorted(sets):
        counts = {}
        for s in sets[d]:
            for o in where.get(s, ()):
                counts[o] = counts.get(o, 0) + 1
            where.setdefault(s, []).append(d)
        for o, both in counts.items():
            if 100 * both >= 80 * (len(sets[d]) + len(sets[o]) - both):
                a, b = sorted((find(d), find(o)))
                parent[b] = a
    return {d: find(d) for d in sets}, {d: len(s) for d, s in sets.items()}


def check(spark, texts):
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    expected, sizes = brute_components({d: t or "" for d, t in texts.items()})
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in jj.op7_jaccard_join(spark, frame).collect()}
    assert got == {d: (expected[d], sizes[d]) for d in texts}


def test_given_documents(spark, texts):
    check(spark, texts)


def test_near_copies_passages_and_chains(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = " ".join(rng.choices(vocabulary, k=40))
    texts, base = {}, rng.choices(vocabulary, k=120)
    for i in range(120):  # one large group: copies with one to six changed words, each from any earlier one
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts[i] = " ".join(words)
        if i % 10 == 0:
            base = words
    for i in range(200, 320):  # a passage that many share, with much or little of their own
        texts[i] = passage + " " + " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 60])))
    for i in range(400, 430):  # windows that slide: chains of links
        words = [f"c{k}" for k in range(3 * (i - 400), 3 * (i - 400) + 60)]
        texts[i] = " ".join(words)
    for i in range(500, 520):
        texts[i] = rng.choice(["a b c", "A b c", "a b", "", None, " \n", "x"])
    check(spark, texts)


def test_frequency_estimates_never_change_links(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    texts = {}
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(80)] = f"e{rng.randrange(50)}"
        texts[i] = " ".join(words)
    for table_of in (lambda _: (np.empty(0, np.uint64), np.empty(0, np.int64)),):
        monkeypatch.setattr(jj, "frequent_shingles", table_of)
        check(spark, texts)
    monkeypatch.undo()
    monkeypatch.setattr(jj, "SHARED_IDS", 0)  # the way without sharing ids
    check(spark, texts)


def test_prefixes_keep_the_promise():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 200))
        a = np.unique(rng.integers(0, 400, n).astype(np.uint64))
        b = np.unique(np.concatenate([rng.choice(a, max(1, int(len(a) * 0.95)), replace=False), rng.integers(0, 400, 2).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 80 * (len(a) + len(b) - both):
            continue
        frequent = np.unique(rng.integers(0, 400, 80).astype(np.uint64))
        counts = rng.integers(3, 50, len(frequent))
        (la, _, pa), (lb, _, pb) = jj.prefix(a, frequent, counts), jj.prefix(b, frequent, counts)
        l = min(la, lb)  # noqa: E741
        ka, kb = len(a) - jj.needed(len(a)) + l, len(b) - jj.needed(len(b)) + l
        assert len(np.intersect1d(pa[:ka], pb[:kb])) >= l


def test_word_hashes_are_those_of_the_words(monkeypatch):
    """One hash per word wherever it stands, A-Z as a-z, another word another hash."""
    rng, hashes, seen = random.Random(6), jj.WordHashes(), {}
    texts = ["", " ", "a", "A b\tB\x0bc", "é É", "x" * 5000 + " y", "\u00a0 one\u2003word"]
    texts += ["".join(rng.choice("abAB é\n\r\x0c ") for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    for size in (1_000_000, 7):
        monkeypatch.setattr(jj, "BYTES", size)
        for t in texts:
            words, found = t.encode().lower().split(), hashes.of(t.encode())
            assert len(found) == len(words)
            for w, h in zip(words, found.tolist(), strict=True):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen) > 500


def test_edge_rows(spark, edge):
    got = jj.op7_jaccard_join(spark, edge).collect()
    assert len(got) == 10
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 8)] == [1, 2, 3, 4, 5, 1, 7, 7]
    assert by_id[None].component_id is None and by_id[None].n_shingles == 1
    assert by_id[2].n_shingles == by_id[4].n_shingles == 0 and by_id[7].n_shingles == 1
    kept = jj.one_per_group(edge)
    assert kept.columns == edge.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "7", "None"])
    assert jj.op7_jaccard_join(spark, edge.limit(0)).count() == 0


def test_one_row_of_equal_texts_stays(spark):
    """Whatever their ids, and beside columns named like those the join makes."""
    text = "seven words are in this very text"
    for ids, kept in (([1, 2, None, None, 1], [1]), ([None, None], [None]), ([4, 3], [3]), ([5, None], [5])):
        rows = [(i, text, n, n) for n, i in enumerate(ids)] + [(9, "other words that nobody else has here", 0, 0), (9, "", 0, 0)]
        frame = spark.createDataFrame(rows, "doc_id long, text string, gone_id int, key int")
        got = jj.one_per_group(frame)
        assert got.columns == frame.columns
        assert sorted(str(r.doc_id) for r in got.collect()) == sorted(map(str, [*kept, 9, 9]))


def test_one_id_with_different_texts(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(500)]
    rows = []
    for i in range(6):  # several, since the hashes decide which of two sets came first
        a, b, c = (rng.choices(vocabulary, k=60) for _ in range(3))
        near = lambda words: " ".join([*words[:-1], "end"])
        base = 100 * i
        rows += [(base + 5, " ".join(a)), (base + 5, " ".join(b)), (base + 9, " ".join(b)), (base + 10, near(b)), (base + 7, near(a))]
        rows += [(base + 5, " ".join(c)), (base + 2, near(c)), (base + 2, None), (base + 2, " ".join(rng.choices(vocabulary, k=60)))]
    # brute force over rows, then the smallest id of each component
    by_row, _ = brute_components({n: t or "" for n, (_, t) in enumerate(rows)})
    least = {}
    for n, c in by_row.items():
        least[c] = min(least.get(c, 10**9), rows[n][0])
    expected = sorted((rows[n][0], least[c]) for n, c in by_row.items())
    frame = spark.createDataFrame([(d, t, n) for n, (d, t) in enumerate(rows)], "doc_id long, text string, n int")
    got = jj.op7_jaccard_join(spark, frame).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == expected
    kept = jj.one_per_group(frame)
    assert kept.columns == frame.columns
    assert {r.n for r in kept.collect()} == {n for n, c in by_row.items() if least[c] == rows[n][0]}


def test_components_against_union_find(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)]
    links += [(500, i) for i in range(501, 560)] + [(None, 3), (7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(parent)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_top(rows, k):
    good = [(i, np.floor(64 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, x in good:
        if q % 20 == 0:
            scored = sorted((-int(x @ y), c) for c, y in good if c != q)[:k]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored)]
    return sorted(out)


def test_search_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, rng.choice([0.01, 1, 5]), 16).astype(np.float32).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)]  # copies: ties
    rows += [(2000 + i, [0.0] * 16) for i in range(30)]
    rows += [(3000, None), (3020, [float("nan")] * 16), (3040, [None] * 16), (3060, [float("inf")] * 16), (None, [1.0] * 16)]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rank int, score int")
    got = sorted(tuple(r) for r in tk.op9_topk_search(spark, frame.repartition(3)).collect())
    assert got == brute_top(rows, 20)
    assert tk.op9_topk_search(spark, frame.limit(0)).count() == 0
    few = frame.where("vec_id < 5")
    assert len(tk.op9_topk_search(spark, few).collect()) == 4


def test_search_with_repeated_query_rows(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(0, 1, 8).astype(np.float32).tolist()) for i in range(200)]
    rows += 2 * [rows[0]] + 24 * [rows[20]] + [(40, rng.normal(0, 1, 8).astype(np.float32).tolist())]  # equal rows; two vectors
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    for chunk in (tk.CHUNK, 7):
        monkeypatch.setattr(tk, "CHUNK", chunk)
        got = sorted(tuple(r) for r in tk.op9_topk_search(spark, frame).collect())
        assert got == brute_top(rows, 20)


def test_vectors_without_exact_scores_raise(spark):
    schema = "vec_id long, embedding array<double>"
    with pytest.raises(ValueError, match="dimensions"):
        tk.op9_topk_search(spark, spark.createDataFrame([(0, [1.0, 2.0]), (20, [1.0])], schema))
    for large in (1e18, 1e300, 2.0**23):
        with pytest.raises(ValueError, match="2\\^53"):
            tk.op9_topk_search(spark, spark.createDataFrame([(0, [1.0, 2.0]), (20, [large, 1.0])], schema))


def test_search_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(tk, "CHUNK", 7)
    frame = table(spark, "/root/testdata/sf0.001", "embeddings")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    assert sorted(tuple(r) for r in tk.op9_topk_search(spark, frame).collect()) == brute_top(rows, 20)


def test_search_cells_hold_chunks_and_runs(spark, monkeypatch):
    """Queries meet the candidates in tasks: only the sample for the pivots comes to the driver."""
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(0, 1000 if i % 3 else 1, 4).tolist()) for i in range(2000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for name, value in (("PIVOT_SAMPLE", 50), ("CHUNK", 30), ("BLOCK", 300)):
        monkeypatch.setattr(tk, name, value)
    fetched = []
    to_arrow = type(frame).toArrow
    monkeypatch.setattr(type(frame), "toArrow", lambda self: fetched.append(to_arrow(self)) or fetched[-1])
    got = sorted(tuple(r) for r in tk.op9_topk_search(spark, frame).collect())
    assert got == brute_top(rows, 20)
    assert [t.num_rows for t in fetched] == [50]


def test_tile_leaves_out_far_groups():
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 300, (40, 16))
    vectors = np.floor(centres[rng.integers(0, 40, 6000)] + rng.normal(0, 5, (6000, 16)))
    ids, k = rng.permutation(6000), 10
    largest = float((vectors**2).sum(axis=1).max())
    lifted = tk.lift(vectors, largest)
    pivots = tk.choose_pivots(lifted[:1000], tk.PIVOTS)
    table = tk.distances(lifted, pivots).astype(np.float32)
    asked = vectors[:64]
    to_pivots = tk.distances(np.concatenate([asked, np.zeros((64, 1))], axis=1), pivots).astype(np.float32)
    order = tk.by_pivot(table, ids)
    ranges = tk.group_ranges(table[order])
    computed = 0
    for q in range(64):  # a query each, and below all in one tile
        one = slice(q, q + 1)
        *_, n = tk.search_tile(ids[one], asked[one], to_pivots[one], np.full(1, -np.inf), ids[order], vectors[order], ranges, largest, k)
        computed += n
    assert computed < 0.5 * 64 * 6000
    places, scores, found, _ = tk.search_tile(ids[:64], asked, to_pivots, np.full(64, -np.inf), ids[order], vectors[order], ranges, largest, k)
    for q in range(64):
        best = sorted((-int(asked[q] @ v), int(i)) for v, i in zip(vectors, ids, strict=True) if i != ids[q])[:k]
        assert [(-int(s), int(i)) for s, i in zip(scores[places == q], found[places == q], strict=True)] == best


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, "/root/testdata/sf0.001", "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, "/root/testdata/sf0.001").cache()
        out.append((name, docs, after))
        docs = after
    return out


def test_pipeline_stages(spark, stages, labels):
    assert [n for n, *_ in stages] == ["toxicity", "quality_rules", "jaccard_join", "packing"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns
        assert not after.exceptAll(before).count()
    toxic = {r.doc_id for r in labels.collect() if r.toxic}
    clean = {r.doc_id for r in labels.collect() if r.quality and not r.toxic}
    _, before, after = stages[0]
    kept = {r.doc_id for r in after.collect()}
    assert len(kept & clean) >= 0.98 * len(clean) and len(kept & toxic) <= 0.3 * len(toxic)
    _, before, after = stages[2]
    expected, _ = brute_components({r.doc_id: r.text or "" for r in before.collect()})
    assert {r.doc_id for r in after.collect()} == set(expected.values())
    _, before, after = stages[3]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}


def test_pipeline_stages_on_odd_rows(spark, edge, labels):
    """Nulls, repeated rows, a very long text, clashing columns and no rows at all."""
    wide = edge.withColumns({c: F.lit(1) for c in ("gone_id", "family", "row", "number", "kept_rule", "y", "hi")})
    wide = wide.withColumn("n_chars", F.length("text").cast("long"))
    rows = wide.collect()
    assert len(rows) == 10
    for frame in (wide, wide.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, frame, "/root/testdata/sf0.001")
            assert after.columns == frame.columns, name
            assert not after.exceptAll(frame).count()
        packed = corpus_pipeline.STAGES[-1][1](spark, frame, "/root/testdata/sf0.001")
        assert packed.where("start = 0").count() == frame.count()
    long = wide.where("doc_id = 5")
    assert jj.one_per_group(long).count() == 1


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.columns == stages[-1][2].columns
    total = lambda f: f.groupBy().sum("length").collect()[0][0]
    assert total(got) == total(stages[-1][2])
