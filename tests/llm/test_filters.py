"""Quality rules and url filters against brute force."""

import math
import re
from collections import Counter, defaultdict

import pytest

from starloom.llm import quality_rules as qr
from starloom.llm import url_filters as uf
from starloom.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = text.split("\n")
    dup = sum(1 for i, line in enumerate(lines) if WORD.search(line) and line in lines[:i])
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_match_brute_force(texts):
    odd = ["", " ", "a b a b a b", "x\ny\nx\n\n\n", "a\r\nb\r\na\r\n", "\u00a0a b", "$ $ $ $", "a a a a a", "日 本 日 本 日 本"]
    for t in odd + list(texts.values()):
        assert qr.measure(t)[:5] == brute_counts(t), t[:50]


def brute_bin(v):
    drop = max(0, v.bit_length() - 6)
    return v >> drop << drop


def brute_fences(rows):
    """(lang, source) -> ratio -> (low, high) from sorted values."""
    groups, langs, every = defaultdict(list), defaultdict(list), []
    for lang, source, ratios in rows:
        groups[lang, source].append(ratios)
        langs[lang].append(ratios)
        every.append(ratios)

    def quartiles(values, k):
        v = sorted(brute_bin(r[k]) for r in values)
        return v[max(0, -(-len(v) // 4) - 1)], v[max(0, -(-len(v) * 3 // 4) - 1)]

    out = {}
    for (lang, source), values in groups.items():
        base = values if len(values) >= qr.MIN_DOCUMENTS else langs[lang] if len(langs[lang]) >= qr.MIN_DOCUMENTS else every
        out[lang, source] = {}
        for k, name in enumerate(qr.RATIOS):
            q25, q75 = quartiles(base, k)
            spread = max(q75 - q25, qr.RATIOS[name][3])
            out[lang, source][name] = (q25 - 3 * spread, q75 + 3 * spread)
    return out


def test_verdicts_match_brute_force(spark, documents, edge):
    columns = ["doc_id", "text", "lang", "source"]
    for frame in (documents.select(*columns), documents.select(*columns).unionByName(edge.select(*columns))):
        rows = []
        for r in frame.collect():
            c = dict(zip(qr.COUNTS, qr.measure(r.text or ""), strict=True))
            failed = c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]
            ratios = [c[t] * s // max(c[b], 1) for t, b, s, *_ in qr.RATIOS.values()]
            rows.append((str(r.doc_id), r.lang, r.source, failed, ratios))
        fences = brute_fences([(lang, source, ratios) for _, lang, source, failed, ratios in rows if not failed])
        expected = []
        for doc, lang, source, failed, ratios in rows:
            kept = not failed
            for (name, (*_, low, high)), v in zip(qr.RATIOS.items(), ratios, strict=True):
                if kept:
                    a, b = fences[lang, source][name]
                    kept = not (low and v < a) and not (high and v > b)
            expected.append((doc, failed, kept))
        got = [(str(r.doc_id), r.base_failed, r.kept) for r in qr.op4_quality_rules(spark, frame).collect()]
        assert sorted(got) == sorted(expected)
        stage = qr.accepted(frame)
        assert stage.columns == columns
        assert sorted(str(r.doc_id) for r in stage.collect()) == sorted(d for d, _, k in expected if k)


def test_rules_on_an_empty_table_and_clashing_columns(spark, edge):
    assert qr.op4_quality_rules(spark, edge.limit(0)).count() == 0
    assert qr.op4_quality_rules(spark, edge).count() == 10
    assert qr.accepted(edge).columns == edge.columns


def test_sketches_merge(spark, documents):
    measured = documents.select("doc_id", "lang", "source", qr.measures("text").alias("c"))
    whole = {tuple(r) for r in qr.merge(qr.sketches(measured), "lang").collect()}
    halves = [qr.sketches(measured.where(f"doc_id % 2 = {k}")) for k in (0, 1)]
    assert whole == {tuple(r) for r in qr.merge(halves[0].unionByName(halves[1]), "lang").collect()}


URLS = [
    (1, None), (2, ""), (3, "no scheme"), (4, "HTTP://A.Net"), (5, "http://x.net/"), (6, "http://netx/"),
    (7, "x://example.net/en/a?b://c"), (8, "http://Ünï.ORG/fr/q#z"), (9, "a\n://b.net/\n?x"), (10, "http://deep.a.example.com/de/1"),
    (11, "http://example.com/de"), (12, "http://notexample.net/en/1"), (13, "http://h?q/net/"), (14, "http://" + "w" * 3000 + ".net/" + "p" * 5000),
    (14, "http://x.net/"), (15, "://"), (16, "http://example.net/EN/"),
]


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def brute_rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in uf.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_rules_match_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "clash", 1.0) for i, u in URLS], "page_id long, url string, host string, score double")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in uf.op6_url_filters(spark, pages).collect() if r.rule)
    expected = []
    for i, u in URLS:
        host, path = brute_parts(u)
        rule, verdict = brute_rule(host, path)
        if rule:
            expected.append((i, host, path, rule, verdict))
    assert got == sorted(expected)
    every = {r.page_id: (r.host, r.path, r.verdict) for r in uf.op6_url_filters(spark, pages).collect()}
    assert every[1][:2] == every[2][:2] == every[3][:2] == every[15][:2] == ("", "")
    assert {v for _, _, v in every.values()} <= {"allow", "block"}
    assert uf.op6_url_filters(spark, pages.limit(0)).count() == 0


def test_regression_matches_plain_gradient_descent(spark):
    urls = [(u, 1) for u in uf.BLOCKED_URLS[:6]] + [(u, 0) for u in uf.ALLOWED_URLS[:6]]
    examples = spark.createDataFrame(urls, "url string, label int")
    host, path = uf.parts(examples.url)
    rows = sorted((r.url, r.label, r.g) for r in examples.select("url", "label", uf.buckets(host, path).alias("g")).collect())
    x = [[(1 / math.sqrt(len(g)) if b in g else 0.0) for b in range(uf.BUCKETS)] + [1.0] for _, _, g in rows]
    w = [0.0] * (uf.BUCKETS + 1)
    for _ in range(uf.STEPS):
        p = [1 / (1 + math.exp(-sum(a * b for a, b in zip(xi, w, strict=True) if a))) for xi in x]
        w = [wi * (1 - uf.RATE * uf.DECAY) for wi in w]
        for xi, pi, (_, y, _) in zip(x, p, rows, strict=True):
            w = [wi + uf.RATE * (y - pi) * a if a else wi for wi, a in zip(w, xi, strict=True)]
    model = uf.weights(examples).collect()[0].model
    assert max(abs(a - b) for a, b in zip([*model.w, model.bias], w, strict=True)) < 1e-9


def test_regression_on_known_and_held_out_hosts(spark):
    held = [
        ("https://www.mega-casino.example.org/en/5", "block"), ("http://quick-bets.example.com/en/1", "block"),
        ("http://herb-pills.example.org/en/9", "block"), ("https://thander.example.com/en/77", "allow"), ("http://m.entarion.example.org/es/12", "allow"),
    ]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(held)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in uf.judge(pages, rules=[]).collect()}
    assert [got[i] for i in range(len(held))] == [v for _, v in held]


def test_training_tables_of_one_label_and_of_too_many_rows(spark, monkeypatch):
    schema = "url string, label int"
    for label in (0, 1):
        one = spark.createDataFrame([(f"https://site{i}.org/path{i}", label) for i in range(4)], schema)
        scores = uf.coefficients(one).collect()
        assert {r.y for r in scores} == {float(label)} and len(scores) == 4
    assert uf.coefficients(spark.createDataFrame([], schema)).count() == 0
    monkeypatch.setattr(uf, "MOST_EXAMPLES", 3)
    with pytest.raises(ValueError, match="more than 3"):
        uf.coefficients(one)


def test_no_python_in_the_url_plan(spark):
    plan = uf.op6_url_filters(spark, table(spark, "/root/testdata/sf0.001", "pages"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "url:string>" in plan
