"""DuckDB SQL of the training-data queries that SQL can express on whole tables."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
#: Fixed values, as in the operator's own table: ratio, numerator, denominator, scale, least
#: spread, whether it has a lower and an upper fence.
RATIOS = [
    ("word_length", "word_chars", "n_words", 100, 100, True, True),
    ("symbols", "n_symbols", "n_words", 1000, 60, False, True),
    ("dup_lines", "n_dup_lines", "n_lines", 1000, 150, False, True),
    ("repeats", "n_repeat_words", "n_words", 1000, 120, False, True),
]
MIN_DOCUMENTS = 100


def _quality_rules() -> str:
    values = ", ".join(f"({s} * {top}) // greatest({bottom}, 1) AS v_{name}" for name, top, bottom, s, *_ in RATIOS)
    bins = "\n      UNION ALL ".join(
        f"SELECT lang, source, '{name}' AS ratio, (v_{name} >> greatest(length(bin(v_{name})) - 6, 0)) "
        f"<< greatest(length(bin(v_{name})) - 6, 0) AS bin FROM measured WHERE NOT base_failed"
        for name, *_ in RATIOS
    )
    quart = "list_sort(list(bin))[(count(*) + 3) // 4] AS q25, list_sort(list(bin))[(3 * count(*) + 3) // 4] AS q75, count(*) AS docs"
    least = " ".join(f"WHEN '{name}' THEN {spread}" for name, _, _, _, spread, *_ in RATIOS)
    bad = []
    for name, *_, low, high in RATIOS:
        sides = [f"v_{name} < lo_{name}"] * low + [f"v_{name} > hi_{name}"] * high
        bad.append(f"CASE WHEN coalesce({' OR '.join(sides)}, false) THEN '{name}' END")
    picks = ", ".join(
        f"max(CASE WHEN ratio = '{name}' THEN q25 - 3 * spread END) AS lo_{name}, "
        f"max(CASE WHEN ratio = '{name}' THEN q75 + 3 * spread END) AS hi_{name}"
        for name, *_ in RATIOS
    )
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
    cut AS (SELECT *, regexp_extract_all(t, '{WORD}') AS w,
                   list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM docs),
    windows AS (SELECT rid, i, w[i:i + 2] AS win
                FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM cut) x),
    twice AS (SELECT rid, win FROM windows GROUP BY rid, win HAVING count(*) > 1),
    covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM windows JOIN twice USING (rid, win),
                       (VALUES (0), (1), (2)) s(k) GROUP BY rid),
    counts AS (
      SELECT rid, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines
      FROM cut LEFT JOIN covered USING (rid)),
    measured AS (
      SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {values} FROM counts),
    bins AS ({bins}),
    own AS (SELECT lang, source, ratio, {quart} FROM bins GROUP BY lang, source, ratio),
    by_lang AS (SELECT lang, ratio, {quart} FROM bins GROUP BY lang, ratio),
    overall AS (SELECT ratio, {quart} FROM bins GROUP BY ratio),
    chosen AS (
      SELECT o.lang, o.source, o.ratio,
             CASE WHEN o.docs >= {MIN_DOCUMENTS} THEN o.q25 WHEN l.docs >= {MIN_DOCUMENTS} THEN l.q25 ELSE a.q25 END AS q25,
             CASE WHEN o.docs >= {MIN_DOCUMENTS} THEN o.q75 WHEN l.docs >= {MIN_DOCUMENTS} THEN l.q75 ELSE a.q75 END AS q75
      FROM own o JOIN by_lang l ON o.lang IS NOT DISTINCT FROM l.lang AND o.ratio = l.ratio
                 JOIN overall a ON o.ratio = a.ratio),
    spreads AS (SELECT *, greatest(q75 - q25, CASE ratio {least} END) AS spread FROM chosen),
    fences AS (SELECT lang, source, {picks} FROM spreads GROUP BY lang, source),
    judged AS (
      SELECT m.*, concat_ws(',', {', '.join(bad)}) AS failed
      FROM measured m LEFT JOIN fences f ON m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND failed = '' AS kept, CASE WHEN base_failed THEN '' ELSE failed END AS failed_ratios
    FROM judged"""


_JACCARD = f"""
    WITH RECURSIVE docs AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                  'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
      FROM documents),
    shingles AS (
      SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') || ' ' || CAST(least(len(w), 5) AS VARCHAR) AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0) x),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (SELECT s FROM shingles GROUP BY s HAVING count(*) > 1),
    common AS (SELECT doc_id, s FROM shingles JOIN shared USING (s)),
    met AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
            FROM common a JOIN common b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
    links AS (SELECT x, y FROM met JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id
              WHERE 100 * c >= 80 * (p.n + q.n - c)),
    edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reach(doc_id, other) AS (
      SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM reach r JOIN edges e ON r.other = e.x)
    SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
    FROM documents d LEFT JOIN sizes USING (doc_id)
    JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)"""

_TOPK = """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
    ranked AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""

ORACLE_SQL: dict[str, str] = {
    "op4_quality_rules": _quality_rules(),
    "op7_jaccard_join": _JACCARD,
    "op9_topk_search": _TOPK,
}
