"""DuckDB twins of the registered queries that SQL can express."""

from __future__ import annotations

from crashlens.llm.mixing import MAX_REPEATS, SLOPES, WEIGHTS
from crashlens.llm.quality import RULES, STOP_WORDS, SYMBOLS

_BREAKS = r"[\x20\x09-\x0D]"


def _quality_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    symbols = "[" + "".join("\\" + c for c in SYMBOLS) + "]"
    tests = []
    for r in RULES:
        bounds = ([f"{r.measure} >= {r.low}"] if r.low is not None else []) + ([f"{r.measure} <= {r.high}"] if r.high is not None else [])
        tests.append(f"CASE WHEN NOT ({' AND '.join(bounds)}) THEN '{r.measure}' END")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '{_BREAKS}+'), lambda x: x <> '') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '{_BREAKS}', '', 'g') <> '') AS l FROM d),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda k: [w[k], w[k + 1], w[k + 2]])) AS g FROM w WHERE len(w) >= 3),
s AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n >= 2),
r AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, i FROM s UNION SELECT doc_id, i + 1 FROM s UNION SELECT doc_id, i + 2 FROM s) GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '{_BREAKS}', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '{symbols}', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS BIGINT) AS n_stop_words
      FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
v AS (SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
             CASE WHEN word_chars > 0 THEN n_symbols * 100.0::DOUBLE / word_chars ELSE 0 END AS symbol_pct,
             CASE WHEN n_words > 0 THEN n_stop_words * 100.0::DOUBLE / n_words ELSE 0 END AS stop_word_pct,
             CASE WHEN n_lines > 0 THEN n_dup_lines * 100.0::DOUBLE / n_lines ELSE 0 END AS dup_line_pct,
             CASE WHEN n_words > 0 THEN n_repeat_words * 100.0::DOUBLE / n_words ELSE 0 END AS repeat_word_pct FROM m),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, concat_ws(',', {', '.join(tests)}) AS failed_rules FROM v)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules FROM f"""


def _suffix_sql() -> str:
    """Every 50-byte string and the smallest document it starts in; bytes within 49 behind the start of one
    that starts in a smaller document go."""
    return """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, CAST(unnest(range(0, CAST(length(h) / 2 AS BIGINT))) AS BIGINT) AS i, h FROM d),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS byte, CASE WHEN 2 * i + 100 <= length(h) THEN substr(h, 2 * i + 1, 100) END AS s FROM b),
m AS (SELECT *, coalesce(s IS NOT NULL AND doc_id > min(doc_id) OVER (PARTITION BY s), false) AS hit FROM w),
c AS (SELECT doc_id, i, byte, bool_or(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM m),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS span FROM c),
k AS (SELECT doc_id, count_if(gone) AS n_removed, count_if(span) AS n_spans,
             coalesce(string_agg(byte, '' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept FROM e GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id"""


def _join_sql() -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array({lower}, '{_BREAKS}+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])
                                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT x, y FROM i JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 90 * (a.n + b.n - i)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT doc_id AS v, doc_id AS c FROM w UNION SELECT e.y, r.c FROM r JOIN e ON r.v = e.x)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, (SELECT min(c) FROM r WHERE r.v = w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id"""


def _pick(values: tuple[float, ...]) -> str:
    return f"CASE place % {len(values)} " + " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(values)) + " END::DOUBLE"


def _mix_sql() -> str:
    earlier = "OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""
WITH d AS (SELECT doc_id, source, md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
                  CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '{_BREAKS}+'), lambda x: x <> '')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
p AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place FROM s),
q AS (SELECT *, {_pick(WEIGHTS)} AS weight, {_pick(SLOPES)} AS slope, source_size * {float(MAX_REPEATS)}::DOUBLE AS cap, CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM p),
l AS (SELECT *, (total - coalesce(sum(cap) {earlier}, 0)) / (sum(weight) OVER () - coalesce(sum(weight) {earlier}, 0)) AS level FROM q),
t AS (SELECT *, least(cap, coalesce((SELECT level FROM l WHERE level * weight <= cap ORDER BY cap / weight, place LIMIT 1) * weight, cap)) AS target FROM l),
b AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM d),
j AS (SELECT b.*, source_size, target, slope, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, CASE WHEN size > 0 THEN CAST(least(whole + CASE WHEN before + size / 2.0 <= target - whole * source_size THEN 1 ELSE 0 END, {MAX_REPEATS}) AS BIGINT) ELSE 0 END AS copies,
             CASE WHEN target > 0 THEN least(1.0, (before + size / 2.0) / target) ELSE 0.0 END AS share FROM j)
SELECT doc_id, size, source_size, round(target, 6) AS target, CAST(copies * size AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies,
       round(CASE WHEN copies > 0 THEN CASE WHEN slope = 0 THEN share ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * share) - (1 - slope)) / (2 * slope) END END, 9) AS position
FROM c"""


def _search_sql() -> str:
    found = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {found} AS t FROM documents),
s AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM d WHERE len(t) > 0),
p AS (SELECT r, doc_id, m, term, CAST(count(*) AS BIGINT) AS tf
      FROM (SELECT r, doc_id, 100 - 25 + (25 * len(t) * s.n) // s.l AS m, unnest(t) AS term FROM d, s) GROUP BY ALL),
q AS (SELECT i, item_id, term, CAST(count(*) AS BIGINT) AS k
      FROM (SELECT row_number() OVER () AS i, item_id, unnest({found}) AS term FROM benchmark) GROUP BY ALL),
f AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(s.n) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, s GROUP BY term),
x AS (SELECT i, item_id, doc_id, r, CAST(sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM q JOIN p USING (term) JOIN f USING (term) GROUP BY i, item_id, doc_id, r),
y AS (SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM x WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM y WHERE rank <= 20"""


def oracle_sql() -> dict[str, str]:
    return {"op1_suffix_dedup": _suffix_sql(), "op2_quality_rules": _quality_sql(), "op3_ngram_join": _join_sql(), "op10_mixing": _mix_sql(),
            "op13_lexical_treap": _search_sql()}
