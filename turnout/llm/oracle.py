"""DuckDB SQL for the queries of this subpackage that SQL can express, written from the definitions.

Tokenisers, trained models, extraction, SimHash (its hash is not in DuckDB), spans that need look-around and
eigenvectors have none; tests/llm holds those against plain versions.
"""

from __future__ import annotations

LETTERS = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACES = r"[^\x20\x09-\x0D]+"

CONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LETTERS}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({LETTERS}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS k
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS k
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT DISTINCT dw.doc_id, dw.p, dw.n, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.k = iw.k),
hits AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY doc_id),
names AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS listed
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(n.listed, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits h USING (doc_id) LEFT JOIN names n USING (doc_id)
"""

# a repeated run is a diagonal of equal lines, as long as it goes, of 50 words or more
LINE_DEDUP = rf"""
WITH l AS (SELECT doc_id, unnest(x) AS line, unnest(range(0, len(x))) AS k
           FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL)),
c AS (SELECT doc_id, k, array_to_string(w, ' ') AS line, len(w) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS i
      FROM (SELECT doc_id, k, regexp_extract_all(line, '{SPACES}') AS w FROM l) WHERE len(w) > 0),
eq AS (SELECT b.doc_id, b.i, b.k, b.n, a.doc_id AS of, b.i - a.i AS shift, b.i - row_number() OVER (PARTITION BY b.doc_id, a.doc_id, b.i - a.i ORDER BY b.i) AS g
       FROM c a JOIN c b ON a.line = b.line AND (a.doc_id < b.doc_id OR a.doc_id = b.doc_id AND a.i < b.i)),
run AS (SELECT doc_id, of, shift, g, min(k) AS first, max(k) AS last FROM eq GROUP BY doc_id, of, shift, g HAVING sum(n) >= 50),
gone AS (SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS k FROM run),
runs AS (SELECT doc_id, min(k) AS a, max(k) AS b FROM (SELECT doc_id, k, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS g FROM gone)
         GROUP BY doc_id, g),
listed AS (SELECT doc_id, string_agg(a || '-' || b, ',' ORDER BY a) AS runs, sum(b - a + 1) AS n FROM runs GROUP BY doc_id),
kept AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.k) AS text FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.k = g.k
         WHERE g.k IS NULL GROUP BY l.doc_id),
sizes AS (SELECT doc_id, count(*) AS n FROM l GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_deleted, coalesce(r.runs, '') AS runs,
       CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN listed r USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

# crc32 by its table, over the distinct words
IMPORTANCE = rf"""
WITH tab AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
                    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT doc_id, regexp_extract_all({LETTERS}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT regexp_extract_all({LETTERS}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
words AS (SELECT DISTINCT unnest(w) AS word FROM (SELECT w FROM d UNION ALL SELECT w FROM i)),
bytes AS (SELECT word, list_transform(range(length(h) // 2), lambda k: CAST('0x' || substr(h, 2 * k + 1, 2) AS BIGINT)) AS b
          FROM (SELECT word, hex(encode(word)) AS h FROM words)),
hashed AS (SELECT word, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
           FROM bytes, tab),
dw AS (SELECT doc_id, bucket FROM (SELECT doc_id, unnest(w) AS word FROM d) JOIN hashed USING (word)),
s AS (SELECT bucket, count(*) AS s FROM dw GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM (SELECT unnest(w) AS word FROM i) JOIN hashed USING (word) GROUP BY bucket),
gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)
                / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)))) AS BIGINT) AS g
         FROM s FULL JOIN t USING (bucket)),
mean AS (SELECT doc_id, CAST(floor(sum(g) / count(*)) AS BIGINT) AS weight FROM dw JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                  / 4294967296))) AS BIGINT) AS score
           FROM d LEFT JOIN mean USING (doc_id)),
drawn AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT scored.doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank
FROM scored LEFT JOIN drawn USING (doc_id)
"""

NEAR_VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
fine AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS size FROM v
         WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda c: c IS NULL OR NOT isfinite(c))) = 0
           AND len(list_filter(e, lambda c: c != 0)) > 0),
pair AS (SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id != b.vec_id
         WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.93),
reach AS (SELECT vec_id, vec_id AS to_id FROM v UNION SELECT reach.vec_id, pair.b FROM reach JOIN pair ON reach.to_id = pair.a),
comp AS (SELECT vec_id, min(to_id) AS component_id FROM reach GROUP BY vec_id),
links AS (SELECT a AS vec_id, count(*) AS n FROM pair GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM comp LEFT JOIN links USING (vec_id)
"""

# votes: rule -> (bad, good); the values are the operator's parameters
_RULES = {
    "length": ("n_words < 50", "n_words >= 100"),
    "word_length": ("word_chars < 3 * n_words OR word_chars > 6.5 * n_words", "word_chars >= 3.5 * n_words AND word_chars <= 6 * n_words"),
    "symbols": ("n_symbols > 0.05 * word_chars", "n_symbols <= 0.005 * word_chars"),
    "bars": ("n_bars > 0.05 * n_words", "n_bars = 0"),
    "repeated_lines": ("n_dup_lines > 0.5 * n_lines", "n_dup_lines = 0"),
    "repeated_words": ("n_repeat_words > 0.3 * n_words", "n_repeat_words <= 0.05 * n_words"),
    "capitals": ("n_capitals > 0.25 * word_chars", "n_capitals <= 0.1 * word_chars"),
    "shouting": ("n_shouts > 0.05 * n_words", "n_shouts = 0"),
}
_START, _GOOD, _BAD, _PRIOR, _STEPS = 0.85, (0.01, 0.9), (0.35, 0.5), 0.1, 12


def _quality() -> str:
    rules = list(_RULES)
    parts = [rf"""
d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{SPACES}') AS w FROM documents),
three AS (SELECT doc_id, p, array_to_string(w[p:p + 2], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) > 2)),
twice AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM three) WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 3)) AS q FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(DISTINCT x) AS u FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d)
          WHERE regexp_matches(x, '{SPACES}') GROUP BY doc_id),
s AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(l.n - l.u, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, coalesce(l.n, 0) AS n_lines,
             len(list_filter(w, lambda x: x = '|')) AS n_bars, length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS n_capitals,
             (length(t) - length(replace(t, '!!', ''))) // 2 AS n_shouts
      FROM d LEFT JOIN lines l USING (doc_id) LEFT JOIN repeats r USING (doc_id)),
v AS (SELECT *, {", ".join(f"CASE WHEN {b} THEN 0 WHEN {g} THEN 1 END AS {r}" for r, (b, g) in _RULES.items())} FROM s),
pat AS (SELECT {", ".join(rules)}, count(*) AS n FROM v GROUP BY ALL),
m0 AS (SELECT {_START}::DOUBLE AS share, {", ".join(f"{_GOOD[k]}::DOUBLE AS g_{r}_{k}, {_BAD[k]}::DOUBLE AS b_{r}_{k}" for r in rules for k in (0, 1))})"""]

    def posterior(src: str) -> str:
        terms = [f"ln({src}.share / (1 - {src}.share))"] + [
            f"CASE {r} WHEN 0 THEN ln({src}.g_{r}_0 / {src}.b_{r}_0) WHEN 1 THEN ln({src}.g_{r}_1 / {src}.b_{r}_1) "
            f"ELSE ln((1 - {src}.g_{r}_0 - {src}.g_{r}_1) / (1 - {src}.b_{r}_0 - {src}.b_{r}_1)) END" for r in rules]
        return f"1 / (1 + exp(-({' + '.join(terms)})))"

    for step in range(1, _STEPS + 1):
        old = f"m{step - 1}"
        parts.append(f"p{step} AS (SELECT pat.*, pat.n * ({posterior(old)}) AS g FROM pat, {old})")
        pull = f"{_PRIOR} * sum(n)"
        rates = ", ".join(
            f"(coalesce(sum(g) FILTER ({r} = {k}), 0) + {pull} * {_GOOD[k]}) / (sum(g) + {pull}) AS g_{r}_{k}, "
            f"(coalesce(sum(n - g) FILTER ({r} = {k}), 0) + {pull} * {_BAD[k]}) / (sum(n) - sum(g) + {pull}) AS b_{r}_{k}"
            for r in rules for k in (0, 1))
        parts.append(f"m{step} AS MATERIALIZED (SELECT (sum(g) + {pull} * {_START}) / (sum(n) + {pull}) AS share, {rates} FROM p{step})")
    failed = "(n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {failed} AS base_failed, {posterior(f"m{_STEPS}")} AS probability,
       NOT {failed} AND {posterior(f"m{_STEPS}")} >= 0.5 AS kept
FROM v, m{_STEPS}"""


def all_sql() -> dict[str, str]:
    return {"op3_quality_rules": _quality(), "op8_line_dedup": LINE_DEDUP, "op10_benchmark_decontamination": CONTAMINATION,
            "op11_embedding_near_dedup": NEAR_VECTORS, "op12_importance_resampling": IMPORTANCE}
