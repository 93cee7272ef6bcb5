"""DuckDB SQL of the operators' queries that SQL can express."""

from tessera.llm.licences import BASE, TEMPLATES, TOLERANCE

LOWER = "translate(coalesce({c}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACE = r"[\x20\x09-\x0D]"

OP13 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM docs),
keyed AS (SELECT *, {LOWER.format(c=f"regexp_replace(regexp_replace(line, '^{SPACE}+', ''), '{SPACE}+$', '')")} AS k FROM lines),
bad AS (SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT r, doc_id, line, place, bad.k IS NOT NULL AND doc_id <> last AS dropped FROM keyed LEFT JOIN bad USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

# CRC-32 over the bytes of a feature: the table by eight steps of its polynomial, then one look-up a byte
OP11 = rf"""
WITH RECURSIVE steps AS (
  SELECT CAST(range AS BIGINT) AS b, CAST(range AS BIGINT) AS c, 0 AS n FROM range(256)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n + 1 FROM steps WHERE n < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE n = 8),
texts AS (SELECT 's' AS side, row_number() OVER () AS r, doc_id, text FROM documents
          UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark),
words AS (SELECT side, r, doc_id, regexp_extract_all({LOWER.format(c='text')},
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
runs AS (SELECT side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
         FROM words),
codes AS (SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, octet_length(encode(f))),
                   lambda i: CAST(('0x' || substr(hex(encode(f)), 2 * i + 1, 2)) AS BIGINT))),
                   lambda a, x: xor(a >> 8, t[xor(a & 255, x) + 1])), 4294967295) % 10000 AS bucket
          FROM (SELECT DISTINCT f FROM runs), crc),
held AS (SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t
         FROM runs JOIN codes USING (f) GROUP BY bucket),
total AS (SELECT CAST(sum(s) + 10000 AS DOUBLE) AS s_all, CAST(sum(t) + 10000 AS DOUBLE) AS t_all FROM held),
gain AS (SELECT bucket, CAST(floor(1000 * ln(((t + 1) * s_all) / ((s + 1) * t_all))) AS BIGINT) AS g FROM held, total),
mean AS (SELECT r, CAST(floor(sum(g) / count(*)) AS BIGINT) AS weight, count(*) AS n
         FROM runs JOIN codes USING (f) JOIN gain USING (bucket) WHERE side = 's' GROUP BY r),
noise AS (SELECT r, doc_id, len(w) AS n_words,
                 CAST(('0x' || substr(sha256('7:' || doc_id), 1, 8)) AS BIGINT) AS h FROM words WHERE side = 's'),
scored AS (SELECT doc_id, n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score
           FROM noise LEFT JOIN mean USING (r)),
able AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS most
         FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CAST(CASE WHEN place <= 25 * most // 100 THEN place END AS BIGINT) AS rank FROM able
UNION ALL SELECT doc_id, n_features, weight, score, NULL FROM scored WHERE n_words < 20
"""

# set sizes and intersections by equal shingles; classes by spreading the smallest id
OP2 = rf"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all({LOWER.format(c='text')}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s
  FROM docs),
class AS (SELECT s, min(r) AS c, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
items AS (SELECT c, n, unnest(s) AS x FROM class),
pairs AS (SELECT a.c AS a, b.c AS b FROM items a JOIN items b ON a.x = b.x AND a.c < b.c
  WHERE 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs UNION ALL SELECT c, c FROM class),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
ids AS (SELECT c, min(doc_id) AS doc_id FROM sets JOIN class USING (s) GROUP BY c),
root AS (SELECT a AS c, min(doc_id) AS component_id FROM reach JOIN ids ON reach.b = ids.c GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM sets LEFT JOIN class USING (s) LEFT JOIN root USING (c)
"""

GOOD = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
WIDE = "list_transform(embedding, lambda x: CAST(x AS DOUBLE))"

OP4 = f"""
WITH RECURSIVE v AS (SELECT vec_id, {WIDE} AS e FROM embeddings
  WHERE {GOOD} AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AND vec_id IS NOT NULL),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id < b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
root AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
per AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN per USING (vec_id) LEFT JOIN root USING (vec_id)
"""

OP5 = f"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id,
  list_transform({WIDE}, lambda x: CAST(floor(64 * x) AS BIGINT)) AS e FROM embeddings WHERE {GOOD}),
scored AS (SELECT a.r, a.vec_id AS query_id, b.vec_id,
  CAST(list_inner_product(CAST(a.e AS DOUBLE[]), CAST(b.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r AND len(a.e) = len(b.e) WHERE a.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20
"""


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _licences() -> str:
    """Every phrase at every place; a template's starts joined within the tolerance."""
    base = ", ".join(f"({_text(p)}, {_text(label)})" for p, label in sorted(BASE.items()))
    templates, keys = [], []
    for t, (label, statement, phrases) in enumerate(TEMPLATES):
        templates.append(f"({t}, {_text(label)}, {_text(statement)}, {len(phrases)})")
        for k, p in enumerate(phrases):
            keys.append(f"({t}, {k}, {_text(p)}, {f' {statement} '.split(f' {p} ')[0].count(' ')})")
    return rf"""
WITH base(phrase, label) AS (VALUES {base}),
templates(t, label, statement, n_keys) AS (VALUES {", ".join(templates)}),
keys(t, k, phrase, place) AS (VALUES {", ".join(keys)}),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER.format(c='text')},
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
phrases AS (SELECT phrase, string_split(phrase, ' ') AS p FROM (SELECT phrase FROM base UNION SELECT phrase FROM keys)),
word AS (SELECT r, unnest(w) AS x, unnest(range(len(w))) AS i FROM docs),
first AS (SELECT r, phrase, p, i FROM word JOIN phrases ON x = p[1]),
stood AS (SELECT r, phrase, i FROM first JOIN docs USING (r) WHERE w[i + 1:i + len(p)] = p),
based AS (SELECT r, count(*) AS n, min(i) AS lo, max(i) AS hi, list(DISTINCT label) AS labels
          FROM stood JOIN base USING (phrase) GROUP BY r),
starts AS (SELECT r, t, k, i - place AS s FROM stood JOIN keys USING (phrase)),
near AS (SELECT a.r, a.t, a.s FROM starts a JOIN starts b ON a.r = b.r AND a.t = b.t AND abs(a.s - b.s) <= {TOLERANCE}
         JOIN templates ON templates.t = a.t WHERE a.k = 0 AND (b.k > 0 OR n_keys = 1)
         GROUP BY a.r, a.t, a.s, n_keys HAVING count(DISTINCT b.k) = greatest(1, n_keys - 1)),
own AS (SELECT r, label, len(list_filter(range(len(x)), lambda j: s + j >= 0 AND w[s + j + 1] = x[j + 1])) / len(x) AS share
        FROM (SELECT *, string_split(statement, ' ') AS x FROM near JOIN templates USING (t) JOIN docs USING (r))),
owned AS (SELECT r, max(share) AS best, list(DISTINCT label) AS labels FROM own GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word,
       coalesce(array_to_string(list_sort(based.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(based.labels, []), coalesce(owned.labels, [])))), ','), '')
         AS labels,
       CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM docs LEFT JOIN based USING (r) LEFT JOIN owned USING (r)
"""


ORACLES = {"op2_shingle_join": OP2, "op3_licences": _licences(), "op4_vector_dedup": OP4, "op5_topk": OP5, "op11_resampling": OP11,
           "op13_line_dedup": OP13}
