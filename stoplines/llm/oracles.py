"""SQL counterparts, for DuckDB, of the queries that SQL can express."""

from stoplines.llm.secrets import RULES, Rule

# Words of lower-cased texts, with their places.
OP7 = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, sizes WHERE len(w) >= n)),
found AS (SELECT doc_id, i, n, item_id FROM doc_windows JOIN windows USING (n, win)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# Vectors linked within their label, and what each reaches.
OP2 = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
usable AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND list_count(e) = len(e) AND isfinite(list_sum(e)) AND list_dot_product(e, e) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id, vec_id AS r FROM v UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.r = links.a),
component AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN component USING (vec_id) LEFT JOIN degree USING (vec_id)
"""

OP3 = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM doc WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT p.a, p.b FROM pairs p JOIN sizes x ON p.a = x.doc_id JOIN sizes y ON p.b = y.doc_id WHERE 100 * p.n >= 85 * (x.n + y.n - p.n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM doc UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a),
component AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM doc JOIN component USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

OP5 = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM doc WHERE len(w) >= 13)),
smallest AS (SELECT g, min(doc_id) AS d FROM windows GROUP BY g),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM windows JOIN smallest USING (g) WHERE d < doc_id)),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM doc),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""

# Digests of leaves, levels of the trees of groups and of their roots, and each leaf's way up through both.
OP11 = """
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, sha256(d || s || l || n || t) AS leaf,
    CASE WHEN c % 7 = 0 THEN sha256(d || s || l || coalesce(len((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || t)
    ELSE sha256(d || s || l || n || t) END AS own
  FROM (
    SELECT doc_id, lang, n_chars,
      coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') AS d, coalesce(strlen(source) || ':' || source, '-') AS s,
      coalesce(strlen(lang) || ':' || lang, '-') AS l, coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS n,
      coalesce(strlen(text) || ':' || text, '-') AS t,
      xor(4294967295, list_reduce(
        list_transform(range(strlen(doc_id::VARCHAR)), lambda i: ord(substr(CAST(doc_id AS VARCHAR), CAST(i + 1 AS INT), 1))),
        lambda crc, byte: list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, byte)),
        4294967295)) AS c
    FROM documents)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS total
  FROM leaves),
tree AS (
  SELECT lang, 0 AS level, place, total, leaf AS node FROM placed
  UNION ALL
  SELECT DISTINCT lang, level + 1, place // 2, (total + 1) // 2, sha256(string_agg(node, '') OVER (
      PARTITION BY lang, place // 2 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
  FROM tree WHERE total > 1),
subroots AS (
  SELECT lang, node AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS place, count(*) OVER () AS total
  FROM tree WHERE total = 1),
top AS (
  SELECT 0 AS level, place, total, subroot AS node FROM subroots
  UNION ALL
  SELECT DISTINCT level + 1, place // 2, (total + 1) // 2, sha256(string_agg(node, '') OVER (
      PARTITION BY place // 2 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
  FROM top WHERE total > 1),
height AS (SELECT lang, max(level) AS height FROM tree GROUP BY lang),
-- One row for each leaf and level, through both trees: the sibling, if there is one, and its side.
steps AS (
  SELECT p.lang, p.place AS first, t.level, t.place AS own_place, s.place AS other, s.node AS sibling
  FROM placed p JOIN tree t ON t.lang IS NOT DISTINCT FROM p.lang AND t.place = p.place >> t.level AND t.total > 1
  LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM t.lang AND s.level = t.level AND s.place = xor(t.place, 1)
  UNION ALL
  SELECT p.lang, p.place, h.height + t.level, t.place, s.place, s.node
  FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang JOIN height h ON h.lang IS NOT DISTINCT FROM p.lang
  JOIN top t ON t.place = r.place >> t.level AND t.total > 1
  LEFT JOIN top s ON s.level = t.level AND s.place = xor(t.place, 1)),
proofs AS (SELECT lang, first, string_agg(sibling, '' ORDER BY level) AS siblings FROM steps GROUP BY lang, first),
fold AS (
  SELECT lang, place, 0 AS level, own AS node FROM placed
  UNION ALL
  SELECT f.lang, f.place, f.level + 1, sha256(CASE WHEN other IS NULL THEN node WHEN other < own_place THEN sibling || node ELSE node || sibling END)
  FROM fold f JOIN steps s ON s.lang IS NOT DISTINCT FROM f.lang AND s.first = f.place AND s.level = f.level),
last AS (SELECT lang, place, arg_max(node, level) AS folded_root FROM fold GROUP BY lang, place),
root AS (SELECT node AS root FROM top WHERE total = 1)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang JOIN last l ON l.lang IS NOT DISTINCT FROM p.lang AND l.place = p.place
LEFT JOIN proofs q ON q.lang IS NOT DISTINCT FROM p.lang AND q.first = p.place, root
"""



def _matches(order: int, rule: Rule) -> str:
    """One row for each match of a rule: what stands before it, the match, and the value that must be long enough."""
    pattern = rule.pattern.replace("'", "''")
    every = f"regexp_extract_all(t, '{pattern}', 0)"
    return f"""
  SELECT doc_id, {order} AS k, '{rule.kind}' AS kind, {rule.at_least} AS least, unnest({every}) AS m,
    unnest(regexp_extract_all(t, '{pattern}', {rule.value})) AS v, unnest(string_split_regex(t, '{pattern}')[1 : len({every})]) AS gap,
    unnest(range(len({every}))) AS i FROM doc WHERE regexp_matches(t, '{pattern}')"""


# Matches of each rule, and their places from the lengths of all that stands before.
OP10 = f"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(_matches(order, rule) for order, rule in enumerate(RULES))}),
placed AS (SELECT *, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, k ORDER BY i) AS BIGINT) AS e FROM found),
spans AS (SELECT doc_id, k, kind, e - length(m) AS s, kind || ':' || (e - length(m)) || ':' || e AS span FROM placed WHERE length(v) >= least),
listed AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c, count(*) FILTER (kind = 'hex') AS h,
    string_agg(span, ',' ORDER BY s, k) FILTER (k < 3) AS base, string_agg(span, ',' ORDER BY s, k) AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(c, 0) AS BIGINT) AS n_access, CAST(coalesce(h, 0) AS BIGINT) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN listed USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op2_spherical_cells": OP2,
    "op3_minhash_near_duplicates": OP3,
    "op5_super_kmer_repeats": OP5,
    "op7_suffix_array_decontamination": OP7,
    "op10_trigram_secrets": OP10,
    "op11_persistent_merkle_manifest": OP11,
}
