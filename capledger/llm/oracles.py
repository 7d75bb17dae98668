"""DuckDB SQL that registered queries of this package must agree with."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: str) -> str:
    """A-Z lower-cased, other letters left alone."""
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


def _components(links: str) -> str:
    """Common table expressions ``reach`` and ``roots`` (node, root) over ``links`` (a, b), which holds both directions."""
    return f"""
reach AS (SELECT DISTINCT a AS node, a AS other FROM {links} UNION SELECT r.node, l.b FROM reach r JOIN {links} l ON r.other = l.a),
roots AS (SELECT node, min(other) AS root FROM reach GROUP BY node)"""


URL_FILTER = f"""
WITH rules(verdict, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), urls AS (
  SELECT page_id, {_lower(r"regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)', 1)")} AS host,
    regexp_extract(coalesce(url, ''), '(?s)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), judged AS (
  SELECT u.*, (SELECT {{'rule': r.host || r.path, 'verdict': r.verdict}} FROM rules r
    WHERE (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
    ORDER BY length(r.host || r.path) DESC, length(r.host) DESC LIMIT 1) AS best
  FROM urls u
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM judged
"""

WARC = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id FROM payloads
)
SELECT page_id, strlen(payload) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((('0x' || substr(digest, 1 + (i // 4) * 5, 5))::BIGINT >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)), '') AS payload_digest,
  CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id < page_id THEN first_id END AS refers_to, true AS intact
FROM firsts
"""

GRID_JOIN = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y
  ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.98
), {_components("links")}
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON vec_id = a LEFT JOIN roots ON vec_id = node
"""

MINHASH = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM words
), sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle JOIN sizes m ON m.doc_id = x.doc_id JOIN sizes n ON n.doc_id = y.doc_id
  WHERE x.doc_id < y.doc_id AND 100 * least(m.n, n.n) >= 80 * greatest(m.n, n.n) GROUP BY 1, 2
), pairs AS (
  SELECT a, b FROM shared JOIN sizes m ON m.doc_id = a JOIN sizes n ON n.doc_id = b WHERE 100 * n_both >= 80 * (m.n + n.n - n_both)
), links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs), {_components("links")}
SELECT doc_id, n AS n_shingles, coalesce(root, doc_id) AS component_id, coalesce(root, doc_id) = doc_id AS kept
FROM sizes LEFT JOIN roots ON doc_id = node
"""

LICENSE_BASE = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), places AS (
  SELECT doc_id, len(w) AS n_words,
    list_filter(range(1, len(w) + 1), lambda i: w[i] = 'mit' AND w[i + 1] = 'license') AS mit,
    list_filter(range(1, len(w) + 1), lambda i: w[i] = 'apache' AND w[i + 1] = 'license') AS apache,
    list_filter(range(1, len(w) + 1), lambda i: w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license') AS gpl
  FROM words
)
SELECT doc_id, n_words, len(mit) + len(apache) + len(gpl) AS n_base, list_min(mit || apache || gpl) - 1 AS first_word,
  list_max(mit || apache || gpl) - 1 AS last_word,
  array_to_string(list_filter([CASE WHEN len(apache) > 0 THEN 'apache' END, CASE WHEN len(gpl) > 0 THEN 'gpl' END,
    CASE WHEN len(mit) > 0 THEN 'mit' END], lambda x: x IS NOT NULL), ',') AS base_labels
FROM places
"""

SECRET_BASE = r"""
SELECT doc_id,
  len(list_filter(regexp_extract_all(coalesce(text, ''),
    '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2), lambda x: length(x) >= 6)) AS n_assign,
  len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 20)) AS n_access,
  len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: length(x) >= 24)) AS n_hex
FROM documents
"""
