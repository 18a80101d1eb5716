"""DuckDB SQL for the registered queries that SQL can express, written out on its own."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op1_url_filter"] = """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
raw AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM cut),
split AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM raw),
rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
hits AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
  FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT page_id, host, path, rule,
       COALESCE(rule_verdict, CASE WHEN regexp_matches(host, '(^|[.-])(ads|bets|casino|pills|spam)([.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM split LEFT JOIN hits USING (page_id)
"""

ORACLE_SQL["op2_quality_rules"] = r"""
WITH d AS (SELECT doc_id, source, COALESCE(text, '') AS text FROM documents),
w AS (SELECT doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
windows AS (
  SELECT doc_id, i, list_aggregate(ws[i:i + 4], 'string_agg', ' ') AS win
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM w WHERE len(ws) >= 5) x),
twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) x WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(generate_series(0, 4)) AS k) t GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) x
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT w.doc_id, w.source, len(ws)::BIGINT AS n_words,
         COALESCE(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         COALESCE(lines.n, 0)::BIGINT AS n_dup_lines, COALESCE(covered.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM b WHERE source IS NOT NULL GROUP BY source),
t AS (SELECT sum(n) AS all_n, count(*) AS hosts, sum(f) / sum(n) AS mean, sum(f * f / n) / sum(n) AS square FROM h),
p AS (
  SELECT mean, CASE WHEN square - mean * mean - mean * (1 - mean) * hosts / all_n > 1e-9
                    THEN greatest(mean * (1 - mean) / (square - mean * mean - mean * (1 - mean) * hosts / all_n) - 1, 1)
                    ELSE 1e6 END AS k FROM t),
r AS (SELECT source, (f + mean * k) / (n + k) AS rate FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT COALESCE(rate > 0.5, false) AS kept
FROM b LEFT JOIN r USING (source)
"""

ORACLE_SQL["op7_norm_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.w, v.w)::BIGINT AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLE_SQL["op11_decontamination"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
w AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS size, array_to_string(ws[i:i + 9], ' ') AS win
  FROM (SELECT item_id, ws, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS i FROM b WHERE len(ws) > 0) x),
spots AS (
  SELECT k, i, size, array_to_string(ws[i:i + size - 1], ' ') AS win
  FROM (SELECT k, ws, size, unnest(generate_series(1, len(ws) - size + 1)) AS i FROM d, (SELECT DISTINCT size FROM w) s WHERE len(ws) >= size) x),
hits AS (SELECT k, i, spots.size, item_id FROM spots JOIN w USING (win)),
covered AS (
  SELECT k, count(DISTINCT word) AS n FROM (SELECT k, unnest(generate_series(i, i + size - 1)) AS word FROM hits) x GROUP BY k),
items AS (
  SELECT k, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT k, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) x GROUP BY k)
SELECT doc_id, len(ws)::BIGINT AS n_words, COALESCE(covered.n, 0)::BIGINT AS n_hit, COALESCE(items.n, 0)::BIGINT AS n_items,
       sha256(COALESCE(ids, '')) AS items_sha256, covered.n IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (k) LEFT JOIN items USING (k)
"""


def _vector_codes(parts: int, entries: int, rounds: int) -> str:
    """Codebooks as rows (part, entry, place, number); every round assigns all parts and takes means anew."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""
near{n} AS (
  SELECT r, p, arg_min(entry, dist * {entries} + entry) AS entry, min(dist) AS dist
  FROM (SELECT x.r, x.p, entry, sum((x.c - book{n}.c) * (x.c - book{n}.c)) AS dist
        FROM x JOIN book{n} ON book{n}.p = x.p AND book{n}.j = x.j GROUP BY x.r, x.p, entry) y GROUP BY r, p)""")
        if n < rounds:
            steps.append(f"""
book{n + 1} AS (
  SELECT p, entry, j, COALESCE(m.c, book{n}.c) AS c
  FROM book{n} LEFT JOIN (
    SELECT p, entry, j, floor(sum(x.c)::DOUBLE / count(*))::BIGINT AS c FROM x JOIN near{n} USING (r, p) GROUP BY p, entry, j) m
  USING (p, entry, j))""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS (
  SELECT r, (i - 1) // (len(v) // {parts}) AS p, (i - 1) % (len(v) // {parts}) AS j, v[i] AS c
  FROM (SELECT r, v, unnest(generate_series(1, len(v))) AS i FROM kept) y),
book0 AS (SELECT p, r - 1 AS entry, j, c FROM x WHERE r <= {entries}),
{",".join(steps)},
coded AS (
  SELECT r, string_agg(printf('%02x', entry), '' ORDER BY p) AS code, sum(dist)::BIGINT AS error FROM near{rounds} GROUP BY r),
digest AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, entry, j)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest
"""


ORACLE_SQL["op12_vector_codes"] = _vector_codes(parts=16, entries=64, rounds=2)


def _merkle(levels: int) -> str:
    """Tables of nodes level by level; a tree of one node stays as it is. ``levels`` are more than any tree has."""
    def field(name: str) -> str:
        return f"COALESCE(strlen({name}::VARCHAR) || ':' || {name}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join([*map(field, ("doc_id", "source", "lang", "n_chars")), text]) + ")"

    def tree(name: str, of: str) -> str:
        steps = [of]
        for n in range(levels):
            below = f"{name}{n}"
            steps.append(f"""
{name}{n + 1} AS (
  SELECT tree, idx // 3 AS idx, CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY idx)) END AS digest,
         any_value((n + 2) // 3) AS n, string_agg(digest, '' ORDER BY idx) AS run FROM {below} GROUP BY tree, idx // 3)""")
        return ",".join(steps)

    def folded(name: str, rows: str) -> str:
        """One level after another: the siblings so far, and the digest with the row's own put in its place."""
        left, right = "substr(u.run, 1, 64 * (b.idx % 3)::INT)", "substr(u.run, 64 * (b.idx % 3)::INT + 65)"
        return ",".join(f"""
{name}_to{n + 1} AS (
  SELECT r.* EXCLUDE (proof, folded), CASE WHEN b.n = 1 THEN proof ELSE proof || {left} || {right} END AS proof,
         CASE WHEN b.n = 1 THEN folded ELSE sha256({left} || folded || {right}) END AS folded
  FROM {name + '_to' + str(n) if n else rows} r JOIN {name}{n} b ON b.tree = r.{name}_tree AND b.idx = r.{name}_idx // {3**n}
  JOIN {name}{n + 1} u ON u.tree = b.tree AND u.idx = b.idx // 3)""" for n in range(levels))

    crc = 0xEDB88320
    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY byte) AS t FROM (
    SELECT byte, list_reduce(list_prepend(byte, generate_series(1, 8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {crc}::BIGINT) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(generate_series(0::BIGINT, 255)) AS byte) b) x),
keyed AS (
  SELECT doc_id, source, {leaf(field('text'))} AS leaf,
         CASE WHEN xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
                                   lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 2 = 0
              THEN {leaf(field("replace(text, chr(10), '')"))} ELSE {leaf(field('text'))} END AS tampered
  FROM documents, crc_table),
rows AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS low_tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS low_idx,
         '' AS proof, tampered AS folded FROM keyed),
{tree("low", "low0 AS (SELECT low_tree AS tree, low_idx AS idx, leaf AS digest, count(*) OVER (PARTITION BY low_tree) AS n FROM rows)")},
{tree("top", f"top0 AS (SELECT 0 AS tree, tree AS idx, digest, count(*) OVER () AS n FROM low{levels})")},
{folded("low", "rows")},
subroots AS (
  SELECT doc_id, leaf, digest AS subroot, 0 AS top_tree, low_tree AS top_idx, proof, folded
  FROM low_to{levels} JOIN low{levels} ON tree = low_tree),
{folded("top", "subroots")}
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified
FROM top_to{levels}, top{levels}
"""


ORACLE_SQL["op13_merkle_manifest"] = _merkle(levels=14)
