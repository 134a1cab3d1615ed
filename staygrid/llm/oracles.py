"""SQL that says the same as three of the queries, by brute force; for small tables."""

from __future__ import annotations

SUBSTRINGS = r"""
WITH words AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM starts),
flagged AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY s) AS lowest FROM windows) WHERE lowest < doc_id),
places AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words WHERE len(w) > 0),
covered AS (SELECT p.doc_id, p.i, p.word, max(CASE WHEN f.i IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM places p LEFT JOIN flagged f ON f.doc_id = p.doc_id AND f.i = p.i),
kept AS (SELECT doc_id, CAST(sum(gone) AS BIGINT) AS n_removed, coalesce(string_agg(CASE WHEN gone = 0 THEN word END, ' ' ORDER BY i), '') AS kept FROM covered GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM words LEFT JOIN kept USING (doc_id)
"""

CHAT = r"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (SELECT *, role || chr(10) || text || chr(10) AS said, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss,
  length(role || text) + length(regexp_replace(role || text, '[^\\<>]', '', 'g')) + length('<turn ></turn>' || chr(10)) AS n FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(said, '' ORDER BY turn, role, text)) AS turns_sha256, CAST(sum(length(loss)) AS BIGINT) AS loss_chars,
  sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256, CAST(sum(n) AS BIGINT) AS formatted_chars FROM marked GROUP BY conv_id
"""

VECTORS = """
WITH RECURSIVE points AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM points a JOIN points b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS v, vec_id AS r FROM points UNION SELECT v, b FROM reach JOIN links ON a = r),
roots AS (SELECT v, min(r) AS component_id FROM reach GROUP BY v),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM points JOIN roots ON v = vec_id LEFT JOIN counts ON a = vec_id
"""


def _grams() -> str:
    """CTEs that number windows of 2, 4, ... 32 words of a text, each from two of half the size, then those of 3, 8 and 61."""
    pair = "SELECT doc_id, i, n, {g}, lead({h}, {by}) OVER (PARTITION BY doc_id ORDER BY i) AS h"
    steps = ["g1 AS (SELECT doc_id, i, n, dense_rank() OVER (ORDER BY word) AS g FROM words)"]
    for k in (1, 2, 4, 8, 16):
        steps.append(f"g{2 * k} AS (SELECT doc_id, i, n, dense_rank() OVER (ORDER BY g, h) AS g FROM ({pair.format(g='g', h='g', by=k)} FROM g{k}))")
    for k, half, by in ((3, 2, 1), (8, 4, 4), (61, 32, 29)):
        pairs = pair.format(g="g", h="g", by=by)
        steps.append(f"""w{k} AS (SELECT doc_id, i, max(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) AS again FROM (
  SELECT doc_id, i, CASE WHEN i + {k - 1} <= n AND count(*) OVER (PARTITION BY doc_id, g, h, i + {k - 1} <= n) > 1 THEN 1 ELSE 0 END AS again FROM ({pairs} FROM g{half})))""")
        steps.append(f"n{k} AS (SELECT doc_id, CAST(sum(again) AS BIGINT) AS n{k} FROM w{k} GROUP BY doc_id)")
    return ",\n".join(steps)


REPEATS = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
lists AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM texts),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
words AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM lists WHERE len(w) > 0),
{_grams()},
counted AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines,
  coalesce(n3, 0) AS n_repeat_words, coalesce(n8, 0) AS n_covered, coalesce(n61, 0) > 0 AS too_long
  FROM lists LEFT JOIN dups USING (doc_id) LEFT JOIN n3 USING (doc_id) LEFT JOIN n8 USING (doc_id) LEFT JOIN n61 USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT too_long AND 100 * n_covered <= 45 * n_words AS kept, n_covered FROM judged
"""

#: CRC-32 of a decimal number's characters.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}) + 1), lambda i: CAST(ascii({0}[i]) AS BIGINT))),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda c, bit: xor(c // 2, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END))))"""

RUNS = rf"""
WITH given AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_CRC.format("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
sized AS (SELECT doc_id, w, h, CAST(len(w) AS BIGINT) AS n, CASE WHEN len(w) > 0 AND h % 10 = 0 THEN (h // 10) % len(w) ELSE len(w) END AS a FROM given),
planted AS (SELECT doc_id, n, CASE WHEN a = n THEN w ELSE list_concat(w[1:a], list_transform(range(a, n), lambda i: w[1 + a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8))])) END AS w FROM sized),
words AS (SELECT doc_id, n, unnest(range(0, n)) AS i, unnest(w) AS word FROM planted WHERE n > 0),
alike AS (SELECT x.doc_id, x.n, y.i - x.i AS q, x.i FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
islands AS (SELECT doc_id, n, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM alike),
spans AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM islands GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS (SELECT doc_id, s, l, min(q) AS q FROM spans GROUP BY doc_id, s, l),
best AS (SELECT doc_id, s, l, q, row_number() OVER (PARTITION BY doc_id ORDER BY CAST(l AS DOUBLE) / q DESC, s, q) AS k FROM runs),
lists AS (SELECT doc_id, count(*) AS n_runs, sha256(string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q)) AS runs_sha256 FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT p.doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, CAST(l AS BIGINT) AS length, q AS period, CAST(1000 * l // q AS BIGINT) AS exponent_milli,
  coalesce(runs_sha256, sha256('')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM planted p LEFT JOIN lists ON lists.doc_id = p.doc_id LEFT JOIN best ON best.doc_id = p.doc_id AND k = 1 LEFT JOIN kept ON kept.doc_id = p.doc_id
"""


def _rounds(n: int) -> str:
    """CTEs of n rounds of assigning vectors (v) to centroids (c0) and replacing those by floored means."""
    near = "a{0} AS (SELECT vec_id, e, k, d FROM (SELECT vec_id, e, k, list_sum(list_transform(range(1, 65), lambda i: (e[i] - c[i]) * (e[i] - c[i]))) AS d FROM v, c{0}) QUALIFY row_number() OVER (PARTITION BY vec_id, e ORDER BY d, k) = 1)"
    sums = "m{0} AS (SELECT k, i, CAST(floor(sum(x)::DOUBLE / count(*)) AS BIGINT) AS x FROM (SELECT k, unnest(e) AS x, unnest(range(64)) AS i FROM a{0}) GROUP BY k, i)"
    means = "c{1} AS (SELECT k, coalesce(m.c, c{0}.c) AS c FROM c{0} LEFT JOIN (SELECT k, list(x ORDER BY i) AS c FROM m{0} GROUP BY k) m USING (k))"
    return ",\n".join([*[part.format(r, r + 1) for r in range(n) for part in (near, sums, means)], near.format(n)])


CLUSTERS = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), e) - 1 AS k, e AS c FROM v WHERE vec_id IS NOT NULL QUALIFY k < 16),
{_rounds(3)}
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a3 JOIN c3 USING (k)
"""
