"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

OP2 = r"""
WITH docs AS (SELECT doc_id, text FROM documents),
placed AS (
  SELECT doc_id, text, pos, trim(line) AS line
  FROM (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
               unnest(range(len(string_split(text, chr(10))))) AS pos FROM docs)
  WHERE trim(line) <> ''),
tokens AS (
  SELECT *, list_transform(string_split(line, ' '),
                           lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS ts FROM placed),
leafed AS (SELECT *, {'n': len(ts), 'lead': ts[1:3]} AS leaf FROM tokens),
seen AS (
  SELECT leaf, line, any_value(ts) AS ts, text, pos, min(doc_id) AS id FROM leafed
  WHERE leaf IN (SELECT leaf FROM leafed GROUP BY leaf HAVING count(*) >= 10)
  GROUP BY leaf, line, text, pos),
lines AS (SELECT leaf, line, any_value(ts) AS ts, count(*) AS n FROM seen GROUP BY leaf, line),
cells AS (SELECT leaf, line, n, unnest(ts) AS token, unnest(range(len(ts))) AS p FROM lines),
totals AS (SELECT leaf, sum(n) AS total FROM lines GROUP BY leaf),
support AS (
  SELECT leaf, p, token, sum(n) AS support FROM cells WHERE token <> '<*>' GROUP BY leaf, p, token HAVING sum(n) >= 10),
fields AS (
  SELECT c.line, c.leaf, c.p, CASE WHEN s.token IS NULL THEN '<*>' ELSE c.token END AS fine,
         CASE WHEN s.support * 20 >= t.total THEN c.token ELSE '<*>' END AS coarse
  FROM cells c JOIN totals t ON c.leaf = t.leaf
  LEFT JOIN support s ON c.leaf = s.leaf AND c.p = s.p AND c.token = s.token),
template AS (
  SELECT line, any_value(leaf) AS leaf,
         CASE WHEN count(*) FILTER (WHERE coarse <> '<*>') >= 0.7 * count(*) THEN string_agg(coarse, ' ' ORDER BY p)
              ELSE string_agg(fine, ' ' ORDER BY p) END AS template
  FROM fields GROUP BY line HAVING count(*) FILTER (WHERE fine <> '<*>') >= 0.7 * count(*)),
found AS (SELECT t.leaf, t.template, s.text, s.pos, s.id FROM seen s JOIN template t ON s.line = t.line),
texts AS (SELECT leaf, template, text, min(id) AS id FROM found GROUP BY leaf, template, text),
recurring AS (
  SELECT leaf, template, arg_min(text, id) AS first FROM texts
  GROUP BY leaf, template HAVING count(*) >= 10),
drops AS (
  SELECT f.text, list(DISTINCT f.pos) AS gone
  FROM found f JOIN recurring r ON f.leaf = r.leaf AND f.template = r.template WHERE f.text <> r.first
  GROUP BY f.text),
kept AS (
  SELECT d.doc_id, d.text, g.gone, string_split(d.text, chr(10)) AS ls
  FROM docs d LEFT JOIN drops g ON d.text = g.text)
SELECT doc_id,
       CASE WHEN gone IS NULL THEN text ELSE array_to_string(
         list_transform(list_filter(range(len(ls)), lambda i: NOT list_contains(gone, i)), lambda i: ls[i + 1]), chr(10))
       END AS text,
       CASE WHEN text IS NULL THEN 0 ELSE len(ls)::INTEGER END AS lines,
       coalesce(len(gone), 0)::INTEGER AS dropped, gone IS NOT NULL AS changed
FROM kept
"""

OP3 = r"""
WITH rules(verdict, rule, rhost, rpath) AS (VALUES
  ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
  ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'),
  ('block', 'com/de/', 'com', '/de/')),
parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
urls AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM parts),
fits AS (
  SELECT u.page_id, u.host, u.path, r.rule, r.verdict,
         row_number() OVER (PARTITION BY u.page_id, u.host, u.path
                            ORDER BY length(r.rule) DESC NULLS LAST, length(r.rhost) DESC) AS n
  FROM urls u LEFT JOIN rules r
    ON (u.host = r.rhost OR ends_with(u.host, '.' || r.rhost)) AND starts_with(u.path, r.rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE n = 1
"""

OP8 = r"""
WITH marks AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^.!?。！？\n]*[.!?。！？\n]+|[^.!?。！？\n]+') AS sents FROM documents),
bares AS (SELECT doc_id, text, sents, list_transform(sents, lambda x: trim(replace(replace(replace(x, chr(10), ' '), chr(9), ' '), chr(13), ' '))) AS b FROM marks),
cut AS (
  SELECT doc_id, text, flatten(list_transform(range(len(sents)), lambda i:
    CASE WHEN greatest(length(b[i + 1]) - length(replace(b[i + 1], ' ', '')) + 1, length(b[i + 1]) // 8) >= 20
         THEN regexp_extract_all(sents[i + 1], '[^vkVK]*[vkVK][^ ]*[ ]*|[^vkVK]+') ELSE [sents[i + 1]] END)) AS segs
  FROM bares),
bare AS (SELECT doc_id, list_transform(segs, lambda x: trim(replace(replace(replace(x, chr(10), ' '), chr(9), ' '), chr(13), ' '))) AS s FROM cut),
words AS (
  SELECT doc_id, s, list_transform(s, lambda x: greatest(length(x) - length(replace(x, ' ', '')) + 1, length(x) // 8)) AS w FROM bare),
starts AS (SELECT doc_id, s, w, unnest(range(len(s))) AS pos FROM words),
runs AS (SELECT *, unnest(range(1, 11)) AS run FROM starts),
sums AS (
  SELECT doc_id, s, pos, run, list_sum(w[pos + 1:pos + run]) AS total, w[pos + 1] AS head, w[pos + run] AS tail
  FROM runs WHERE pos + run <= len(s)),
spans AS (
  SELECT doc_id, pos, run, array_to_string(s[pos + 1:pos + run], chr(1)) AS span FROM sums
  WHERE (run = 1 AND head >= 20) OR (run >= 2 AND total >= 10 AND (
    (head < 20 AND (run = 2 OR total - tail < 10)) OR (tail < 20 AND (run = 2 OR total - head < 10))))),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY span, run ORDER BY doc_id, pos) AS n FROM spans),
drops AS (
  SELECT doc_id, list(DISTINCT i) AS gone
  FROM (SELECT doc_id, unnest(range(pos, pos + run)) AS i FROM numbered WHERE n > 1) GROUP BY doc_id)
SELECT c.doc_id,
       CASE WHEN gone IS NULL THEN text ELSE array_to_string(
         list_transform(list_filter(range(len(segs)), lambda i: NOT list_contains(gone, i)), lambda i: segs[i + 1]), '')
       END AS text,
       coalesce(len(segs), 0)::INTEGER AS sentences, coalesce(len(gone), 0)::INTEGER AS removed,
       gone IS NOT NULL AS changed
FROM cut c LEFT JOIN drops d ON c.doc_id = d.doc_id
"""

OP9 = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
         vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP11 = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
drawn AS (
  SELECT doc_id, text, u, len(u) AS n,
         ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS p, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS q,
         CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM units),
cut AS (
  SELECT *, array_to_string(u[1:least(p, q)], '') AS pre, array_to_string(u[least(p, q) + 1:greatest(p, q)], '') AS mid,
         array_to_string(u[greatest(p, q) + 1:], '') AS suf
  FROM drawn)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(coalesce(pre, ''))::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(coalesce(mid, ''))::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
              WHEN 'psm' THEN concat('<P>', pre, '<S>', suf, '<M>', mid)
              ELSE concat('<S>', suf, '<P>', pre, '<M>', mid) END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""

ORACLE = {"op2_template_lines": OP2, "op3_url_rules": OP3, "op8_sentence_spans": OP8, "op9_threshold_topk": OP9,
          "op11_learned_rank_fim": OP11}
