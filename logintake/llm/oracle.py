"""SQL for the queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH docs AS (
  SELECT doc_id, source AS owner, concat(coalesce(source, ''), '/', coalesce(lang, '')) AS repo,
         coalesce(text, '') AS text
  FROM documents),
matched AS (
  SELECT doc_id, owner, repo, 0 AS kind, 12 AS least,
         regexp_extract_all(text, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)') AS m,
         regexp_extract_all(text, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1) AS v,
         string_split_regex(text, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)') AS p
  FROM docs
  UNION ALL
  SELECT doc_id, owner, repo, 1, 18, regexp_extract_all(text, 'AKIA[A-Z0-9]+'),
         regexp_extract_all(text, 'AKIA[A-Z0-9]+'), string_split_regex(text, 'AKIA[A-Z0-9]+')
  FROM docs
  UNION ALL
  SELECT doc_id, owner, repo, 2, 16, regexp_extract_all(text, '[0-9a-f]+'),
         regexp_extract_all(text, '[0-9a-f]+'), string_split_regex(text, '[0-9a-f]+')
  FROM docs),
each AS (
  SELECT doc_id, owner, repo, kind, least, generate_subscripts(m, 1) AS pos, unnest(v) AS value,
         unnest(list_transform(m, lambda x: length(x))) AS size,
         unnest(list_transform(p[1:len(m)], lambda x: length(x))) AS gap
  FROM matched),
placed AS (
  SELECT doc_id, owner, repo, kind, least, value, size,
         sum(size + gap) OVER (PARTITION BY doc_id, kind ORDER BY pos) AS stop
  FROM each),
spans AS (SELECT *, stop - size AS start FROM placed WHERE length(value) >= least),
owned AS (
  SELECT value, count(DISTINCT coalesce(owner, '')) AS owners, count(DISTINCT repo) AS repos
  FROM spans GROUP BY value),
judged AS (
  SELECT doc_id, kind, start,
         concat(['assign', 'access', 'hex'][kind + 1], ':', start::BIGINT, ':', stop::BIGINT) AS span,
         CASE WHEN owners >= 3 OR repos >= 5 THEN 'example'
              WHEN owners = 1 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
                   AND len(list_distinct(string_split(value, ''))) >= 8 THEN 'live'
              ELSE 'unclear' END AS status
  FROM spans JOIN owned USING (value)),
listed AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex, string_agg(span, ',' ORDER BY start, kind) AS spans,
         count(*) FILTER (status = 'example') AS n_example, count(*) FILTER (status = 'live') AS n_live
  FROM judged GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_example, 0) AS n_example, coalesce(n_live, 0) AS n_live
FROM docs LEFT JOIN listed USING (doc_id)
"""

OP2 = r"""
WITH lasts AS (
  SELECT conv_id, max(turn) FILTER (role = 'assistant') AS last FROM conversations GROUP BY conv_id),
sides AS (
  SELECT 'chosen' AS side, conv_id, turn, role, text FROM conversations
  UNION ALL
  SELECT 'rejected', c.conv_id, turn, role, text FROM conversations c JOIN lasts USING (conv_id)
  WHERE last IS NULL OR turn IS NULL OR turn < last
  UNION ALL
  SELECT 'rejected', m.conv_id, coalesce(m.last, 1099511627776), c.role, c.text
  FROM conversations c JOIN lasts l USING (conv_id) JOIN lasts m ON m.conv_id = xor(c.conv_id, 1)
  WHERE c.role = 'assistant' AND c.turn = l.last),
placed AS (
  SELECT side, conv_id, role, text,
         row_number() OVER (PARTITION BY side, conv_id ORDER BY turn NULLS FIRST) - 1 AS number
  FROM sides),
differs AS (
  SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.number, b.number) AS number
  FROM (SELECT * FROM placed WHERE side = 'chosen') a
  FULL JOIN (SELECT * FROM placed WHERE side = 'rejected') b USING (conv_id, number)
  WHERE a.side IS NULL OR b.side IS NULL OR a.role != b.role OR a.text != b.text),
parts AS (
  SELECT conv_id AS pair_id, number, role, text,
         CASE WHEN common IS NULL OR number < common THEN 'prompt' ELSE side END AS part
  FROM placed LEFT JOIN (SELECT conv_id, min(number) AS common FROM differs GROUP BY conv_id) USING (conv_id)
  WHERE side = 'chosen' OR number >= common)
SELECT pair_id, part, number, role, concat('<|im_start|>', role, chr(10), text, '<|im_end|>', chr(10)) AS rendered,
       CASE WHEN part != 'prompt' AND role = 'assistant' THEN 13 + length(role) ELSE 0 END::BIGINT AS mask_start,
       CASE WHEN part != 'prompt' AND role = 'assistant' THEN 23 + length(role) + length(text) ELSE 0 END::BIGINT
         AS mask_end
FROM parts
"""

OP5 = r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
      FROM documents)
WINDOW same AS (PARTITION BY norm)
"""

_WORDS = """
  SELECT {id}, generate_subscripts(words, 1) - 1 AS place, unnest(words) AS word FROM (
    SELECT {id}, list_filter(
        regexp_split_to_array(
            regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[!-/:-@\\[-`{{-~]', '', 'g'),
            '[\\x20\\x09-\\x0D]+'), lambda x: x != '') AS words
    FROM {table})
"""

OP7 = f"""
WITH d AS ({_WORDS.format(id='doc_id', table='documents')}),
b AS ({_WORDS.format(id='item_id', table='benchmark')}),
sizes AS (SELECT item_id, count(*) AS n, least(count(*), 13) AS size FROM b GROUP BY item_id),
agree AS (
  SELECT doc_id, item_id, d.place - b.place AS diagonal, b.place FROM d JOIN b USING (word)),
dense AS (
  SELECT doc_id, item_id, diagonal, list(place) AS places FROM agree JOIN sizes USING (item_id)
  GROUP BY doc_id, item_id, diagonal, size HAVING count(*) >= ceil(0.8 * size)),
best AS (
  SELECT doc_id, item_id, size,
         list_max(list_transform(range(0, n - size + 1), lambda lo:
             len(list_filter(places, lambda p: p >= lo AND p < lo + size)))) AS matches
  FROM dense JOIN sizes USING (item_id))
SELECT doc_id, item_id, max(matches)::BIGINT AS matches, max(size)::BIGINT AS "window"
FROM best WHERE matches >= ceil(0.8 * size) GROUP BY doc_id, item_id
"""

OP8 = r"""
SELECT page_id, strlen(html) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  ((('0x' || substr(digest, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)),
           '') AS payload_digest,
       CASE WHEN page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id != max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages)
WINDOW same AS (PARTITION BY html)
"""

OP11 = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n,
         sha256(concat('1:', doc_id)) AS h
  FROM documents),
numbers AS (
  SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
cut AS (
  SELECT doc_id, n, form, text, least(a, b) AS lo, greatest(a, b) AS hi,
         substring(text, 1, least(a, b)) AS prefix,
         substring(text, least(a, b) + 1, greatest(a, b) - least(a, b)) AS middle,
         substring(text, greatest(a, b) + 1) AS suffix
  FROM numbers)
SELECT doc_id, n, form, CASE WHEN form != 'plain' THEN lo END AS prefix_chars,
       CASE WHEN form != 'plain' THEN hi - lo END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""

OP12 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
each AS (SELECT doc, lang, source, unnest(words) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS total FROM each GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
counted AS (
  SELECT lang, source, term, count(*) AS n FROM each SEMI JOIN kept USING (lang, term) GROUP BY ALL),
parts AS (
  SELECT lang, source, coalesce(n, 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM docs)
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM counted GROUP BY ALL) USING (lang, source)),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(total) AS n FROM kept GROUP BY lang),
shares AS (
  SELECT parts.lang, parts.source, kept.term, coalesce(counted.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(counted.n, 0) + 5)) // (parts.n + 5 * v) AS p,
         1 + (1000000000::HUGEINT * (total + 5)) // (langs.n + 5 * v) AS q
  FROM parts JOIN langs USING (lang) JOIN kept ON kept.lang = parts.lang
  LEFT JOIN counted ON counted.lang = parts.lang AND counted.source = parts.source AND counted.term = kept.term),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM parts a JOIN parts b ON a.lang = b.lang AND a.source != b.source
  LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM every
QUALIFY part = 'pair' OR rank <= 50
"""

ORACLE = {
    "op1_secret_ownership": OP1,
    "op2_preference_turns": OP2,
    "op5_block_naming": OP5,
    "op7_spaced_seeds": OP7,
    "op8_capture_index": OP8,
    "op11_fenwick_infill": OP11,
    "op12_source_divergence": OP12,
}
