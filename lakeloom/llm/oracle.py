"""DuckDB SQL for the registered queries that SQL can express."""

OP1 = r"""
WITH urls AS (
  SELECT page_id, url, 1704067200 + page_id * 7919 % 525600 * 60 AS fetched_at,
    regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '\.+$', '')
      AS host,
    list_filter(string_split(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/'),
      lambda part: part <> '') AS folders
  FROM pages
),
places AS (
  SELECT DISTINCT host, string_split(host, '.')[-2] || '.' || string_split(host, '.')[-1] || '/' AS domain,
    host || '/' || folders[1] || '/' AS folder
  FROM urls WHERE contains(host, '.')
),
numbered AS (
  SELECT *, CAST('0x' || substr(md5(host), 1, 7) AS BIGINT) AS h,
    CAST('0x' || substr(md5(domain), 1, 7) AS BIGINT) AS d,
    CASE WHEN folder IS NOT NULL THEN CAST('0x' || substr(md5(folder), 1, 7) AS BIGINT) END AS f
  FROM places
),
entries AS (
  SELECT 'hosts' AS list_name, host || '/' AS pattern, 'block' AS action, h % 250 AS day FROM numbered
  UNION SELECT 'hosts', host || '/', 'remove', h % 250 + 20 + h // 7 % 60 FROM numbered
  UNION SELECT 'hosts', host || '/', 'block', h % 250 + 90 + h // 11 % 40 FROM numbered
  UNION SELECT 'domains', domain, 'allow', d % 60 FROM numbered
  UNION SELECT 'domains', domain, 'block', d % 60 + 200 FROM numbered
  UNION SELECT 'folders', folder, 'allow', f % 365 FROM numbered WHERE folder IS NOT NULL
),
single AS (
  SELECT list_name, pattern, day, min(CASE action WHEN 'block' THEN 1 WHEN 'allow' THEN 2 ELSE 3 END) AS rank
  FROM entries GROUP BY ALL
),
intervals AS (
  SELECT list_name, pattern, CASE rank WHEN 1 THEN 'block' WHEN 2 THEN 'allow' ELSE 'remove' END AS action,
    1704067200 + day * 86400 AS valid_from,
    lead(1704067200 + day * 86400) OVER (PARTITION BY list_name, pattern ORDER BY day) AS valid_to,
    len(string_split(pattern, '/')) - 2 AS n_folders, len(string_split(string_split(pattern, '/')[1], '.')) AS n_labels
  FROM single
),
matched AS (
  SELECT page_id, url, i.*, row_number() OVER (PARTITION BY page_id, url
    ORDER BY n_folders DESC, n_labels DESC, action <> 'block', list_name, pattern, valid_from) AS place
  FROM urls u JOIN intervals i ON i.action <> 'remove'
    AND (CASE WHEN n_folders = 0 THEN ends_with('.' || host || '/', '.' || pattern)
      ELSE starts_with(host || '/' || array_to_string(folders, '/') || '/', pattern) END)
    AND fetched_at >= valid_from AND (valid_to IS NULL OR fetched_at < valid_to)
)
SELECT u.page_id, fetched_at, host, coalesce(action, 'unlisted') AS verdict, pattern, list_name, valid_from
FROM urls u LEFT JOIN matched m ON m.place = 1 AND u.page_id = m.page_id AND u.url = m.url
"""

OP4 = r"""
WITH last AS (
  SELECT conv_id, turn AS last_turn, text AS reply
  FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, text DESC NULLS LAST) AS place
    FROM conversations WHERE role = 'assistant'
  ) WHERE place = 1
),
given AS (
  SELECT c.conv_id, c.turn, c.role, c.text, false AS rejected FROM conversations c
  UNION ALL
  SELECT c.conv_id, c.turn, c.role, CASE WHEN o.conv_id IS NOT NULL THEN n.reply ELSE c.text END, true
  FROM conversations c
  LEFT JOIN last o ON c.conv_id = o.conv_id AND c.turn = o.last_turn AND c.role = 'assistant'
  LEFT JOIN last n ON n.conv_id = xor(c.conv_id, 1)
  WHERE o.conv_id IS NULL OR n.conv_id IS NOT NULL
),
sides AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, rejected
  FROM given WHERE conv_id IS NOT NULL
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, rejected ORDER BY turn NULLS FIRST, role, text) AS p FROM sides
),
differing AS (
  SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, min(coalesce(a.p, b.p)) AS first
  FROM (SELECT * FROM placed WHERE NOT rejected) a
  FULL JOIN (SELECT * FROM placed WHERE rejected) b ON a.conv_id = b.conv_id AND a.p = b.p
  WHERE a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text
  GROUP BY 1
),
rendered AS (
  SELECT p.conv_id, p.rejected, p.p, p.role, first IS NULL OR p.p < first AS common,
    '<|im_start|>' || replace(role, '<|', '< |') || chr(10) AS head,
    replace(text, '<|', '< |') || '<|im_end|>' AS body
  FROM placed p LEFT JOIN differing USING (conv_id)
),
located AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, rejected, common ORDER BY p
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM rendered
),
joined AS (
  SELECT conv_id,
    count(*) FILTER (common AND NOT rejected) AS n_prompt,
    coalesce(string_agg(head || body || chr(10), '' ORDER BY p) FILTER (common AND NOT rejected), '') AS prompt,
    coalesce(string_agg(head || body || chr(10), '' ORDER BY p) FILTER (NOT common AND NOT rejected), '') AS chosen,
    coalesce(string_agg(head || body || chr(10), '' ORDER BY p) FILTER (NOT common AND rejected), '') AS rejected,
    coalesce(string_agg(CAST(before + length(head) AS BIGINT) || '-' || CAST(before + length(head) + length(body) AS BIGINT), ','
      ORDER BY p) FILTER (NOT common AND NOT rejected AND role = 'assistant'), '') AS chosen_learn,
    coalesce(string_agg(CAST(before + length(head) AS BIGINT) || '-' || CAST(before + length(head) + length(body) AS BIGINT), ','
      ORDER BY p) FILTER (NOT common AND rejected AND role = 'assistant'), '') AS rejected_learn
  FROM located GROUP BY conv_id
)
SELECT conv_id AS pair_id, n_prompt, prompt, chosen, rejected, chosen_learn, rejected_learn,
  CASE WHEN chosen = '' AND rejected = '' THEN 'identical'
    WHEN chosen_learn = '' OR rejected_learn = '' THEN 'one_sided' ELSE 'pair' END AS status
FROM joined
"""

OP7 = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS doc,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
item_windows AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i : i + 12], ' ') AS run
  FROM items, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i)
  WHERE len(w) > 0
),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc, n, i, array_to_string(w[i : i + n - 1], ' ') AS run
  FROM words, lengths, unnest(range(1, len(w) - n + 2)) AS t(i)
  WHERE len(w) >= n
),
hits AS (SELECT doc, d.n, i, item FROM doc_windows d JOIN item_windows b ON d.n = b.n AND d.run = b.run),
covered AS (
  SELECT doc, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY doc
),
named AS (
  SELECT doc, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc, item FROM hits) GROUP BY doc
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN covered USING (doc) LEFT JOIN named USING (doc)
"""

OP9 = r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS digest,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents
),
sources AS (
  SELECT key, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY key) AS place
  FROM sized GROUP BY key
),
capped AS (
  SELECT *, [3, 1, 2][(place - 1) % 3 + 1] AS weight, 2 * source_size AS cap FROM sources
),
levelled AS (
  SELECT *, cap / weight AS ratio,
    (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5
      - coalesce(CAST(sum(cap) OVER earlier AS DOUBLE), 0))
    / (CAST(sum(weight) OVER () AS DOUBLE) - coalesce(CAST(sum(weight) OVER earlier AS DOUBLE), 0)) AS level
  FROM capped
  WINDOW earlier AS (ORDER BY cap / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
common AS (
  SELECT level FROM levelled WHERE level * weight < cap ORDER BY ratio, key LIMIT 1
),
targets AS (
  SELECT key, source_size,
    CASE WHEN c.level IS NULL OR c.level * weight >= cap THEN CAST(cap AS DOUBLE)
      ELSE c.level * weight END AS target
  FROM levelled l LEFT JOIN common c ON true
),
placed AS (
  SELECT doc_id, key, size,
    CAST(sum(size) OVER (PARTITION BY key ORDER BY digest, doc_id NULLS FIRST, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - size AS start
  FROM sized
)
SELECT doc_id, size, source_size, target,
  greatest(0, least(start + size, CAST(floor(target) AS BIGINT)) - start)
  + greatest(0, least(source_size + start + size, CAST(floor(target) AS BIGINT)) - source_size - start) AS taken
FROM placed JOIN targets USING (key)
"""

ORACLE_SQL = {"op1_url_filter": OP1, "op4_chat": OP4, "op7_decontamination": OP7, "op9_mixing": OP9}
