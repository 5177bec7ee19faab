"""SQL for the queries that SQL can express, for DuckDB."""

from __future__ import annotations

from fareloom.llm.repetition import DUP_LINES, DUPLICATED, MIN_WORDS, TOP_NGRAM

LIMITS = {**TOP_NGRAM, **DUPLICATED}

OP2 = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), size AS (
  SELECT doc_id, len(w) AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, w
  FROM d
), line AS (
  SELECT doc_id, length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) AS chars,
         count(*) AS copies
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
  GROUP BY doc_id, line
), lines AS (
  SELECT doc_id, sum(copies - 1)::BIGINT AS n_dup_lines,
         sum((copies - 1) * chars)::BIGINT AS dup_line_chars
  FROM line GROUP BY doc_id
), gram AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n_words, unnest(range(2, 11)) AS n FROM size),
       unnest(range(1, n_words - n + 2)) AS starts(i)
  WHERE n_words >= n
), copies AS (
  SELECT doc_id, n, i, count(*) OVER same AS copies,
         row_number() OVER (PARTITION BY doc_id, n, g ORDER BY i) AS k,
         length(g) - n + 1 AS chars
  FROM gram WINDOW same AS (PARTITION BY doc_id, n, g)
), top AS (
  SELECT doc_id, n, max(copies * chars) AS chars FROM (
    SELECT *, max(copies) OVER (PARTITION BY doc_id, n) AS most
    FROM copies WHERE n <= 4 AND copies > 1
  ) WHERE copies = most GROUP BY doc_id, n
), hit AS (
  SELECT DISTINCT doc_id, n, i + o AS spot
  FROM copies, unnest(range(0, n)) AS t(o)
  WHERE n = 3 AND copies > 1 OR n >= 5 AND k > 1
), cover AS (
  SELECT h.doc_id, h.n, count(*) AS words, sum(length(s.w[h.spot]))::BIGINT AS chars
  FROM hit h JOIN size s USING (doc_id) GROUP BY h.doc_id, h.n
), wide AS (
  SELECT doc_id, max(words) FILTER (n = 3) AS n_repeat_words,
         {", ".join(f"max(chars) FILTER (n = {n}) AS dup{n}_chars" for n in DUPLICATED)}
  FROM cover GROUP BY doc_id
), wide_top AS (
  SELECT doc_id, {", ".join(f"max(chars) FILTER (n = {n}) AS top{n}_chars" for n in TOP_NGRAM)}
  FROM top GROUP BY doc_id
), every AS (
  SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(dup_line_chars, 0)::BIGINT AS dup_line_chars,
         {", ".join(f"coalesce(top{n}_chars, 0)::BIGINT AS top{n}_chars" for n in TOP_NGRAM)},
         {", ".join(f"coalesce(dup{n}_chars, 0)::BIGINT AS dup{n}_chars" for n in DUPLICATED)}
  FROM size LEFT JOIN lines USING (doc_id) LEFT JOIN wide USING (doc_id)
       LEFT JOIN wide_top USING (doc_id)
), judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM every
)
SELECT *, NOT base_failed AND 100 * dup_line_chars <= {DUP_LINES} * word_chars
  AND {" AND ".join(f"100 * {'top' if n in TOP_NGRAM else 'dup'}{n}_chars <= {k} * word_chars" for n, k in LIMITS.items())} AS kept
FROM judged
"""

OP7 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP8 = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1),
         lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END) AS g
  FROM d
), n AS (
  SELECT d.doc_id, count(s.g) AS n FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id
), pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * same >= 90 * (x.n + y.n - same)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM n
  UNION
  SELECT r.a, CASE WHEN l.a = r.b THEN l.b ELSE l.a END
  FROM reach r JOIN link l ON l.a = r.b OR l.b = r.b
)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, min(r.b) AS component_id
FROM n JOIN reach r ON r.a = n.doc_id GROUP BY n.doc_id, n.n
"""

OP10 = """
WITH timed AS (
  SELECT *, (page_id * 7919) % 86400000 + 864000 AS t, md5(html) AS tag,
         md5(html || '2') AS new_tag,
         regexp_replace(url, '^https?://', '') AS bare
  FROM pages
), named AS (
  SELECT *, 'HTTP://www.' || regexp_replace(bare, '^www\\.', '') AS hosted FROM timed
), record AS (
  SELECT page_id * 8 AS id, url, t, true AS full_response, tag AS etag, t::VARCHAR AS modified,
         t::VARCHAR AS date, NULL AS expires, 'text/html' AS ctype, tag AS digest FROM named
  UNION ALL
  SELECT page_id * 8 + 1, 'https://' || bare, t + 86400, false, 'W/' || tag, NULL,
         (t + 86400)::VARCHAR, NULL, 'x', NULL FROM named
  UNION ALL
  SELECT page_id * 8 + 2, hosted, t + 432000, false, NULL, t::VARCHAR, NULL, NULL, NULL, NULL
  FROM named
  UNION ALL
  SELECT page_id * 8 + 3, url, t + 518400, true, new_tag, NULL, (t + 518400)::VARCHAR, NULL,
         NULL, new_tag FROM named WHERE page_id % 3 = 0
  UNION ALL
  SELECT page_id * 8 + 4, hosted, t + 604800, false, tag, NULL, NULL, NULL, NULL, NULL
  FROM named WHERE page_id % 3 = 0
  UNION ALL
  SELECT page_id * 8 + 5, url, t + 691200, false, new_tag, NULL, NULL, (t + 777600)::VARCHAR,
         NULL, NULL FROM named WHERE page_id % 3 = 0
  UNION ALL
  SELECT page_id * 8 + 6, url, t - 86400, false, tag, NULL, NULL, NULL, NULL, NULL
  FROM named WHERE page_id % 5 = 0
), split AS (
  SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^(?i)https?://', '') AS rest
  FROM record
), parts AS (
  SELECT *, lower(regexp_extract(rest, '^([^/?]*)', 1)) AS host,
         regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
         array_to_string(list_sort(list_filter(
           string_split(regexp_extract(rest, '\\?(.*)$', 1), '&'),
           lambda p: NOT regexp_matches(p, '^(utm_|ref=|$)'))), '&') AS query
  FROM split
), canonical AS (
  SELECT * EXCLUDE (url),
         regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\\.', '') || path
         || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS url
  FROM parts
), matched AS (
  SELECT r.*, s.id AS response_id, s.etag AS s_etag, s.modified AS s_modified, s.date AS s_date,
         s.expires AS s_expires, s.ctype AS s_ctype, s.digest AS s_digest,
         row_number() OVER (PARTITION BY r.id ORDER BY s.t DESC, s.id DESC) AS k
  FROM canonical r
  LEFT JOIN canonical s
    ON s.full_response AND s.url = r.url AND (s.t < r.t OR s.t = r.t AND s.id < r.id)
  WHERE NOT r.full_response
), judged AS (
  SELECT *, CASE
    WHEN response_id IS NULL THEN 'missing'
    WHEN etag IS NOT NULL AND s_etag IS NOT NULL THEN
      CASE WHEN regexp_replace(etag, '^W/', '') = s_etag THEN 'resolved' ELSE 'modified' END
    WHEN modified IS NOT NULL AND s_modified IS NOT NULL AND modified <> s_modified
      THEN 'modified'
    ELSE 'resolved' END AS status
  FROM matched WHERE k = 1
)
SELECT id AS record_id, url, t AS fetched_at, response_id, status,
       CASE WHEN status = 'resolved' THEN s_digest END AS digest,
       CASE WHEN status = 'resolved' THEN coalesce(etag, s_etag) END AS etag,
       CASE WHEN status = 'resolved' THEN coalesce(modified, s_modified) END AS last_modified,
       CASE WHEN status = 'resolved' THEN coalesce(date, s_date) END AS date,
       CASE WHEN status = 'resolved' THEN coalesce(expires, s_expires) END AS expires,
       CASE WHEN status = 'resolved' THEN s_ctype END AS content_type
FROM judged
"""

# The crc32 of a list of bytes goes through a table of 256 numbers, which is computed.
CRC_STEP = "list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)"
OP11 = f"""
WITH RECURSIVE crc AS (
  SELECT list({CRC_STEP} ORDER BY b) AS step FROM (SELECT unnest(range(256)) AS b)
), run AS (
  SELECT doc_id, word, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS word
    FROM documents) GROUP BY ALL
), spelled AS (
  SELECT word, n, flatten(list_transform(string_split(concat(doc_id, ':', word), ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
                   ELSE [195, unicode(c)::BIGINT - 64] END)) AS bytes
  FROM run
), hashed AS (
  SELECT word, n, xor(list_reduce(bytes,
    lambda c, b: xor(c >> 8, step[xor(c & 255, b) + 1]), 4294967295), 4294967295) AS h
  FROM spelled, crc
), word AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 <> 0 THEN word
                ELSE substr(word, 1, (h % length(word))::INT)
                     || substr(word, (h % length(word))::INT + 2) END AS word, n
    FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS z
  FROM (SELECT *, unnest(range(1, length(word) + 1))::INT AS i FROM word)
), near AS (
  SELECT x.word, y.word AS other, y.n FROM cut x JOIN cut y USING (i, a, z)
  WHERE x.word <> y.word
  UNION
  SELECT x.word, y.word, y.n FROM cut x JOIN word y ON y.word = x.a || x.z
  UNION
  SELECT y.word, x.word, x.n FROM cut x JOIN word y ON y.word = x.a || x.z
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-n, encode(other))) AS form, max(n) AS form_n
  FROM near GROUP BY word
), chosen AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.form_n >= 2 * w.n THEN b.form END AS form,
         CASE WHEN b.form_n >= 2 * w.n THEN b.form_n END AS form_n
  FROM word w LEFT JOIN best b USING (word)
), path AS (
  SELECT word, form AS at FROM chosen WHERE form IS NOT NULL
  UNION ALL
  SELECT p.word, c.form FROM path p JOIN chosen c ON c.word = p.at WHERE c.form IS NOT NULL
), ended AS (
  SELECT p.word, p.at AS root FROM path p JOIN chosen c ON c.word = p.at WHERE c.form IS NULL
)
SELECT c.word, c.form, coalesce(e.root, c.word) AS root, c.n, c.n_near, c.form_n
FROM chosen c LEFT JOIN ended e USING (word)
"""

OP13 = """
WITH term AS (
  SELECT 'd' AS kind, doc_id AS id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM documents
  UNION ALL
  SELECT 'q', item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))
  FROM benchmark
), bag AS (
  SELECT kind, id, term, count(*) AS tf FROM term GROUP BY ALL
), size AS (
  SELECT id, sum(tf)::BIGINT AS n FROM bag WHERE kind = 'd' GROUP BY id
), whole AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM size
), weight AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM bag, whole WHERE kind = 'd' GROUP BY term
), worth AS (
  SELECT id, term, (w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS v
  FROM bag JOIN size USING (id) JOIN weight USING (term), whole WHERE kind = 'd'
), score AS (
  SELECT q.id AS item_id, d.id AS doc_id, sum(q.tf * d.v)::BIGINT AS score
  FROM bag q JOIN worth d USING (term) WHERE q.kind = 'q' GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank
  FROM score WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE = {
    "op10_warc_revisits": OP10,
    "op11_spelling_variants": OP11,
    "op13_ranked_search": OP13,
    "op2_repetition_coverage": OP2,
    "op7_exact_topk": OP7,
    "op8_jaccard_join": OP8,
}
