"""The queries that SQL can express, in DuckDB's SQL."""

ORACLES: dict[str, str] = {}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES["op5_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
grams AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM d, unnest(range(1, len(w) - 1)) t(i) WHERE len(w) >= 3
),
twice AS (
  SELECT doc_id, i FROM grams
  QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, unnest([0, 1, 2]) t(k) GROUP BY doc_id
),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
stops AS (
  SELECT list(DISTINCT v) AS s FROM (
    SELECT unnest([x, upper(x[1:1]) || x[2:], upper(x)]) AS v
    FROM unnest(string_split(
      'the of and to in is that it for was with as on at by this '
      || 'der die das und ist in den von zu mit sich auf für nicht ein eine '
      || 'le la les de des et en un une du que qui dans pour au est '
      || 'el la los las de que y en un una por se del con para lo', ' ')) t(x))
),
counts AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(w, lambda x: list_contains(s, x))) AS n_stop
  FROM d CROSS JOIN stops LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_words > 100000
    OR word_chars::DOUBLE / n_words NOT BETWEEN 2.0 AND 12.0 OR n_symbols::DOUBLE / word_chars > 0.1
    OR n_dup_lines::DOUBLE / n_lines > 0.3 OR n_stop::DOUBLE / n_words < 0.02) AS kept
FROM counts
"""

ORACLES["op6_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
b AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
p AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(i) WHERE len(w) > 0
),
x AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM d, (SELECT DISTINCT n FROM p), unnest(range(1, len(w) - n + 2)) t(i) WHERE len(w) >= n
),
hits AS (SELECT DISTINCT doc_id, i, x.n, item_id FROM x JOIN p ON x.s = p.s AND x.n = p.n),
words AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(0, n)) t(k) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLES["op4_warc"] = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
f AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, upper(sha1(payload)) AS hex,
        min(page_id) OVER (PARTITION BY payload) AS first FROM p)
SELECT page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hex, 5 * (k // 4) + 1, 5))::BIGINT >> (15 - 5 * (k % 4))) & 31)::INT + 1, 1) for k in range(32)], '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

# All pairs of sets that share a shingle; components by repeated smallest neighbours.
ORACLES["op8_jaccard_join"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS g
  FROM d, unnest(range(1, greatest(len(w) - 3, 2))) t(i) WHERE len(w) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM e JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)
),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(r.c, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a) r USING (doc_id)
"""

ORACLES["op7_repeated_bytes"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM d, unnest(range(0, length(h) // 2 - 49)) t(i)),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM w),
g AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS step FROM f WHERE first < doc_id),
runs AS (
  SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM (
    SELECT *, sum(CASE WHEN step <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g)
  GROUP BY doc_id, run
),
gaps AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS c,
    lead(a) OVER (PARTITION BY doc_id ORDER BY a) IS NULL AS last
  FROM runs
),
kept AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed,
    string_agg(substr(h, (2 * c + 1)::BIGINT, (2 * (a - c))::BIGINT) || CASE WHEN last THEN substr(h, (2 * b + 1)::BIGINT) ELSE '' END, '' ORDER BY a) AS rest
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def _codebook_rounds(rounds: int) -> str:
    """CTEs a0, b1, a1, ... : assignment to the entries of a round, and the next codebooks."""
    assign = """
a{k} AS MATERIALIZED (
  SELECT r, pos, any_value(part) AS part, min(struct_pack(error := error, entry := entry)) AS best FROM (
    SELECT p.r, p.pos, p.part, b.entry, list_sum(list_transform(list_zip(p.part, b.part), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS error
    FROM p JOIN b{k} b USING (pos)) GROUP BY r, pos
),"""
    renew = """
s{n} AS (
  SELECT pos, entry, dim, sum(x)::BIGINT AS s, count(*)::BIGINT AS n FROM (
    SELECT pos, best.entry AS entry, unnest(part) AS x, generate_subscripts(part, 1) AS dim FROM a{k}) GROUP BY ALL
),
m{n} AS (
  SELECT pos, entry, list((s - ((s % n) + n) % n) // n ORDER BY dim) AS part FROM s{n} GROUP BY ALL
),
b{n} AS MATERIALIZED (
  SELECT b.pos, b.entry, coalesce(m.part, b.part) AS part FROM b{k} b LEFT JOIN m{n} m USING (pos, entry)
),"""
    return "".join(assign.format(k=k) + renew.format(k=k, n=k + 1) for k in range(rounds)) + assign.format(k=rounds)


ORACLES["op11_vector_codes"] = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS r, vec_id, label,
    list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS c
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
p AS MATERIALIZED (
  SELECT r, pos, c[pos * (len(c) // 4) + 1 : (pos + 1) * (len(c) // 4)] AS part FROM v, range(4) t(pos)
),
b0 AS MATERIALIZED (SELECT pos, r AS entry, part FROM p WHERE r < 256),{_codebook_rounds(4)}
said AS (
  SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY pos, entry, dim)) AS h FROM (
    SELECT pos, entry, unnest(part) AS x, generate_subscripts(part, 1) AS dim FROM b4)
),
found AS (
  SELECT r, string_agg(lower(printf('%02x', best.entry)), '' ORDER BY pos) AS code, sum(best.error)::BIGINT AS error FROM a4 GROUP BY r
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM v JOIN found USING (r), said
"""

_SPACE = r"\x20\x09-\x0D"

ORACLES["op12_conversation_repair"] = rf"""
WITH RECURSIVE tab AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) x(i))
),
hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT)),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM conversations, tab
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hit, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) n(i)
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    regexp_replace(text, '[{_SPACE}]+$', '') AS rest
  FROM damaged
),
turns AS MATERIALIZED (
  SELECT conv_id, pos, turn, role, text, role[1:1] AS initial, role[1:1] IN ('s', 'u', 'a') AND
      lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY pos) || role[1:1] IN ('su', 'ua', 'au') AS legal,
    CASE WHEN rest = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate' WHEN rest[-1:] NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
  FROM placed
),
ins(i, j, n) AS (VALUES (0, 0, 0), (0, 2, 1), (0, 3, 2), (1, 1, 0), (1, 2, 1), (1, 3, 2), (2, 2, 0), (2, 3, 1), (3, 3, 0), (3, 2, 1)),
edges(i, j, letter, initial) AS (
  VALUES (0, 0, 'D', ''), (1, 1, 'D', ''), (2, 2, 'D', ''), (3, 3, 'D', ''),
    (0, 1, 'K', 's'), (0, 2, 'K', 'u'), (1, 2, 'K', 'u'), (3, 2, 'K', 'u'), (2, 3, 'K', 'a'),
    (0, 2, 'R', ''), (1, 2, 'R', ''), (3, 2, 'R', ''), (2, 3, 'R', '')
),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS pos, 0 AS state, 0::BIGINT AS cost, '' AS audit FROM conversations
  UNION ALL
  SELECT conv_id, pos, state, cost, audit FROM (
    SELECT w.conv_id, t.pos, e.j AS state, w.cost + 5 * n.n
        + CASE e.letter WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN e.letter <> 'D' AND t.fault = 'truncated' THEN 5 ELSE 0 END AS cost,
      w.audit || repeat('I', n.n) || e.letter AS audit
    FROM walk w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.pos = w.pos + 1
    JOIN ins n ON n.i = w.state
    JOIN edges e ON e.i = n.j AND (e.letter <> 'K' OR e.initial = t.initial) AND (e.letter = 'D' OR t.fault IS NULL OR t.fault = 'truncated'))
  QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1
),
sizes AS (SELECT conv_id, max(pos) AS n FROM walk GROUP BY conv_id),
best AS MATERIALIZED (
  SELECT w.conv_id, w.cost + 5 * n.n AS cost, w.audit || repeat('I', n.n) AS audit
  FROM walk w JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.n = w.pos JOIN ins n ON n.i = w.state AND n.j IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + 5 * n.n, w.audit || repeat('I', n.n)) = 1
),
letters AS (
  SELECT conv_id, k, audit[k:k] AS letter, length(replace(audit[1:k], 'I', '')) AS pos,
    length(replace(audit[1:k], 'D', '')) AS line, length(replace(audit, 'D', '')) % 2 AS odd
  FROM best, unnest(range(1, length(audit) + 1)) x(k)
),
lines AS (
  SELECT l.conv_id, string_agg(CASE letter WHEN 'K' THEN t.role || ':' || t.text
    ELSE CASE WHEN (line - odd) % 2 = 1 THEN 'user:' ELSE 'assistant:' END || CASE letter WHEN 'R' THEN t.text ELSE '' END END, chr(10) ORDER BY k) AS text
  FROM letters l LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM l.conv_id AND t.pos = l.pos
  WHERE letter <> 'D' GROUP BY l.conv_id
),
counts AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pos > 1 AND NOT coalesce(legal, false)) AS illegal
  FROM turns GROUP BY conv_id
)
SELECT b.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, cost::BIGINT AS cost, audit, sha256(coalesce(l.text, '')) AS repaired_sha256
FROM best b LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM b.conv_id
"""
