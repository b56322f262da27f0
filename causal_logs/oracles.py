"""The registered queries as DuckDB SQL, by other means where there are any:
pairwise clock comparison, global windows, generator columns."""

_EV = """
ev AS (
  SELECT *, CAST(user_id % 4 AS INTEGER) AS node_idx, epoch_us(ts) // 1000 AS at_ms,
         epoch_us(ts) // 3600000000 AS hour,
         CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN'
              WHEN 'purchase' THEN 'INFO' WHEN 'view' THEN 'INFO' WHEN 'click' THEN 'DEBUG' END AS level,
         event_type || ' value=' || CAST(value AS VARCHAR) AS text,
         'node-' || CAST(user_id % 4 AS VARCHAR) AS node_id
  FROM events)"""

_LOG = _EV + """,
hourly AS (SELECT node_idx, hour, count(*) AS n FROM ev GROUP BY ALL),
known AS (SELECT node_idx, hour, sum(n) OVER (PARTITION BY node_idx ORDER BY hour) AS n FROM hourly),
clocks AS (
  SELECT h.node_idx, h.hour,
         coalesce(k0.n, 0) AS k0, coalesce(k1.n, 0) AS k1, coalesce(k2.n, 0) AS k2, coalesce(k3.n, 0) AS k3
  FROM hourly h
  ASOF LEFT JOIN (SELECT * FROM known WHERE node_idx = 0) k0 ON h.hour - 6 * abs(h.node_idx - 0) >= k0.hour
  ASOF LEFT JOIN (SELECT * FROM known WHERE node_idx = 1) k1 ON h.hour - 6 * abs(h.node_idx - 1) >= k1.hour
  ASOF LEFT JOIN (SELECT * FROM known WHERE node_idx = 2) k2 ON h.hour - 6 * abs(h.node_idx - 2) >= k2.hour
  ASOF LEFT JOIN (SELECT * FROM known WHERE node_idx = 3) k3 ON h.hour - 6 * abs(h.node_idx - 3) >= k3.hour),
own AS (SELECT *, row_number() OVER (PARTITION BY node_idx ORDER BY hour, event_id) AS tick FROM ev),
log AS (
  SELECT o.event_id, o.user_id, o.node_id, o.node_idx, o.level, o.text AS message, CAST(o.tick AS BIGINT) AS tick,
         CAST(o.tick - 1 AS BIGINT) AS seq, CAST(o.ts AS DATE) AS log_date, o.at_ms,
         CAST(regexp_extract(o.props, '"k": *([0-9]+)', 1) AS VARCHAR) AS k,
         CAST(CASE WHEN o.node_idx = 0 THEN tick ELSE k0 END AS BIGINT) AS v0,
         CAST(CASE WHEN o.node_idx = 1 THEN tick ELSE k1 END AS BIGINT) AS v1,
         CAST(CASE WHEN o.node_idx = 2 THEN tick ELSE k2 END AS BIGINT) AS v2,
         CAST(CASE WHEN o.node_idx = 3 THEN tick ELSE k3 END AS BIGINT) AS v3,
         o.at_ms + 3600000 * CASE o.node_idx WHEN 0 THEN 0 WHEN 1 THEN -12 WHEN 2 THEN 6 ELSE 18 END AS ts_ms
  FROM own o JOIN clocks c USING (node_idx, hour))"""

_LOSSY = _LOG + """,
lossy AS (SELECT * FROM log WHERE event_id % 10 <> 3)"""


def _le(a, b):
    return "(" + " AND ".join(f"{a}.v{i} <= {b}.v{i}" for i in range(4)) + ")"


def _before(a, b):
    return f"({_le(a, b)} AND NOT {_le(b, a)})"


_SUM = "(v0 + v1 + v2 + v3)"

_EFF = """,
eff AS (
  SELECT b.event_id, max(a.ts_ms) AS eff_ts
  FROM {log} a JOIN {log} b ON """ + _le("a", "b") + """
  GROUP BY b.event_id)"""


def _causal_order(log):
    return _EFF.format(log=log) + f""",
ordered AS (
  SELECT l.*, eff_ts,
         row_number() OVER (ORDER BY eff_ts, {_SUM}, ts_ms, node_id, seq, l.event_id) AS pos
  FROM {log} l JOIN eff USING (event_id))"""


def _audit(ordered):
    return f"""
SELECT b.event_id, b.pos, max(a.pos) AS latest_past_pos
FROM {ordered} a JOIN {ordered} b ON {_before("a", "b")}
GROUP BY b.event_id, b.pos HAVING max(a.pos) > b.pos"""


_TIMED = """,
timed AS (SELECT *, row_number() OVER (ORDER BY ts_ms, node_id, event_id) AS pos FROM log)"""


def _show(*names):
    return "'[' || " + " || ', ' || ".join(f"CAST({n} AS VARCHAR)" for n in names) + " || ']'"


_VC = _show("v0", "v1", "v2", "v3")

# --- intake -----------------------------------------------------------------

_RAW = _EV + """,
raw AS (
  SELECT *, strftime(ts, '%Y-%m-%d') || '.log' AS file, event_id % 6 AS shape,
         CAST(epoch_us(ts) // 1000 AS BIGINT) AS whole_ms
  FROM ev WHERE event_id % 6 <> 5)"""

_JSON = _LOG + """,
lines AS (
  SELECT *, event_id % 17 = 0 AS hit, (event_id // 17) % 8 AS kind,
         '{"node_id":"' || node_id || '","vector_clock":{"node-0":' || v0 || ',"node-1":' || v1 ||
         ',"node-2":' || v2 || ',"node-3":' || v3 || '},"timestamp":' || ts_ms || ',"level":"' || level ||
         '","message":"' || message || '","metadata":{"trace_id":"' || user_id || '","k":"' || k || '"}}' AS good
  FROM log),
damaged AS (
  SELECT *, CASE WHEN NOT hit THEN good
    WHEN kind = 0 THEN substr(good, 1, length(good) - 20)
    WHEN kind = 1 THEN 'not json ' || good
    WHEN kind = 2 THEN replace(good, '"timestamp":' || ts_ms, '"timestamp":9223372036854775808')
    WHEN kind = 3 THEN regexp_replace(good, '"vector_clock":\\{[^}]*\\}', '"vector_clock":"lost"')
    WHEN kind = 4 THEN replace(good, '"vector_clock":{', '"vector_clock":{"node-0":0,')
    WHEN kind = 5 THEN replace(good, '"vector_clock":{', '"vector_clock":{"peer-0":1,')
    WHEN kind = 6 THEN '{"host":"h1",' || substr(good, 2)
    ELSE replace(good, '"level":"' || level || '",', '') END AS line,
    CASE WHEN NOT hit THEN NULL WHEN kind IN (0, 1) THEN 'malformed' WHEN kind = 2 THEN 'bad_timestamp'
      WHEN kind = 3 THEN 'bad_clock' WHEN kind = 5 THEN 'bad_clock_key' END AS reason
  FROM lines)""".replace("\\\\", "\\")

# --- relations --------------------------------------------------------------


def _counts(log):
    return f"""
SELECT x.event_id,
       CAST(sum(CASE WHEN {_before("y", "x")} THEN 1 ELSE 0 END) AS BIGINT) AS n_before,
       CAST(sum(CASE WHEN {_before("x", "y")} THEN 1 ELSE 0 END) AS BIGINT) AS n_after,
       CAST(sum(CASE WHEN x.event_id <> y.event_id AND {_le("x", "y")} AND {_le("y", "x")} THEN 1 ELSE 0 END) AS BIGINT) AS n_equal,
       CAST(sum(CASE WHEN NOT {_le("x", "y")} AND NOT {_le("y", "x")} THEN 1 ELSE 0 END) AS BIGINT) AS n_concurrent
FROM {log} x, {log} y GROUP BY x.event_id"""


def _graph(log):
    return f""",
last_known AS (
  SELECT b.event_id AS dst, b.node_idx AS dst_node, a.node_idx AS src_node, max(a.tick) AS tick
  FROM {log} a JOIN {log} b ON {_before("a", "b")} GROUP BY ALL),
candidate AS (
  SELECT k.*, a.event_id AS src, a.v0, a.v1, a.v2, a.v3
  FROM last_known k JOIN {log} a ON a.node_idx = k.src_node AND a.tick = k.tick)
SELECT c.src AS src_event, c.dst AS dst_event, c.src_node, c.dst_node
FROM candidate c
WHERE NOT EXISTS (
  SELECT 1 FROM candidate d WHERE d.dst = c.dst AND d.src <> c.src AND {_before("c", "d")})"""


def _clock_audit(log, bad="0"):
    falls = " OR ".join(f"(node_idx <> {j} AND v{j} < p{j})" for j in range(4))
    lacks = " UNION ".join(
        f"""SELECT b.node_idx, b.tick, b.copies FROM news b ASOF JOIN (SELECT * FROM per_tick WHERE node_idx = {j}) s ON b.v{j} >= s.tick
        WHERE b.node_idx <> {j} AND b.v{j} > coalesce(b.p{j}, 0) AND NOT {_le("s", "b")}"""
        for j in range(4)
    )
    return f""",
top AS (SELECT node_idx, max(own) AS m FROM {log} GROUP BY 1),
stepped AS (SELECT *, lag(own) OVER (PARTITION BY node_idx ORDER BY seq, event_id) AS p FROM {log}),
per_tick AS (
  SELECT node_idx, own AS tick, count(*) AS copies, max(v0) AS v0, max(v1) AS v1, max(v2) AS v2, max(v3) AS v3
  FROM {log} WHERE node_idx IS NOT NULL AND own > 0 GROUP BY ALL),
news AS (SELECT *, lag(v0) OVER w AS p0, lag(v1) OVER w AS p1, lag(v2) OVER w AS p2, lag(v3) OVER w AS p3
  FROM per_tick WINDOW w AS (PARTITION BY node_idx ORDER BY tick)),
lacking AS ({lacks})
SELECT node_idx, CAST(count(*) AS BIGINT) AS entries, CAST(max(own) AS BIGINT) AS max_tick,
       CAST(max(own) - count(DISTINCT CASE WHEN own > 0 THEN own END) AS BIGINT) AS missing_ticks,
       CAST(count(CASE WHEN own > 0 THEN 1 END) - count(DISTINCT CASE WHEN own > 0 THEN own END) AS BIGINT) AS duplicate_ticks,
       CAST(count(CASE WHEN own <= p THEN 1 END) AS BIGINT) AS not_rising,
       CAST(count(CASE WHEN v0 > (SELECT m FROM top WHERE node_idx = 0) OR v1 > (SELECT m FROM top WHERE node_idx = 1)
                OR v2 > (SELECT m FROM top WHERE node_idx = 2) OR v3 > coalesce((SELECT m FROM top WHERE node_idx = 3), 0)
                THEN 1 END) AS BIGINT) AS above_owner,
       CAST({bad} AS BIGINT) AS bad_size,
       CAST(coalesce((SELECT sum(copies) FROM news n WHERE n.node_idx = stepped.node_idx AND ({falls})), 0) AS BIGINT) AS knowledge_falls,
       CAST(coalesce((SELECT sum(copies) FROM lacking l WHERE l.node_idx = stepped.node_idx), 0) AS BIGINT) AS knowledge_incomplete
FROM stepped GROUP BY node_idx"""


def _ranges(log):
    """Bounds by looking at all entries of a node, counts by comparing all pairs."""
    of = lambda row, node: f"CASE {node} " + " ".join(f"WHEN {j} THEN {row}.v{j}" for j in range(4)) + " END"
    return f"""
SELECT b.event_id AS target_id, b.node_idx AS target_node, a.node_idx,
       any_value(CASE WHEN a.node_idx = b.node_idx THEN b.tick - 1 ELSE {of("b", "a.node_idx")} END) AS known_upto,
       min(CASE WHEN a.node_idx = b.node_idx THEN b.tick + 1 WHEN {of("a", "b.node_idx")} >= b.tick THEN a.tick END) AS first_knowing,
       CAST(count(*) FILTER ({_before("a", "b")}) AS BIGINT) AS n_before,
       CAST(count(*) FILTER (NOT {_le("a", "b")} AND NOT {_le("b", "a")}) AS BIGINT) AS n_concurrent,
       CAST(count(*) FILTER ({_before("b", "a")}) AS BIGINT) AS n_after
FROM {log} a, target b GROUP BY b.event_id, b.node_idx, a.node_idx"""


_RESTAMPED = _LOG + """,
restamped AS (
  SELECT event_id, node_id, node_idx, seq, ts_ms, CASE WHEN node_idx = 0 THEN tick ELSE 0 END AS own,
         tick AS v0, 0 AS v1, 0 AS v2, 0 AS v3 FROM log)"""

_UNLISTED = _LOG + """,
unlisted AS (
  SELECT event_id, node_id, CASE WHEN node_idx < 3 THEN node_idx END AS node_idx, seq, ts_ms,
         CASE WHEN node_idx < 3 THEN tick ELSE 0 END AS own, v0, v1, v2, CASE WHEN event_id % 50 = 7 THEN 0 ELSE v3 END AS v3
  FROM log)"""

_INCOMPLETE = _LOG + """,
incomplete AS (
  SELECT event_id, node_id, node_idx, seq, ts_ms, tick AS own, v0,
         CASE WHEN node_idx = 2 AND event_id % 40 = 6 THEN greatest(v1 - 100, 0) ELSE v1 END AS v1, v2,
         CASE WHEN node_idx = 0 AND day(log_date) % 3 = 0 THEN 0 ELSE v3 END AS v3 FROM log)"""

_TRACE = """
turns AS (
  SELECT conv_id * 1000 + turn AS event, CAST((conv_id + 3 * turn) % 8 AS INTEGER) AS node_idx, conv_id, turn
  FROM conversations),
placed AS (SELECT *, row_number() OVER (PARTITION BY node_idx ORDER BY turn, conv_id) AS tick FROM turns),
step AS (
  SELECT event, lag(event) OVER (PARTITION BY node_idx ORDER BY tick) AS cause FROM placed
  UNION
  SELECT b.event, a.event FROM turns a JOIN turns b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1),
reach AS (
  SELECT event, event AS cause FROM placed
  UNION
  SELECT r.event, s.cause FROM reach r JOIN step s ON s.event = r.cause WHERE s.cause IS NOT NULL)"""

# --- search -----------------------------------------------------------------

_WORDS = r"""
words AS (
  SELECT event_id, token, count(*) AS tf
  FROM (SELECT doc_id AS event_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS token FROM documents)
  WHERE token <> '' GROUP BY ALL)"""


def _hits(words, least):
    listed = ", ".join(f"'{w}'" for w in words)
    return f""",
hits AS (
  SELECT event_id, CAST(count(*) AS BIGINT) AS matched, CAST(sum(tf) AS BIGINT) AS tf
  FROM words WHERE token IN ({listed}) GROUP BY event_id HAVING count(*) >= {least})"""


_RELATION = f"""CASE WHEN {_le("a", "b")} AND {_le("b", "a")} THEN 'EQUAL' WHEN {_le("a", "b")} THEN 'HAPPENS_BEFORE'
       WHEN {_le("b", "a")} THEN 'HAPPENS_AFTER' ELSE 'CONCURRENT' END"""

ORACLES = {
    "ingest_raw_lines": f"""WITH {_RAW}
        SELECT event_id, node_id, file, event_id AS line_no, level_out AS level, message,
               CASE shape WHEN 0 THEN whole_ms // 1000 * 1000 WHEN 1 THEN whole_ms ELSE whole_ms + 1000 END AS ts_ms
        FROM (SELECT *, text AS message, CASE WHEN shape = 4 THEN 'INFO' ELSE level END AS level_out FROM raw)""",
    "ingest_raw_lines_observed": f"""WITH {_RAW}
        SELECT event_id, node_id, file, event_id AS line_no,
               CASE WHEN shape IN (0, 4) THEN 'INFO' ELSE level END AS level,
               CASE WHEN shape = 0 THEN strftime(ts, '%M:%S') || ' ' || level || '  ' || text ELSE text END AS message,
               CASE shape WHEN 1 THEN whole_ms ELSE whole_ms + 1000 END AS ts_ms
        FROM raw""",
    "stamp_clocks": f"""WITH {_RAW},
        s AS (SELECT event_id, node_idx, row_number() OVER (PARTITION BY node_idx ORDER BY file, event_id) AS t FROM raw)
        SELECT event_id, node_idx, CAST(t - 1 AS BIGINT) AS seq,
               '[' || array_to_string(list_transform([0, 1, 2, 3], lambda i: CASE WHEN i = node_idx THEN t ELSE 0 END), ', ') || ']' AS vc
        FROM s""",
    "stream_ingest": f"""WITH {_RAW},
        s AS (SELECT *, row_number() OVER (PARTITION BY node_idx ORDER BY event_id) AS t FROM raw)
        SELECT node_id, CAST(t - 1 AS BIGINT) AS seq,
               '[' || array_to_string(list_transform([0, 1, 2, 3], lambda i: CASE WHEN i = node_idx THEN t ELSE 0 END), ', ') || ']' AS vc,
               CASE WHEN shape = 4 THEN 'INFO' ELSE level END AS level, text AS message
        FROM s""",
    "stream_to_store": f"""WITH {_RAW},
        s AS (SELECT *, row_number() OVER (PARTITION BY node_idx ORDER BY event_id) AS t FROM raw)
        SELECT node_id, CAST(t - 1 AS BIGINT) AS seq,
               '[' || array_to_string(list_transform([0, 1, 2, 3], lambda i: CASE WHEN i = node_idx THEN t ELSE 0 END), ', ') || ']' AS vc,
               CASE WHEN shape = 4 THEN 'INFO' ELSE level END AS level, text AS message
        FROM s""",
    "ingest_jsonl": f"""WITH {_JSON}
        SELECT event_id, node_id, {_VC} AS vc, ts_ms,
               CASE WHEN hit AND kind = 7 THEN 'INFO' ELSE level END AS level, message,
               CAST(user_id AS VARCHAR) AS meta_trace_id, k AS meta_k
        FROM damaged WHERE reason IS NULL""",
    "ingest_jsonl_rejects": f"WITH {_JSON} SELECT event_id, line, reason FROM damaged WHERE reason IS NOT NULL",
    "ingest_stats": f"""WITH {_JSON}
        SELECT node_id AS source_node, log_date, CAST(count(*) AS BIGINT) AS received,
               CAST(count(*) FILTER (reason IS NULL) AS BIGINT) AS stored, CAST(count(reason) AS BIGINT) AS errors,
               CAST(sum(strlen(line)) AS BIGINT) AS bytes
        FROM damaged GROUP BY ALL""",
    "export_jsonl": f"""WITH {_JSON}
        SELECT event_id, log_date, good AS line, {_VC} AS vc_text,
               strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S.%g') AS ts_text FROM lines""",
    "export_jsonl_ascii": r"""
        SELECT doc_id AS event_id,
               '{"node_id":"node-0","vector_clock":{"node-0":' || (doc_id + 1) || '},"timestamp":' || doc_id ||
               ',"level":"INFO","message":"' ||
               replace(replace(replace(replace(regexp_replace(text, '[^\x20-\x7E\n\t]', '', 'g'),
                 '\', '\\'), '"', '\"'), chr(10), '\n'), chr(9), '\t') || '"}' AS line
        FROM documents""",
    "causal_order": f"WITH {_LOG}{_causal_order('log')} SELECT event_id, eff_ts, pos FROM ordered",
    "causal_order_lossy": f"WITH {_LOSSY}{_causal_order('lossy')} SELECT event_id, eff_ts, pos FROM ordered",
    "causal_order_any_clock": f"""WITH {_RESTAMPED}
        SELECT event_id, row_number() OVER (ORDER BY {_SUM}, ts_ms, node_id, seq, event_id) AS pos FROM restamped""",
    "time_order": f"WITH {_LOG}{_TIMED} SELECT event_id, pos FROM timed",
    "order_audit_time": f"WITH {_LOG}{_TIMED}{_audit('timed')}",
    "order_audit_causal": f"WITH {_LOG}{_causal_order('log')}{_audit('ordered')}",
    "clock_relation": f"""WITH {_LOG},
        paired AS (SELECT *, lag(event_id) OVER (PARTITION BY level ORDER BY ts_ms, event_id) AS prev FROM log),
        related AS (
          SELECT b.level, a.event_id AS a_event_id, b.event_id AS b_event_id, {_RELATION} AS relation,
                 a.ts_ms AS a_ts, b.ts_ms AS b_ts, a.node_id AS a_node, b.node_id AS b_node
          FROM paired b JOIN log a ON a.event_id = b.prev)
        SELECT level, a_event_id, b_event_id, relation,
               CASE WHEN relation = 'HAPPENS_BEFORE' THEN -1 WHEN relation = 'HAPPENS_AFTER' THEN 1
                    WHEN a_ts < b_ts THEN -1 WHEN a_ts > b_ts THEN 1
                    WHEN a_node < b_node THEN -1 WHEN a_node > b_node THEN 1 ELSE 0 END AS sign
        FROM related""",
    "pairs_within": f"""WITH {_LOG},
        related AS (
          SELECT a.event_id AS a_event_id, b.event_id AS b_event_id, b.ts_ms - a.ts_ms AS gap_ms, {_RELATION} AS relation, a.node_id AS a_node, b.node_id AS b_node
          FROM log a JOIN log b ON b.ts_ms BETWEEN a.ts_ms AND a.ts_ms + 600000 AND a.node_id <> b.node_id
            AND (a.ts_ms < b.ts_ms OR a.event_id < b.event_id))
        SELECT a_event_id, b_event_id, gap_ms, relation,
               CASE WHEN relation = 'HAPPENS_BEFORE' THEN -1 WHEN relation = 'HAPPENS_AFTER' THEN 1 WHEN gap_ms > 0 THEN -1
                    WHEN a_node < b_node THEN -1 ELSE 1 END AS sign FROM related""",
    "relation_counts": f"WITH {_LOG}{_counts('log')}",
    "relation_counts_lossy": f"WITH {_LOSSY}{_counts('lossy')}",
    "causal_slice": f"""WITH {_LOG},
        middle AS (SELECT node_idx, max(tick) // 2 AS m FROM log GROUP BY 1),
        target AS (
          SELECT * FROM log WHERE (node_idx, tick) IN (
            SELECT (l.node_idx, min(tick)) FROM log l JOIN middle USING (node_idx)
            WHERE level = 'ERROR' AND tick >= m GROUP BY l.node_idx))
        SELECT b.event_id AS target_id, a.event_id, {_RELATION} AS relation
        FROM log a, target b WHERE a.event_id <> b.event_id""",
    "causal_ranges": f"""WITH {_LOG},
        middle AS (SELECT node_idx, max(tick) // 2 AS m FROM log GROUP BY 1),
        target AS (
          SELECT * FROM log WHERE (node_idx, tick) IN (
            SELECT (l.node_idx, min(tick)) FROM log l JOIN middle USING (node_idx)
            WHERE level = 'ERROR' AND tick >= m GROUP BY l.node_idx)){_ranges("log")}""",
    "causal_ranges_lossy": f"WITH {_LOSSY}, target AS (SELECT * FROM lossy WHERE event_id % 100 = 0){_ranges('lossy')}",
    "causal_slice_restamped": f"""WITH {_RESTAMPED}
        SELECT b.event_id AS target_id, a.event_id, {_RELATION} AS relation
        FROM restamped a, restamped b WHERE b.event_id % 500 = 0 AND a.event_id <> b.event_id
          AND {_RELATION} IN ('HAPPENS_BEFORE', 'HAPPENS_AFTER')""",
    "merge_clocks": f"""WITH {_LOG}
        SELECT level, log_date, {_show("max(v0)", "max(v1)", "max(v2)", "max(v3)")} AS merged, count(*) AS n
        FROM log GROUP BY level, log_date""",
    "running_frontier": f"""WITH {_LOSSY}
        SELECT node_id, seq, {_show(*[f"max(v{i}) OVER w" for i in range(4)])} AS frontier
        FROM lossy WINDOW w AS (PARTITION BY node_id ORDER BY seq)""",
    "level_frontier": f"""WITH {_LOG}
        SELECT level, event_id, {_show(*[f"max(v{i}) OVER w" for i in range(4)])} AS frontier
        FROM log WINDOW w AS (PARTITION BY level ORDER BY event_id)""",
    "replay_clocks": f"""WITH RECURSIVE {_TRACE}
        SELECT p.event, p.node_idx, CAST(p.tick - 1 AS BIGINT) AS seq,
               {_show(*[f"coalesce(max(c.tick) FILTER (c.node_idx = {i}), 0)" for i in range(8)])} AS vc
        FROM placed p JOIN reach r ON r.event = p.event JOIN placed c ON c.event = r.cause
        GROUP BY p.event, p.node_idx, p.tick""",
    "replay_clocks_lossy": f"""WITH RECURSIVE {_TRACE.replace("placed AS (", "all_placed AS (", 1).replace(
        "step AS (", "placed AS (SELECT * FROM all_placed WHERE event % 7 <> 3 AND NOT (event % 1000 = 1 AND event // 1000 % 10 = 0)),\nstep AS (", 1
    ).replace("FROM turns a JOIN turns b", "FROM placed a JOIN placed b", 1)}
        SELECT p.event, p.node_idx, CAST(p.tick - 1 AS BIGINT) AS seq,
               {_show(*[f"coalesce(max(c.tick) FILTER (c.node_idx = {i}), 0)" for i in range(8)])} AS vc
        FROM placed p JOIN reach r ON r.event = p.event JOIN placed c ON c.event = r.cause
        GROUP BY p.event, p.node_idx, p.tick""",
    "causal_graph": f"WITH {_LOG}{_graph('log')}",
    "causal_graph_lossy": f"WITH {_LOSSY}{_graph('lossy')}",
    "clock_audit_lossy": f"WITH {_LOSSY}, checked AS (SELECT *, tick AS own FROM lossy){_clock_audit('checked')}",
    "clock_audit_unlisted": f"WITH {_UNLISTED}{_clock_audit('unlisted', 'count(CASE WHEN event_id % 50 = 7 THEN 1 END)')}",
    "store_causal_order": f"WITH {_LOG}{_causal_order('log')} SELECT node_id, seq, eff_ts, pos FROM ordered",
    "store_order_audit": f"""WITH {_LOG}{_TIMED}, late AS ({_audit('timed')})
        SELECT node_id, seq, late.pos, latest_past_pos FROM late JOIN log USING (event_id)""",
    "running_frontier_whole": f"""WITH {_LOG}
        SELECT node_id, seq, {_show(*[f"max(v{i}) OVER w" for i in range(4)])} AS frontier
        FROM log WINDOW w AS (PARTITION BY node_id ORDER BY seq)""",
    "log_query_stored": f"""WITH {_LOG} SELECT event_id, node_id, level, ts_ms FROM log
        WHERE level IN ('WARN', 'ERROR', 'FATAL') AND node_id = 'node-1' AND log_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'""",
    "keyword_search_stored": rf"""WITH {_LOG}, tokens AS (
          SELECT event_id, unnest(regexp_split_to_array(lower(message), '[^\p{{L}}\p{{N}}]+')) AS token FROM log)
        SELECT event_id, CAST(count(DISTINCT token) AS BIGINT) AS matched, CAST(count(*) AS BIGINT) AS tf
        FROM tokens WHERE token IN ('value', '1', 'error') GROUP BY event_id HAVING count(DISTINCT token) = 3""",
    "clock_audit_restamped": f"WITH {_RESTAMPED}{_clock_audit('restamped')}",
    "clock_audit_incomplete": f"WITH {_INCOMPLETE}{_clock_audit('incomplete')}",
    "relation_counts_restamped": f"WITH {_RESTAMPED}{_counts('restamped')}",
    "relation_counts_incomplete": f"WITH {_INCOMPLETE}{_counts('incomplete')}",
    "order_audit_restamped": f"""WITH {_RESTAMPED},
        timed AS (SELECT *, row_number() OVER (ORDER BY ts_ms, node_id, event_id) AS pos FROM restamped){_audit('timed')}""",
    "order_audit_incomplete": f"""WITH {_INCOMPLETE},
        timed AS (SELECT *, row_number() OVER (ORDER BY ts_ms, node_id, event_id) AS pos FROM incomplete){_audit('timed')}""",
    "missing_ticks": f"""WITH {_LOSSY},
        stepped AS (SELECT node_idx, tick, coalesce(lag(tick) OVER (PARTITION BY node_idx ORDER BY tick), 0) AS p FROM lossy)
        SELECT node_idx, p + 1 AS first_missing, tick - 1 AS last_missing FROM stepped WHERE tick - p > 1""",
    "log_query": f"""WITH {_LOG}
        SELECT event_id, node_id, level, CAST(CASE level WHEN 'WARN' THEN 2 ELSE 3 END AS INTEGER) AS level_rank, message,
               strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S.%g') AS ts_text
        FROM log
        WHERE level IN ('WARN', 'ERROR', 'FATAL') AND node_id IN ('node-0', 'node-2') AND ts_ms >= 1704412800000
          AND log_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-25' AND k = '7'""",
    "log_query_first": f"""WITH {_LOG}
        SELECT event_id, node_id, ts_ms, message FROM log WHERE level = 'ERROR'
        ORDER BY ts_ms, node_id, event_id LIMIT 100""",
    "log_query_causal": f"""WITH {_LOG}{_causal_order('log')}
        SELECT event_id, pos FROM ordered WHERE level = 'ERROR' AND node_id = 'node-1'""",
    "log_query_causal_first": f"""WITH {_LOG}{_causal_order('log')}
        SELECT event_id, eff_ts, pos FROM ordered WHERE level = 'ERROR' AND node_id = 'node-1' ORDER BY pos LIMIT 50""",
    "metadata_lookup": f"""WITH {_LOG}
        SELECT event_id, CAST(user_id AS VARCHAR) AS meta_trace_id, k AS meta_k, level AS meta_level,
               CAST(NULL AS VARCHAR) AS meta_nonexistent FROM log""",
    "metadata_pairs": f"""WITH {_LOG}
        SELECT event_id, 'trace_id' AS key, CAST(user_id AS VARCHAR) AS value FROM log
        UNION ALL SELECT event_id, 'k', k FROM log""",
    "metadata_groups": f"""WITH {_LOG}
        SELECT CAST(user_id AS VARCHAR) AS value, count(*) AS n, min(ts_ms) AS first_ms, max(ts_ms) AS last_ms,
               {_show("max(v0)", "max(v1)", "max(v2)", "max(v3)")} AS merged
        FROM log GROUP BY user_id""",
    "build_inverted_index": f"WITH {_WORDS} SELECT token, event_id, tf FROM words",
    "keyword_hits_all": f"WITH {_WORDS}{_hits(('und', 'die'), 2)} SELECT * FROM hits",
    "keyword_hits_any": f"WITH {_WORDS}{_hits(('und', 'die', 'la'), 1)} SELECT * FROM hits",
    "keyword_search": f"""WITH {_WORDS}{_hits(('und', 'die'), 2)}
        SELECT event_id, CAST(length(text) AS INTEGER) AS n_chars FROM hits JOIN documents ON doc_id = event_id""",
    "keyword_scan": f"""WITH {_WORDS}{_hits(('und', 'die', 'la'), 1)}
        SELECT event_id, CAST(length(text) AS INTEGER) AS n_chars FROM hits JOIN documents ON doc_id = event_id""",
}
ORACLES["keyword_blocks"] = ORACLES["keyword_search_stored"]
ORACLES["keyword_blocks_any"] = ORACLES["keyword_hits_any"]
