import json

import pytest
from pyspark.sql import functions as F

from causal_logs.functions import entries, levels
from causal_logs.operators import ingest
from causal_logs.sources import jsonl, raw, store

NOW = 111
AT = 1719655201000  # 2024-06-29 10:00:01 UTC

# line, documented (level, ts, message), observed (level, ts, message)
LINES = [
    ("2024-06-29 10:00:01 INFO  Worker seven is ready", ("INFO", AT, "Worker seven is ready"), ("INFO", NOW, "00:01 INFO  Worker seven is ready")),
    ("2024-06-29 10:00:01 WARN  Disk almost full (93%)", ("WARN", AT, "Disk almost full (93%)"), ("INFO", NOW, "00:01 WARN  Disk almost full (93%)")),
    ("2024-06-29 10:00:01 ERROR Failed: timeout", ("ERROR", AT, "Failed: timeout"), ("INFO", NOW, "00:01 ERROR Failed: timeout")),
    ("2024-06-29 10:00:01 INFO Lamp switched on ", ("INFO", AT, "Lamp switched on "), ("INFO", NOW, "00:01 INFO Lamp switched on ")),
    ('   say "2024-06-29 10:01:00 INFO Lamp switched on" ',) + (("INFO", NOW, '   say "2024-06-29 10:01:00 INFO Lamp switched on" '),) * 2,
    ("2024-06-29 10:00:01.123 ERROR Something failed",) + (("ERROR", AT + 123, "Something failed"),) * 2,
    ("2024-06-29 10:00:01.5 warn", ("WARN", AT + 500, ""), ("WARN", AT + 5, "")),
    ("2024-06-29 10:00:01.123", ("INFO", NOW, "2024-06-29 10:00:01.123"), ("INFO", NOW, "00:01.123")),
    ("2024-06-29 10:00:01 Hello world", ("INFO", AT, "Hello world"), ("INFO", NOW, "00:01 Hello world")),
    ("2024-06-29 10:00:01 WARNING disk", ("INFO", AT, "WARNING disk"), ("INFO", NOW, "00:01 WARNING disk")),
    ("2024-06-29 10:00:01.250 Hello world", ("INFO", AT + 250, "Hello world"), ("INFO", AT + 250, "world")),
    ("[INFO] Request started",) + (("INFO", NOW, "Request started"),) * 2,
    ("INFO: Request started",) + (("INFO", NOW, "Request started"),) * 2,
    (" ERROR: x", ("ERROR", NOW, "x"), ("INFO", NOW, "x")),
    ("http://x/y", ("INFO", NOW, "http://x/y"), ("INFO", NOW, "//x/y")),
    ("A very long prefix here: x",) + (("INFO", NOW, "A very long prefix here: x"),) * 2,
    ("[INFO]",) + (("INFO", NOW, "[INFO]"),) * 2,
    ("   ",) + (("INFO", NOW, "   "),) * 2,
    ("2024-13-01 10:00:01.000 INFO x", None, ("INFO", 1735725601000, "x")),
]


@pytest.mark.parametrize("grammar", ["documented", "observed"])
def test_line_grammars(spark, grammar):
    rows = [("n", "f", i, line, NOW) for i, (line, *_) in enumerate(LINES)] + [("n", "f", 99, "", NOW)]
    df = spark.createDataFrame(rows, "node_id string, file string, line_no long, line string, now long")
    got = {r.line_no: (r.level, r.ts_ms, r.message) for r in ingest.ingest_raw_lines(df, grammar, "now").collect()}
    want = {i: (doc, obs)[grammar == "observed"] for i, (_, doc, obs) in enumerate(LINES)}
    assert got == {i: w for i, w in want.items() if w is not None}
    rejected = ingest.ingest_raw_lines_rejects(df, grammar, "now").collect()
    assert [(r.line_no, r.reason) for r in rejected] == [(i, "bad_timestamp") for i, w in want.items() if w is None]


def test_message_cut_keeps_characters_whole(spark):
    df = spark.createDataFrame([("n", "f", 1, "abcé日本", NOW)], "node_id string, file string, line_no long, line string, now long")
    cut = lambda n: ingest.ingest_raw_lines(df, ingest_ts="now", max_message_bytes=n).first().message
    assert [cut(n) for n in (3, 4, 5, 7, 8, 50)] == ["abc", "abc", "abcé", "abcé", "abcé日", "abcé日本"]


def test_levels(spark):
    names = ["DEBUG", "info", "Warn", "ERROR", "fatal", "unknown", None, "WARNING"]
    df = spark.createDataFrame([(n,) for n in names], "l string")
    got = df.select(levels.normalize("l"), levels.rank("l")).collect()
    assert [tuple(r) for r in got] == [
        ("DEBUG", 0), ("INFO", 1), ("WARN", 2), ("ERROR", 3), ("FATAL", 4), ("INFO", None), ("INFO", None), ("INFO", None),
    ]
    ranks = spark.createDataFrame([(r,) for r in (0, 4, 5, -1)], "r int").select(levels.label("r")).collect()
    assert [r[0] for r in ranks] == ["DEBUG", "FATAL", "UNKNOWN", "UNKNOWN"]


def test_stamp_clocks_counts_over_files_and_blocks(spark):
    rows = [(n, f, i, f"INFO: {n} {f} {i}") for n in "ab" for f in ("1", "2") for i in range(1, 24)]
    df = spark.createDataFrame(rows, "node_id string, file string, line_no long, line string")
    nodes = ingest.node_dimension(df)
    stamped = ingest.stamp_clocks(ingest.ingest_raw_lines(df), nodes, 3, rows=5).orderBy("node_id", "seq").collect()
    order = sorted(rows)
    assert [r.message for r in stamped] == [line[6:] for *_, line in order]
    assert [r.seq for r in stamped] == list(range(46)) * 2
    assert all(r.vc == [r.seq + 1 if i == r.node_idx else 0 for i in range(3)] for r in stamped)


def test_unlisted_nodes_stay_and_too_many_fail(spark):
    schema = "node_id string, file string, line_no long, line string"
    df = spark.createDataFrame([("a", "f", 1, "x"), ("b", "f", 1, "y"), (None, "f", 1, "z")], schema)
    nodes = spark.createDataFrame([("a", 0)], "node_id string, node_idx int")
    got = {(r.node_id, r.node_idx, tuple(r.vc)) for r in ingest.stamp_clocks(ingest.ingest_raw_lines(df), nodes, 2).collect()}
    assert got == {("a", 0, (1, 0)), ("b", None, (0, 0)), ("", None, (0, 0))}
    many = spark.range(33).selectExpr("cast(id as string) as node_id", "cast(id as int) as node_idx")
    with pytest.raises(ValueError):
        ingest.stamp_clocks(ingest.ingest_raw_lines(df), many, 2)
    with pytest.raises(ValueError):
        ingest.node_dimension(many)


def test_text_files_keep_line_numbers(spark, tmp_path):
    for node in "ab":
        (tmp_path / node).mkdir()
        (tmp_path / node / "1.log").write_text("".join(f"INFO: {node}{i}\n" for i in range(500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = raw.read_raw_lines(spark, str(tmp_path / "*")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.node_id, r.line_no, r.line) for r in got) == sorted(
        (n, i + 1, f"INFO: {n}{i}") for n in "ab" for i in range(500)
    )


def test_jsonl_reasons(spark):
    good = '{"node_id":"node-01","vector_clock":{"node-0":1,"node-1":0,"node-2":0},"timestamp":1782927620557,"level":"INFO","message":"m"}'
    cases = [
        (good, None), (good[:-9], "malformed"), ("not json", "malformed"), ("", "malformed"), ("[]", "malformed"),
        (good.replace("1782927620557", "9223372036854775808"), "bad_timestamp"),
        (good.replace("1782927620557", "-5"), "bad_timestamp"),
        (good.replace('"node_id":"node-01",', ""), "missing_node_id"),
        (good.replace('{"node-0":1,"node-1":0,"node-2":0}', '"x"'), "bad_clock"),
        (good.replace('"vector_clock":{"node-0":1,"node-1":0,"node-2":0},', ""), "bad_clock"),
        (good.replace("node-2", "other"), "bad_clock_key"),
        (good.replace("node-2", "node-77"), "clock_too_wide"),
        (good.replace('"level"', '"host":"h","level"'), None),
        (good.replace('"level":"INFO",', ""), None),
    ]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, line string")
    rejects = {r.i: r.reason for r in jsonl.ingest_jsonl_rejects(df).collect()}
    assert rejects == {i: reason for i, (_, reason) in enumerate(cases) if reason}
    rows = jsonl.ingest_jsonl(df).collect()
    assert {r.i for r in rows} == {i for i, (_, reason) in enumerate(cases) if not reason}
    assert all((r.node_id, r.vc, r.ts_ms, r.level, r.message) == ("node-01", [1, 0, 0], 1782927620557, "INFO", "m") for r in rows)


def _log(spark, rows):
    return spark.createDataFrame(
        rows, "node_id string, vc array<bigint>, ts_ms long, level string, message string, metadata map<string,string>, log_date date"
    )


def test_export_format_and_store_round_trip(spark, tmp_path):
    import datetime
    days = [datetime.date(2024, 6, 29), datetime.date(2024, 6, 30)]
    rows = [
        ("node-01", [1, 3, 2], 1719648000000, "INFO", "Request processed successfully", {"trace_id": "abc-123", "request_id": "req-456"}, days[0]),
        ("node-02", [0, 4, 2], 1719648000001, "WARN", 'q"b\\n\nt\té', None, days[1]),
        ("node-02", [0, 5, 2], 1719648000002, "WARN", "", {}, days[1]),
    ]
    log = _log(spark, rows)
    out = [tuple(r) for r in store.export_jsonl(log).select("line", "vc_text", "ts_text").collect()]
    head = (
        '{"node_id":"node-01","vector_clock":{"node-0":1,"node-1":3,"node-2":2},"timestamp":1719648000000,"level":"INFO",'
        '"message":"Request processed successfully","metadata":'
    )
    assert out[0][0].startswith(head) and json.loads(out[0][0])["metadata"] == rows[0][5]
    assert out[0][1:] == ("[1, 3, 2]", "2024-06-29 08:00:00.000")
    assert '"message":"q\\"b\\\\n\\nt\\té"}' in out[1][0] and "metadata" not in out[2][0]
    assert "té" not in store.export_jsonl(log, ascii_only=True).collect()[1].line
    assert store.export_jsonl(log, max_record_bytes=150).count() == 2
    for files in (None, 2):
        path = str(tmp_path / f"store{files}")
        store.write_jsonl(log, path, files)
        back = store.read_store(spark, path)
        got = sorted((r.node_id, r.vc, r.ts_ms, r.level, r.message, r.metadata, r.log_date) for r in back.collect())
        assert got == sorted((*r[:5], r[5] or None, r[6]) for r in rows)
        day = back.where(F.col("log_date") == "2024-06-29")
        assert day.count() == 1
        assert "PartitionFilters: [isnotnull(log_date" in day._jdf.queryExecution().executedPlan().toString()


def test_typed_table_round_trip(spark, tmp_path):
    import datetime
    day = datetime.date(2024, 6, 29)
    log = _log(spark, [("n", [1], 5, "INFO", "m", {"a": "b"}, day)]).withColumn("extra", F.lit(7))
    store.write_table(log, str(tmp_path / "t"))
    back = store.read_table(spark, str(tmp_path / "t"))
    row = back.where(F.col("log_date") == "2024-06-29").first()
    assert (row.node_id, row.node_idx, row.vc, row.ts_ms, row.seq, row.extra, row.log_date) == ("n", None, [1], 5, None, 7, day)
    assert dict(back.dtypes)["seq"] == "bigint" and dict(back.dtypes)["vc"] == "array<bigint>"


def test_metadata_rules(spark):
    df = _log(spark, [("n", [1], 1, "INFO", "m", {"trace_id": "abc-123", "request_id": "req-456"}, None)])
    add = lambda k, v, limit=None: df.select(entries.add_metadata("metadata", k, v, limit)).first()[0]
    assert add("k", "v") == {"trace_id": "abc-123", "request_id": "req-456", "k": "v"}
    assert add("trace_id", "other")["trace_id"] == "abc-123"
    assert "k" not in add("k", "v", 2) and "k" in add("k", "v", 3)
    get = lambda k: df.select(entries.get_metadata("metadata", k)).first()[0]
    assert [get(k) for k in ("trace_id", "request_id", "nonexistent")] == ["abc-123", "req-456", None]
    line = '{"node_id":"n","vector_clock":{"node-0":1},"timestamp":1,"message":"m","metadata":{"a":"1","b":"2","a":"3","c":"4"}}'
    text = spark.createDataFrame([(line,)], "line string")
    assert jsonl.ingest_jsonl(text).first().metadata == {"a": "1", "b": "2", "c": "4"}
    assert jsonl.ingest_jsonl(text, max_metadata=2).first().metadata == {"a": "1", "b": "2"}


def test_ingest_stats(spark):
    good = '{"node_id":"n%d","vector_clock":{"node-0":1},"timestamp":1,"message":"é"}'
    df = spark.createDataFrame([(good % 1,), (good % 1,), (good % 2,), ("xx",)], "line string")
    got = {r.node_id: tuple(r)[1:] for r in ingest.ingest_stats(jsonl.decode(df), ["node_id"]).collect()}
    size = len((good % 1).encode())
    assert got == {"n1": (2, 2, 0, 2 * size), "n2": (1, 1, 0, size), None: (1, 0, 1, 2)}


def test_rows_without_a_place_are_kept(spark):
    from causal_logs.operators import ingest

    rows = [("a", "f", 1), ("a", None, 2), ("a", "f", None), (None, "f", 3)]
    parsed = spark.createDataFrame(rows, "node_id string, file string, line_no bigint")
    nodes = spark.createDataFrame([("a", 0)], "node_id string, node_idx int")
    stamped = ingest.stamp_clocks(parsed, nodes, 2).collect()
    assert sorted((r.file or "", r.line_no or 0) for r in stamped) == sorted((f or "", n or 0) for _, f, n in rows)
    assert sorted(r.seq for r in stamped if r.node_id == "a") == [0, 1, 2]


def test_stored_records_of_three_nodes_in_causal_order(spark, tmp_path):
    from causal_logs.operators import ingest, order
    from causal_logs.sources import store

    nodes = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "node_id string, node_idx int")
    # a sends to b, b to c; wall clocks run backwards.
    rows = [("a", [1, 0, 0], 300), ("b", [1, 1, 0], 200), ("c", [1, 1, 1], 100), ("d", [1, 1, 1], 1), ("c", [2, 0, 0], 5)]
    log = spark.createDataFrame(
        [(n, vc, t, "INFO", "m", {}) for n, vc, t in rows],
        "node_id string, vc array<bigint>, ts_ms bigint, level string, message string, metadata map<string,string>",
    )
    store.write_jsonl(log, str(tmp_path))
    decoded = store.read_store(spark, str(tmp_path))
    typed = ingest.typed_log(decoded, nodes)
    ordered = order.causal_order(typed, 3, tie_break="seq").orderBy("pos").collect()
    assert [(r.node_id, r.seq) for r in ordered] == [("a", 0), ("b", 0), ("c", 0)]
    rejects = ingest.typed_log_rejects(decoded, nodes).collect()
    assert sorted((r.node_id, r.reason) for r in rejects) == [("c", "no_own_tick"), ("d", "unlisted_node")]


def test_long_records_are_set_aside(spark):
    from causal_logs.sources import store

    log = spark.createDataFrame(
        [("a", [1], 1, "INFO", "m" * n, {}) for n in (5, 5000)],
        "node_id string, vc array<bigint>, ts_ms bigint, level string, message string, metadata map<string,string>",
    )
    kept, rest = store.export_jsonl(log, max_record_bytes=4095), store.export_jsonl_rejects(log, 4095)
    assert kept.count() == 1 and [r.reason for r in rest.collect()] == ["too_long"]
