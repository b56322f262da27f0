from pyspark.sql import functions as F

from causal_logs.operators import ingest
from causal_logs.sources import jsonl, raw
from causal_logs.streaming import ingest as stream


def _land(folder, node, name, texts):
    (folder / node).mkdir(parents=True, exist_ok=True)
    (folder / node / name).write_text("".join(t + "\n" for t in texts))


def _lines(node, name, n):
    out = []
    for i in range(n):
        out.append(f"2024-06-29 10:00:{i % 60:02d}.5 WARN {node} {name} {i}")
        if i % 4 == 0:
            out.append("")
        if i % 7 == 0:
            out.append(f"[error] {node} {name} plain {i}")
    return out


def _stamped(spark, store, nodes):
    rows = stream.read_stamped(spark, store, nodes, 3)
    return {(r.node_id, r.seq): (r.level, r.message, tuple(r.vc)) for r in rows.collect()}, rows.count()


def test_ticks_continue_over_batches_and_restarts(spark, tmp_path):
    landing, store = tmp_path / "landing", str(tmp_path / "store")
    nodes = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "node_id string, node_idx int")
    for node in "abc":
        for part in range(3):
            _land(landing, node, f"{part:03d}.log", _lines(node, part, 10 + part))
    stream.ingest_available(spark, str(landing), store, max_files=2)
    first, n_first = _stamped(spark, store, nodes)
    assert len(first) == n_first > 0

    _land(landing, "a", "003.log", [*_lines("a", 3, 25), "2024-13-01 10:00:00 INFO no such month"])
    _land(landing, "b", "003.log", _lines("b", 3, 5))
    stream.ingest_available(spark, str(landing), store)
    second, n_second = _stamped(spark, store, nodes)
    assert len(second) == n_second > n_first
    assert all(second[k] == v for k, v in first.items())

    batch = ingest.stamp_clocks(
        ingest.ingest_raw_lines(raw.read_raw_lines(spark, str(landing / "*"))), nodes, 3
    )
    expected = {(r.node_id, r.seq): (r.level, r.message, tuple(r.vc)) for r in batch.collect()}
    assert {k: v for k, v in expected.items()} == second

    stream.ingest_available(spark, str(landing), store)
    assert _stamped(spark, store, nodes)[1] == n_second
    rejects = spark.read.parquet(f"{store}/rejects").collect()
    assert [(r.node_id, r.line) for r in rejects] == [("a", "2024-13-01 10:00:00 INFO no such month")]


def test_latest_start_skips_older_files(spark, tmp_path):
    landing, store = tmp_path / "landing", str(tmp_path / "store")
    _land(landing, "a", "000.log", ["INFO: old"])
    import os
    os.utime(landing / "a" / "000.log", (1_600_000_000, 1_600_000_000))
    import time
    since = int(time.time() * 1000)
    raw_stream = stream.read_landing(spark, str(landing), since_ms=since)
    _land(landing, "a", "001.log", ["INFO: new"])
    later = time.time() + 5
    os.utime(landing / "a" / "001.log", (later, later))
    stream.start_landing(raw_stream, store).awaitTermination()
    assert [r.message for r in spark.read.parquet(f"{store}/parsed").collect()] == ["new"]
    # Landed while nothing runs, taken after a restart with the same time.
    _land(landing, "a", "002.log", ["INFO: while down"])
    os.utime(landing / "a" / "002.log", (later + 1, later + 1))
    stream.start_landing(stream.read_landing(spark, str(landing), since_ms=since), store).awaitTermination()
    assert sorted(r.message for r in spark.read.parquet(f"{store}/parsed").collect()) == ["new", "while down"]


def test_stream_store_and_stats(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    good = '{"node_id":"n%d","vector_clock":{"node-0":%d},"timestamp":5,"level":"warn","message":"m"}'
    (inbox / "1.jsonl").write_text("\n".join([good % (1, 1), good % (2, 2), "broken"]) + "\n")
    records = stream.read_records(spark, str(inbox))

    out = str(tmp_path / "store")
    decoded = stream.observed(jsonl.decode(records))
    typed = decoded.where(F.col("reason").isNull())
    query = stream.start_store(typed, out, str(tmp_path / "cp1"))
    query.awaitTermination()
    metrics = [p["observedMetrics"]["intake"] for p in query.recentProgress if p["numInputRows"]]
    assert [(m["received"], m["stored"], m["errors"]) for m in metrics] == [(3, 2, 1)]
    stored = spark.read.text(out)
    assert stored.columns == ["value", "log_date"]
    assert sorted(r.value for r in stored.collect()) == [
        '{"node_id":"n1","vector_clock":{"node-0":1},"timestamp":5,"level":"WARN","message":"m"}',
        '{"node_id":"n2","vector_clock":{"node-0":2},"timestamp":5,"level":"WARN","message":"m"}',
    ]

    stats = stream.stream_stats(records, ["node_id"])
    counting = (
        stats.writeStream.outputMode("update").format("memory").queryName("intake_stats")
        .option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    )
    counting.awaitTermination()
    got = {r.node_id: (r.received, r.stored, r.errors) for r in spark.table("intake_stats").collect()}
    assert got == {"n1": (1, 1, 0), "n2": (1, 1, 0), None: (1, 0, 1)}


def _intake(spark, landing, path, out, nodes, max_files=None):
    raw_lines = stream.read_landing(spark, str(landing), max_files=max_files)
    stream.start_intake(raw_lines, path, out, nodes, 3).awaitTermination()


def _records(spark, out):
    return sorted((str(r.log_date), r.value) for r in spark.read.text(out).collect())


def test_stream_into_the_daily_store(spark, tmp_path):
    landing, path, out = tmp_path / "landing", str(tmp_path / "intake"), str(tmp_path / "store")
    nodes = spark.createDataFrame([("a", 0), ("b", 1)], "node_id string, node_idx int")
    for node in "abc":
        for part in range(3):
            _land(landing, node, f"{part:03d}.log", _lines(node, part, 10 + part))
    _intake(spark, landing, path, out, nodes, max_files=2)
    first = _records(spark, out)
    # Another run without new files, then new files, one of them with a line that cannot be.
    _intake(spark, landing, path, out, nodes)
    assert _records(spark, out) == first
    _land(landing, "a", "003.log", [*_lines("a", 3, 25), "2024-13-01 10:00:00 INFO no such month"])
    _land(landing, "b", "003.log", _lines("b", 3, 5))
    _intake(spark, landing, path, out, nodes)
    second = _records(spark, out)
    assert set(first) < set(second)
    assert [(r.node_id, r.line) for r in spark.read.parquet(f"{path}/rejects").collect()] == [("a", "2024-13-01 10:00:00 INFO no such month")]

    batch = ingest.stamp_clocks(ingest.ingest_raw_lines(raw.read_raw_lines(spark, str(landing / "*"))), nodes, 3)
    stored = jsonl.ingest_jsonl(jsonl.read_jsonl(spark, out))
    show = lambda df: sorted((r.node_id, tuple(r.vc), r.level, r.message) for r in df.collect())
    assert show(stored) == show(batch)
    assert not list((tmp_path / "intake" / "work").glob("*")) and len(list((tmp_path / "intake" / "counters").glob("batch=*"))) <= 2


def test_a_batch_that_is_run_again_replaces_itself(spark, tmp_path):
    landing, path, out = tmp_path / "landing", str(tmp_path / "intake"), str(tmp_path / "store")
    nodes = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "node_id string, node_idx int")
    for part in range(4):
        for node in "abc":
            _land(landing, node, f"{part:03d}.log", _lines(node, part, 8))
    _intake(spark, landing, path, out, nodes, max_files=4)
    whole = _records(spark, out)
    commits = sorted((tmp_path / "intake" / "_checkpoints" / "intake" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    assert len(commits) == 3
    # As after a crash between the last batch's writes and its commit.
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    _land(landing, "a", "009.log", ["INFO: after the crash"])
    _intake(spark, landing, path, out, nodes, max_files=4)
    again = _records(spark, out)
    assert set(whole) < set(again) and len(again) == len(whole) + 1
