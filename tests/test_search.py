import datetime

from pyspark.sql import functions as F

from causal_logs.operators import blocks, query, search

TEXTS = [
    (1, "Disk full on node-7; disk replaced"), (2, "disk ok"), (3, "Straße DISK größer"), (4, ""), (5, "diskette full"),
    (6, "full disk full"),
]


def _docs(spark):
    return spark.createDataFrame(TEXTS, "event_id long, message string")


def _ids(df):
    return sorted(r.event_id for r in df.collect())


def test_index_and_scan_agree(spark, tmp_path):
    docs = _docs(spark)
    index = search.build_inverted_index(docs)
    tf = {(r.token, r.event_id): r.tf for r in index.collect()}
    assert tf["disk", 1] == 2 and tf["full", 6] == 2 and tf["straße", 3] == 1 and ("", 4) not in tf
    path = str(tmp_path / "index")
    search.write_index(index, path)
    stored = search.read_index(spark, path)
    for words, mode, want in [
        (["disk", "FULL"], "and", [1, 6]), (["disk"], "and", [1, 2, 3, 6]), (["größer", "ok"], "or", [2, 3]), (["none"], "or", []),
    ]:
        assert _ids(search.keyword_search(docs, index, words, mode)) == want
        assert _ids(search.keyword_search(docs, stored, words, mode)) == want
        assert _ids(search.keyword_scan(docs, words, mode)) == want
    plan = search.keyword_hits(stored, ["disk"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "PushedFilters: [IsNotNull(token), EqualTo(token,disk)" in plan


def test_log_query(spark):
    day = datetime.date(2024, 1, 2)
    rows = [
        (i, f"n{i % 2}", i % 2, [i + 1 if j == i % 2 else 0 for j in range(2)], 1000 - i, ("DEBUG", "WARN", "FATAL")[i % 3], "m",
         {"k": str(i % 4)}, i, day) for i in range(12)
    ]
    log = spark.createDataFrame(
        rows, "event_id long, node_id string, node_idx int, vc array<bigint>, ts_ms long, level string, message string, "
        "metadata map<string,string>, seq long, log_date date"
    )
    assert _ids(query.log_query(log, min_level="warn", nodes=["n1"])) == [1, 5, 7, 11]
    assert _ids(query.log_query(log, since_ms=990, until_ms=993)) == [8, 9, 10]
    assert _ids(query.log_query(log, metadata={"k": "2"})) == [2, 6, 10]
    assert _ids(query.log_query(log, dates=("2024-01-03", "2024-01-05"))) == []
    first = query.log_query(log, order="time", limit=3)
    assert [r.event_id for r in first.collect()] == [11, 10, 9]
    assert "TakeOrderedAndProject" in first._jdf.queryExecution().executedPlan().toString()
    causal = query.log_query(log, min_level="fatal", order="causal", node_count=2, limit=2).collect()
    assert [r.pos for r in causal] == sorted(r.pos for r in causal) and len(causal) == 2


def test_metadata_pairs_and_groups(spark):
    rows = [(1, 0, [1, 0], 5, {"t": "x", "u": "y"}), (2, 1, [1, 1], 7, {"t": "x"}), (3, 1, [1, 2], 9, None)]
    log = spark.createDataFrame(rows, "event_id long, node_idx int, vc array<bigint>, ts_ms long, metadata map<string,string>")
    assert sorted(map(tuple, query.metadata_pairs(log).collect())) == [(1, "t", "x"), (1, "u", "y"), (2, "t", "x")]
    assert [tuple(r) for r in query.metadata_groups(log, "t", 2).collect()] == [("x", 2, 5, 7, [1, 1])]


def test_postings_without_a_day_are_kept(spark, tmp_path):
    day = datetime.date(2024, 1, 2)
    log = spark.createDataFrame([(1, "disk full", day), (2, "disk ok", None)], "event_id long, message string, log_date date")
    postings, path = search.build_inverted_index(log, keep=("log_date",)), str(tmp_path / "index")
    for _ in range(2):
        search.write_index(postings, path, day="log_date")
    index = search.read_index(spark, path)
    assert index.count() == 4
    assert _ids(search.keyword_search(log, index, ["disk"])) == [1, 2]
    # Fewer postings in fewer buckets: nothing of the day's older folders is left.
    search.write_index(postings, path, day="log_date", bucket_rows=1)
    search.write_index(postings.where("token <> 'full'"), path, day="log_date")
    index = search.read_index(spark, path)
    assert sorted((r.token, r.event_id) for r in index.collect()) == [("disk", 1), ("disk", 2), ("ok", 2)]


def test_blocks_like_the_scan(spark, tmp_path, monkeypatch):
    import random

    monkeypatch.setattr(blocks, "SPAN", 16)
    rng = random.Random(5)
    words = ["disk", "full", "ok", "red", "blue"]
    rows = [(i * rng.randint(1, 3) + 200 * i, " ".join(rng.choices(words, weights=[9, 3, 3, 1, 1], k=rng.randint(0, 5))), f"d{i % 4}" if i % 9 else None) for i in range(-20, 120)]
    log = spark.createDataFrame(rows, "event_id long, message string, day string")
    postings, path = search.build_inverted_index(log, keep=("day",)), str(tmp_path / "blocks")
    tfs = {(r.token, r.event_id): r.tf for r in postings.collect()}

    def check():
        index = blocks.read_blocks(spark, path)
        for asked in (["disk"], ["disk", "full"], ["red", "blue", "ok"], ["none", "disk"], ["Disk/full"]):
            want = [t for k in asked for t in k.lower().replace("/", " ").split()]
            for mode, least in (("and", len(want)), ("or", 1)):
                got = {r.event_id: (r.matched, r.tf) for r in blocks.block_hits(index, asked, mode).collect()}
                found = {i: [tfs[w, i] for w in want if (w, i) in tfs] for i, _, _ in rows}
                assert got == {i: (len(t), sum(t)) for i, t in found.items() if len(t) >= least}

    blocks.write_blocks(postings, path, "day", bucket_rows=40)
    check()
    blocks.write_blocks(postings.where("day = 'd1'"), path, "day")
    check()
    blocks.merge_parts(spark, path, ["d0", "d1", "none"], "old", bucket_rows=60)
    check()
    assert sorted({r.part for r in blocks.read_blocks(spark, path).select("part").collect()}) == ["d2", "d3", "old"]
    index = blocks.read_blocks(spark, path)
    assert index.where("part = 'old'").groupBy("token", "span").count().where("count > 1").count() == 0
    plan = blocks.block_hits(index, ["disk"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(token,disk)" in plan


def test_blocks_are_smaller_than_postings(spark, tmp_path):
    log = spark.range(60_000).selectExpr("id as event_id", "concat('all of ', if(id % 3 = 0, 'third', 'rest'), ' n', id % 100) as message")
    postings = search.build_inverted_index(log).withColumn("day", F.lit("d")).cache()
    rows, packed = tmp_path / "rows", tmp_path / "blocks"
    search.write_index(postings.drop("day"), str(rows))
    blocks.write_blocks(postings, str(packed), "day")
    size = lambda p: sum(f.stat().st_size for f in p.rglob("*.parquet"))
    assert size(packed) * 2 < size(rows)
    postings.unpersist()
