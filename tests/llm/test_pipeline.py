"""The pipeline's stages one by one against plain versions, each on what the one before kept."""

import corpus_pipeline
from cases import documents, texts
from test_pairs import _plain_components, _plain_hits, _plain_repeats

from causal_logs.llm import decontaminate
from causal_logs.session import written

ITEMS = [(1, "a passage of a benchmark that has been copied into two of the documents of this table")]


def _kept(text, earlier, width=50):
    """What is left of a text, as characters."""
    data = text.encode()
    known = {t.encode()[k : k + width] for t in earlier for k in range(len(t.encode()) - width + 1)}
    gone = [False] * len(data)
    for k in range(len(data) - width + 1):
        if data[k : k + width] in known:
            gone[k : k + width] = [True] * width
    return bytes(b for b, g in zip(data, gone, strict=True) if not g).decode("utf-8", "ignore")


def test_rows_without_an_id_or_with_the_same_one(spark, tmp_path):
    """Every row keeps its own text, and goes by its own text only."""
    words = lambda k, n: " ".join(f"w{k}x{j}" for j in range(n))
    passage = ITEMS[0][1]
    rows = [(1, words(1, 30)), (1, words(2, 30)), (2, words(3, 30)), (2, f"{words(4, 30)} {passage}"), (3, words(1, 30)), (3, words(1, 30))]
    rows += [(None, words(5, 30)), (None, words(6, 30)), (None, words(7, 30) + " " + passage), (None, None), (4, words(8, 30)), (None, words(8, 30) + " and more")]
    sf = str(tmp_path)
    documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars", "score", "component").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs, order = spark.read.parquet(f"{sf}/documents.parquet"), lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    got = written(corpus_pipeline.without_near_copies(spark, docs, sf), "stage")
    one = [r for r in rows if r[0] != 3]
    assert order(got) == sorted(one, key=repr) and got.columns == docs.columns
    got = written(corpus_pipeline.without_repeats(spark, docs, sf), "stage")
    want = [(i, t and _kept(t, [u for j, u in one if j is not None and (i is None or j < i)])) for i, t in one]
    assert len(set(want)) == len(one) and (None, " and more") in want
    assert order(got) == sorted(want, key=repr) and all(r.n_chars == (r.text and len(r.text)) for r in got.collect())
    got = corpus_pipeline.without_benchmark(spark, docs, sf)
    clean = [r for r in rows if passage not in (r[1] or "")]
    assert order(got) == sorted(clean, key=repr)
    table = spark.read.parquet(f"{sf}/benchmark.parquet").union(spark.createDataFrame([(9, words(2, 30))], "item_id bigint, text string"))
    for pass_bytes in (1 << 20, 100):
        assert order(decontaminate.decontaminated(docs, table, pass_bytes=pass_bytes)) == sorted([r for r in clean if r[1] != words(2, 30)], key=repr)


def test_two_stages_on_one_table(spark, tmp_path):
    """A stage leaves alone what other results read; columns may be named like its own in any case."""
    rows = [(i, t) for i, t in texts() if t is None or len(t) < 5000]
    docs = documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").selectExpr("*", "'x' as Score", "1 as LANG_PRED")
    first = corpus_pipeline.without_near_copies(spark, docs, str(tmp_path))
    second = corpus_pipeline.without_repeats(spark, docs, str(tmp_path))
    third = corpus_pipeline.identified(spark, docs, str(tmp_path))
    for found in (first, second, third):
        assert found.columns == docs.columns and found.count() > 0
    assert {r.Score for r in third.collect()} == {"x"} and {r.LANG_PRED for r in third.collect()} == {1}


def test_a_run_leaves_only_its_result(spark, tmp_path):
    from causal_logs.session import collected

    documents(spark).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    with collected() as paths:
        one = corpus_pipeline.run(spark, str(tmp_path))
        two = corpus_pipeline.run(spark, str(tmp_path))
    assert one.count() == two.count() > 0
    place = spark._jvm.org.apache.hadoop.fs.Path(paths[0])
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    assert sum(files.exists(spark._jvm.org.apache.hadoop.fs.Path(p)) for p in paths) == 2


def test_stages(spark, tmp_path):
    rows = [(i, t) for i, t in texts() if t is None or len(t) < 5000]
    rows += [(400, f"Before it. {ITEMS[0][1].upper()}! After it."), (401, rows[9][1] + " " + ITEMS[0][1]), (402, "12 34 ... 56")]
    sf = str(tmp_path)
    documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars", "score", "component").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, dict(rows)

    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = written(stage(spark, docs, sf), "stage")
        assert docs.columns == columns
        got = {r.doc_id: r.text for r in docs.collect()}
        assert len(got) == docs.count() and all(r.n_chars == len(r.text) for r in docs.collect())
        if name == "language ID":
            want = {i: t for i, t in seen.items() if t and any(map(str.isalpha, t))}
        elif name == "n-gram Jaccard join":
            label = _plain_components(list(seen.items()))
            want = {i: t for i, t in seen.items() if label[i][1] == i}
        elif name == "suffix-array dedup":
            want = {i: _kept(t, [u for j, u in seen.items() if j < i]) for i, t in seen.items()}
            want = {i: t for i, t in want.items() if t}
            assert any(n for _, n, _, _ in _plain_repeats([(i, t.encode()) for i, t in seen.items()]).values())
        else:
            want = {i: t for i, t in seen.items() if not _plain_hits(t, ITEMS)[4]}
        assert got == want
        assert len(want) < len(seen) or name == "suffix-array dedup"
        seen = got

    last = corpus_pipeline.STAGES[4][1](spark, docs, sf).collect()
    assert {r.doc_id for r in last} == set(seen) and all(r.round_trip for r in last)
    whole = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id, r.sample, r.ids_sha256) for r in whole) == sorted((r.doc_id, r.sample, r.ids_sha256) for r in last)
