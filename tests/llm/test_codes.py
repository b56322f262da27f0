"""Codes of vectors against a plain version."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from causal_logs.llm import codes

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, id int"


def plain(rows, parts=4, entries=256, rounds=4):
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    whole = [[int(np.floor(1024 * float(x))) for x in r[1]] for r in kept]
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in whole]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            got = {}
            for v in cut:
                got.setdefault(near(v[p], books[p])[1], []).append(v[p])
            for i, members in got.items():
                books[p][i] = tuple(sum(x) // len(members) for x in zip(*members))
    out, totals = [], {}
    for r, v in zip(kept, cut):
        found = [near(v[p], books[p]) for p in range(parts)]
        error = sum(e for e, _ in found)
        totals[r[2]] = totals.get(r[2], 0) + error
        out.append((r[0], bytes(i for _, i in found).hex(), error, r[2]))
    said = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((a, b, c, totals[d], said) for a, b, c, d in out), key=str)


def _rows(n, width, spread, seed, step=None):
    rng = np.random.default_rng(seed)
    values = rng.normal(0, spread, (n, width))
    if step:
        values = np.round(values / step) * step
    return [(int(i) * 3 % 1009, [float(np.float32(x)) for x in v], int(i % 5) or None, "x", 1) for i, v in enumerate(values)]


@pytest.mark.parametrize("n,width,entries,step", [(120, 8, 16, None), (400, 16, 32, 0.25), (30, 8, 256, None)])
def test_like_plain(spark, n, width, entries, step):
    rows = _rows(n, width, 0.3, n, step)
    rows += [rows[3], rows[3], (None, rows[5][1], 2, None, None), (rows[7][0], rows[9][1], 4, "", 0)]
    bad = [(5000, None, 1, "a", 1), (0, [None] * width, 1, "a", 1), (1, [float("nan")] * width, 1, "a", 1), (2, [float("-inf")] + [0.0] * (width - 1), 1, "a", 1)]
    table = spark.createDataFrame(rows + bad, SCHEMA).repartition(3)
    got = codes.coded(table, entries=entries)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, entries=entries)


def test_one_vector_holds_most_rows(spark):
    rows = _rows(40, 8, 0.3, 1)
    rows += [(2000 + i, rows[0][1], 1, "x", 1) for i in range(400)]
    got = codes.coded(spark.createDataFrame(rows, SCHEMA).repartition(7), entries=8)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, entries=8)


def test_rows_that_cannot_be_coded(spark):
    rows = [(1, [0.5] * 8, 1, "", 0), (2, [0.25] * 7, 1, "", 0), (3, [1e30] + [0.0] * 7, None, "", 0), (4, [], 2, "", 0), (5, [0.25] * 8, 2, "", 0)]
    got = {r.vec_id: (r.code, r.error, r.label_error) for r in codes.coded(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: ("00000000", 0, 0), 2: (None, None, 0), 3: (None, None, None), 4: (None, None, 0), 5: ("01010101", 0, 0)}
    odd = [(1, [0.5] * 7, 1, "", 0), (2, [0.5] * 8, 1, "", 0)]
    assert {r.code for r in codes.coded(spark.createDataFrame(odd, SCHEMA)).collect()} == {None}
    assert codes.coded(spark.createDataFrame([], SCHEMA)).collect() == []
    empty = [(1, [], 1, "", 0), (2, [], 1, "", 0)]
    assert [(r.code, r.error) for r in codes.coded(spark.createDataFrame(empty, SCHEMA)).collect()] == [("00000000", 0)] * 2


def test_walk_shares_prefixes_over_runs():
    rng = np.random.default_rng(4)
    parts = np.unique(rng.integers(-3, 3, (500, 5)), axis=0)
    book = rng.integers(-3, 3, (7, 5))
    far = ((parts[:, None] - book) ** 2).sum(2)
    for leaves in (1, 3, 64, 1024):
        code, error = codes.nearest(parts, book, leaves)
        assert (code == far.argmin(1)).all() and (error == far.min(1)).all()


def test_types_of_ids(spark):
    table = spark.createDataFrame(_rows(20, 8, 0.3, 2), SCHEMA).withColumn("vec_id", F.concat(F.lit("v"), "vec_id"))
    assert codes.coded(table).schema["vec_id"].dataType.simpleString() == "string"
