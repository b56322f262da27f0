import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from causal_logs.functions import clocks
from plain_models import relation

PAIRS = [
    ([1, 2, 3], [1, 2, 3], "EQUAL", [1, 2, 3]),
    ([1, 0, 0], [1, 1, 0], "HAPPENS_BEFORE", [1, 1, 0]),
    ([2, 1, 1], [1, 1, 0], "HAPPENS_AFTER", [2, 1, 1]),
    ([2, 1, 0], [1, 2, 0], "CONCURRENT", [2, 2, 0]),
    ([3, 1, 2], [1, 4, 2], "CONCURRENT", [3, 4, 2]),
    ([1, 2, 3], [4, 1], "CONCURRENT", [4, 2, 3]),
    ([], [0, 0], "EQUAL", [0, 0]),
    (None, [1], "CONCURRENT", None),
]


@pytest.mark.parametrize("width", [None, 3])
def test_relation_and_merge(spark, width):
    df = spark.createDataFrame([(a, b) for a, b, _, _ in PAIRS], "a array<bigint>, b array<bigint>")
    got = df.select(clocks.relation("a", "b", width).alias("r"), clocks.merge("a", "b").alias("m")).collect()
    assert [(r.r, r.m) for r in got] == [(r, m) for _, _, r, m in PAIRS]


_clock = st.lists(st.integers(0, 3), min_size=0, max_size=4)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(_clock, _clock, _clock), min_size=20, max_size=60))
def test_laws(spark, triples):
    df = spark.createDataFrame(triples, "a array<bigint>, b array<bigint>, c array<bigint>")
    m = clocks.merge
    rows = df.select(
        "a", "b",
        clocks.relation("a", "b").alias("ab"), clocks.relation("b", "a").alias("ba"),
        (m("a", "b") == m("b", "a")).alias("commutes"),
        (m(m("a", "b"), "c") == m("a", m("b", "c"))).alias("associates"),
        (m("a", "a") == F.col("a")).alias("idempotent"),
    ).collect()
    flip = {"HAPPENS_BEFORE": "HAPPENS_AFTER", "HAPPENS_AFTER": "HAPPENS_BEFORE"}
    for r in rows:
        assert r.ab == relation(r.a, r.b) and r.ba == flip.get(r.ab, r.ab)
        assert r.commutes and r.associates and r.idempotent


def test_init_increment_valid_text(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 3, 32, 33)], "n int")
    zeros = [r.z for r in df.select(clocks.zeros(F.col("n")).alias("z")).collect()]
    assert [len(z) for z in zeros] == [0, 1, 3, 32, 0] and not any(map(any, zeros))
    steps = spark.createDataFrame([(i,) for i in (-1, 0, 2, 3)], "i int").withColumn("vc", F.array(*[F.lit(x).cast("bigint") for x in (5, 3, 7)]))
    got = [r.v for r in steps.select(clocks.increment("vc", F.col("i")).alias("v")).collect()]
    assert got == [[5, 3, 7], [6, 3, 7], [5, 3, 8], [5, 3, 7]]
    one = steps.limit(1).select(
        clocks.to_text("vc").alias("t"), clocks.to_json("vc").alias("j"),
        clocks.to_json("vc", ["a", "b", "c"]).alias("named"), clocks.total("vc").alias("s"),
    ).first()
    assert tuple(one) == ("[5, 3, 7]", '{"node-0":5,"node-1":3,"node-2":7}', '{"a":5,"b":3,"c":7}', 15)
    valid = spark.createDataFrame([([0] * n if n is not None else None,) for n in (3, 0, 33, None)], "vc array<bigint>")
    assert [r[0] for r in valid.select(clocks.is_valid("vc")).collect()] == [True, False, False, False]


def _decode(spark, texts, **options):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [(r.vc, r.clock_error) for r in clocks.with_decoded(df, "t", **options).collect()]


def test_decode(spark):
    got = _decode(spark, [
        '{"node-0":5,"node-1":3,"node-2":7}', '{"node-0":10, "node-2":30}', '{"node-1":1,"node-0":2}',
        '{"node-0":1,"node-0":2}', '{"peer":1}', '{"node-abc":1}', '{"node-0":"5"}', '{"node-0":-1}',
        '{"node-0":99999999999999999999}', '{"node-32":1}', "[1]", "lost", None, "{}",
    ])
    assert got == [
        ([5, 3, 7], None), ([10, 0, 30], None), ([2, 1], None), ([2], None),
        (None, "bad_clock_key"), (None, "bad_clock_key"), (None, "bad_clock"), (None, "bad_clock"),
        (None, "bad_clock"), (None, "clock_too_wide"), (None, "bad_clock"), (None, "bad_clock"),
        (None, "bad_clock"), ([], None),
    ]
    assert _decode(spark, ['{"node-1":4}', '{"node-3":1}'], node_count=3) == [([0, 4, 0], None), (None, "clock_too_wide")]
    assert _decode(spark, ['{"B":1,"A":2}', '{"A":1,"B":2}', '{"C":1}'], names=["A", "B"]) == [
        ([2, 1], None), ([1, 2], None), (None, "bad_clock_key"),
    ]


def test_round_trip(spark):
    df = spark.createDataFrame([([10, 20, 30],), ([0] * 32,)], "vc0 array<bigint>").withColumn("t", clocks.to_json("vc0"))
    assert all(r.vc == r.vc0 for r in clocks.with_decoded(df, "t").collect())
