"""Jobs against plain-Python models, with chunks small enough to matter."""

import pytest
from pyspark.sql import functions as F

from causal_logs.operators import audit, graph, merge, order, relation, replay
from causal_logs.plans import scan, skew
from causal_logs.plans import frontier
from plain_models import SCHEMA, random_log, reduced_edges, relation as rel

CASES = [
    dict(seed=2, nodes=3, lost=0.15), dict(seed=3, nodes=5, events=70, copies=0.2), dict(seed=4, lost=0.1, copies=0.1),
]


@pytest.fixture(params=range(len(CASES)), ids=str, scope="module")
def case(request, spark):
    options = CASES[request.param]
    rows = random_log(**options)
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3), options.get("nodes", 4)


def _violations(rows, pos):
    return {
        (a[0], b[0]) for a in rows for b in rows
        if rel(a[3], b[3]) == "HAPPENS_BEFORE" and pos[a[0]] > pos[b[0]]
    }


def test_causal_order(case):
    rows, log, n = case
    out = order.causal_order(log, n, rows=3).collect()
    pos = {r.event_id: r.pos for r in out}
    assert sorted(pos.values()) == list(range(1, len(rows) + 1))
    assert not _violations(rows, pos)
    eff = {r.event_id: r.eff_ts for r in out}
    for b in rows:
        past = [a[4] for a in rows if rel(a[3], b[3]) in ("HAPPENS_BEFORE", "EQUAL")]
        assert eff[b[0]] == max(past)
    for a in out:
        for b in out:
            if a.vc == b.vc and (a.ts_ms, a.node_id) < (b.ts_ms, b.node_id):
                assert a.pos < b.pos


def test_order_without_premise(case):
    rows, log, n = case
    pos = {r.event_id: r.pos for r in order.causal_order(log, n, well_formed=False).collect()}
    assert sorted(pos.values()) == list(range(1, len(rows) + 1)) and not _violations(rows, pos)


def test_agreeing_clocks_give_time_order(spark):
    rows = [(i, n, k, v, 1000 + i, s) for i, n, k, v, _, s in random_log(9)]
    log = spark.createDataFrame(rows, SCHEMA)
    assert [r.event_id for r in order.causal_order(log, 4).orderBy("pos").collect()] == [r[0] for r in rows]


def test_order_audit(case):
    rows, log, n = case
    timed = order.time_order(log)
    pos = {r.event_id: r.pos for r in timed.collect()}
    got = {r.event_id: r.latest_past_pos for r in order.order_audit(timed, n, rows=4).collect()}
    want = {}
    for a, b in _violations(rows, pos):
        want[b] = max(want.get(b, 0), pos[a])
    assert got == want


def test_time_order_matches_sort(case):
    rows, log, _ = case
    got = [r.event_id for r in order.time_order(log).orderBy("pos").collect()]
    assert got == [r[0] for r in sorted(rows, key=lambda r: (r[4], r[1], r[0]))]


def test_relation_counts(case):
    rows, log, n = case
    got = {r.event_id: (r.n_before, r.n_after, r.n_equal, r.n_concurrent) for r in relation.relation_counts(log, n, 3).collect()}
    for x in rows:
        kinds = [rel(y[3], x[3]) for y in rows if y[0] != x[0]]
        assert got[x[0]] == tuple(kinds.count(k) for k in ("HAPPENS_BEFORE", "HAPPENS_AFTER", "EQUAL", "CONCURRENT"))


def test_entries_without_a_clock_are_concurrent(spark):
    rows = [*random_log(7, events=20), (98, "node-0", 0, None, 5, 90), (99, "node-1", None, [1, 1, 1, 1], 6, 91)]
    log = spark.createDataFrame(rows, SCHEMA)
    got = {r.event_id: (r.n_before, r.n_after, r.n_equal, r.n_concurrent) for r in relation.relation_counts(log, 4).collect()}
    assert got[98] == got[99] == (0, 0, 0, 21) and all(sum(c) == 21 for c in got.values())
    assert {r.pos for r in order.causal_order(log, 4).collect()} == set(range(1, 23))


def test_heavy_copies_take_the_broadcast_path(case, monkeypatch):
    rows, log, n = case
    plain = sorted(map(tuple, relation.relation_counts(log, n).collect()))
    monkeypatch.setattr(frontier, "HEAVY_ROWS", 2)
    monkeypatch.setattr(replay, "HEAVY_ROWS", 2)
    assert sorted(map(tuple, relation.relation_counts(log, n).collect())) == plain


def test_slices(case, monkeypatch):
    rows, log, n = case
    targets = log.where(F.pmod("event_id", F.lit(7)) == 0)
    def check(relations, want):
        got = {(r.target_id, r.event_id): r.relation for r in relation.causal_slice(log, targets, n, relations).collect()}
        assert got == want
    everything = ("HAPPENS_BEFORE", "HAPPENS_AFTER", "CONCURRENT", "EQUAL")
    want = {(t[0], e[0]): rel(e[3], t[3]) for t in rows if t[0] % 7 == 0 for e in rows if e[0] != t[0]}
    check(everything, want)
    check(("HAPPENS_BEFORE",), {k: v for k, v in want.items() if v == "HAPPENS_BEFORE"})
    monkeypatch.setattr(relation, "MAX_BROADCAST_CELLS", 1)
    check(everything, want)


def test_pairs_in_sequence(case, monkeypatch):
    rows, log, _ = case
    by_node = {}
    for r in sorted(rows, key=lambda r: (r[4], r[0])):
        by_node.setdefault(r[0] % 3, []).append(r)
    want = {}
    for group in by_node.values():
        for a, b in zip(group, group[1:]):
            place = -1 if (a[4], a[1]) < (b[4], b[1]) else 0 if (a[4], a[1]) == (b[4], b[1]) else 1
            kind = rel(a[3], b[3])
            want[a[0], b[0]] = (kind, {"HAPPENS_BEFORE": -1, "HAPPENS_AFTER": 1}.get(kind, place))
    traced = log.withColumn("trace", F.pmod("event_id", F.lit(3)))
    for width in (None, 5):
        got = relation.clock_relation(traced, "trace", ["ts_ms", "event_id"], width=width).collect()
        assert {(r.a_event_id, r.b_event_id): (r.relation, r.sign) for r in got} == want


def test_previous_row_over_chunk_borders(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    got = {r.id: r.prev_id for r in scan.with_previous(df, ["k"], ["id"], ["id"], rows=7).collect()}
    assert got == {i: i - 3 if i >= 3 else None for i in range(100)}


def test_graph(case):
    rows, log, n = case
    got = {(r.src_event, r.dst_event) for r in graph.causal_graph(log, n, rows=3).collect()}
    assert got == reduced_edges(rows)


def test_running_frontier_and_merge(case):
    rows, log, n = case
    got = {(r.node_id, r.seq): r.frontier for r in merge.running_frontier(log, n, rows=4).collect()}
    for node in {r[1] for r in rows}:
        top = [0] * n
        for r in sorted((r for r in rows if r[1] == node), key=lambda r: r[5]):
            top = [max(x, y) for x, y in zip(top, r[3])]
            assert got[node, r[5]] == top
    merged = {r.node_id: (r.merged, r.n) for r in merge.merge_clocks(log, ["node_id"], n).collect()}
    for node, (clock, count) in merged.items():
        mine = [r[3] for r in rows if r[1] == node]
        assert (clock, count) == ([max(c) for c in zip(*mine)], len(mine))


def test_merge_of_different_lengths(spark):
    df = spark.createDataFrame([("g", [1, 2, 3]), ("g", [4, 1])], "g string, vc array<bigint>")
    assert merge.merge_clocks(df, ["g"], 5).first().merged == [4, 2, 3]


def test_audit_of_gaps_and_copies(spark):
    rows = [
        (0, "n0", 0, [1, 0], 1, 0), (1, "n0", 0, [2, 0], 2, 1), (2, "n0", 0, [2, 0], 3, 2), (3, "n0", 0, [6, 9], 4, 3),
        (4, "n1", 1, [0, 3], 1, 0), (5, "n1", 1, [0, 2], 2, 1), (6, "n1", 1, [0, 4, 0], 3, 2), (7, "n1", 1, None, 4, 3),
    ]
    log = spark.createDataFrame(rows, SCHEMA)
    got = {r.node_idx: tuple(r)[1:] for r in audit.clock_audit(log, 2, rows=2).collect()}
    # entries, max tick, missing, duplicates, not rising, above owner, bad size, knowledge falls, knowledge incomplete
    assert got == {0: (4, 6, 3, 1, 1, 1, 0, 0, 0), 1: (4, 4, 1, 0, 2, 0, 2, 0, 0)}
    ranges = sorted(map(tuple, audit.missing_ticks(log, rows=2).collect()))
    assert ranges == [(0, 3, 5), (1, 1, 1)]


SCENARIO = {"A": (0, 0, [1, 0, 0]), "C": (0, 1, [2, 0, 0]), "F": (0, 2, [3, 0, 0]), "B": (1, 0, [1, 1, 0]),
            "D": (1, 1, [1, 2, 0]), "E": (2, 0, [2, 0, 1]), "G": (2, 1, [2, 0, 2])}


@pytest.mark.parametrize("heavy", [1, 1 << 20])
def test_scenario(spark, heavy, monkeypatch):
    monkeypatch.setattr(replay, "HEAVY_ROWS", heavy)
    events = spark.createDataFrame([(e, n, s) for e, (n, s, _) in SCENARIO.items()], "event string, node_idx int, seq long")
    messages = spark.createDataFrame([("A", "B"), ("C", "E")], "send_event string, recv_event string")
    replayed = replay.replay_clocks(events, messages, 3)
    vc = {r.event: r.vc for r in replayed.collect()}
    assert vc == {e: c for e, (_, _, c) in SCENARIO.items()}
    for a, b in ("AB", "BD", "AD", "CE", "AF"):
        assert rel(vc[a], vc[b]) == "HAPPENS_BEFORE"
    assert rel(vc["D"], vc["F"]) == rel(vc["D"], vc["G"]) == "CONCURRENT"
    edges = {(r.src_event, r.dst_event) for r in graph.causal_graph(replayed, 3, "event").collect()}
    assert edges == set(map(tuple, ("AB", "AC", "BD", "CE", "CF", "EG")))


def test_replay_doubles_hops_and_finds_circles(spark):
    hops = 40
    chain = [(i, i % 3, i // 3) for i in range(hops)]
    events = spark.createDataFrame(chain, "event long, node_idx int, seq long")
    messages = spark.createDataFrame([(i, i + 1) for i in range(hops - 1)], "send_event long, recv_event long")
    got = {r.event: r.vc for r in replay.replay_clocks(events, messages, 3, rows=4, max_rounds=8).collect()}
    assert got == {i: [(i + 3 - j) // 3 for j in range(3)] for i in range(hops)}
    circle = spark.createDataFrame([(5, 1), (1, 5)], "send_event long, recv_event long")
    with pytest.raises(ValueError, match="circle"):
        replay.replay_clocks(events, circle, 3).collect()


def test_clocks_that_tick_one_component_never_pass(spark):
    """Nodes that all tick component 0: no order audit gives an all-clear."""
    from causal_logs.plans.frontier import MalformedClocks

    rows = [(i, f"n{i % 3}", i % 3, [i // 3 + 1, 0, 0], 1000 - i, i // 3, i) for i in range(30)]
    log = spark.createDataFrame(rows, "event_id int, node_id string, node_idx int, vc array<bigint>, ts_ms bigint, seq bigint, pos bigint")
    for use in (lambda: order.order_audit(log, 3), lambda: order.causal_order(log.drop("pos"), 3), lambda: relation.relation_counts(log, 3)):
        with pytest.raises(MalformedClocks, match="own component not ticked"):
            use().count()
    assert order.causal_order(log.drop("pos"), 3, well_formed=False).count() == 30


@pytest.mark.parametrize("rows", [2, 3, 4, 1 << 16])
def test_knowledge_that_falls_between_chunks(spark, rows):
    """Node 0 forgets what it knew of node 1 at tick 4, wherever chunks begin, and after a chunk without ticks."""
    from causal_logs.plans.frontier import MalformedClocks

    def log(known):
        own = [(k, "n0", 0, [tick, c], 1000 + tick, k, k) for k, (tick, c) in enumerate(known)]
        other = [(10 + k, "n1", 1, [0, k], 900 + k, k, 100 + k) for k in range(1, 4)]
        return spark.createDataFrame(own + other, "event_id int, node_id string, node_idx int, vc array<bigint>, ts_ms bigint, seq bigint, pos bigint")

    for known in ([(1, 0), (2, 2), (3, 3), (4, 1), (5, 3)], [(1, 0), (2, 3), (3, 3), (40, 2)]):
        for use in (lambda: order.order_audit(log(known), 2, rows=rows), lambda: order.causal_order(log(known).drop("pos"), 2, rows=rows)):
            with pytest.raises(MalformedClocks, match="knowledge falls: 1 entries"):
                use().count()
    assert order.causal_order(log([(1, 0), (2, 2), (3, 3), (4, 3)]).drop("pos"), 2, rows=rows).count() == 7


def test_replay_refuses_gaps_and_unknown_events(spark):
    from causal_logs.operators import replay

    events = spark.createDataFrame([(1, 0, 0), (2, 0, 2), (3, 1, 0)], "event int, node_idx int, seq bigint")
    none = spark.createDataFrame([], "send_event int, recv_event int")
    with pytest.raises(ValueError, match="gaps"):
        replay.replay_clocks(events, none, 2)
    with pytest.raises(ValueError, match="unknown"):
        replay.replay_clocks(events.where("seq = 0"), spark.createDataFrame([(1, 9)], "send_event int, recv_event int"), 2)


def _audited(rows, n):
    """(falls, incomplete) per node, by looking at every row and every sender."""
    ticks = {}
    for _, _, node, vc, _, _ in rows:
        if vc[node] > 0:
            known = ticks.setdefault((node, vc[node]), [0, [0] * n])
            ticks[node, vc[node]] = [known[0] + 1, [max(x, y) for x, y in zip(known[1], vc)]]
    out = {}
    for (node, tick), (copies, vc) in ticks.items():
        before = [0] * n
        for (j, k), (_, clock) in sorted(ticks.items()):
            if j == node and k < tick:
                before = clock
        falls = any(vc[j] < before[j] for j in range(n) if j != node)
        lacks = False
        for j in range(n):
            if j != node and vc[j] > before[j]:
                sent = [clock for (i, k), (_, clock) in sorted(ticks.items()) if i == j and k <= vc[j]]
                lacks |= bool(sent) and any(a > b for a, b in zip(sent[-1], vc))
        a, b = out.get(node, (0, 0))
        out[node] = (a + copies * falls, b + copies * lacks)
    return out


@pytest.mark.parametrize("rows", [2, 5, 1 << 16])
def test_audit_of_knowledge(spark, rows):
    import random

    rng = random.Random(rows)
    whole = random_log(11, nodes=3, events=80, lost=0.1, copies=0.1)
    hurt = [(i, n, k, [c if j == k or rng.random() < 0.9 else rng.randint(0, c) for j, c in enumerate(vc)], t, s) for i, n, k, vc, t, s in whole]
    for log in (whole, hurt):
        got = {r.node_idx: (r.knowledge_falls, r.knowledge_incomplete) for r in audit.clock_audit(spark.createDataFrame(log, SCHEMA), 3, rows=rows).collect()}
        assert got == _audited(log, 3)
    assert any(sum(x) for x in _audited(hurt, 3).values()) and not any(sum(x) for x in _audited(whole, 3).values())


def test_audit_names_what_the_order_refuses(spark):
    """A node that forgets: every job that rests on the premise refuses it, and the audit says why."""
    rows = [(0, "n0", 0, [1, 1], 1, 0), (1, "n0", 0, [2, 0], 2, 1), (2, "n1", 1, [0, 1], 0, 0)]
    got = {r.node_idx: r.knowledge_falls for r in audit.clock_audit(spark.createDataFrame(rows, SCHEMA), 2).collect()}
    assert got == {0: 1, 1: 0}


@pytest.mark.parametrize("rows", [3, 1 << 16])
def test_ranges(case, rows):
    entries, log, n = case
    targets = log.where(F.pmod("event_id", F.lit(5)) == 0)
    ranges = relation.causal_ranges(log, targets, n, rows=rows)
    got = {(r.target_id, r.node_idx): r for r in ranges.collect()}
    chosen = [t for t in entries if t[0] % 5 == 0]
    assert set(got) == {(t[0], j) for t in chosen for j in range(n)}
    for t in chosen:
        for j in range(n):
            r = got[t[0], j]
            kinds = [rel(e[3], t[3]) for e in entries if e[2] == j]
            assert (r.n_before, r.n_concurrent, r.n_after) == tuple(kinds.count(k) for k in ("HAPPENS_BEFORE", "CONCURRENT", "HAPPENS_AFTER"))
            for e in entries:
                if e[2] == j:
                    tick, kind = e[3][j], rel(e[3], t[3])
                    assert (kind == "HAPPENS_BEFORE") == (tick <= r.known_upto)
                    assert (kind == "HAPPENS_AFTER") == (r.first_knowing is not None and tick >= r.first_knowing)
    kinds = ("HAPPENS_BEFORE", "HAPPENS_AFTER", "CONCURRENT")
    for asked in (kinds, kinds[:1], kinds[2:]):
        listed = {(r.target_id, r.event_id): r.relation for r in relation.in_ranges(log, ranges, asked, rows=rows).collect()}
        assert listed == {(t[0], e[0]): rel(e[3], t[3]) for t in chosen for e in entries if rel(e[3], t[3]) in asked}


def _shapeless(seed, n, events=70):
    """Clocks of all kinds: whole, fallen, all ticking component 0, short, all zero, missing, repeated."""
    import random

    rng = random.Random(seed)
    rows = random_log(seed, nodes=n, events=events, copies=0.1)
    out = []
    for i, node, k, vc, t, s in rows:
        kind = rng.random()
        if kind < 0.2:
            vc = [rng.randint(0, 12) for _ in range(n)]
        elif kind < 0.3:
            vc = [s + 1] + [0] * (n - 1)
        elif kind < 0.35:
            vc = vc[: n - 1]
        elif kind < 0.4:
            vc = [0] * n if kind < 0.38 else None
        out.append((i, node, k, vc, t, s))
    return out


@pytest.mark.parametrize("seed,n,chunk,portion", [(1, 3, 7, 1000), (2, 4, 1, 5), (3, 5, 64, 3), (4, 3, 8192, 1 << 17)])
def test_any_clocks(spark, seed, n, chunk, portion, monkeypatch):
    from causal_logs.plans import dominance

    monkeypatch.setattr(dominance, "CHUNK_CLOCKS", chunk)
    monkeypatch.setattr(dominance, "PORTION_RUNS", portion)
    rows = _shapeless(seed, n, 24 if chunk == 1 else 70)
    log = spark.createDataFrame(rows, SCHEMA)
    got = {r.event_id: (r.n_before, r.n_after, r.n_equal, r.n_concurrent) for r in relation.relation_counts(log, n, well_formed=False).collect()}
    for x in rows:
        kinds = [rel(y[3], x[3]) for y in rows if y[0] != x[0]]
        assert got[x[0]] == tuple(kinds.count(k) for k in ("HAPPENS_BEFORE", "HAPPENS_AFTER", "EQUAL", "CONCURRENT"))
    timed = order.time_order(log)
    pos = {r.event_id: r.pos for r in timed.collect()}
    want = {}
    for a, b in _violations(rows, pos):
        want[b] = max(want.get(b, 0), pos[a])
    assert {r.event_id: r.latest_past_pos for r in order.order_audit(timed, n, well_formed=False).collect()} == want
    targets = log.where(F.pmod("event_id", F.lit(6)) == 0)
    for cells in (200_000, n):
        monkeypatch.setattr(relation, "MAX_BROADCAST_CELLS", cells)
        kinds = ("HAPPENS_BEFORE", "HAPPENS_AFTER", "CONCURRENT", "EQUAL")
        listed = {(r.target_id, r.event_id): r.relation for r in relation.causal_slice(log, targets, n, kinds, well_formed=False).collect()}
        assert listed == {(t[0], e[0]): rel(e[3], t[3]) for t in rows if t[0] % 6 == 0 for e in rows if e[0] != t[0]}


def test_no_clocks_at_all(spark):
    log = spark.createDataFrame([(1, "a", 0, None, 1, 0), (2, "b", 1, None, 2, 0)], SCHEMA)
    got = sorted((r.event_id, r.n_before, r.n_after, r.n_equal, r.n_concurrent) for r in relation.relation_counts(log, 2, well_formed=False).collect())
    assert got == [(1, 0, 0, 0, 1), (2, 0, 0, 0, 1)]
    assert order.order_audit(order.time_order(log), 2, well_formed=False).collect() == []


def test_slices_refuse_clocks_that_tick_one_component(spark):
    from causal_logs.plans.frontier import MalformedClocks

    rows = [(0, "n0", 0, [1, 0], 1, 0), (1, "n0", 0, [2, 0], 2, 1), (2, "n1", 1, [1, 0], 3, 0), (3, "n1", 1, [3, 0], 4, 1)]
    log = spark.createDataFrame(rows, SCHEMA)
    target = log.where("event_id = 1")
    for use in (relation.causal_slice, relation.causal_ranges):
        with pytest.raises(MalformedClocks, match="own component not ticked"):
            use(log, target, 2).count()
    got = {r.event_id: r.relation for r in relation.causal_slice(log, target, 2, well_formed=False).collect()}
    assert got == {0: "HAPPENS_BEFORE", 2: "HAPPENS_BEFORE", 3: "HAPPENS_AFTER"}


def _joins(df):
    """The lines of a plan that join."""
    return [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if " Join " in x or x.startswith("Join ")]


def test_slices_compare_numbers_only(spark):
    """No pair takes a clock apart or compares names of relations."""
    log = spark.createDataFrame([(0, "n0", 0, [1, 0], 1, 0), (1, "n0", 0, None, 2, 1), (2, "n1", 1, [3], 3, 0)], SCHEMA)
    found = relation.causal_slice(log, log, 2, well_formed=False)
    assert (joins := _joins(found)) and not any("vc#" in x or "HAPPENS" in x for x in joins)
    assert sorted(tuple(r) for r in found.collect()) == [(0, 2, "HAPPENS_AFTER"), (2, 0, "HAPPENS_BEFORE")]
    assert relation.causal_slice(log, log, 2, (), well_formed=False).count() == 0
    alone = relation.causal_slice(log, log, 2, ("CONCURRENT",), well_formed=False).collect()
    assert sorted(tuple(r) for r in alone) == [(0, 1, "CONCURRENT"), (1, 0, "CONCURRENT"), (1, 2, "CONCURRENT"), (2, 1, "CONCURRENT")]


@pytest.mark.parametrize("entries", [20_000, 4, 1])
def test_pairs_within(case, entries, monkeypatch):
    rows, log, n = case
    rows = [*rows, (900, "node-0", 0, None, 1_000_100, 0), (901, "node-1", 1, None, 1_000_100, 0), (902, "x", None, [1], None, 0), (903, None, None, [1], -3, 0), (904, "x", None, [1], 3, 0)]
    log = log.unionByName(log.sparkSession.createDataFrame(rows[-5:], SCHEMA))
    for within, across in ((0, False), (7, False), (150, True), (100_000, False)):
        want = {}
        for a in rows:
            for b in rows:
                if None in (a[4], b[4]) or not 0 <= b[4] - a[4] <= within or not (a[4], a[0]) < (b[4], b[0]) or (across and a[1] == b[1]):
                    continue
                kind = rel(a[3], b[3])
                place = -1 if a[4] < b[4] else 0 if None in (a[1], b[1]) else (a[1] > b[1]) - (a[1] < b[1])
                want[a[0], b[0]] = (b[4] - a[4], kind, {"HAPPENS_BEFORE": -1, "HAPPENS_AFTER": 1}.get(kind, place))
        got = relation.pairs_within(log, within, across_nodes=across, entries=entries).collect()
        assert len(got) == len(want)
        assert {(r.a_event_id, r.b_event_id): (r.gap_ms, r.relation, r.sign) for r in got} == want
        monkeypatch.setattr(relation, "MAX_HOT_BUCKETS", 0)


@pytest.mark.parametrize("entries", [20_000, 3])
def test_pairs_within_read_their_log_once(case, entries):
    """With a width too; the join deals out numbers, not clocks, and reads the entries from one stored table."""
    rows, log, n = case
    log = log.unionByName(log.sparkSession.createDataFrame([(900, "node-0", 0, None, 1_000_100, 0), (901, "node-1", 1, [1], 1_000_100, 0)], SCHEMA))
    plain = relation.pairs_within(log, 150, entries=entries)
    wide = relation.pairs_within(log, 150, width=n, entries=entries)
    assert sorted(tuple(r) for r in wide.collect()) == sorted(tuple(r) for r in plain.collect())
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "vc#" not in plan and "LogicalRDD" not in plan and "LocalRelation" not in plan


@pytest.mark.parametrize("pairs", [1 << 26, 800])
def test_pairs_within_follow_node_and_time(spark, pairs, monkeypatch):
    """The pairs of a bucket come by entry, node and time, however the log lies: alike rows next to each other take little room on disk."""
    monkeypatch.setattr(relation, "TASK_PAIRS", pairs)
    rows = [(i, f"node-{i % 3}", i % 3, [i + 1] * 3, (i * 37) % 90, i) for i in range(40)]
    at = {r[0]: (r[1], r[4], r[0]) for r in rows}
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        log = spark.createDataFrame([rows[(i * 23) % 40] for i in range(40)], SCHEMA).repartition(5)
        found = relation.pairs_within(log, 100, width=3)
        got = [(at[r.a_event_id], at[r.b_event_id]) for r in found.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert got == sorted((a, b) for a in at.values() for b in at.values() if a[1:] < b[1:])
    # Of 1,600 pairs that meet, 800 a task.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert (", 2), REPARTITION_BY_NUM" in plan) == (pairs == 800)


def test_first_in_causal_order(case):
    rows, log, n = case
    extra = [(800, "node-0", 0, None, 5, 90), (801, "node-1", None, None, None, 91), (802, "node-1", 1, None, 999_999_999, 92)]
    log = log.unionByName(log.sparkSession.createDataFrame(extra, SCHEMA))
    whole = [(r.event_id, r.eff_ts, r.pos) for r in order.causal_order(log, n, rows=3).orderBy("pos").collect()]
    wanted = F.col("event_id") % 3 == 0
    for limit in (1, 4, 1000):
        got = order.causal_first(log, n, limit, wanted, rows=3).collect()
        assert [(r.event_id, r.eff_ts, r.pos) for r in got] == [w for w in whole if w[0] % 3 == 0][:limit]
    assert order.causal_first(log, n, 5, F.lit(False)).collect() == []


def test_first_in_causal_order_ranks_few_rows(spark, monkeypatch):
    rows = [(i, f"node-{i % 2}", i % 2, [i // 2 + 1 if j == i % 2 else 0 for j in range(2)], 1000 + i, i // 2) for i in range(200)]
    log, ranked = spark.createDataFrame(rows, SCHEMA), []
    rank = order.rank_rows
    monkeypatch.setattr(order, "rank_rows", lambda df, *a: (ranked.append(df.count()), rank(df, *a))[1])
    got = order.causal_first(log, 2, 3, F.col("event_id") % 5 == 0).collect()
    assert [r.event_id for r in got] == [0, 5, 10] and ranked == [11]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_replay_with_lost_events(spark, seed):
    import random

    rng = random.Random(seed)
    nodes, events, sent = 4, [], []
    counts, messages = [0] * nodes, []
    for i in range(90):
        node = rng.randrange(nodes)
        events.append((i, node, counts[node]))
        counts[node] += 1
        if i and rng.random() < 0.5:
            messages.append((rng.randrange(i), i))
    kept = [e for e in events if rng.random() < 0.6]
    ids, last, past = {e[0] for e in kept}, {}, {}
    senders = {}
    for a, b in messages:
        senders.setdefault(b, []).append(a)
    for i, node, seq in kept:
        past[i] = {(node, seq + 1)}
        for cause in [last.get(node), *senders.get(i, [])]:
            if cause in ids:
                past[i] |= past[cause]
        last[node] = i
    want = {i: [max([t for n, t in known if n == j], default=0) for j in range(nodes)] for i, known in past.items()}
    given = spark.createDataFrame(kept, "event long, node_idx int, seq long").repartition(3)
    told = spark.createDataFrame(messages, "send_event long, recv_event long")
    for rows in (2, 5, 1 << 16):
        got = replay.replay_clocks(given, told, nodes, rows=rows, lost=True).collect()
        assert {r.event: r.vc for r in got} == want and {(r.event, r.node_idx, r.seq) for r in got} == set(kept)
    with pytest.raises(ValueError, match="repeat"):
        replay.replay_clocks(given.union(given.limit(1)), told, nodes, lost=True)
