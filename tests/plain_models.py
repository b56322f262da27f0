"""Small plain-Python models the jobs are compared with."""

import random


def relation(a, b):
    if a is None or b is None:
        return "CONCURRENT"
    n = max(len(a), len(b))
    a, b = list(a) + [0] * (n - len(a)), list(b) + [0] * (n - len(b))
    le, ge = all(x <= y for x, y in zip(a, b)), all(x >= y for x, y in zip(a, b))
    return "EQUAL" if le and ge else "HAPPENS_BEFORE" if le else "HAPPENS_AFTER" if ge else "CONCURRENT"


def random_log(seed, nodes=4, events=60, lost=0.0, copies=0.0):
    """Rows of nodes that tick, send and receive at random, with skewed wall clocks."""
    rng = random.Random(seed)
    clocks = [[0] * nodes for _ in range(nodes)]
    sent, rows, moment = [], [], 0
    skew = [rng.randrange(-400, 400) for _ in range(nodes)]
    for _ in range(events):
        node = rng.randrange(nodes)
        clocks[node][node] += 1
        if sent and rng.random() < 0.4:
            clocks[node] = [max(x, y) for x, y in zip(clocks[node], rng.choice(sent))]
        if rng.random() < 0.5:
            sent.append(list(clocks[node]))
        moment += rng.randrange(1, 60)
        row = (f"node-{node}", node, list(clocks[node]), 1_000_000 + moment + skew[node], clocks[node][node] - 1)
        if rng.random() >= lost:
            rows += [row] * (1 + (rng.randrange(1, 5) if rng.random() < copies else 0))
    return [(i, *row) for i, row in enumerate(rows)]


SCHEMA = "event_id long, node_id string, node_idx int, vc array<bigint>, ts_ms long, seq long"


def reduced_edges(rows):
    """Transitive reduction over distinct clocks, named by the smallest id."""
    name = {}
    for r in rows:
        name.setdefault(tuple(r[3]), r[0])
    clocks = list(name)
    before = {(a, b) for a in clocks for b in clocks if relation(a, b) == "HAPPENS_BEFORE"}
    return {
        (name[a], name[b])
        for a, b in before
        if not any((a, c) in before and (c, b) in before for c in clocks)
    }
