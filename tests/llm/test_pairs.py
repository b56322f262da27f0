"""Decontamination, repeated bytes and the similarity join against brute force."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cases import LONG, documents, odd, texts
from causal_logs.llm import components, decontaminate, exchange, jaccard, repeats

import numpy as np

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# --- decontamination --------------------------------------------------------


def _plain_hits(text, items, window=10):
    words, hit, found = _WORD.findall(_lower(text)), set(), set()
    for item, passage in items:
        own = _WORD.findall(_lower(passage))
        n = min(window, len(own))
        for a in range(len(own) - n + 1 if own else 0):
            for b in range(len(words) - n + 1):
                if words[b : b + n] == own[a : a + n]:
                    hit.update(range(b, b + n))
                    found.add(str(item))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def _benchmark(spark):
    base = [t for _, t in texts()[:4]]
    items = [(3, " ".join(base[0].split()[5:30])), (20, base[1].upper().replace(" ", ", ")), (7, "one two"), (8, None), (9, ""), (11, base[0]), (7, "four"), (None, base[2])]
    return items, spark.createDataFrame([(*i, "x") for i in items], "item_id int, text string, spans string")


def test_decontamination(spark):
    items, table = _benchmark(spark)
    rows = [r for r in texts() if r[1] is None or len(r[1]) < 5000]
    want = {i: _plain_hits(t, [x for x in items if x[0] is not None]) for i, t in rows}
    for pass_bytes in (decontaminate.PASS_BYTES, 300):
        found = decontaminate.report(decontaminate.contamination(documents(spark, rows), table, pass_bytes=pass_bytes))
        assert {r[0]: tuple(r[1:]) for r in found.collect()} == want
    assert any(w[4] for w in want.values()) and not all(w[4] for w in want.values())


def test_decontamination_edges(spark):
    items, table = _benchmark(spark)
    assert decontaminate.contamination(documents(spark, []), table).count() == 0
    found = decontaminate.contamination(odd(spark), table.where("false"))
    assert found.count() == len(texts()) + 4 and found.where("size(spans) > 0").count() == 0
    kept = decontaminate.decontaminated(odd(spark), table)
    assert kept.columns == odd(spark).columns
    ids = {r.doc_id for r in kept.collect()}
    assert 0 not in ids and {2, 100, 101, 106, None} <= ids


# --- repeated bytes ---------------------------------------------------------


def _plain_repeats(rows, width=50):
    first = {}
    for i, t in rows:
        for k in range(len(t) - width + 1):
            w = t[k : k + width]
            first[w] = min(i, first.get(w, i))
    out = {}
    for i, t in rows:
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - width + 1):
            if first[t[k : k + width]] < i:
                gone[k : k + width] = True
        rest = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(t) else 0
        out[i] = (len(t), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest())
    return out


def test_repeats(spark):
    rows = [(i, t) for i, t in texts() if i not in (106, 107)] + [(200, "be " * 300), (201, "be " * 90), (202, "a" * 50), (203, "a" * 49), (150, "a" * 400)]
    want = _plain_repeats([(i, (t or "").encode()) for i, t in rows])
    docs = documents(spark, rows).repartition(6)
    for options in ({}, {"spread_bytes": 1}, {"spread_bytes": 1, "bucket_bytes": 2000}, {"spread_bytes": 3000, "bucket_bytes": 2000}):
        assert {r[0]: tuple(r[1:]) for r in repeats.repeats(docs, **options).collect()} == want
    assert sum(w[1] for w in want.values()) > 1000


def test_repeats_behind_one_hot_anchor(spark):
    """Forty shared bytes in front of tails that differ, in copies too."""
    rng = np.random.default_rng(6)
    head = "the same forty bytes stand before a tail"
    tail = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), 60))
    tails = [tail() for _ in range(40)]
    rows = [(i, "".join(head + tails[int(k)] for k in rng.integers(0, 40, 6)) + tail()) for i in range(40)]
    want = _plain_repeats([(i, t.encode()) for i, t in rows])
    docs = documents(spark, rows).repartition(8)
    for options in ({}, {"spread_bytes": 500, "bucket_bytes": 2000}):
        assert {r[0]: tuple(r[1:]) for r in repeats.repeats(docs, **options).collect()} == want


def test_repeats_edges(spark):
    assert repeats.repeats(documents(spark, [])).count() == 0
    found = repeats.repeats(odd(spark), kept=True).collect()
    assert len(found) == len(texts()) + 4
    by = {r.doc: r for r in found if r.doc is not None}
    # Rows of one id do not remove each other; a row without an id comes last.
    twice = [r for r in found if r.doc == 5]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert sorted(r.n_removed for r in found if r.doc is None and r.n_bytes) == [0, len(texts()[6][1].encode())]
    assert by[107].n_removed >= len(LONG) and by[106].n_removed == 0 and by[106].kept == LONG


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.tuples(st.text("abé ", max_size=40), st.integers(0, 9)), max_size=5), min_size=1, max_size=4))
def test_merged_transforms(batches):
    """The merge of shards against counting windows, for windows of four bytes."""
    contexts, own = [], []
    for batch in batches:
        strings = [(t.encode(), d) for t, d in batch if len(t.encode()) >= 4]
        if strings:
            contexts.append((np.frombuffer(b"".join(s for s, _ in strings), np.uint8), np.cumsum([len(s) for s, _ in strings]), np.array([d for _, d in strings])))
            own.append(strings)
    if not contexts:
        return
    first = {}
    for strings in own:
        for s, d in strings:
            for k in range(len(s) - 3):
                first[s[k : k + 4]] = min(d, first.get(s[k : k + 4], d))
    for strings, found in zip(own, repeats.first_documents(contexts, 4), strict=True):
        want = [first[s[k : k + 4]] if k <= len(s) - 4 else exchange.NO_ID for s, _ in strings for k in range(len(s))]
        assert found.tolist() == want


# --- similarity join --------------------------------------------------------


def _plain_components(rows, percent=80, size=5):
    sets = {}
    for i, t in rows:
        w = _SPACE.findall(_lower(t))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed = changed or label[a] != label[b]
            label[a] = label[b] = low
    return {i: (len(sets[i]), label[i]) for i in sets}


def test_similarity(spark):
    rows = texts() + [(300 + k, " ".join(f"w{j}" if j not in (7 * k % 60, 9 * k % 60) else f"v{k}" for j in range(60 + k % 3))) for k in range(40)]
    want = _plain_components(rows)
    for frequent in (jaccard.FREQUENT, 3, 1):
        found = jaccard.similar(documents(spark, rows), frequent=frequent).select("doc", "n_shingles", "component")
        assert {r[0]: tuple(r[1:]) for r in found.collect()} == want
    assert len({c for _, c in want.values()}) < len(rows) - 20


def test_similarity_edges(spark):
    assert jaccard.similar(documents(spark, [])).count() == 0
    found = jaccard.similar(odd(spark)).collect()
    assert len(found) == len(texts()) + 4
    by = {r.doc: r for r in found if r.doc is not None}
    assert by[104].component == by[105].component == 104 and by[103].component == 103 and by[100].n_shingles == 0
    # Without an id: with its group, or alone.
    assert sorted((r.component is None for r in found if r.doc is None)) == [False, True, True]
    lone = [r for r in jaccard.deduplicated(odd(spark)).collect() if r.doc_id is None]
    assert len(lone) == 3
    kept = jaccard.deduplicated(documents(spark))
    assert kept.columns == documents(spark).columns
    groups = {c for _, c in _plain_components(texts()).values()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(groups)


def test_components(spark):
    pairs = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 105), (7, 200)]
    found = components.components(spark.createDataFrame(pairs, "a int, b int"))
    assert {r.node: r.component for r in found.collect()} == {**{i: 0 for i in range(51)}, 200: 0, 100: 100, 101: 100, 105: 100}
    assert components.components(spark.createDataFrame([], "a int, b int")).count() == 0


# --- keys of the similarity join --------------------------------------------


@given(st.integers(1, 1 << 40), st.integers(50, 99), st.floats(0, 1))
def test_similar_sizes_are_in_neighbouring_classes(n, percent, share):
    most = 100 * n // percent
    m = n + int(share * (most - n))
    low, high = jaccard._classes(np.array([n, m]), percent)
    assert low <= high <= low + 1


def test_long_prefixes_are_not_combined():
    """A text of 20,000 frequent shingles has a key or two for each token of its prefix, not for each pair of them."""
    n = 20_000
    tokens = np.sort(np.random.default_rng(1).integers(0, 1 << 62, n).astype(np.uint64))
    for count in (300, 5_000, 10**6):
        code = np.full(n, jaccard._code(np.array([count]))[0])
        owner, key, rest = jaccard._postings(tokens, code, np.array([0, n]), 80, 256)
        assert len(key) <= 2 * (n // 5 + 1) and len(np.unique(key)) == len(key)
    short = np.array([0, 100])
    pairs = jaccard._postings(tokens[:100], np.full(100, jaccard._code(np.array([10**6]))[0]), short, 80, 256)
    assert len(pairs[0]) == 2 * (22 * 21 // 2)


def test_similar_long_texts(spark):
    """Long texts made of shingles that many texts have, in several sizes, and texts that share most of them without being similar."""
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(words[: 3000 - 7 * i])) for i in range(40)] + [(100 + i, " ".join(words[1500 + 3 * i :])) for i in range(40)]
    rows += [(200 + i, " ".join(words[i * 30 : i * 30 + 60])) for i in range(90)] + [(300 + i, " ".join(words[i * 30 : i * 30 + 64])) for i in range(90)]
    want = _plain_components(rows)
    for frequent in (256, 2, 1):
        found = jaccard.similar(documents(spark, rows), frequent=frequent).select("doc", "n_shingles", "component")
        assert {r[0]: tuple(r)[1:] for r in found.collect()} == want
