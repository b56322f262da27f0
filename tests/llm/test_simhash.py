"""Fingerprints and their groups against a plain version."""

import random
import re

import numpy as np
import pytest
import xxhash

from causal_logs.llm import components, simhash



def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    size = min(4, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i : i + size]).encode(), seed=42).intdigest() for i in range(len(words) - size + 1)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups(prints, bits=4):
    """Smallest index linked with each of the fingerprints."""
    near = np.bitwise_count(np.array(prints, np.uint64)[:, None] ^ np.array(prints, np.uint64)) <= bits
    label = np.arange(len(prints))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label.tolist()
        label = new


def labelled(spark, prints, **options):
    rows = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "print bigint").repartition(3)
    found = {r.node: r.component for r in components.components(simhash.linked(rows, **options)).collect()}
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    seen = {}
    return [seen.setdefault(found.get(p, p), i) for i, p in enumerate(signed)]


def _cloud(rng, n, flips, bits=range(64)):
    centre = rng.getrandbits(64)
    out = set()
    while len(out) < n:
        p = centre
        for b in rng.sample(list(bits), rng.randint(0, flips)):
            p ^= 1 << b
        out.add(p)
    return list(out)


@pytest.mark.parametrize("limit", [2048, 16, 4])
def test_links_like_all_pairs(spark, limit):
    rng = random.Random(limit)
    prints = {rng.getrandbits(64) for _ in range(150)} | {0, 1, (1 << 64) - 1, 1 << 63}
    for flips in (2, 3, 4, 5, 9):
        prints |= set(_cloud(rng, 40, flips))
    # Differing in two bytes only: the lists of all other positions stay long, whatever they are dealt by.
    prints |= set(_cloud(rng, 120, 10, range(16)))
    prints = sorted(prints)
    assert labelled(spark, prints, limit=limit) == groups(prints)


def test_every_four_shared_positions_meet():
    from itertools import combinations

    for shared in combinations(range(8), 4):
        assert any(set(pair) <= set(shared) for pair in simhash._BASE)


def test_documents_like_plain(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)] + ["Ärger", "ÉTÉ", "日本語", "a"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 120))) for _ in range(60)]
    texts += [t.replace("w1", "v1", 1) + " end" for t in texts[:30]] + texts[:10]
    texts += [None, "", " \n\t", "one", "one two", "ONE\x0btwo\x0cthree\r\n", "x " * 70_000, "a\x1cb\x85c d", " ".join(["deep"] * 9)]
    texts += ["long " + " ".join(rng.choice(words) for _ in range(90_000))]
    rows = [(i, t, i, "p") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, print int, component string").repartition(5)
    prints = [plain_print(t) for t in texts]
    found = {r.doc_id: r for r in simhash.near_copies(docs, limit=8).collect()}
    assert [found[i].fingerprint for i in range(len(rows))] == [f"{p:016x}" for p in prints]
    assert [found[i].component_id for i in range(len(rows))] == groups(prints)


def test_odd_tables(spark):
    rows = [(None, None), (None, "a b c d e"), (4, "a b c d e"), (4, "other words stand here"), (2, None), (9, "a b c d e")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = simhash.near_copies(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    found = sorted([(str(r.doc_id), r.fingerprint, r.component_id) for r in got.collect()])
    zero, abc, other = "0" * 16, f"{plain_print('a b c d e'):016x}", f"{plain_print('other words stand here'):016x}"
    assert found == sorted([("None", zero, 2), ("None", abc, 4), ("4", abc, 4), ("4", other, 4), ("2", zero, 2), ("9", abc, 4)])
    assert simhash.near_copies(docs.limit(0)).collect() == []
    assert [r.component_id for r in simhash.near_copies(spark.createDataFrame([(None, "a")], "doc_id bigint, text string")).collect()] == [None]
