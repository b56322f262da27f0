"""Repaired conversations against a plain search."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from causal_logs.llm import repair

SPACE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = name(role), name(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain(originals, rows):
    """Every conversation by Dijkstra over (turn, state), cost and then text."""
    out = {}
    for conv in {r[0] for r in originals}:
        turns = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, faults = set(), []
        for _, _, role, text in turns:
            rest = text.rstrip(SPACE)
            faults.append("blank" if not rest else "duplicate" if (role, text) in seen else "truncated" if rest[-1] not in ".!?" else None)
            seen.add((role, text))
        initials = [r[2][:1] for r in turns]
        numbers = [r[1] for r in turns if r[1] is not None]
        legal = re.compile("(s?(ua)+)?")
        prefix = re.compile("s?(ua)*u?")
        heap, done = [(0, "", 0, "", ())], set()
        while True:
            cost, audit, at, roles, lines = heapq.heappop(heap)
            state = (at, roles[-1:])
            if state in done:
                continue
            done.add(state)
            if at == len(turns) and legal.fullmatch(roles):
                break
            steps = [(5, "I", at, r, (f"{r}:",)) for r in ("user", "assistant")]
            if at < len(turns):
                _, _, role, text = turns[at]
                steps.append((2, "D", at + 1, None, ()))
                if faults[at] not in ("blank", "duplicate"):
                    extra = 5 * (faults[at] == "truncated")
                    steps.append((extra, "K", at + 1, role, (f"{role}:{text}",)))
                    steps += [(1 + extra, "R", at + 1, r, (f"{r}:{text}",)) for r in ("user", "assistant")]
            for price, letter, to, role, line in steps:
                after = roles if role is None else (roles + role[:1] if role[:1] else None)
                if after is not None and prefix.fullmatch(after):
                    heapq.heappush(heap, (cost + price, audit + letter, to, after, lines + line))
        count = faults.count
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out[conv] = (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def _rows(seed, convs=40, longest=9):
    rng = random.Random(seed)
    out = []
    for conv in range(convs):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "usher"])
            text = rng.choice(["Yes.", "No", " ", "", None, f"Say {turn}!", "a ", "Hm? \n", "x ", "Done."])
            out.append((conv, rng.choice([turn, turn, turn, turn + 2, None]), role, text))
    return out


def _check(spark, rows, damage=True, parts=3, **options):
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(parts)
    table = table.withColumns({c: F.lit("x") for c in ("conv", "copies", "audit", "number")})
    turns = repair.damaged(table) if damage else repair.as_turns(table)
    name = lambda x: " " if x is None else x
    want = plain(rows, plain_damage(rows) if damage else [(a, b, name(c), name(d)) for a, b, c, d in rows])
    got = repair.repaired(turns, **options).collect()
    assert len(got) == len(want)
    assert {r[0]: tuple(r)[1:9] for r in got} == want
    return got


@pytest.mark.parametrize("seed,damage", [(1, True), (2, False), (3, True)])
def test_like_plain(spark, seed, damage):
    rows = _rows(seed)
    _check(spark, [*rows, *rows[:9], (None, 1, "user", "A."), (None, None, None, None), (None, 1, "user", "A.")], damage)


def test_one_conversation_over_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_ROWS", 7)
    rng = random.Random(8)
    rows = _rows(4, 12)
    for turn in range(150):
        rows.append((500, turn * 2 if turn % 9 else None, rng.choice(["user", "assistant", "system", "u"]), rng.choice(["Again.", f"Say {turn}.", "cut", f"cut {turn}", " "])))
    for records in ("10000", "5"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
        got = _check(spark, rows, parts=5, texts=True)
        for r in got:
            assert hashlib.sha256(r.repaired.encode()).hexdigest() == r.repaired_sha256
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_turns_and_empty_tables(spark):
    dropped = [(c, t) for c in range(200) for t in range(1) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:3]
    rows = [(c, t, "user", "Hi.") for c, t in dropped]
    got = _check(spark, rows)
    assert {tuple(r)[1:] for r in got} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert repair.repaired(repair.damaged(spark.createDataFrame([], "conv_id string, turn int, role string, text string"))).collect() == []


def test_copies_of_one_turn(spark):
    rows = [(1, 0, "user", "Same.")] * 300 + [(1, 1, "assistant", "Other.")] + [(2, 5, "user", "")] * 40
    _check(spark, rows, damage=False, parts=7)


def test_rules_change_nothing():
    rng = np.random.default_rng(5)
    rules = [(2, 3), (9, 9), (3, 2), (0, 0), (10, 12), (6, 7)]
    plain_, ruled = repair.grammar([]), repair.grammar(rules)
    for n in range(60):
        string = rng.choice([0, 1, 2, 3, 4, 6, 7, 2, 3, 2, 3], n).astype(np.uint8).tobytes()
        assert repair.cheapest(string, plain_) == repair.cheapest(string, ruled)
        assert len(repair.compressed(np.frombuffer(string, np.uint8).astype(np.int16), rules)) <= n


def test_rules_are_learnt(spark):
    strings = spark.createDataFrame([(bytes([2, 3] * 20), 5), (bytes([1, 2, 3]), 2), (bytes([0, 0, 0, 0]), 1)], "string binary, n bigint")
    rules = repair._rules(strings, 6, 24, 120)
    assert rules[0] == (2, 3)
    assert len(repair.compressed(np.array([2, 3] * 20, np.int16), rules)) <= 3
