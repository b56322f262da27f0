"""Conversations brought into the form system, user, assistant, user, assistant ... by their cheapest edits.

Every turn is a symbol: the initial of its role and its fault. A conversation is a string of symbols, and its
cheapest edits are a shortest path through four states (nothing yet, after system, after user, after
assistant). A symbol is a min-plus matrix over these states whose cells also hold the edits made; strings
multiply theirs. The strings of the whole table are compressed by one Re-Pair grammar: in every round the frequent
pairs of neighbouring symbols, counted by Spark, become rules. A rule has one matrix, the product of its two symbols', made once and
shared by all conversations, so a conversation costs one step for each symbol of its compressed string.

Edits are compared by cost, then as text. Of two edit texts of equal cost for the same turns neither begins with the other
(that would be the same edits and more inserts), so the least text of a product is made of least texts.

Turns are sorted by range, so one conversation may fill many tasks. Conversations that lie whole in a task are done
there; of the others each piece sends its matrix, and the pieces of a conversation are multiplied in order.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import written

KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED = 5
# Rounds of pairs, pairs of a round, and rules in all.
ROUNDS, PAIRS, RULES = 6, 24, 120
# Turns and bytes of a stored block.
BLOCK_ROWS, BLOCK_BYTES = 1 << 13, 1 << 21
# Results kept of strings met before, in a task.
_KNOWN = 1 << 15
# Symbols: to be deleted, then initials (s, u, a, others), then the same truncated.
_DELETED, _INITIALS = 0, "sua"
_SYMBOLS = 9
_SPACES = " \t\n\v\f\r"
# States: nothing yet, after system, after user, after assistant.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {_START: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}


class Rope:
    """A text made of two; put together when it is first asked for."""

    __slots__ = ("left", "right", "_text")

    def __init__(self, left, right):
        self.left, self.right, self._text = left, right, None

    def text(self) -> str:
        if self._text is None:
            self._text = _text(self.left) + _text(self.right)
        return self._text


def _text(rope) -> str:
    return rope if isinstance(rope, str) else rope.text()


def _times(a: dict, b: dict) -> dict:
    """Product of two matrices: ``(from, to) -> (cost, rope)`` where there is a way."""
    out: dict = {}
    for (i, k), (cost, rope) in a.items():
        for j in range(4):
            if (more := b.get((k, j))) is None:
                continue
            total = cost + more[0]
            held = out.get((i, j))
            if held is None or total < held[0]:
                out[i, j] = (total, Rope(rope, more[1]))
            elif total == held[0] and (new := Rope(rope, more[1])).text() < _text(held[1]):
                out[i, j] = (total, new)
    return out


def _inserts() -> dict:
    """Up to two inserts, as a matrix; more would only lead back."""
    out = {(i, i): (0, "") for i in range(4)}
    for i in range(4):
        at, n = i, 0
        while (at := _NEXT[at]) != i and (i, at) not in out:
            n += 1
            out[i, at] = (n * INSERT, "I" * n)
    return out


def symbol_matrices() -> list[dict]:
    """The matrix of each symbol: inserts before the turn, then what is done with it."""
    out = []
    for symbol in range(_SYMBOLS):
        cells = {(i, i): (DELETE, "D") for i in range(4)}
        if symbol != _DELETED:
            kind, late = (symbol - 1) % 4, TRUNCATED * (symbol > 4)
            for i in range(4):
                keeps = {0: _SYSTEM if i == _START else None, 1: _NEXT[i] if i != _USER else None, 2: _ASSISTANT if i == _USER else None}.get(kind)
                ways = [(REROLE + late, "R", _NEXT[i])] + ([(KEEP + late, "K", keeps)] if keeps is not None else [])
                for cost, letter, to in ways:
                    if (i, to) not in cells or (cost, letter) < cells[i, to]:
                        cells[i, to] = (cost, letter)
        out.append(_times(_inserts(), cells))
    return out


class Grammar(NamedTuple):
    """Rules (left, right) of the symbols from ``_SYMBOLS`` on, and the matrix of every symbol, as text."""

    rules: list[tuple[int, int]]
    matrices: list[dict]


def grammar(rules: list[tuple[int, int]]) -> Grammar:
    ropes = symbol_matrices()
    for a, b in rules:
        ropes.append(_times(ropes[a], ropes[b]))
    return Grammar(rules, [{k: (cost, _text(rope)) for k, (cost, rope) in m.items()} for m in ropes])


def _matches(string: np.ndarray, a: int, b: int) -> np.ndarray:
    """Places of the pair, left to right without overlaps."""
    at = np.flatnonzero((string[:-1] == a) & (string[1:] == b))
    if a == b and len(at):
        run = np.flatnonzero(np.append(True, np.diff(at) != 1))
        inside = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
        at = at[inside % 2 == 0]
    return at


def compressed(string: np.ndarray, rules: list[tuple[int, int]]) -> np.ndarray:
    """A string of symbols (or several, parted by -1) with the rules put in, in their order."""
    for number, (a, b) in enumerate(rules, _SYMBOLS):
        at = _matches(string, a, b)
        if len(at):
            string = string.copy()
            string[at] = number
            string = np.delete(string, at + 1)
    return string


def _ranked(ways: dict) -> dict:
    """States with what is needed to compare them: ``state -> (cost, rank of its text, trail)``."""
    order = {key: n for n, key in enumerate(sorted({way[1:3] for way in ways.values()}))}
    return {j: (way[0], order[way[1:3]], way[3]) for j, way in ways.items()}


def _step(states: dict, matrix: dict) -> dict:
    """The states after a matrix; a trail is (trail before, state before, text)."""
    best: dict = {}
    for (i, j), (cost, text) in matrix.items():
        if i in states:
            before, rank, trail = states[i]
            way = (before + cost, rank, text)
            if j not in best or way < best[j][:3]:
                best[j] = (*way, (trail, i, text))
    return _ranked(best)


def _trail(trail) -> list[tuple[int, str]]:
    """(state before, text) of each step."""
    out = []
    while trail is not None:
        trail, i, text = trail
        out.append((i, text))
    return out[::-1]


def _finish(states: dict) -> tuple[int, str, tuple | None]:
    """Cost, last inserts and trail of the cheapest way to a whole conversation."""
    ends = [(states[i][0] + cost, states[i][1], text, i) for (i, j), (cost, text) in _inserts().items() if i in states and j in (_START, _ASSISTANT)]
    cost, _, text, i = min(ends)
    return cost, text, states[i][2]


def cheapest(string: bytes, rules: Grammar) -> tuple[int, str]:
    """Cost and edits of a whole conversation."""
    states = {_START: (0, 0, None)}
    for symbol in compressed(np.frombuffer(string, np.uint8).astype(np.int16), rules.rules).tolist():
        states = _step(states, rules.matrices[symbol])
    cost, last, trail = _finish(states)
    return cost, "".join(text for _, text in _trail(trail)) + last


def _piece_matrix(string: bytes, rules: Grammar) -> dict:
    """The matrix of a piece of a conversation."""
    symbols = compressed(np.frombuffer(string, np.uint8).astype(np.int16), rules.rules).tolist()
    out = {}
    for i in range(4):
        states = {i: (0, 0, None)}
        for symbol in symbols:
            states = _step(states, rules.matrices[symbol])
        for j, (cost, _, trail) in states.items():
            out[i, j] = (cost, "".join(text for _, text in _trail(trail)))
    return out


def _lines(roles: list, texts: list, copies: list, edits: str, state: int) -> tuple[list[str], int]:
    """The repaired turns, and the state after them."""
    out, at = [], 0

    def inserts(at: int, state: int) -> tuple[int, int]:
        while at < len(edits) and edits[at] == "I":
            state = _NEXT[state]
            out.append(f"{_ROLE[state]}:")
            at += 1
        return at, state

    for role, text, many in zip(roles, texts, copies, strict=True):
        for _ in range(many):
            at, state = inserts(at, state)
            if edits[at] == "K":
                state = 1 + _INITIALS.index(role[0])
                out.append(f"{role}:{text}")
            elif edits[at] == "R":
                state = _NEXT[state]
                out.append(f"{_ROLE[state]}:{text}")
            at += 1
    at, state = inserts(at, state)
    return out, state


class _Turns:
    """Turns of one conversation in order: what is wrong with them, taken alone."""

    def __init__(self, turns: list, roles: list, texts: list, copies: list, blank: list, late: list, seen=()):
        self.symbols = bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = ""
        known = set()
        self.keys: list = []
        numbers = []
        for turn, role, text, many, empty, cut in zip(turns, roles, texts, copies, blank, late, strict=True):
            if not many:
                continue
            initial = role[:1]
            kind = _INITIALS.find(initial) if initial else 3
            again = (role, text) in known
            if not (again or empty):
                known.add((role, text))
                if seen is not None:
                    key = _key(role, text)
                    self.keys.append(key)
                    again = key in seen
            if empty:
                self.blank += many
                self.symbols += bytes(many)
            else:
                self.duplicate += many - (not again)
                self.truncated += cut and not again
                self.symbols.append(_DELETED if again else 1 + (kind if kind >= 0 else 3) + 4 * cut)
                self.symbols += bytes(many - 1)
            if self.symbols and len(self.symbols) > many:
                self.illegal += (self.last + initial) not in ("su", "ua", "au")
            else:
                self.first = initial
            self.illegal += many - 1
            self.last = initial
            if turn is not None and (not numbers or numbers[-1] != turn):
                numbers.append(turn)
        self.low, self.high, self.distinct = (numbers[0], numbers[-1], len(numbers)) if numbers else (None, None, 0)


def _key(role: str, text: str) -> bytes:
    import hashlib

    return hashlib.md5(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()


def _columns(rows: pa.RecordBatch) -> list[list]:
    """turn, role, text, copies, blank and truncated as lists."""
    ends = pc.utf8_rtrim(rows.column("text"), characters=_SPACES)
    late = pc.invert(pc.or_(pc.or_(pc.ends_with(ends, "."), pc.ends_with(ends, "!")), pc.ends_with(ends, "?")))
    blank = pc.equal(pc.binary_length(ends), 0)
    return [*[rows.column(c).to_pylist() for c in ("turn", "role", "text", "copies")], blank.to_pylist(), late.to_pylist()]


def damaged(rows: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text, copies``: the turns of a table with faults made by the crc32 of ``id:turn`` modulo 20.

    0 drops a turn (no copies), 1 empties it, 2 removes its full stops, exclamation and question marks, 3 repeats it, 4 makes it the user's. A null
    is one space, in the key too; a null ``turn`` stays null.
    """
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(filled(id), F.lit(":"), filled(turn)).cast("binary")) % 20
    said = F.when(kind == 1, "").when(kind == 2, F.translate(filled(text), ".!?", "")).otherwise(filled(text))
    return rows.select(
        F.col(id).alias("conv"), F.col(turn).cast("bigint").alias("turn"), F.when(kind == 4, "user").otherwise(filled(role)).alias("role"),
        said.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )


def as_turns(rows: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text, copies`` of a table as it is; a null role or text is one space."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(F.col(id).alias("conv"), F.col(turn).cast("bigint").alias("turn"), filled(role).alias("role"), filled(text).alias("text"), F.lit(1).cast("bigint").alias("copies"))


_ROW = ["conv", "turn", "role", "text", "copies"]


def _ipc(rows: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(rows)
    return out.getvalue().to_pybytes()


def _read(block: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(block).read_all().combine_chunks().to_batches()[0]


def _edges(conv: pa.Array) -> list[int]:
    """First places of the runs of equal values, nulls and NaN equal to themselves, and the length."""
    n = len(conv)
    if not n:
        return [0]
    values = pc.dictionary_encode(conv, null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return [*np.flatnonzero(np.append(True, values[1:] != values[:-1])).tolist(), n]


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal turns of a batch become one with their copies added up."""
    for batch in batches:
        if batch.num_rows:
            table = pa.Table.from_batches([batch]).group_by(_ROW[:4]).aggregate([("copies", "sum")]).rename_columns(_ROW)
            yield from table.cast(batch.schema).to_batches()


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns as blocks: of whole conversations, or a piece of one that may go on elsewhere."""
    number = TaskContext.get().partitionId() << 32
    closed: list = []
    current: list = []
    # Shares of a block that these take up, and whether the current conversation may have begun elsewhere.
    full, grown, opened = 0.0, 0.0, True

    def out(held: list, piece: bool) -> pa.RecordBatch:
        nonlocal number
        rows = pa.concat_batches(held)
        strings, keys = [], []
        columns, edges = _columns(rows), _edges(rows.column("conv"))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            turns = _Turns(*[c[a:b] for c in columns], seen=() if piece else None)
            strings.append(bytes(turns.symbols))
            keys += turns.keys
        number += 1
        values = [rows.column("conv")[:1] if piece else pa.nulls(1, rows.schema.field("conv").type), pa.array([number - 1]), pa.array([piece])]
        values += [pa.array([strings], pa.list_(pa.binary())), pa.array([keys], pa.list_(pa.binary())), pa.array([_ipc(rows)], pa.binary())]
        return pa.RecordBatch.from_arrays(values, names=["conv", "number", "piece", "strings", "keys", "block"])

    def end() -> Iterator[pa.RecordBatch]:
        """The current conversation is over."""
        nonlocal opened, full, grown
        if opened and current:
            yield out(current, True)
        elif current:
            closed.extend(current)
            full += grown
            if full >= 1:
                yield out(closed, False)
                closed.clear()
                full = 0.0
        current.clear()
        grown, opened = 0.0, False

    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv")
        edges = _edges(conv)
        lengths = pc.add(pc.binary_length(batch.column("text")), pc.binary_length(batch.column("role")))
        ends = np.concatenate([[0], np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))])
        share = lambda a, b: (b - a) / BLOCK_ROWS + int(ends[b] - ends[a]) / BLOCK_BYTES  # noqa: E731, B023
        if current and len(_edges(pa.concat_arrays([current[-1].column("conv")[-1:], conv[:1]]))) == 3:
            yield from end()
        for a, b in ((0, edges[1]), (edges[-2], edges[-1]))[: len(edges) - 1]:
            if a:
                # The first conversation of the batch is over, and so are all others but the last one.
                yield from end()
                at = edges[1]
                for e in edges[2:-1]:
                    if full + share(at, e) >= 1:
                        closed.append(batch.slice(at, e - at))
                        yield out(closed, False)
                        closed.clear()
                        at, full = e, 0.0
                if at < a:
                    closed.append(batch.slice(at, a - at))
                    full += share(at, a)
            current.append(batch.slice(a, b - a))
            grown += share(a, b)
            if grown >= 1:
                yield out(current, True)
                current.clear()
                grown, opened = 0.0, True
    # The last conversation of a task may go on in the next one.
    if current:
        yield out(current, True)
    if closed:
        yield out(closed, False)


def _rules(strings: DataFrame, rounds: int, pairs: int, most: int) -> list[tuple[int, int]]:
    """Re-Pair over ``string, n``: in each round, the most frequent pairs that do not touch each other."""
    rules: list[tuple[int, int]] = []

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            own = batch.column("string").to_pylist()
            if not own:
                continue
            parted = compressed(np.concatenate([np.append(np.frombuffer(s, np.uint8).astype(np.int16), np.int16(-1)) for s in own]), rules)
            weight = batch.column("n").to_numpy()[np.cumsum(parted == -1) - (parted == -1)]
            whole = (parted[:-1] >= 0) & (parted[1:] >= 0)
            key = (parted[:-1].astype(np.int64) << 16 | parted[1:])[whole]
            same = parted[:-1][whole] == parted[1:][whole]
            many = np.where(same, 0, weight[:-1][whole])
            kinds, which = np.unique(key, return_inverse=True)
            for k, n in zip(kinds.tolist(), np.bincount(which, many, len(kinds)).tolist(), strict=True):
                a, b = k >> 16, k & 0xFFFF
                sums[a, b] = sums.get((a, b), 0) + (int(weight[_matches(parted, a, b)].sum()) if a == b else int(n))
        ends = list(sums)
        yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in ends], pa.int64()), pa.array([e[1] for e in ends], pa.int64()), pa.array(list(sums.values()), pa.int64())], names=["a", "b", "n"])

    for _ in range(rounds):
        totals = strings.mapInArrow(counted, "a bigint, b bigint, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n")).where("n > 1")
        # There are no more pairs than the square of the number of symbols.
        found = totals.orderBy(F.desc("n"), "a", "b").limit(16 * pairs).collect()
        left, right, new = set(), set(), []
        for row in found:
            a, b = row["a"], row["b"]
            if len(rules) + len(new) < most and len(new) < pairs and a not in right and b not in left and (a != b or (a not in left and b not in right)):
                left.add(a)
                right.add(b)
                new.append((a, b))
        if not new:
            break
        rules = rules + new
    return rules


_RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _gaps(low, high, distinct: int) -> int:
    return high - low + 1 - distinct if distinct else 0


def repaired(turns: DataFrame, texts: bool = False, rounds: int = ROUNDS, pairs: int = PAIRS, most_rules: int = RULES) -> DataFrame:
    """``conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` for every ``conv`` of ``turns`` (see
    ``as_turns`` and ``damaged``); with ``texts`` also ``repaired``, the ``role:text`` of the repaired turns by line.

    Turns are taken in the order of ``turn`` (nulls first); turns of one number by role and text, so copies are neighbours. Null
    conversations are one conversation. A conversation all of whose turns have no copies gives zeros and empty texts. ``audit`` has a letter for
    each turn (Keep, Rerole, Delete) and each Insert; blank and repeated turns are always deleted.
    """
    conv_type = turns.schema["conv"]
    types = lambda ddl: StructType([conv_type, *StructType.fromDDL(ddl).fields])
    folded = turns.select(*_ROW).mapInArrow(_folded, turns.select(*_ROW).schema)
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role"]
    ranged = folded.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    spark = turns.sparkSession
    stored = written(ranged.mapInArrow(_blocked, types("number bigint, piece boolean, strings array<binary>, keys array<binary>, block binary")), "turns")

    # Turns of a piece that stand in an earlier piece of the same conversation.
    pieces = stored.where("piece")
    said = pieces.select("conv", "number", F.explode("keys").alias("key")).select(F.struct("conv", "key").alias("said"), "number")
    first = said.groupBy("said").agg(F.min("number").alias("first"))
    again = said.join(first, "said").where("first < number").groupBy("number").agg(F.collect_list("said.key").alias("seen"))

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for block, seen in zip(batch.column("block"), batch.column("seen"), strict=True):
                t = _Turns(*_columns(_read(block.as_py())), seen=set(seen.as_py() or []))
                out.append((bytes(t.symbols), t.blank, t.duplicate, t.truncated, t.illegal, t.first, t.last, t.low, t.high, t.distinct))
            kinds = [pa.binary(), *[pa.int64()] * 4, pa.string(), pa.string(), *[pa.int64()] * 3]
            values = [pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("number"), *values, batch.column("block")], schema=None, names=_PIECE)

    piece_type = "number bigint, string binary, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, low bigint, high bigint, distinct bigint, block binary"
    parts = written(pieces.select("conv", "number", "block").join(again, "number", "left").mapInArrow(known, types(piece_type)), "pieces")

    whole = stored.where("NOT piece").select(F.explode("strings").alias("string"))
    strings = whole.union(parts.select("string")).where("length(string) > 1").groupBy("string").agg(F.count(F.lit(1)).alias("n"))
    rules = grammar(_rules(written(strings, "strings"), rounds, pairs, most_rules))

    result = _RESULT + ", repaired string" * texts
    names = ["conv", *StructType.fromDDL(result).names]

    def batch_of(convs: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        kinds = [*[pa.int64()] * 6, pa.string(), pa.string(), *[pa.string()] * texts]
        return pa.RecordBatch.from_arrays([convs, *[pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]], names=names)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        done: dict = {}
        for batch in batches:
            for block in batch.column("block"):
                rows = _read(block.as_py())
                columns, edges, out = _columns(rows), _edges(rows.column("conv")), []
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    own = [c[a:b] for c in columns]
                    t = _Turns(*own, seen=None)
                    string = bytes(t.symbols)
                    if string not in done:
                        if len(done) >= _KNOWN:
                            done.clear()
                        done[string] = cheapest(string, rules)
                    cost, audit = done[string]
                    text = "\n".join(_lines(own[1], own[2], own[3], audit, _START)[0])
                    digest = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((_gaps(t.low, t.high, t.distinct), t.blank, t.duplicate, t.truncated, t.illegal, cost, audit, digest, *[text] * texts))
                yield batch_of(rows.column("conv").take(pa.array(edges[:-1])), out)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_piece_matrix(s.as_py(), rules) for s in batch.column("string")]
            cells = pa.array([[{"i": i, "j": j, "cost": c, "text": x} for (i, j), (c, x) in m.items()] for m in found], pa.list_(pa.struct([("i", pa.int32()), ("j", pa.int32()), ("cost", pa.int64()), ("text", pa.string())])))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in _SLIM], cells], names=[*_SLIM, "cells"])

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces in order: the edits of each, and on the last one the conversation's result."""
        held: list = []
        states: dict = {}
        total: list = []

        def begin():
            nonlocal states, total
            states, total = {_START: (0, 0, None)}, [0, 0, 0, 0, "", "", None, None, 0]
            held.clear()

        def end() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            cost, last, trail = _finish(states)
            steps = _trail(trail)
            steps[-1] = (steps[-1][0], steps[-1][1] + last)
            for k, ((number, conv), (state, edits)) in enumerate(zip(held, steps, strict=True)):
                final = k == len(held) - 1
                values = [_gaps(*total[6:]), *total[:4], cost] if final else [None] * 6
                audit = "".join(x for _, x in steps) if final else None
                yield pa.RecordBatch.from_arrays(
                    [conv, pa.array([number], pa.int64()), pa.array([state], pa.int64()), pa.array([edits], pa.string()), *[pa.array([v], pa.int64()) for v in values], pa.array([audit], pa.string())], names=_STEP
                )

        before = None
        for batch in batches:
            conv = batch.column("conv")
            rows = batch.to_pydict()
            for k in range(batch.num_rows):
                own = conv[k : k + 1]
                if before is None or len(_edges(pa.concat_arrays([before, own]))) != 2:
                    yield from end()
                    begin()
                before = own
                # A piece without turns left leaves everything as it is.
                cells = {(c["i"], c["j"]): (c["cost"], c["text"]) for c in rows["cells"][k]}
                states = _step(states, cells)
                held.append((rows["number"][k], own))
                for n, name in enumerate(("blank", "duplicate", "truncated", "illegal")):
                    total[n] += rows[name][k]
                if rows["string"][k]:
                    if total[5] is not None and total[4] == "any":
                        total[3] += (total[5] + rows["first"][k]) not in ("su", "ua", "au")
                    total[4], total[5] = "any", rows["last"][k]
                if rows["distinct"][k]:
                    total[8] += rows["distinct"][k] - (total[7] == rows["low"][k])
                    total[6], total[7] = rows["low"][k] if total[6] is None else total[6], rows["high"][k]
        yield from end()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The repaired text of each conversation, piece by piece."""
        import hashlib

        digest, some, lines_ = hashlib.sha256(), False, []
        for batch in batches:
            for k in range(batch.num_rows):
                turns_ = _read(batch.column("block")[k].as_py())
                own = [turns_.column(c).to_pylist() for c in ("role", "text", "copies")]
                lines, _ = _lines(*own, batch.column("edits")[k].as_py(), batch.column("state")[k].as_py())
                for line in lines:
                    digest.update((("\n" if some else "") + line).encode("utf-8", "surrogatepass"))
                    some = True
                if texts:
                    lines_ += lines
                if (audit := batch.column("audit")[k].as_py()) is not None:
                    values = [batch.column(c)[k].as_py() for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
                    yield batch_of(batch.column("conv")[k : k + 1], [(*values, audit, digest.hexdigest(), *["\n".join(lines_)] * texts)])
                    digest, some, lines_ = hashlib.sha256(), False, []

    cell_type = "number bigint, string binary, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, low bigint, high bigint, distinct bigint, cells array<struct<i:int,j:int,cost:bigint,text:string>>"
    step_type = "number bigint, state bigint, edits string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
    in_order = lambda df: df.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "number")
    steps = written(in_order(parts.select(*_SLIM).mapInArrow(matrices, types(cell_type))).mapInArrow(chained, types(step_type)), "steps")
    open_ = in_order(parts.select("number", "block").join(steps, "number")).select(*_STEP, "block").mapInArrow(joined, types(result))
    closed = stored.where("NOT piece").select("block").mapInArrow(close, types(result))
    return closed.union(open_)


_PIECE = ["conv", "number", "string", "blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "distinct", "block"]
_SLIM = _PIECE[:-1]
_STEP = ["conv", "number", "state", "edits", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
