"""Segmentation lattices over a fixed SentencePiece vocabulary, for many texts at once.

A text is read as SentencePiece reads it (a space is put before it and spaces belong
to the piece on their right) and cut into parts before every space that follows another
character: no piece crosses such a place, as pieces have spaces in front only (or are runs of them). A
lattice edge is a piece standing at some place of a part; characters that are no
pieces are spelled with byte pieces. Equal parts of a batch share one lattice. Parts of any
length are whole; sums over those of more than ``PART`` bytes are kept as logarithms.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from .words import hashed, stream

PART = 48
_EMPTY = -1
# A byte that UTF-8 does not use.
_APART = 0xFF


class Vocabulary(NamedTuple):
    """A trie of the pieces as a hash table of its edges, and each piece's bytes."""

    keys: np.ndarray  # node * 256 + byte, or _EMPTY
    nodes: np.ndarray
    piece: np.ndarray  # by node: piece id or -1
    first_byte: int  # id of the byte piece 0
    rank: np.ndarray  # by id: place among the pieces, best first
    bytes: np.ndarray  # all pieces end to end
    starts: np.ndarray
    longest: int  # bytes of the longest piece

    @property
    def size(self) -> int:
        return len(self.rank)


def load(path: str) -> Vocabulary:
    """The pieces of a SentencePiece model; it must have byte pieces, and no piece with a space after another character."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.vocab_size())
    if not any(model.is_byte(i) for i in ids):
        raise ValueError("the vocabulary needs byte pieces")
    first_byte = next(i for i in ids if model.is_byte(i))
    texts, edges, piece, scores, longest = [], {}, [-1], np.zeros(len(ids)), 1
    for i in ids:
        text = b""
        if model.is_byte(i):
            text = bytes([i - first_byte])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            text = model.id_to_piece(i).replace("▁", " ").encode()
            if b" " in text.lstrip(b" "):
                raise ValueError(f"piece {i} has a space after another character")
            node = 0
            for byte in text:
                key = node * 256 + byte
                if key not in edges:
                    edges[key] = len(piece)
                    piece.append(-1)
                node = edges[key]
            if text and piece[node] < 0:
                piece[node] = i
            longest = max(longest, len(text))
        texts.append(text)
        scores[i] = model.get_score(i)
    rank = np.empty(len(ids), np.int64)
    rank[np.argsort(-scores, kind="stable")] = np.arange(len(ids))
    bits = (8 * len(edges)).bit_length()
    keys, nodes = np.full(1 << bits, _EMPTY, np.int64), np.zeros(1 << bits, np.int32)
    todo, targets = np.array(list(edges), np.int64), np.array(list(edges.values()), np.int32)
    slot = _slot(todo, bits)
    while len(todo):
        free = np.flatnonzero(keys[slot] == _EMPTY)
        _, one = np.unique(slot[free], return_index=True)
        placed = free[one]
        keys[slot[placed]], nodes[slot[placed]] = todo[placed], targets[placed]
        left = np.ones(len(todo), bool)
        left[placed] = False
        todo, targets, slot = todo[left], targets[left], (slot[left] + 1) & ((1 << bits) - 1)
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    return Vocabulary(keys, nodes, np.array(piece, np.int32), first_byte, rank, np.frombuffer(b"".join(texts), np.uint8), starts, longest)


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * stream(5, 1)[0]) >> np.uint64(64 - bits)).astype(np.int64)


def _child(vocabulary: Vocabulary, keys: np.ndarray) -> np.ndarray:
    """Node reached by each edge, or -1."""
    last = len(vocabulary.keys) - 1
    slot = _slot(keys, last.bit_length())
    seen = vocabulary.keys[slot]
    out = np.where(seen == keys, vocabulary.nodes[slot], -1)
    open_ = np.flatnonzero((seen != keys) & (seen != _EMPTY))
    while len(open_):
        slot[open_] = (slot[open_] + 1) & last
        seen = vocabulary.keys[slot[open_]]
        hit = seen == keys[open_]
        out[open_[hit]] = vocabulary.nodes[slot[open_[hit]]]
        open_ = open_[~hit & (seen != _EMPTY)]
    return out


class Parts(NamedTuple):
    """Parts of texts: text i has parts ``first[i]:first[i + 1]``; ``which`` numbers the distinct ones, which lie in ``data``."""

    first: np.ndarray
    which: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    hash: np.ndarray  # of the distinct ones, ascending


def parts(data: np.ndarray, starts: np.ndarray) -> Parts:
    """Cut texts into parts; an empty text has none."""
    full = np.flatnonzero(np.diff(starts))
    places = np.insert(data, starts[:-1][full], 0x20)
    begins = starts[:-1] + np.cumsum(np.diff(starts) > 0) - (np.diff(starts) > 0)
    cut = places == 0x20
    cut[1:] &= ~cut[:-1]
    cut[begins[np.diff(starts) > 0]] = True
    at = np.flatnonzero(cut)
    end = np.append(at, len(places))[1:]
    value, one, which = np.unique(hashed(places, at, end), return_index=True, return_inverse=True)
    size = (end - at)[one]
    own = np.concatenate([[0], np.cumsum(size)])
    flat = places[np.arange(own[-1]) + np.repeat(at[one] - own[:-1], size)]
    first = np.append(np.searchsorted(at, begins), len(at))
    return Parts(first, which, flat, own, value)


class Lattice(NamedTuple):
    """Edges between nodes, in order of start; a part of n bytes has n + 1 nodes.

    ``place`` is each node's byte place in its part; ``first[i]`` and ``first[i + 1] - 1``
    are the nodes at the ends of part i. ``many`` counts the edges of the whole lattice that start at each node.
    """

    start: np.ndarray
    end: np.ndarray
    id: np.ndarray
    place: np.ndarray
    first: np.ndarray
    many: np.ndarray


def lattice(vocabulary: Vocabulary, data: np.ndarray, starts: np.ndarray) -> Lattice:
    size = np.diff(starts)
    nodes = size + 1
    first = starts + np.arange(len(starts))
    # Bytes by node: after each part comes one that is in no piece, so no piece goes on in the next part.
    own = np.arange(len(data)) + np.repeat(np.arange(len(size)), size)
    spread = np.full(first[-1], _APART, np.uint8)
    spread[own] = data
    begins = (data & 0xC0) != 0x80
    begins[starts[:-1][size > 0]] = True
    char = np.flatnonzero(begins)
    width = np.diff(np.append(char, len(data)))
    # By node, bytes of the character that begins there; longer ones are no UTF-8.
    alone = np.zeros(len(spread), np.uint8)
    alone[own[char]] = np.where(width <= 4, width, 0)
    known = np.zeros(len(spread), bool)
    root = _child(vocabulary, np.arange(256))
    node = root[spread]
    at = np.flatnonzero(node >= 0)
    node, edges = node[at], []
    many = np.zeros(len(spread), np.int64)
    for length in range(1, vocabulary.longest + 1):
        if length > 1:
            node = _child(vocabulary, node.astype(np.int64) * 256 + spread[at + (length - 1)])
            on = np.flatnonzero(node >= 0)
            at, node = at[on], node[on]
        if not len(at):
            break
        piece = vocabulary.piece[node]
        whole = np.flatnonzero(piece >= 0)
        begin = at[whole]
        edges.append((begin, length, piece[whole]))
        many[begin] += 1
        if length <= 4:
            known[begin[alone[begin] == length]] = True
    spelled = np.flatnonzero(np.repeat(~known[own[char]], width))
    edges.append((own[spelled], 1, (vocabulary.first_byte + data[spelled]).astype(np.int32)))
    many[own[spelled]] += 1
    # By start, and by length where that is the same: no start is twice in one of the lists.
    free = np.cumsum(many) - many
    start = np.repeat(np.arange(len(spread)), many)
    end, ids = np.empty(len(start), np.int64), np.empty(len(start), np.int32)
    for at, length, piece in edges:
        slot = free[at]
        end[slot], ids[slot] = at + length, piece
        free[at] = slot + 1
    place = np.arange(first[-1]) - np.repeat(first[:-1], nodes)
    return Lattice(start, end, ids, place, first, many)


def _sums(edges: Lattice, weight: np.ndarray, source: np.ndarray, target: np.ndarray, ends: np.ndarray, step: int, logs: bool = False) -> np.ndarray:
    """Sums over paths from ``ends``; edges are taken by their target's place in the part, ``step`` giving the direction.

    With ``logs``, ``weight`` and the sums are logarithms.
    """
    place = (edges.place.astype(np.int8) if edges.place.max(initial=0) <= 127 else edges.place)[target]
    if step > 0:
        order = np.argsort(target, kind="stable")
        order = order[np.argsort(place[order], kind="stable")]
    else:
        order = np.argsort(place, kind="stable")
    source, target, weight = source[order], target[order], weight[:, order]
    sums = np.full((len(weight), len(edges.place)), -np.inf if logs else 0.0)
    sums[:, ends] = 0.0 if logs else 1.0
    if not len(target):
        return sums
    group = np.flatnonzero(np.append(True, target[1:] != target[:-1]))
    # Targets of one place follow each other.
    target = target[group]
    at = edges.place[target]
    first = np.append(np.flatnonzero(np.append(True, at[1:] != at[:-1])), len(group))
    cuts = np.append(group, len(source))[first]
    for g, h, a, b in list(zip(first[:-1], first[1:], cuts[:-1], cuts[1:], strict=True))[::step]:
        value = weight[:, a:b] + sums[:, source[a:b]] if logs else weight[:, a:b] * sums[:, source[a:b]]
        sums[:, target[g:h]] = (np.logaddexp if logs else np.add).reduceat(value, group[g:h] - a, axis=1)
    return sums


def forward(edges: Lattice, weight: np.ndarray) -> np.ndarray:
    """For each model and node, the sum over all segmentations up to it of the product of edge weights (models by edges).

    For parts of up to ``PART`` bytes; sums of much longer ones are too small for a float.
    """
    return _sums(edges, weight, edges.start, edges.end, edges.first[:-1], 1)


def backward(edges: Lattice, weight: np.ndarray) -> np.ndarray:
    """The same from each node to the end of its part."""
    return _sums(edges, weight, edges.end, edges.start, edges.first[1:] - 1, -1)


def _long(edges: Lattice) -> tuple[np.ndarray, np.ndarray, Lattice, Lattice]:
    """Parts of more than ``PART`` bytes, their edges, and the lattices of the edges of the others and of these."""
    size = np.diff(edges.first)
    long = size > PART + 1
    own = np.repeat(long, size)[edges.start] if long.any() else np.zeros(len(edges.start), bool)
    if not own.any():
        return long, own, edges, edges
    of = lambda keep: edges._replace(start=edges.start[keep], end=edges.end[keep], id=edges.id[keep])
    return long, own, of(~own), of(own)


def _log_sums(part: Lattice, weight: np.ndarray, step: int) -> np.ndarray:
    source, target, ends = (part.start, part.end, part.first[:-1]) if step > 0 else (part.end, part.start, part.first[1:] - 1)
    return _sums(part, np.log(weight), source, target, ends, step, logs=True)


def log_totals(edges: Lattice, weight: np.ndarray) -> np.ndarray:
    """For each model and part, the logarithm of the sum over all its segmentations."""
    long, own, short, rest = _long(edges)
    last = edges.first[1:] - 1
    out = np.log(np.maximum(forward(short, weight[:, ~own] if own.any() else weight)[:, last], 1e-300))
    if own.any():
        out[:, long] = _log_sums(rest, weight[:, own], 1)[:, last[long]]
    return out


def shares(edges: Lattice, weight: np.ndarray) -> np.ndarray:
    """The share of each edge among all segmentations from its start on (one model)."""
    long, own, short, rest = _long(edges)
    after = backward(short, (weight[~own] if own.any() else weight)[None])[0]
    share = np.empty(len(weight))
    share[~own] = weight[~own] * after[short.end] / after[short.start]
    if own.any():
        after = _log_sums(rest, weight[own][None], -1)[0]
        share[own] = np.exp(np.log(weight[own]) + after[rest.end] - after[rest.start])
    return share


def expected(edges: Lattice, weight: np.ndarray) -> np.ndarray:
    """The chance of each edge to be in a segmentation of its part (one model)."""
    long, own, short, rest = _long(edges)
    used = (weight[~own] if own.any() else weight)[None]
    before, after = forward(short, used)[0], backward(short, used)[0]
    nodes = np.diff(edges.first)
    total = np.repeat(after[edges.first[:-1]], nodes)
    share = np.empty(len(weight))
    share[~own] = before[short.start] * weight[~own] * after[short.end] / total[short.start]
    if own.any():
        before, after = _log_sums(rest, weight[own][None], 1)[0], _log_sums(rest, weight[own][None], -1)[0]
        total = np.repeat(after[edges.first[:-1]], nodes)
        share[own] = np.exp(before[rest.start] + np.log(weight[own]) + after[rest.end] - total[rest.start])
    return share


def spelled(vocabulary: Vocabulary, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The bytes of a sequence of pieces, and where in them each piece begins and the last one ends."""
    kind = pa.large_binary()
    known = pa.Array.from_buffers(kind, vocabulary.size, [None, pa.py_buffer(vocabulary.starts), pa.py_buffer(vocabulary.bytes)])
    _, ends, data = known.take(pa.array(ids)).buffers()
    return memoryview(data or b""), np.frombuffer(ends, np.int64)[: len(ids) + 1]


def decoded(vocabulary: Vocabulary, ids: np.ndarray) -> bytes:
    """The text of a sequence of piece ids, without the space that encoding puts in front."""
    data, ends = spelled(vocabulary, ids)
    return data[1 : ends[-1]].tobytes()
