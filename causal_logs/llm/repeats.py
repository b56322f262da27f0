"""Byte stretches that repeat across documents, by merging Burrows-Wheeler transforms of shards.

Only windows of ``width`` bytes that can occur in two documents are sorted. Each window
has an anchor, the smallest hash of the ``ANCHOR``-byte strings in it, so equal windows
have equal anchors. Runs of windows with one anchor are its contexts. Anchors met in one
document only are done with. The contexts of the others are sent to buckets by anchor, so
equal windows meet in one bucket; where all contexts of an anchor are one string, the batch that has
it first sends the string, and others its hash only.

In a bucket, the contexts of some batches of documents are a shard: a text with its
suffix order and its transform (the two bytes before each suffix). The shards'
transforms are merged by refining their interleave: starting from the shards one after
the other, each round deals the current order stably by the preceding symbols, so
after k rounds it is the order by the first 2k bytes. No suffix of one shard is compared
with one of another. A suffix parted from both its neighbours has its place: after a few rounds only the others
are dealt, block by block, in the order of the suffixes that follow the bytes compared so far, which doubles these. The
round in which two neighbours part bounds their common prefix; neighbours never parted within
``width`` bytes form the repeated intervals, each with its smallest document.

Contexts of an anchor with very many bytes of different ones are sent by window instead.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import written
from . import exchange
from .words import BYTES, mixed, stream

WIDTH = 50
ANCHOR = 16
# An anchor with more bytes of contexts than this is spread over buckets by window, if they differ.
SPREAD_BYTES = 1 << 24
_STEP = 128
# Bytes of a shard's strings, and parts of a bucket that are merged one after the other.
SHARD_BYTES = 1 << 16
PARTS = 16
# At most so many windows of a run are one context: then its first and last window cover it.
_RUN = 48
_B = stream(3, 1)[0]


def _grams(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes from each place on (of those that have so many)."""

    def power(n: int) -> np.uint64:
        return np.uint64(pow(int(_B), n, 1 << 64))

    have, size, out, done, rest = BYTES[data], 1, None, 0, width
    while True:
        if rest & 1:
            if out is None:
                out, done = have, size
            else:
                n = max(0, min(len(out), len(have) - done))
                out = out[:n] * power(size) + have[done : done + n]
                done += size
        rest >>= 1
        if not rest:
            return out[: max(0, len(data) - width + 1)]
        n = max(0, len(have) - size)
        have = have[:n] * power(size) + have[size : size + n]
        size *= 2


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[: len(values) - size], values[size:])
        size *= 2
    more = width - size
    return np.minimum(values[: len(values) - more], values[more:]) if more else values


class _Contexts:
    """Contexts of the texts of a batch: windows ``start .. start + n - 1`` (byte places), their anchor and a hash of their bytes."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, width: int):
        anchor = min(ANCHOR, width)
        whole = _grams(data, width)
        least = _least(mixed(_grams(data, anchor)), width - anchor + 1) if len(whole) else whole
        # Windows that stay in their text.
        inside = np.ones(len(least) + 1, bool)
        for k in np.flatnonzero(np.diff(starts)):
            inside[max(starts[k], starts[k + 1] - width + 1) : starts[k + 1]] = False
        inside = inside[: len(least)]
        edge = np.ones(len(least) + 1, bool)
        edge[1:-1] = (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])
        edge[starts[(starts < len(least))]] = True
        at = np.flatnonzero(edge) if len(least) else np.zeros(0, np.int64)
        start, n = at[:-1], np.diff(at)
        keep = inside[start]
        start, n = start[keep], n[keep]
        pieces = -(-n // _RUN)
        if (pieces > 1).any():
            step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            left = np.repeat(n, pieces) - step * _RUN
            start, n = np.repeat(start, pieces) + step * _RUN, np.minimum(left, _RUN)
        self.start, self.n = start, n
        # Mixed again: smallest hashes are not evenly spread.
        self.anchor = mixed(least[start])
        self.hash = mixed(whole[start] * np.uint64(5) + mixed(whole[start + n - 1]) + n.astype(np.uint64))
        self.text = np.searchsorted(starts, start, "right") - 1
        self.whole = whole


def _open(parted: np.ndarray) -> np.ndarray:
    """Places not parted from a neighbour; ``parted`` tells of each place if a block begins there."""
    return np.flatnonzero(~(parted & np.append(parted[1:], True)))


def _refined(at: np.ndarray, parted: np.ndarray, block: np.ndarray, place: np.ndarray, after: np.ndarray, wanted: np.ndarray | None = None) -> np.ndarray:
    """Order the blocks of several suffixes by what follows each of them; the places where blocks were parted anew.

    ``at`` lists suffixes in order, ``place`` is its inverse, ``block`` the first place of each place's block, ``after`` the
    suffix whose order decides. All are changed in place. With ``wanted``, only those suffixes are ordered, in the places that
    they have in their blocks; others between them say nothing from then on.
    """
    open_ = _open(parted)
    if wanted is not None:
        open_ = open_[wanted[at[open_]]]
    if not len(open_):
        return open_
    own, inside = at[open_], block[open_]
    follows = place[after[own]]
    key = inside.astype(np.uint64) << np.uint64(32) | follows.astype(np.uint64)
    order = np.argsort(key)
    own, follows = own[order], block[follows[order]]
    fresh = np.append(True, (inside[1:] != inside[:-1]) | (follows[1:] != follows[:-1]))
    at[open_], place[own] = own, open_
    begins = open_[fresh]
    block[open_] = np.repeat(begins.astype(np.int32), np.diff(np.append(np.flatnonzero(fresh), len(open_))))
    new = begins[~parted[begins]]
    parted[begins] = True
    return new


def _blocks(parted: np.ndarray) -> np.ndarray:
    begins = np.flatnonzero(parted)
    return np.repeat(begins.astype(np.int32), np.diff(np.append(begins, len(parted))))


def _suffix_order(data: np.ndarray, width: int) -> np.ndarray:
    """Places of a text in the order of their next ``width`` bytes or more, the text being a circle."""
    n, have = len(data), 8
    key = np.zeros(n, np.uint64)
    for k in range(have):
        key = key << np.uint64(8) | np.roll(data, -k)
    order = np.argsort(key).astype(np.int32)
    sorted_ = key[order]
    parted = np.append(True, sorted_[1:] != sorted_[:-1])
    block, place = _blocks(parted), np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    while have < width and not parted.all():
        _refined(order, parted, block, place, np.roll(np.arange(n, dtype=np.int32), -have))
        have *= 2
    return order


class Shard:
    """A text as a circle, its suffixes in order, and the two bytes before each of them."""

    def __init__(self, data: np.ndarray, width: int):
        self.data = data
        self.order = _suffix_order(data, width)
        before = np.roll(data, 1)
        self.before = (np.roll(data, 2).astype(np.uint16) << 8 | before)[self.order]

    def after(self, many: int) -> np.ndarray:
        """Of each suffix in order, the number of the one that begins so many bytes later."""
        number = np.empty(len(self.order), np.int32)
        number[self.order] = np.arange(len(self.order), dtype=np.int32)
        return np.roll(number, -many)[self.order]


# Rounds in which all suffixes are dealt.
_WHOLE_ROUNDS = 4


def merged(shards: list[Shard], width: int, windows: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The merged suffix order of all shards: shard and place of each suffix, and for each how many bytes it has in common
    with the one before: a length up to which they were compared and found equal (``width`` or more: that long or longer).

    ``windows`` marks the places of each shard that matter; others are ordered as far as those need it.
    """
    sizes = [len(s.order) for s in shards]
    total = sum(sizes)
    symbols = np.concatenate([s.before for s in shards])
    kind = np.uint16 if len(shards) <= 1 << 16 else np.uint32
    whose = np.repeat(np.arange(len(shards), dtype=kind), sizes)
    source = whose
    block, common = np.zeros(total, np.int32), np.full(total, -1, np.int32)
    common[:1] = 0
    rounds = -(-width // 2)
    slots = np.arange(total)
    for k in range(min(rounds, _WHOLE_ROUNDS)):
        symbol = np.empty(total, np.uint16)
        symbol[slots] = symbols
        order = np.argsort(symbol, kind="stable")
        source, symbol, block = source[order], symbol[order], block[order]
        parted = np.append(True, (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1]))
        common[parted & (common < 0)] = 2 * k
        block = np.cumsum(parted, dtype=np.int32)
        slots = np.argsort(source, kind="stable")
    slots, at = slots.astype(np.int32), np.empty(total, np.int32)
    at[slots] = np.arange(total, dtype=np.int32)
    have, whole = 2 * min(rounds, _WHOLE_ROUNDS), 2 * rounds
    if have < whole:
        block, bases = _blocks(parted), np.cumsum([0, *sizes[:-1]])
        steps = []
        while have < whole:
            steps.append((have, min(have, whole - have)))
            have += steps[-1][1]
        # Whose order a round needs: the windows in the last one; before, also what follows those.
        needs, own = [], windows
        for _, more in reversed(steps):
            needs.append(own)
            own = own and [w | np.roll(w, more) for w in own]
        for (have, more), own in zip(steps, reversed(needs), strict=True):
            after = np.concatenate([s.after(more) + np.int32(base) for s, base in zip(shards, bases, strict=True)])
            wanted = own and np.concatenate([w[s.order] for w, s in zip(own, shards, strict=True)])
            common[_refined(at, parted, block, slots, after, wanted)] = have
    common[common < 0] = 2 * rounds
    return whose[at], np.concatenate([s.order for s in shards])[at].astype(np.int64), common


def first_documents(contexts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], width: int) -> list[np.ndarray]:
    """For the contexts of each shard (bytes end to end, their ends, their smallest documents), the smallest document of every byte place's window among all shards.

    Places whose window leaves its context get ``NO_ID``.
    """
    own, inside = [], []
    for data, ends, docs in contexts:
        sizes = np.diff(np.concatenate([[0], ends]))
        own.append(np.repeat(docs, sizes))
        inside.append(np.repeat(ends, sizes) - np.arange(len(data)) >= width)
    shards = [Shard(data, width) for data, _, _ in contexts]
    source, place, common = merged(shards, width, inside)
    base = np.cumsum([0, *[len(x) for x in own]])
    at = base[source] + place
    own, inside = np.concatenate(own), np.concatenate(inside)
    # A smallest document of each interval, counting whole windows only.
    fresh = np.flatnonzero(common < width)
    doc = np.where(inside[at], own[at], exchange.NO_ID)
    least = np.repeat(np.minimum.reduceat(doc, fresh), np.diff(np.append(fresh, len(doc))))
    out = np.empty(len(doc), np.int64)
    out[at] = np.where(inside[at], least, exchange.NO_ID)
    return np.split(out, base[1:-1])


# What a bucket says of an anchor: in one document only; to be merged, its contexts being all alike; to be merged; to be merged by window.
_ALONE, _ALIKE, _MERGE, _SPREAD = range(4)


def _counted(group: pa.Table, spread_bytes: int) -> pa.Table:
    """Answer the anchors of a bucket: what to do with each, and the first document where contexts are all alike."""
    held = [exchange.unpacked(b.as_py()) for b in group.column("block")]
    low, doc, several, small, large, size = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(low, kind="stable")
    fresh = np.append(True, low[order][1:] != low[order][:-1])
    at = np.flatnonzero(fresh)
    first, last = np.minimum.reduceat(doc[order], at), np.maximum.reduceat(doc[order], at)
    repeated = (first < last) | np.maximum.reduceat(several[order], at)
    alike = np.minimum.reduceat(small[order], at) == np.maximum.reduceat(large[order], at)
    total = np.add.reduceat(size[order].astype(np.int64), at) * _STEP
    say = np.where(~repeated, _ALONE, np.where(alike, _ALIKE, np.where(total > spread_bytes, _SPREAD, _MERGE))).astype(np.uint8)
    which = np.empty(len(low), np.int64)
    which[order] = np.cumsum(fresh) - 1
    answers, start = [], 0
    for part in held:
        own = which[start : start + len(part[0])]
        answers.append(exchange.packed(say[own], first[own][say[own] == _ALIKE]))
        start += len(part[0])
    rows_ = list(zip(group.column("bucket").to_pylist(), group.column("batch").to_pylist(), answers, strict=True))
    return pa.Table.from_batches([exchange.blocks(rows_)])


class _Batch:
    """The steps of one batch: the same contexts are found again in each of them."""

    def __init__(self, block: bytes, width: int, buckets: int):
        self.ids, ends, self.data = exchange.unpacked(block)
        self.starts = np.concatenate([[0], ends]).astype(np.int64)
        self.width, self.buckets = width, buckets
        self.found = found = _Contexts(self.data, self.starts, width)
        self.order = np.argsort(found.anchor, kind="stable")
        self.anchors, self.at = np.unique(found.anchor[self.order], return_index=True)
        self.doc = self.ids[found.text] if len(found.text) else np.zeros(0, np.int64)
        self.cuts = exchange.cuts(exchange.bucket_of(self.anchors, buckets), buckets)

    def anchors_sent(self) -> list[tuple[int, bytes]]:
        if not len(self.anchors):
            return []
        doc, value = self.doc[self.order], self.found.hash[self.order]
        first, last = np.minimum.reduceat(doc, self.at), np.maximum.reduceat(doc, self.at)
        small, large = np.minimum.reduceat(value, self.at), np.maximum.reduceat(value, self.at)
        # Where the contexts are alike, the second hash compresses to nothing.
        low, several, other = self.anchors.astype(np.uint32), first < last, small != large
        # Bytes of its contexts here, in steps that most anchors do not reach.
        size = np.minimum(np.add.reduceat(self.found.n[self.order] + self.width - 1, self.at) // _STEP, 255).astype(np.uint8)
        out = []
        for b, i, j in self.cuts:
            out.append((b, exchange.packed(low[i:j], first[i:j], several[i:j], small[i:j], np.where(other[i:j], large[i:j], small[i:j]), size[i:j])))
        return out

    def told(self, answers: list[dict]) -> None:
        """Take in what the buckets say of the anchors."""
        say, first = [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)]
        for a in sorted(answers, key=lambda a: a["bucket"]):
            code, doc = exchange.unpacked(a["block"])
            say.append(code)
            first.append(doc)
        by_anchor = np.concatenate(say)
        number = np.repeat(np.arange(len(self.at)), np.diff(np.append(self.at, len(self.order))))
        said = np.empty(len(self.order), np.uint8)
        said[self.order] = by_anchor[number]
        known = np.full(len(by_anchor), exchange.NO_ID)
        known[by_anchor == _ALIKE] = np.concatenate(first)
        earliest = np.empty(len(self.order), np.int64)
        earliest[self.order] = known[number]
        # Strings to be merged: the distinct contexts of most anchors, the distinct windows of those that are spread.
        found = self.found
        whole = np.flatnonzero((said == _MERGE) | (said == _ALIKE))
        wide = np.flatnonzero(said == _SPREAD)
        many = found.n[wide]
        step = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        window = np.repeat(found.start[wide], many) + step
        key = np.concatenate([mixed(found.anchor[whole] + found.hash[whole]), mixed(found.whole[window])])
        place = np.concatenate([found.start[whole], window])
        n = np.concatenate([found.n[whole], np.ones(len(window), np.int64)])
        to = np.concatenate([found.anchor[whole], key[len(whole) :]])
        doc = np.concatenate([self.doc[whole], np.repeat(self.doc[wide], many)])
        # The smallest document that has the string, where that is known: whoever has that document sends the string.
        sender = np.concatenate([np.where(said[whole] == _ALIKE, earliest[whole], -1), np.full(len(window), -1)])
        order = np.argsort(key, kind="stable")
        fresh = np.append(True, key[order][1:] != key[order][:-1]) if len(key) else np.zeros(0, bool)
        at = np.flatnonzero(fresh)
        one = order[at]
        bucket = exchange.bucket_of(to[one], self.buckets)
        by = np.argsort(bucket, kind="stable")
        # Of the distinct strings, in the order they are sent: place, windows, first document, bucket, hash, whether it goes itself.
        self.sent_place, self.sent_n, self.sent_bucket, self.sent_key = place[one][by], n[one][by], bucket[by], key[one][by]
        self.sent_doc = np.minimum.reduceat(doc[order], at)[by] if len(at) else doc
        self.sent_part = (to[one][by] & np.uint64(PARTS - 1)).astype(np.uint8)
        self.sent_self = (sender[one][by] < 0) | (sender[one][by] == self.sent_doc)
        back = np.empty(len(by), np.int64)
        back[by] = np.arange(len(by))
        self.which = np.empty(len(key), np.int64)
        self.which[order] = back[np.cumsum(fresh) - 1]
        self.place, self.n = place, n

    def strings_sent(self) -> list[tuple[int, bytes]]:
        out = []
        for b, i, j in exchange.cuts(self.sent_bucket, self.buckets):
            size = np.where(self.sent_self[i:j], self.sent_n[i:j] + self.width - 1, 0)
            ends = np.cumsum(size)
            at = np.arange(int(ends[-1])) + np.repeat(self.sent_place[i:j] - ends + size, size)
            out.append((b, exchange.packed(self.data[at], size.astype(np.uint16), self.sent_n[i:j].astype(np.uint8), self.sent_doc[i:j], self.sent_key[i:j], self.sent_part[i:j])))
        return out

    def covered(self, answers: list[dict]) -> np.ndarray:
        """Bytes covered by windows that an earlier document has too."""
        first = np.full(len(self.data), exchange.NO_ID)
        docs = np.concatenate([np.zeros(0, np.int64), *[exchange.unpacked(a["block"])[0] for a in sorted(answers, key=lambda a: a["bucket"])]])
        begin = np.cumsum(self.sent_n) - self.sent_n
        step = np.arange(int(self.n.sum())) - np.repeat(np.cumsum(self.n) - self.n, self.n)
        first[np.repeat(self.place, self.n) + step] = docs[np.repeat(begin[self.which], self.n) + step]
        starts = first < np.repeat(self.ids, np.diff(self.starts))
        count = np.cumsum(starts)
        count[self.width :] -= count[: -self.width].copy()
        return count > 0


def _ranges(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The numbers from each start on, so many of them."""
    return np.arange(int(many.sum())) + np.repeat(start - np.cumsum(many) + many, many)


def _answered(group: pa.Table, width: int) -> pa.Table:
    """Answer the strings of a bucket with the smallest document of each of their windows."""
    held = [exchange.unpacked(b.as_py()) for b in group.column("block")]
    data, sizes, windows, docs, keys, parts = (np.concatenate(x) for x in zip(*held, strict=True))
    sizes, windows = sizes.astype(np.int64), windows.astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    # A string that several batches know stands in one shard only, from one that sent it whole.
    order = np.lexsort((sizes == 0, keys))
    fresh = np.append(True, keys[order][1:] != keys[order][:-1])
    one = order[fresh]
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(fresh) - 1
    doc = np.full(len(one), exchange.NO_ID)
    np.minimum.at(doc, which, docs)
    own = np.zeros(len(keys), bool)
    own[one] = True
    sent = np.flatnonzero(own)
    found = np.empty(int(windows[sent].sum()), np.int64)
    at = np.zeros(len(keys), np.int64)
    at[sent] = np.cumsum(windows[sent]) - windows[sent]
    # A part of the bucket at a time: what is equal is in one part, and a small merge stays in the processor's cache.
    for part in np.unique(parts[sent]).tolist():
        mine = sent[parts[sent] == part]
        full = (np.cumsum(sizes[mine]) - 1) // SHARD_BYTES
        shards = []
        for some in np.split(mine, np.flatnonzero(np.diff(full)) + 1):
            shards.append((data[_ranges(starts[some], sizes[some])], np.cumsum(sizes[some]), doc[which[some]]))
        firsts = first_documents(shards, width)
        inside = [np.repeat(ends, np.diff(np.concatenate([[0], ends]))) - np.arange(len(text)) >= width for text, ends, _ in shards]
        found[_ranges(at[mine], windows[mine])] = np.concatenate([f[i] for f, i in zip(firsts, inside, strict=True)])
    # Where the windows of each distinct string lie in ``found``, which follows the order of sending.
    begin = np.zeros(len(one), np.int64)
    begin[which[sent]] = at[sent]
    replies = found[_ranges(begin[which], windows)]
    cuts = np.cumsum(windows)[np.cumsum([len(h[1]) for h in held]) - 1]
    answers = [exchange.packed(r) for r in np.split(replies, cuts[:-1])]
    rows_ = list(zip(group.column("bucket").to_pylist(), group.column("batch").to_pylist(), answers, strict=True))
    return pa.Table.from_batches([exchange.blocks(rows_)])


def repeats(docs: DataFrame, width: int = WIDTH, id: str = "doc_id", text: str = "text", kept: bool = False, carry: list[str] | None = None, spread_bytes: int = SPREAD_BYTES, bucket_bytes: int = exchange.BUCKET_BYTES) -> DataFrame:
    """A row for each row of ``docs``: ``doc, n_bytes, n_removed, n_spans, kept_sha256`` and, if asked for, ``kept``,
    the remaining text (a character of which a byte is gone is left out; the digest is that of all remaining bytes).
    With ``carry``, each row also has these columns of its own row of ``docs`` as the struct ``own``, and ``none``, whether its text is null.

    Removed is every byte covered by a string of ``width`` bytes that also starts in a
    document of smaller id. Strings are those of the input in UTF-8 and do not cross
    documents. A null text is empty. Rows of one id are one document as far as "earlier"
    goes: they do not remove each other's bytes. A row without an id counts as the last of all.
    """
    if width % 2 or width < 2:
        raise ValueError("width must be even")
    table = exchange.batches(docs, id, text, "texts", carry)
    # Some 18 bytes are sent for an anchor, which there is for every 13 bytes of text.
    buckets = exchange.bucket_count(int((table.agg(F.sum("bytes")).first()[0] or 0) * 1.4), bucket_bytes)

    def each(parts: Iterator[pa.RecordBatch]):
        for part in parts:
            names = part.schema.names
            for row in range(part.num_rows):
                yield _Batch(part.column("block")[row].as_py(), width, buckets), {n: part.column(n)[row].as_py() for n in names if n != "block"}

    def send(parts):
        for batch, row in each(parts):
            yield exchange.blocks([(b, row["batch"], block) for b, block in batch.anchors_sent()])

    def send_strings(parts):
        for batch, row in each(parts):
            batch.told(row["answers"] or [])
            yield exchange.blocks([(b, row["batch"], block) for b, block in batch.strings_sent()])

    def finish(parts):
        import hashlib

        for batch, row in each(parts):
            batch.told(row["answers"] or [])
            gone = batch.covered(row["merged"] or [])
            starts = batch.starts
            total = np.concatenate([[0], np.cumsum(gone)])
            fresh = gone & ~np.concatenate([[False], gone[:-1]]) if len(gone) else gone
            fresh[starts[:-1][np.diff(starts) > 0]] = gone[starts[:-1][np.diff(starts) > 0]]
            spans = np.concatenate([[0], np.cumsum(fresh)])
            rest = [batch.data[a:b][~gone[a:b]].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
            columns = [
                pa.array(batch.ids), pa.array(np.diff(starts)), pa.array(total[starts[1:]] - total[starts[:-1]]), pa.array(spans[starts[1:]] - spans[starts[:-1]]),
                pa.array([hashlib.sha256(r).hexdigest() for r in rest]),
            ]
            names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            texts_ = [pa.array([r.decode("utf-8", "ignore") for r in rest])] if kept else []
            own = list(exchange.own_rows(row["others"])) if carry else []
            yield pa.RecordBatch.from_arrays(columns + texts_ + own, names=names + ["kept"] * kept + ["own", "none"] * bool(carry))

    texts = table.select("batch", "block")
    anchors = texts.mapInArrow(send, exchange.BLOCKS)
    said = written(anchors.groupBy("bucket").applyInArrow(lambda group: _counted(group, spread_bytes), exchange.BLOCKS), "anchors")
    asked = exchange.answered(table.drop("bytes"), said)
    strings = asked.mapInArrow(send_strings, exchange.BLOCKS)
    merged_ = strings.groupBy("bucket").applyInArrow(lambda group: _answered(group, width), exchange.BLOCKS)
    last = exchange.answered(asked, merged_, "merged")
    schema = "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept string" * kept
    schema = StructType.fromDDL(schema)
    if carry:
        schema = StructType([*schema.fields, *docs.select(F.struct(*carry).alias("own"), F.lit(True).alias("none")).schema.fields])
    out = last.mapInArrow(finish, schema)
    return out.withColumn("doc", F.when(F.col("doc") != F.lit(int(exchange.NO_ID)), F.col("doc")))

