"""Benchmark passages in documents: Wu-Manber search over words.

An item's windows of ``window`` consecutive words are the patterns (a shorter item
is one pattern). The "characters" of the search are words. For patterns of equal
length, a table says for each block of words how far the search may move on when the
text shows that block; blocks of no pattern allow almost a whole pattern's length.
Where the table allows nothing, the block is a pattern's end: a hash of it and of
the first block selects the patterns that may stand here, and their words are
compared with the text's.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import rows
from .words import ALNUM, LOWER, Words, shingled, words

WINDOW = 10
BLOCK = 3
STRIPE = 1024
# Bytes of item text searched for in one pass over the documents.
PASS_BYTES = 1 << 21


class Patterns:
    """The tables for patterns of ``length`` words: ``found[key]`` lists (words, item ids)."""

    def __init__(self, length: int, patterns: dict[bytes, set[str]]):
        self.length, self.block = length, min(BLOCK, length)
        joined = b"\n".join(patterns)
        data = np.frombuffer(joined, np.uint8)
        hashes = words(data, np.array([0, len(data)]), ALNUM).hash
        blocks = shingled(hashes, self.block)
        self.bits = np.uint64(64 - max(10, (4 * len(patterns) * length).bit_length()))
        self.shift = np.full(1 << int(64 - self.bits), length - self.block + 1, np.int64)
        firsts = np.arange(len(patterns)) * length
        for at in range(length - self.block + 1):
            np.minimum.at(self.shift, blocks[firsts + at] >> self.bits, length - self.block - at)
        keys = self.key(blocks[firsts], blocks[firsts + length - self.block])
        self.found: dict[int, list[tuple[bytes, list[str]]]] = {}
        for key, (pattern, items) in zip(keys.tolist(), patterns.items(), strict=True):
            self.found.setdefault(key, []).append((pattern, sorted(items)))
        self.keys = np.unique(keys)

    @staticmethod
    def key(first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return first * np.uint64(3) + last

    def blocks_at(self, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        return shingled_at(hashes, at, self.block)

    def candidates(self, hashes: np.ndarray) -> np.ndarray:
        """First words of places where a pattern may stand. Stripes of the text are searched side by side."""
        n = len(hashes)
        at = np.arange(self.length - 1, n, STRIPE)
        stop = np.minimum(at + STRIPE, n)
        ends = []
        while len(at):
            shift = self.shift[self.blocks_at(hashes, at - self.block + 1) >> self.bits]
            ends.append(at[shift == 0])
            at = at + np.maximum(shift, 1)
            inside = at < stop
            at, stop = at[inside], stop[inside]
        first = np.sort(np.concatenate(ends)) - self.length + 1 if ends else np.zeros(0, np.int64)
        last_block = self.blocks_at(hashes, first + self.length - self.block)
        return first[np.isin(self.key(self.blocks_at(hashes, first), last_block), self.keys)]

    def occurrences(self, data: np.ndarray, found: Words) -> Iterator[tuple[int, list[str]]]:
        """(first word, items) of every occurrence; a pattern does not stand across two texts."""
        first = self.candidates(found.hash)
        text = np.searchsorted(found.first, first, "right")
        first = first[first + self.length <= found.first[text]] if len(first) else first
        ends = self.blocks_at(found.hash, first + self.length - self.block)
        keys = self.key(self.blocks_at(found.hash, first), ends).tolist()
        begin, end = found.start, found.end
        for at, key in zip(first.tolist(), keys, strict=True):
            here = b" ".join(data[begin[k] : end[k]].tobytes() for k in range(at, at + self.length))
            for pattern, items in self.found[key]:
                if pattern == here:
                    yield at, items


def shingled_at(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """``shingled`` at some places only."""
    return shingled(values[at[:, None] + np.arange(size)].ravel(), size)[::size] if len(at) else np.zeros(0, np.uint64)


def patterns(items: list[tuple[str, bytes]], window: int = WINDOW) -> list[Patterns]:
    """Search tables of the items (id, text), one for each pattern length."""
    by_length: dict[int, dict[bytes, set[str]]] = {}
    for item, text in items:
        data = LOWER[np.frombuffer(text, np.uint8)]
        found = words(data, np.array([0, len(data)]), ALNUM)
        own = [data[a:b].tobytes() for a, b in zip(found.start, found.end, strict=True)]
        length = min(window, len(own))
        for at in range(len(own) - length + 1 if own else 0):
            by_length.setdefault(length, {}).setdefault(b" ".join(own[at : at + length]), set()).add(item)
    return [Patterns(length, found) for length, found in sorted(by_length.items())]


def _merged(places: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for start, end in sorted(places):
        if out and start <= out[-1]["start"] + out[-1]["n"]:
            out[-1]["n"] = max(out[-1]["n"], end - out[-1]["start"])
        else:
            out.append({"start": start, "n": end - start})
    return out


def _places(part: rows.Texts, tables: list[Patterns]) -> tuple[Words, list[list[tuple[int, int]]], list[set[str]]]:
    """Words of the texts, and the hit stretches and items of each text."""
    data = LOWER[part.data]
    found = words(data, part.starts, ALNUM)
    places = [[] for _ in range(len(part))]
    items = [set() for _ in range(len(part))]
    for table in tables:
        for at, names in table.occurrences(data, found):
            i = int(np.searchsorted(found.first, at, "right")) - 1
            own = at - int(found.first[i])
            places[i].append((own, own + table.length))
            items[i].update(names)
    return found, places, items


def _searched(docs: DataFrame, columns: list[str], text: str, tables: list[Patterns]) -> DataFrame:
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows.texts(batches, text):
            found, places, items = _places(part, tables)
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(c) for c in columns],
                    pa.array(np.diff(found.first), pa.int64()),
                    pa.array([_merged(p) for p in places], spans_type),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                ],
                names=[*columns, "n_words", "spans", "items"],
            )

    added = "n_words bigint, spans array<struct<start:bigint,n:bigint>>, items array<string>"
    return docs.select(*columns, text).mapInArrow(search, rows.schema(docs, columns, added))


def _blocks(benchmark: DataFrame, item: str, item_text: str, pass_bytes: int):
    """The number of passes, and a function that gives the items of a pass."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).cast("binary").alias("text")).dropna()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = -(-size // pass_bytes) or 1
    own = F.pmod(F.xxhash64("item", "text"), F.lit(passes))
    return passes, lambda k: [tuple(r) for r in items.where(own == k).collect()]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", pass_bytes: int = PASS_BYTES) -> DataFrame:
    """Where windows of benchmark items stand: ``id, n_words, spans (start, n), items``, a row for each row of ``docs``.

    Spans are runs of hit words, overlapping windows joined. A text that is null or
    has no word has none; an item without words, text or id is never found. Repeated
    rows of either table are judged like any others. Other columns are not read.

    Items are sent to the tasks in blocks of ``pass_bytes``, with a pass over the
    documents for each block, so any number of items can be searched for.
    """
    passes, block = _blocks(benchmark, item, item_text, pass_bytes)
    if passes == 1:
        return _searched(docs, [id], text, patterns(block(0), window))
    docs = written(docs.select(F.monotonically_increasing_id().alias("_row"), id, text), "docs")
    found = []
    for k in range(passes):
        found.append(_searched(docs, ["_row", id], text, patterns(block(k), window)))
    spans, names = F.flatten(F.collect_list("spans")), F.flatten(F.collect_list("items"))
    grouped = reduce(DataFrame.union, found).groupBy("_row").agg(F.first(id).alias(id), F.first("n_words").alias("n_words"), F.array_sort(spans).alias("spans"), F.array_sort(F.array_distinct(names)).alias("items"))
    return grouped.drop("_row")


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item: str = "item_id", item_text: str = "text", pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``docs`` without the rows in which a benchmark window stands; rows are kept whole, null and empty texts too.

    Every row is judged by its own text, whatever its id. What a pass keeps is stored for the next one.
    """

    def clean(docs: DataFrame, tables: list[Patterns]) -> DataFrame:
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in rows.texts(batches, text):
                _, places, _ = _places(part, tables)
                own = part.batch.slice(part.index.start, len(part))
                yield own.filter(pa.array([not p for p in places], pa.bool_()))

        return docs.mapInArrow(search, docs.schema)

    passes, block = _blocks(benchmark, item, item_text, pass_bytes)
    for k in range(passes):
        docs = clean(docs if k == 0 else written(docs, "clean"), patterns(block(k), window))
    return docs


def report(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """Counts and a digest of each row of ``contamination``."""
    step = lambda acc, s: F.struct(
        (acc.n + F.greatest(F.lit(0), s.start + s.n - F.greatest(s.start, acc.end))).alias("n"),
        F.greatest(acc.end, s.start + s.n).alias("end"),
    )
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))
    hit = F.aggregate("spans", zero, step).n
    return found.select(
        id, "n_words", hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
