"""Near copies by SimHash: a byte-position inverted index with count filtering.

Every text has a fingerprint of eight bytes. Fingerprints that differ in at most ``bits`` = 4
bits differ in at most four bytes, so they agree in four byte positions at least. The index
lists fingerprints by the bytes in some positions; ``_BASE`` are pairs of positions such that any
four positions contain one of them, so similar fingerprints meet in a list. In a list, the
equal bytes of each pair are tallied, pairs with fewer than four are dropped, and the others verified by
their differing bits.

Only distinct fingerprints are indexed, so copies cost nothing. A list of more than
``limit`` fingerprints is dealt anew by a third position (two more must agree, so five of the
other six do) and then by a fourth (any of the other five). A list still too long holds many fingerprints that
differ in few places: those that differ in one byte only are linked first, by lists of at most 256,
and then the members outside the list's largest component are compared with all, block by block.
A list gives no more links than join its members, not all its pairs.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import written
from .components import components

SHINGLE = 4
BITS = 4
SEED = 42
# Fingerprints of a list beyond which it is dealt anew.
LIMIT = 2048
# Any four of eight positions include one of these pairs: two of them lie in {0,1,2}, {3,4,5} or {6,7}.
_BASE = ((0, 1), (0, 2), (1, 2), (3, 4), (3, 5), (4, 5), (6, 7))
# Shingles hashed at a time, and rows of lists worked on at a time.
_SHINGLES = 1 << 16
_ROWS = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of a text in UTF-8: each bit that more than half the hashes of its shingles have."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    line, size = b" ".join(words), min(shingle, len(words))
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    first, last = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(line)]])
    first, last = first[: len(words) - size + 1], last[size - 1 :]
    votes = np.zeros(64, np.int64)
    for at in range(0, len(first), _SHINGLES):
        spans = zip(first[at : at + _SHINGLES].tolist(), last[at : at + _SHINGLES].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in spans], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(first), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id, print`` (bigint) of every row; null texts and texts without words get zero."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint((t.as_py() or "").encode(), shingle) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints.view(np.int64))], names=["id", "print"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    types = StructType([*rows.select("id").schema.fields, *StructType.fromDDL("print bigint").fields])
    return rows.mapInArrow(each, types)


def _byte(position: int) -> int:
    """The bits of a byte position, as a signed 64-bit number."""
    mask = 255 << (8 * position)
    return mask - (1 << 64) if mask >> 63 else mask


def _masked(mask: Column, print_: Column) -> Column:
    """The fingerprint with only the bytes whose positions are set in ``mask``."""
    kept = F.lit(0).cast("bigint")
    for p in range(8):
        kept = kept.bitwiseOR(F.when(mask.bitwiseAND(F.lit(1 << p)) != 0, F.lit(_byte(p)).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return print_.bitwiseAND(kept)


def _listed(rows: DataFrame, masks: Column) -> DataFrame:
    """A row ``mask, value, print`` for each of the ``masks`` of a fingerprint."""
    dealt = rows.select("print", F.explode(masks).alias("mask"))
    return dealt.select("mask", _masked(F.col("mask"), F.col("print")).alias("value"), "print")


def _wider(mask: Column, skip: bool) -> Column:
    """The masks with one more position; with ``skip``, one position that is not needed is left out."""
    left_out = {1 << a | 1 << b: 1 << (3 - a - b if b < 3 else 12 - a - b if b < 6 else 0) for a, b in _BASE}
    omit = F.lit(0)
    for pair, other in left_out.items() if skip else ():
        omit = F.when(mask == pair, other).otherwise(omit)
    ones = F.array(*[F.lit(1 << p) for p in range(8)])
    free = F.filter(ones, lambda one: mask.bitwiseOR(omit).bitwiseAND(one) == 0)
    return F.transform(free, lambda one: mask.bitwiseOR(one))


def _joined(group: np.ndarray, prints: np.ndarray, labels: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join the similar fingerprints of each group (ascending numbers); ``labels`` tells what is one already."""
    least, found = 8 - bits, []
    # Places as labels: those of one group and label share the first one's.
    _, first, which = np.unique(np.stack([group, labels]), axis=1, return_index=True, return_inverse=True)
    label = first[which]
    step, left = 1, np.arange(len(group))
    while True:
        # Each place with the one ``step`` further on, while any is in the same group.
        left = left[left + step < len(group)]
        left = left[group[left] == group[left + step]]
        if not len(left):
            return found
        a = left[label[left] != label[left + step]]
        apart = prints[a] ^ prints[a + step]
        tally = (apart.view(np.uint8).reshape(-1, 8) == 0).sum(1)
        a = a[tally >= least]
        a = a[np.bitwise_count(prints[a] ^ prints[a + step]) <= bits]
        if len(a):
            low, high = np.minimum(label[a], label[a + step]), np.maximum(label[a], label[a + step])
            # One link for each two labels.
            one = np.unique(np.stack([low, high]), axis=1, return_index=True)[1]
            found.append((prints[a[one]], prints[a[one] + step]))
            root = np.arange(len(group))
            x, y = low[one], high[one]
            while len(x):
                np.minimum.at(root, y, x)
                while not (root[root] == root).all():
                    root = root[root]
                x, y = root[x], root[y]
                x, y = np.minimum(x, y)[x != y], np.maximum(x, y)[x != y]
            label = root[label]
        step += 1


def _links(lists: DataFrame, bits: int) -> DataFrame:
    """``a, b``: links inside each list (``mask, value, cell``) of ``print`` and ``label``, enough to join what is similar."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def work(rows: np.ndarray, all_: bool):
            fresh = np.append(True, (rows[1:, :3] != rows[:-1, :3]).any(1))
            group = np.cumsum(fresh)
            # The last list may go on in the next batch.
            upto = len(rows) if all_ else int(np.searchsorted(group, group[-1]))
            pairs = _joined(group[:upto], np.ascontiguousarray(rows[:upto, 3]).view(np.uint64), rows[:upto, 4], bits) if upto else []
            out = [np.concatenate([p[k] for p in pairs]) if pairs else np.zeros(0, np.uint64) for k in range(2)]
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in out], names=["a", "b"]), rows[upto:]

        for batch in batches:
            if batch.num_rows:
                held.append(np.stack([batch.column(c).to_numpy() for c in ("mask", "value", "cell", "print", "label")], axis=1))
            if sum(len(h) for h in held) >= _ROWS:
                out, rest = work(np.concatenate(held), False)
                held = [rest]
                yield out
        if sum(len(h) for h in held):
            yield work(np.concatenate(held), True)[0]

    keys = ["mask", "value", "cell"]
    rows = lists.select(*[F.col(c).cast("bigint").alias(c) for c in (*keys, "print", "label")])
    return rows.repartition(*keys).sortWithinPartitions(*keys, "print").mapInArrow(found, "a bigint, b bigint")


def _alone(lists: DataFrame) -> DataFrame:
    """Lists without blocks and without anything known of components."""
    return lists.withColumn("cell", F.lit(0)).withColumn("label", F.col("print"))


def _long(lists: DataFrame, links: DataFrame | None, limit: int, bits: int) -> DataFrame:
    """Links in lists that are too long and have no more positions to be dealt by."""
    members = lists.select("print").distinct()
    # Fingerprints that differ in one byte only: lists of at most 256.
    near = _links(_alone(_listed(members, F.array(*[F.lit(255 - (1 << p)) for p in range(8)]))), bits)
    near = written(near if links is None else links.union(near), "near")
    label = components(near).select(F.col("node").alias("print"), F.col("component").alias("label"))
    placed = written(lists.join(label, "print", "left").withColumn("label", F.coalesce("label", "print")), "long")
    sizes = placed.groupBy("mask", "value", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("mask", "value").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("all"))
    largest = largest.where(F.col("top.n") < F.col("all")).select("mask", "value", F.col("top.label").alias("top"), F.col("top.n").alias("main"), (F.col("all") - F.col("top.n")).alias("rest"))
    both = placed.join(largest, ["mask", "value"])
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) * 2 / limit))
    # Cells (0, i, j): block i of the largest component with block j of the others. Cells (1, i, j): two blocks of the others.
    own = lambda n: F.pmod(F.xxhash64("print"), blocks(n))
    others = F.sequence(F.lit(0).cast("bigint"), blocks("rest") - 1)
    cell = lambda kind, i, j: (F.lit(kind) * F.lit(1 << 60)) + i * F.lit(1 << 30) + j
    in_main = F.transform(others, lambda j: cell(0, own("main"), j))
    in_rest = F.concat(
        F.transform(F.sequence(F.lit(0).cast("bigint"), blocks("main") - 1), lambda i: cell(0, i, own("rest"))),
        F.transform(others, lambda j: cell(1, F.least(j, own("rest")), F.greatest(j, own("rest")))),
    )
    dealt = both.select("mask", "value", "print", "label", F.explode(F.when(F.col("label") == F.col("top"), in_main).otherwise(in_rest)).alias("cell"))
    return near.union(_links(dealt, bits))


def linked(prints: DataFrame, bits: int = BITS, limit: int = LIMIT) -> DataFrame:
    """``a, b``: links between distinct fingerprints (``print``) that differ in at most ``bits`` bits; their components are those of all such links."""
    if not 0 < bits <= 4:
        raise ValueError("fingerprints with more than four differing bits need not share four bytes")
    lists = written(_listed(prints.select("print"), F.array(*[F.lit(1 << a | 1 << b) for a, b in _BASE])), "lists")
    links: DataFrame | None = None
    for positions in (2, 3, 4):
        heavy = written(lists.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("mask", "value"), "heavy")
        done = heavy.limit(1).count() == 0
        light = lists if done else lists.join(heavy, ["mask", "value"], "left_anti")
        new = _links(_alone(light), bits)
        links = written(new if links is None else links.union(new), "links")
        if done:
            return links
        long = lists.join(heavy, ["mask", "value"], "left_semi")
        if positions == 4:
            return written(_long(long, links, limit, bits), "links")
        # A list reached by way of several shorter keys holds a fingerprint once.
        dealt = long.select("print", F.explode(_wider(F.col("mask"), positions == 2)).alias("mask")).distinct()
        lists = written(dealt.select("mask", _masked(F.col("mask"), F.col("print")).alias("value"), "print"), "lists")


def near_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS, limit: int = LIMIT) -> DataFrame:
    """``<id>, fingerprint, component_id`` for each row of ``docs``; other columns do not matter.

    ``fingerprint`` has 16 hex digits; ``component_id`` is the smallest id that links lead to, the own one included. Rows with one
    fingerprint are linked, so all rows without words (null, empty or blank texts) are one group, with others that are close to zero. A row
    without an id is a member of its group but never names it; its component is null if nobody in it has an id. Rows that share an
    id are rows of their own. An empty table gives no rows.
    """
    found = written(fingerprints(docs, id, text, shingle), "prints")
    nodes = written(found.groupBy("print").agg(F.min("id").alias("id")), "nodes")
    links = linked(nodes, bits, limit)
    classes = components(links).select(F.col("node").alias("print"), "component")
    named = written(nodes.join(classes, "print", "left").withColumn("component", F.coalesce("component", "print")), "classes")
    smallest = named.groupBy("component").agg(F.min("id").alias("component_id"))
    by_print = named.select("print", "component").join(smallest, "component").select("print", "component_id")
    return found.join(by_print, "print", "left").select(F.col("id").alias(id), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
