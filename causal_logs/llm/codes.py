"""Product codes of vectors, assigned by a lexicographic trie over distinct parts.

A vector of whole numbers is cut into parts; every part gets the number of the nearest entry of
its position's codebook. The distinct parts of the table, with how often each occurs, are stored
in lexicographic order, so the parts of a task are the leaves of a few subtrees of one
trie whose edges are dimensions. A depth-first walk carries the distances to all entries,
accumulated over the dimensions so far: parts with a common prefix share that vector. At a leaf it is
complete; its smallest element is the code, and the leaf adds its part times its
weight to that entry's sums. Sums are added up by Spark; a codebook is all that reaches the driver.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import written

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
# Components are smaller than this in size, so that squared distances are exact in 64 bits.
LIMIT = 1 << 26
# Leaves that the walk takes side by side; the path to the last one is kept for the next ones.
LEAVES = 1024
_SIGN = np.int64(1 << 31)


def whole(column: pa.Array, length: int, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a list column that are vectors (no null, nothing infinite), those of them that can be coded,
    and the latter as whole numbers ``floor(scale * x)``."""
    sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64())
    values = np.floor(scale * flat.fill_null(np.nan).to_numpy(zero_copy_only=False))
    ends = np.cumsum(sizes)
    count = lambda flags: np.concatenate([[0], np.cumsum(flags)])[np.concatenate([[0], ends])]
    good = np.asarray(pc.is_valid(column)) & (np.diff(count(~np.isfinite(values))) == 0)
    fit = good & (sizes == length) & (np.diff(count(~(np.abs(values) < LIMIT))) == 0)
    at = (ends - sizes)[fit][:, None] + np.arange(length)
    return good, fit, values[at].astype(np.int64)


def _keys(parts: np.ndarray) -> np.ndarray:
    """Parts as byte strings in the same order."""
    return np.ascontiguousarray((parts + _SIGN).astype(">u4")).view(f"S{4 * parts.shape[1]}")[:, 0]


def _values(keys: pa.Array, width: int) -> np.ndarray:
    joined = np.frombuffer(b"".join(keys.to_pylist()), ">u4").reshape(len(keys), width)
    return joined.astype(np.int64) - _SIGN


def nearest(parts: np.ndarray, book: np.ndarray, leaves: int = LEAVES) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (ties: lowest) and squared distance of distinct parts in lexicographic order."""
    n, width = parts.shape
    code, error = np.zeros(n, np.int64), np.zeros(n, np.int64)
    reach = max(int(np.abs(parts).max(initial=0)), int(np.abs(book).max(initial=0))) * 2
    kind = np.int32 if reach * reach * max(1, width) < 1 << 31 else np.int64
    parts, book = parts.astype(kind), np.ascontiguousarray(book.T.astype(kind))
    # Distances to all entries, accumulated along the path to the last leaf.
    path = np.zeros((width + 1, book.shape[1]), kind)
    for first in range(0, n, leaves):
        rows = parts[first : first + leaves]
        # Dimensions that a leaf shares with the leaf before.
        shared = np.zeros(len(rows), np.int64)
        if width:
            before = parts[first - 1 : first + len(rows) - 1] if first else np.concatenate([rows[:1] - 1, rows[:-1]])
            shared = (rows != before).argmax(1)
        far, node = path[:1], np.zeros(len(rows), np.int64)
        for depth in range(width):
            fresh = shared <= depth
            known = not fresh[0]
            fresh[0] = True
            lead = np.flatnonzero(fresh)
            step = rows[lead, depth][:, None] - book[depth]
            step *= step
            step += far if len(far) == len(lead) else far[node[lead]]
            if known:
                step[0] = path[depth + 1]
            far, node = step, np.cumsum(fresh) - 1
            path[depth + 1] = far[-1]
        far = np.broadcast_to(far, (len(rows), book.shape[1])) if not width else far
        code[first : first + len(rows)] = far.argmin(1)
        error[first : first + len(rows)] = far[np.arange(len(rows)), code[first : first + len(rows)]]
    return code, error


def _distinct(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct parts in lexicographic order, which one each row is, and how often each occurs."""
    if not parts.shape[1]:
        return parts[:1], np.zeros(len(parts), np.int64), np.array([len(parts)])
    _, one, which, many = np.unique(_keys(parts), return_index=True, return_inverse=True, return_counts=True)
    return parts[one], which, many


def _first(rows: DataFrame, parts: int, entries: int, scale: int) -> list[np.ndarray]:
    """The first codebooks: the parts of the vectors with the smallest ids."""
    vectors = rows.where("forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('inf'))").orderBy(F.col("id").asc_nulls_last(), "vector")
    head = vectors.first()
    length = len(head["vector"]) if head else 0
    if length % parts:
        return []
    fits = f"size(vector) = {length} and forall(vector, x -> x < {LIMIT / scale}D and x >= -{(LIMIT - 1) / scale}D)"
    found = vectors.where(fits).limit(entries).collect()
    book = np.floor(scale * np.array([r["vector"] for r in found], float)).astype(np.int64).reshape(len(found), length)
    return np.split(book, parts, axis=1) if len(found) else []


def codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> list[np.ndarray]:
    """Codebooks (entry, dimension) of each part position for ``rows`` (``id, vector array<double>``); empty if nothing can be coded."""
    books = _first(rows, parts, entries, scale)
    if not books:
        return []
    width = books[0].shape[1]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, own in enumerate(np.split(whole(batch.column("vector"), parts * width, scale)[2], parts, axis=1)):
                if len(own):
                    kinds, _, many = _distinct(own)
                    keys = pa.array([k.tobytes() for k in (kinds + _SIGN).astype(">u4")], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(kinds), place)), keys, pa.array(many)], names=["place", "part", "weight"])

    # Copies are folded in every batch before the shuffle; equal parts then meet in one range.
    ranged = rows.select("vector").mapInArrow(cut, "place bigint, part binary, weight bigint").repartitionByRange("place", "part")
    trie = written(ranged.groupBy("place", "part").agg(F.sum("weight").alias("weight")).sortWithinPartitions("place", "part"), "parts")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, len(books[0]), width + 1), np.int64)
        for batch in batches:
            places, weights = batch.column("place").to_numpy(), batch.column("weight").to_numpy()
            edges = np.flatnonzero(np.append(True, places[1:] != places[:-1])).tolist() if len(places) else []
            for a, b in zip(edges, [*edges[1:], len(places)], strict=True):
                leaves = _values(batch.column("part")[a:b], width)
                code, _ = nearest(leaves, books[places[a]])
                order = np.argsort(code, kind="stable")
                at = np.flatnonzero(np.append(True, code[order][1:] != code[order][:-1]))
                weighted = np.concatenate([leaves, np.ones((len(leaves), 1), np.int64)], axis=1) * weights[a:b, None]
                sums[places[a], code[order][at]] += np.add.reduceat(weighted[order], at, axis=0)
        place, entry = np.nonzero(sums[:, :, -1])
        if len(place):
            lists = pa.ListArray.from_arrays(np.arange(len(place) + 1, dtype=np.int32) * (width + 1), sums[place, entry].ravel())
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(entry), lists], names=["place", "entry", "sums"])

    for _ in range(rounds):
        totals = trie.mapInArrow(summed, "place bigint, entry bigint, sums array<bigint>").groupBy("place", "entry")
        new = totals.agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(width + 1)]).alias("sums"))
        books = [b.copy() for b in books]
        # At most a row for each entry of a codebook.
        for row in new.collect():
            books[row["place"]][row["entry"]] = np.array(row["sums"][:-1], np.int64) // row["sums"][-1]
    return books


def digest(books: list[np.ndarray]) -> str:
    import hashlib

    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def coded(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``<id>, code, error, label_error, codebooks_sha256`` for each row with a vector; other columns do not matter.

    A row whose vector is null, or holds a null or non-finite component, is dropped. Every other row stays, repeated ids and
    null ids too (a null id sorts last, equal ids by their vectors). The vector of the smallest id sets the length; where a
    vector has another length, or a component of 65,536 or more in size, or the length cannot be cut into equal parts, ``code``
    and ``error`` are null. ``label_error`` adds up the errors of equal labels, null labels together. An empty table gives no rows.
    ``entries`` is at most 256.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's number has two hex digits")
    rows = vectors.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).alias("label"))
    books = codebooks(rows.select("id", "vector"), parts, entries, rounds, scale)
    length = sum(b.shape[1] for b in books)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, fit, values = whole(batch.column("vector"), length if books else -1, scale)
            codes, errors = np.zeros((len(values), len(books)), np.uint8), np.zeros(len(values), np.int64)
            for place, book in enumerate(books):
                kinds, which, _ = _distinct(values[:, place * book.shape[1] : (place + 1) * book.shape[1]])
                if len(values):
                    code, error = nearest(kinds, book)
                    codes[:, place] = code[which]
                    errors += error[which]
            text, error = np.full(len(good), None, object), np.full(len(good), None, object)
            text[fit] = [c.tobytes().hex() for c in codes]
            error[fit] = errors.tolist()
            own = batch.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays(
                [own.column("id"), own.column("label"), pa.array(text[good], pa.string()), pa.array(error[good], pa.int64())], names=["id", "label", "code", "error"]
            )

    types = StructType([*rows.select("id", "label").schema.fields, *StructType.fromDDL("code string, error bigint").fields])
    found = written(rows.mapInArrow(assign, types), "codes")
    totals = found.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error"))
    out = found.join(totals, F.col("label").eqNullSafe(F.col("l")), "left")
    return out.select(F.col("id").alias(id), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
