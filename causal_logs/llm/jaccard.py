"""Similar documents by exact Jaccard similarity of their shingles: token-combination prefixes.

Tokens (hashes of ``shingle`` consecutive words) are ordered by how many documents have
them, rarest first. Two sets of similarity ``percent`` share a token among the
first n - o + 1 of each, and two tokens among the first n - o + 2, where o is the least
overlap a set of n tokens can have with a similar one. The first shared token is either
rare, and indexed alone, or all shared ones are frequent; then the combination of
the first two is indexed. So a frequent token alone never makes a candidate.

Sets are indexed by class of size as well. A class is as wide as similar sets can differ, so these are in one class
or in neighbouring ones: a set stands in the lists of its own class and of the next, and two sets meet in the list of the larger
one's class. What counts as frequent depends on that class, so both sides agree: with p tokens in a prefix there are p(p - 1) / 2
combinations, which pays only for tokens in so many more documents. Prefixes of over ``COMBINED`` tokens are never combined.

Equal sets are one node, and keys of the same nodes one list. Nodes are first compared with
one head of each of their lists only; what is linked then needs no more comparing
within its component. Pairs of nodes that share a list but no component are all verified.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased. A set is told by 64-bit
hashes of its shingles.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import written
from . import exchange
from .components import components
from .words import LOWER, SPACES, mixed, shingled, stream, words

SHINGLE = 5
PERCENT = 80
# A token in more documents than this is frequent, times half the tokens of a prefix of the class.
FREQUENT = 256
# Longest prefix whose tokens are combined.
COMBINED = 512
# Times that lists are compared with a head, before all pairs left are.
ROUNDS = 2
_INSIDE = ~SPACES
# Codes of document counts: 0 for one, then eight steps for each doubling.
_CODE = 8


def _code(counts: np.ndarray) -> np.ndarray:
    return np.minimum(255, np.ceil(_CODE * np.log2(np.maximum(counts, 1)))).astype(np.uint8)


def _sets(data: np.ndarray, starts: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of each text, ascending, end to end; and where each text's begin."""
    found = words(LOWER[data], starts, _INSIDE)
    many = np.diff(found.first)
    tokens = shingled(found.hash, shingle)
    sets = []
    for first, n in zip(found.first[:-1].tolist(), many.tolist(), strict=True):
        if n >= shingle:
            sets.append(np.unique(tokens[first : first + n - shingle + 1]))
        else:
            sets.append(shingled(found.hash[first : first + n], n) if n else found.hash[:0])
    ends = np.cumsum([len(s) for s in sets])
    return np.concatenate(sets), np.concatenate([[0], ends]).astype(np.int64)


def _signatures(tokens: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    """16 bytes that tell a set, or None if it is empty."""
    sums = np.zeros((len(first), 2), np.uint64)
    for k, factor in enumerate(stream(41, 2)):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(tokens * factor + factor), dtype=np.uint64)])
        sums[:-1, k] = total[first[1:]] - total[first[:-1]]
    size = np.diff(first)
    return [sums[i].tobytes() if n else None for i, n in enumerate(size.tolist())]


def _classes(n: np.ndarray, percent: int) -> np.ndarray:
    """Class of each set's size; those of similar sets differ by one at most."""
    step = np.log(100 / percent) * (1 + 1e-9) if percent < 100 else np.log(2)
    return np.floor(np.log(np.maximum(n, 1)) / step).astype(np.int64)


def _limits(classes: np.ndarray, percent: int, frequent: int) -> np.ndarray:
    """Code of document counts beyond which a token is frequent in the lists of a class."""
    size = (100 / percent if percent < 100 else 2.0) ** classes
    prefix = (100 - percent) / 100 * size + 2
    limit = _code(frequent * np.maximum(1, prefix / 2))
    return np.where(prefix > COMBINED, 255, limit)


def _postings(tokens: np.ndarray, code: np.ndarray, first: np.ndarray, percent: int, frequent: int):
    """(text, key, rest) of the index keys; ``rest`` counts the tokens from the key's first one on."""
    n = np.diff(first)
    text = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((tokens, code, text))
    tokens, code = tokens[order], code[order]
    place = np.arange(len(tokens)) - np.repeat(first[:-1], n)
    spare = (n + (-percent * n // 100))[text]
    rest, found = n[text] - place, []
    for more in (0, 1):
        classes = _classes(n, percent) + more
        salt = mixed(classes.astype(np.uint64) * np.uint64(2) + np.uint64(1))[text]
        common = code > _limits(classes, percent, frequent)[text]
        rare = np.flatnonzero((place <= spare) & (code > 0) & ~common)
        found.append((text[rare], mixed(tokens[rare] ^ salt[rare]), rest[rare]))
        often = np.flatnonzero((place <= spare + 1) & common)
        edges = np.flatnonzero(np.append(True, text[often][1:] != text[often][:-1])) if len(often) else []
        for group in np.split(often, edges[1:]) if len(often) else []:
            a, b = np.triu_indices(len(group), 1)
            a, b = group[a], group[b]
            keep = place[a] <= spare[a]
            a, b = a[keep], b[keep]
            found.append((text[a], mixed(tokens[a] * np.uint64(3) + mixed(tokens[b] ^ salt[b])), rest[a]))
    return [np.concatenate(x) for x in zip(*found, strict=True)]


def indexed(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, frequent: int = FREQUENT, id: str = "doc_id", text: str = "text", table: DataFrame | None = None) -> DataFrame:
    """A stored row for each row of ``docs``: ``doc, node, n, keys (key, rest)``, ``tokens`` where there are keys, and where the row is: ``batch, at``.

    ``table`` are the rows in batches, if they are stored already.
    """
    table = exchange.batches(docs, id, text, "texts") if table is None else table
    # About a token of four bytes for six bytes of text.
    total = table.agg(F.sum("bytes")).first()[0] or 0
    buckets = exchange.bucket_count(total * 2 // 3)

    def sent(batch: int, block: bytes) -> pa.RecordBatch:
        _, ends, data = exchange.unpacked(block)
        tokens, _ = _sets(data, np.concatenate([[0], ends]), shingle)
        value, count = np.unique(tokens, return_counts=True)
        count = np.minimum(count, 65_535).astype(np.uint16)
        low = value.astype(np.uint32)
        cuts = exchange.cuts(exchange.bucket_of(value, buckets), buckets)
        return exchange.blocks([(b, batch, exchange.packed(low[i:j], count[i:j])) for b, i, j in cuts])

    def send(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for batch, block in zip(part.column("batch").to_pylist(), part.column("block"), strict=True):
                yield sent(batch, block.as_py())

    def count(group: pa.Table) -> pa.Table:
        """Document counts by token; a bucket knows a token by 32 more bits of its hash."""
        held = [exchange.unpacked(b.as_py()) for b in group.column("block")]
        value, which = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        code = _code(np.bincount(which, np.concatenate([h[1] for h in held])))[which]
        ends = np.cumsum([len(h[0]) for h in held])[:-1]
        answers = [exchange.packed(c) for c in np.split(code, ends)]
        return pa.Table.from_batches([exchange.blocks(list(zip(group.column("bucket").to_pylist(), group.column("batch").to_pylist(), answers, strict=True)))])

    blocks = table.select("batch", "block").mapInArrow(send, exchange.BLOCKS)
    answers = blocks.groupBy("bucket").applyInArrow(count, exchange.BLOCKS)

    key_type = pa.list_(pa.struct([("key", pa.int64()), ("rest", pa.int32())]))

    def index(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for number, block, replies in zip(part.column("batch").to_pylist(), part.column("block"), part.column("answers"), strict=True):
                ids, ends, data = exchange.unpacked(block.as_py())
                tokens, first = _sets(data, np.concatenate([[0], ends]), shingle)
                value, which = np.unique(tokens, return_inverse=True)
                ordered = sorted(replies.as_py() or [], key=lambda r: r["bucket"])
                code = np.concatenate([np.zeros(0, np.uint8), *[exchange.unpacked(r["block"])[0] for r in ordered]])[which]
                owner, key, rest = _postings(tokens, code, first, percent, frequent)
                order = np.argsort(owner, kind="stable")
                own = np.searchsorted(owner[order], np.arange(len(ids) + 1))
                keys = pa.StructArray.from_arrays([pa.array(key[order].view(np.int64)), pa.array(rest[order].astype(np.int32))], names=["key", "rest"])
                keys = pa.ListArray.from_arrays(pa.array(own, pa.int32()), keys)
                kept = [tokens[first[i] : first[i + 1]].tobytes() if own[i] < own[i + 1] else None for i in range(len(ids))]
                columns = [pa.array(ids), pa.array(_signatures(tokens, first), pa.binary()), pa.array(np.diff(first)), keys.cast(key_type), pa.array(kept, pa.binary())]
                columns += [pa.array(np.full(len(ids), number)), pa.array(np.arange(len(ids)))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "node", "n", "keys", "tokens", "batch", "at"])

    asked = exchange.answered(table.select("batch", "block"), answers).select("batch", "block", "answers")
    return written(asked.mapInArrow(index, "doc bigint, node binary, n bigint, keys array<struct<key:bigint,rest:int>>, tokens binary, batch bigint, at bigint"), "index")


def _alike(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar."""

    def verify(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keep = []
            for x, y in zip(part.column("x"), part.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = (x, y) if len(x) < len(y) else (y, x)
                at = np.searchsorted(large, small)
                shared = int(np.count_nonzero(large[np.minimum(at, len(large) - 1)] == small))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sets = nodes.select("node", "tokens")
    joined = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    return joined.select("a", "b", "x", "y").mapInArrow(verify, "a binary, b binary")


def _possible(n: Column, m: Column, rest: Column, rest2: Column, percent: int) -> Column:
    """Sets of n and m tokens can be similar if their first shared token leaves these rests."""
    return F.least(rest, rest2) * (100 + percent) >= percent * (n + m)


def _lists(postings: DataFrame) -> DataFrame:
    """``list, node, n, rest`` from ``key, node, n, rest``, without keys of one node only.

    Keys of exactly the same nodes (told by their number and two sums of hashes) make the
    same pairs and become one list; a node's largest rest is kept, so no pair is lost.
    """
    keys = postings.groupBy("key").agg(
        F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("node")).alias("s"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("t")
    ).where("c > 1")
    named = keys.select("key", F.xxhash64("c", "s", "t").alias("list"))
    return postings.join(named, "key").groupBy("list", "node").agg(F.max("n").alias("n"), F.max("rest").alias("rest"))


def _headed(placed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of each list's head with the nodes of other components.

    The head has fewest tokens before the shared one: the most ordinary of the list.
    """
    best = F.min(F.struct((F.col("n") - F.col("rest")).alias("place"), "node", "n", "rest", "component")).alias("head")
    heads = placed.groupBy("list").agg(best).select("list", *[F.col(f"head.{c}").alias(f"{c}2") for c in ("node", "n", "rest", "component")])
    met = placed.join(heads, "list").where(
        (F.col("component") != F.col("component2")) & _possible(F.col("n"), F.col("n2"), F.col("rest"), F.col("rest2"), percent)
    )
    return met.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b"))


def _apart(shared: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of the lists that have nodes of several components, with the components, stored."""
    placed = written(shared.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), "placed")
    several = placed.groupBy("list").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c < d").select("list")
    return written(placed.join(several, "list", "left_semi"), "apart")


def similar(docs: DataFrame, percent: int = PERCENT, id: str = "doc_id", text: str = "text", **index) -> DataFrame:
    """A row for each row of ``docs``: ``doc, n_shingles, n_verified, component``.

    ``component`` is the smallest id that links lead to, the own one included; ``n_verified``
    counts the row's links that were verified: to heads of its lists, and to sets of other components. Sets that one
    link has brought into a component are not compared further, so a set may be similar to more. A text with fewer than ``shingle`` words is one shingle; one
    without words, or null, has none and no links. Equal rows are linked. A row
    without an id counts as having the largest one; alone, its component is null.
    """
    rows, classes = _grouped(docs, percent, id, text, **index)
    out = rows.select("doc", "node", "n").join(classes.drop("component"), "node", "left")
    known = lambda c: F.when(c != F.lit(int(exchange.NO_ID)), c)
    return out.select(
        known(F.col("doc")).alias("doc"), F.col("n").alias("n_shingles"), F.coalesce("n_verified", F.lit(0)).cast("bigint").alias("n_verified"),
        known(F.coalesce("smallest", "doc")).alias("component"),
    )


def _grouped(docs: DataFrame, percent: int, id: str, text: str, **index) -> tuple[DataFrame, DataFrame]:
    """The indexed rows, and ``node, component, smallest, n_verified`` of the nodes that are not alone (``component`` is a node, ``smallest`` an id)."""
    rows = indexed(docs, percent=percent, id=id, text=text, **index)
    reps = written(rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc").alias("doc"), F.count(F.lit(1)).alias("rows")), "nodes")
    held = rows.where("tokens IS NOT NULL").join(reps.select("node", "doc"), ["node", "doc"], "left_semi")
    nodes = written(held.select("node", "n", "keys", "tokens").dropDuplicates(["node"]), "sets")
    shared = written(_lists(nodes.select("node", "n", F.inline("keys"))), "postings")
    placed, links = shared.withColumn("component", F.col("node")), None
    for _ in range(ROUNDS):
        pairs = _headed(placed, percent).select("a", "b").distinct()
        found_links = _alike(pairs, nodes, percent)
        links = written(found_links if links is None else links.union(found_links).distinct(), "links")
        found = components(links)
        placed = _apart(shared, found)
    # Lists whose nodes are still in several components: every pair across components.
    other = placed.select("list", *[F.col(c).alias(f"{c}2") for c in ("node", "n", "rest", "component")])
    across = placed.join(other, "list").where(
        (F.col("component") < F.col("component2")) & _possible(F.col("n"), F.col("n2"), F.col("rest"), F.col("rest2"), percent)
    )
    pairs = across.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()
    links = written(links.union(_alike(pairs, nodes, percent)).distinct(), "links")
    found = components(links)
    counted = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count(F.lit(1)).alias("n_verified"))
    classes = reps.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = classes.groupBy("component").agg(F.min("doc").alias("smallest"))
    classes = classes.join(smallest, "component").join(counted, "node", "left").select("node", "component", "smallest", F.coalesce("n_verified", F.lit(0)).alias("n_verified"))
    # Alone, a row is its own component; only other nodes have to meet their rows.
    classes = written(classes.join(reps.select("node", "doc", "rows"), "node").where("rows > 1 OR smallest < doc OR n_verified > 0").drop("doc", "rows"), "classes")
    return rows, classes


def deduplicated(docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = PERCENT, **options) -> DataFrame:
    """``docs`` with one row of each component kept: one of the smallest id.

    Rows are told apart by where they are stored, so rows of one id stay if they are not similar. Rows without an id
    have no order and stay, as do rows without words.
    """
    carry = [c for c in docs.columns if c != text]
    known = docs.where(F.col(id).isNotNull())
    table = exchange.batches(known, id, text, "texts", carry)
    rows, classes = _grouped(known, percent, id, text, table=table, **options)
    placed = written(rows.select("node", "doc", "batch", "at").join(classes.select("node", "component"), "node").drop("node"), "placed")
    first = placed.groupBy("component").agg(F.min(F.struct("doc", "batch", "at")).alias("first")).select("first.batch", "first.at")
    gone = placed.join(first, ["batch", "at"], "left_anti").groupBy("batch").agg(F.collect_list("at").alias("gone"))

    def keep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for block, others, out in zip(part.column("block"), part.column("others"), part.column("gone"), strict=True):
                _, ends, data = exchange.unpacked(block.as_py())
                own, none = exchange.own_rows(others.as_py())
                stays = np.ones(len(ends), bool)
                stays[np.array(out.as_py() or [], np.int64)] = False
                starts = np.concatenate([[0], ends])
                texts = [None if m else data[a:b].tobytes().decode("utf-8", "replace") for a, b, m in zip(starts[:-1], ends, none.to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([own, pa.array(texts, pa.string())], names=["own", "text"]).filter(pa.array(stays))

    schema = StructType([*known.select(F.struct(*carry).alias("own")).schema.fields, *StructType.fromDDL("text string").fields])
    kept = table.join(gone, "batch", "left").select("block", "others", "gone").mapInArrow(keep, schema)
    columns = [F.col("text").cast(docs.schema[text].dataType).alias(c) if c == text else F.col("own")[c].alias(c) for c in docs.columns]
    return kept.select(*columns).unionByName(docs.where(F.col(id).isNull()))
