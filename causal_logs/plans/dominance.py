"""How many clocks lie below and above each clock, for any clocks at all.

Nothing is assumed of the clocks, so each is compared with others by all its components; but not
pair by pair. Distinct clocks, sorted by node and sum, are cut into chunks, and a chunk into runs: sequences
whose clocks never fall in any component. Along the clocks of one node that is mostly a single run; a
clock that does not fit starts another one. Runs that follow each other form chains.

Below a clock b, a chain is a prefix: its runs whose last clock is below b, then the prefix of one more run, in which each
component's part is found by binary search and the shortest is the answer. So a clock asks one run of each chain, and
counts the others from the chain's totals. Only the runs' first and last clocks and totals travel to every task, in
portions of bounded size. The work grows with the number of clocks times chains: with one chain per node, as much as clocks whose knowledge
is whole need; with clocks in no order at all it is as slow as comparing all pairs, but never wrong.
"""

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clocks as clock
from ..session import written
from .scan import rank_rows
from .skew import HEAVY_ROWS, lookup

# Clocks of a chunk, and runs whose ends are sent to every task at a time.
CHUNK_CLOCKS = 1 << 13
PORTION_RUNS = 1 << 17
_NONE = np.iinfo(np.int64).min

# The functions travel to the executors by value: those need numpy and pyarrow, but not this library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Chain(NamedTuple):
    """Runs in order: their numbers, first and last clocks, and the totals of those before each (copies, largest value)."""

    runs: np.ndarray
    first: np.ndarray
    last: np.ndarray
    copies: np.ndarray
    values: np.ndarray


def split(clocks: np.ndarray) -> list[np.ndarray]:
    """Places of rows as few runs; each row goes to the first run that it continues."""
    if len(clocks) < 2 or (clocks[1:] >= clocks[:-1]).all():
        return [np.arange(len(clocks))]
    tails, runs = np.empty((16, clocks.shape[1]), np.int64), []
    for row, clock in enumerate(clocks):
        fits = (tails[: len(runs)] <= clock).all(1)
        k = int(fits.argmax()) if fits.any() else len(runs)
        if k == len(runs):
            runs.append([])
            if k == len(tails):
                tails = np.concatenate([tails, np.empty_like(tails)])
        runs[k].append(row)
        tails[k] = clock
    return [np.array(r) for r in runs]


def chains(runs: np.ndarray, first: np.ndarray, last: np.ndarray, copies: np.ndarray, values: np.ndarray) -> list[Chain]:
    """Runs as few chains; a run goes to the first chain that it continues."""
    tails, members = np.empty((16, first.shape[1]), np.int64), []
    for k in range(len(runs)):
        fits = (tails[: len(members)] <= first[k]).all(1)
        at = int(fits.argmax()) if fits.any() else len(members)
        if at == len(members):
            members.append([])
            if at == len(tails):
                tails = np.concatenate([tails, np.empty_like(tails)])
        members[at].append(k)
        tails[at] = last[k]
    out = []
    for m in members:
        before = np.concatenate([[0], np.cumsum(copies[m])])
        tops = np.maximum.accumulate(np.concatenate([[_NONE], values[m]]))
        out.append(Chain(runs[m], first[m], last[m], before, tops))
    return out


def _prefix(sorted_: np.ndarray, points: np.ndarray) -> np.ndarray:
    """For each point, how many of the rows, which never fall, are below it or equal."""
    return np.min([np.searchsorted(sorted_[:, j], points[:, j], "right") for j in range(points.shape[1])], axis=0)


def _below(sorted_: np.ndarray, points: np.ndarray) -> np.ndarray:
    """For each point, how many of the rows, which never fall, are not above it or equal."""
    return np.max([np.searchsorted(sorted_[:, j], points[:, j], "left") for j in range(points.shape[1])], axis=0)


def _packed(*arrays: np.ndarray) -> bytes:
    return np.concatenate([a.astype(np.int64).ravel() for a in arrays]).tobytes()


def _points(block: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions, copies, values and clocks of a run."""
    table = np.frombuffer(block, np.int64).reshape(width + 3, -1)
    return table[0], table[1], table[2], table[3:].T


_COUNTED = "pos bigint, n_before bigint, n_after bigint, best bigint"


def _counted(pos: np.ndarray, before: np.ndarray, after: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(pos), pa.array(before), pa.array(after), pa.array(best, mask=best == _NONE)], names=["pos", "n_before", "n_after", "best"]
    )


def around(clocks: DataFrame, names: list[str], first_order: list[str], chunk: int = CHUNK_CLOCKS, portion: int = PORTION_RUNS) -> DataFrame:
    """``clocks`` (distinct in ``names``; with ``copies`` and ``value``) with ``n_before`` and ``n_after``, the copies of the clocks strictly below
    and above, and ``best``, the largest ``value`` below (NULL: none). Clocks sorted by ``first_order`` and sum should mostly rise.
    """
    width, spark = len(names), clocks.sparkSession
    summed = clocks.withColumn("_sum", F.expr(" + ".join(names)))
    ranked = written(rank_rows(summed, [*first_order, "_sum", *names], "pos").drop("_sum"), "clocks")

    def cut(key, group):
        table = np.stack([group.column(c).to_numpy() for c in ("pos", "copies", "value", *names)])
        table = table[:, np.argsort(table[0])]
        rows = []
        for k, own in enumerate(split(np.ascontiguousarray(table[3:].T))):
            run = table[:, own]
            rows.append(((key[0].as_py() << 20) + k, run[3:, 0].tolist(), run[3:, -1].tolist(), int(run[1].sum()), int(run[2].max()), _packed(run)))
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary()]
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["run", "first", "last", "copies", "value", "block"])

    types = "run bigint, first array<bigint>, last array<bigint>, copies bigint, value bigint, block binary"
    chunked = ranked.select("pos", "copies", F.coalesce("value", F.lit(int(_NONE))).alias("value"), *names)
    runs = written(chunked.groupBy(F.expr(f"(pos - 1) div {chunk}").alias("_chunk")).applyInArrow(cut, types), "runs")

    found = None
    numbers = runs.select("run", "first", "last", "copies", "value")
    lowest = -1
    while True:
        # The next portion of runs, at most ``portion`` of them.
        ends = numbers.where(F.col("run") > lowest).orderBy("run").limit(portion).toArrow()
        if not ends.num_rows:
            break
        columns = {c: ends.column(c).to_pylist() for c in ends.column_names}
        lowest = columns["run"][-1]
        parts = chains(*[np.array(columns[c], np.int64) for c in ("run", "first", "last", "copies", "value")])
        new = written(_portion(runs, spark.sparkContext.broadcast(parts), width), "counted")
        found = new if found is None else found.unionByName(new)
    if found is None:
        return ranked.withColumns({"n_before": F.lit(0).cast("bigint"), "n_after": F.lit(0).cast("bigint"), "best": F.lit(None).cast("bigint")}).drop("pos")
    totals = found.groupBy("pos").agg(F.sum("n_before").alias("n_before"), F.sum("n_after").alias("n_after"), F.max("best").alias("best"))
    return ranked.join(totals, "pos").drop("pos")


def _portion(runs: DataFrame, parts, width: int) -> DataFrame:
    """``_COUNTED`` rows of all clocks against the runs of some chains."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, block in zip(batch.column("run").to_pylist(), batch.column("block"), strict=True):
                pos, copies, values, clocks = _points(block.as_py(), width)
                clocks = np.ascontiguousarray(clocks)
                before, after = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
                best = np.full(len(pos), _NONE)
                asked: dict = {}
                for chain in parts.value:
                    at = np.flatnonzero(chain.runs == number)
                    if len(at):
                        # The own run is counted here; what comes before it is below, what follows is above.
                        full, rest = np.full(len(pos), at[0]), np.full(len(pos), at[0] + 1)
                        sums = np.concatenate([[0], np.cumsum(copies)])
                        before += sums[:-1]
                        after += sums[-1] - sums[1:]
                        best = np.maximum(best, np.maximum.accumulate(np.concatenate([[_NONE], values]))[:-1])
                    else:
                        full, rest = _prefix(chain.last, clocks), _below(chain.first, clocks)
                        more = np.flatnonzero(full < len(chain.runs))
                        low = more[(chain.first[full[more]] <= clocks[more]).all(1)]
                        for k in np.unique(full[low]).tolist():
                            asked.setdefault(int(chain.runs[k]), [[], []])[0].append(low[full[low] == k])
                        less = np.flatnonzero(rest > 0)
                        high = less[(chain.last[rest[less] - 1] >= clocks[less]).all(1)]
                        for k in np.unique(rest[high]).tolist():
                            asked.setdefault(int(chain.runs[k - 1]), [[], []])[1].append(high[rest[high] == k])
                    before += chain.copies[full]
                    best = np.maximum(best, chain.values[full])
                    after += chain.copies[-1] - chain.copies[rest]
                rows = [(None, _packed(pos, before, after, best), None)]
                for target, (low, high) in asked.items():
                    ends = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (low, high)]
                    both = np.concatenate(ends)
                    rows.append((target, _packed(pos[both][None], clocks[both].T), len(ends[0])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int64())],
                    names=["run", "asked", "below"],
                )

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column("asked"):
                yield _counted(*np.frombuffer(block.as_py(), np.int64).reshape(4, -1))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, asked, many in zip(batch.column("block"), batch.column("asked"), batch.column("below").to_pylist(), strict=True):
                _, copies, values, clocks = _points(block.as_py(), width)
                table = np.frombuffer(asked.as_py(), np.int64).reshape(width + 1, -1)
                sums = np.concatenate([[0], np.cumsum(copies)])
                tops = np.maximum.accumulate(np.concatenate([[_NONE], values]))
                low = _prefix(clocks, table[1:, :many].T)
                yield _counted(table[0, :many], sums[low], np.zeros(many, np.int64), tops[low])
                high = _below(clocks, table[1:, many:].T)
                rest = table.shape[1] - many
                yield _counted(table[0, many:], np.zeros(rest, np.int64), sums[-1] - sums[high], np.full(rest, _NONE))

    asks = written(runs.select("run", "block").mapInArrow(ask, "run bigint, asked binary, below bigint"), "asks")
    own = asks.where("run IS NULL").select("asked").mapInArrow(plain, _COUNTED)
    met = asks.where("run IS NOT NULL").join(runs.select("run", "block"), "run").select("block", "asked", "below")
    return own.unionByName(met.mapInArrow(answer, _COUNTED))


def of_clocks(log: DataFrame, node_count: int, value: str | None = None, chunk: int | None = None, portion: int | None = None) -> DataFrame:
    """``log`` with ``copies`` (entries of the same clock), ``n_before``, ``n_after`` and ``best`` (see ``around``) of each entry's clock; NULL without a clock.

    Copies of a clock are folded before the shuffle, and hot clocks joined apart.
    """
    names = [f"_c{j}" for j in range(node_count)]
    wide = log.withColumns({c: F.when(F.col("vc").isNotNull(), clock.component("vc", j)) for j, c in enumerate(names)})
    most = F.max(value) if value else F.lit(None).cast("bigint")
    folded = wide.where("vc IS NOT NULL").groupBy(*names).agg(
        F.count(F.lit(1)).alias("copies"), F.min("node_idx").alias("_node"), most.cast("bigint").alias("value")
    )
    facts = written(around(folded, names, ["_node"], chunk or CHUNK_CLOCKS, portion or PORTION_RUNS).drop("_node", "value"), "around")
    found = lookup(wide, facts, names, facts.where(F.col("copies") >= HEAVY_ROWS))
    return found.drop(*names)
