"""Sampled SentencePiece segmentations: Gumbel top-k without replacement, and encoding and decoding.

Every segmentation of a text has a probability under a unigram model of the
vocabulary. Adding a Gumbel variable to each log-probability and taking the k largest sums draws k
distinct segmentations without replacement. The sums are never listed: the
largest below a partial segmentation is a Gumbel variable too, so a best-first search of
the tree of partial segmentations finds them in order. Its frontier has, for
each piece of a segmentation found so far, the group of all segmentations that part
there. The largest sum in a group is drawn below the sum of what it parts from; the best group
of all gives the next segmentation: a piece not yet taken there, and then a free walk
through the lattice, each next piece drawn by its share of the sums from there on.

The walks of all texts of a batch go on side by side. Draws depend on the row's key,
the sample, the part and the step only, so results do not depend on how rows are dealt out.
"""

from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate
from operator import add as plus

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pieces, rows
from .words import mixed

SAMPLES = 3
# Below 1: less likely segmentations are drawn more often.
ALPHA = 0.6
PART_BYTES = 1 << 19
_U = np.uint64
_WALK, _GROUP, _CHOICE, _ROOT = (_U(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3))


def _keyed(*keys) -> np.ndarray:
    """A state that depends on the keys only."""
    state = np.zeros(1, _U)
    for key in keys:
        state = mixed(state * _U(0x2545F4914F6CDD1D) + np.asarray(key).astype(_U))
    return state


def _uniform(state: np.ndarray, place=0) -> np.ndarray:
    """Numbers in (0, 1), for each state and place another one."""
    value = mixed(state + np.asarray(place).astype(_U) * _U(0x9E3779B97F4A7C15))
    value >>= _U(11)
    out = value.astype(np.float64)
    out += 0.5
    out /= 1 << 53
    return out


def weights(vocabulary: pieces.Vocabulary, alpha: float = ALPHA) -> np.ndarray:
    """Piece probabilities by Zipf's law (a BPE vocabulary publishes ranks, no counts), flattened by the power ``alpha``."""
    share = (vocabulary.rank + 10.0) ** -alpha
    return share / share.sum()


def _below(location: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel variables at ``location``, given that they are at most ``top``."""
    with np.errstate(over="ignore", divide="ignore"):
        return location - np.log(np.exp(location - top) - np.log(u))


class Walks:
    """The lattice of a batch's parts, with the share of every edge among those of its node."""

    def __init__(self, cut: pieces.Parts, vocabulary: pieces.Vocabulary, probability: np.ndarray):
        self.cut = cut
        self.edges = edges = pieces.lattice(vocabulary, cut.data, cut.starts)
        self.share = pieces.shares(edges, probability[edges.id])
        self.log_share = np.log(self.share)
        many = edges.many
        self.out = np.concatenate([[0], np.cumsum(many)])
        # By edge: its start has others too.
        self.others = np.repeat(many > 1, many)
        # By edge: the sum of the shares before it at its start.
        self.below = np.zeros(len(self.share))
        at, size = self.out[:-1], many
        for rank in range(1, int(many.max(initial=0))):
            more = np.flatnonzero(size > rank)
            at, size = at[more], size[more]
            self.below[at + rank] = self.below[at + (rank - 1)] + self.share[at + (rank - 1)]
        self.last = np.zeros(len(many) + 1, bool)
        self.last[edges.first[1:] - 1] = True
        # The last edge of each node, by node and by the edge that leads there; -1 at the end of a part.
        self.final = np.where(self.last[:-1], -1, self.out[1:] - 1)
        self.next = self.final[edges.end]

    def walk(self, node: np.ndarray, seed: np.ndarray, part: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray]:
        """Edges drawn from each start node to the end of its part, one walk after the other, and where each walk begins (and the last one ends)."""
        at = self.final[node]
        owner, step, taken, whose = np.flatnonzero(at >= 0), 0, [], []
        at, state = at[owner], _keyed(_WALK, seed, part, sample)[owner]
        while len(owner):
            u = _uniform(state, step)
            # Longer pieces are likelier: the last edge with no more than that before it, from the last one on.
            far = np.flatnonzero(self.below[at] > u)
            while len(far):
                back = at[far] - 1
                at[far] = back
                far = far[self.below[back] > u[far]]
            taken.append(at)
            whose.append(owner)
            step += 1
            at = self.next[at]
            on = np.flatnonzero(at >= 0)
            at, owner, state = at[on], owner[on], state[on]
        # A walk takes an edge at each step until it ends.
        size = np.bincount(np.concatenate([*whose, np.zeros(0, np.int64)]), minlength=len(node))
        begin = np.concatenate([[0], np.cumsum(size)])
        edge = np.empty(int(begin[-1]), np.int64)
        for step, (own, owner) in enumerate(zip(taken, whose, strict=True)):
            edge[begin[owner] + step] = own
        return edge, begin


def sampled(walks: Walks, seeds: np.ndarray, k: int):
    """For each sample: the texts that have one, their edges end to end and where each text's begin, log-probability, perturbed
    log-probability; and of each text the best perturbed value not taken (-inf if there is none)."""
    cut, edges = walks.cut, walks.edges
    texts = len(seeds)
    first_node = edges.first[cut.which]
    full = np.flatnonzero(np.diff(cut.first))
    found: list[dict] = []
    # Groups at places where a segmentation was already parted from: (sample, place) -> edges taken.
    taken: list[dict[int, list[int]]] = []
    best_value = np.full((k, texts), -np.inf)
    best_place = np.zeros((k, texts), np.int64)

    def settle(number: int) -> None:
        s = found[number]
        best_value[number] = -np.inf
        begin = s["begin"][:-1]
        if len(begin):
            best = np.maximum.reduceat(s["group"], begin)
            hit = np.flatnonzero(s["group"] == np.repeat(best, np.diff(s["begin"])))
            own = np.searchsorted(s["begin"], hit, "right") - 1
            chosen = np.full(len(begin), -1)
            chosen[own[::-1]] = hit[::-1]
            best_value[number, s["texts"]] = best
            best_place[number, s["texts"]] = chosen

    def add(number: int, which: np.ndarray, edge: np.ndarray, part: np.ndarray, begin: np.ndarray, top: np.ndarray, fresh: np.ndarray) -> None:
        """``fresh``: places of which the frontier group is new."""
        size = np.diff(begin)
        log = walks.log_share[edge]
        run = np.cumsum(log)
        before = run - log - np.repeat(run[begin[:-1]] - log[begin[:-1]], size)
        group = np.full(len(edge), -np.inf)
        at = np.flatnonzero(fresh & walks.others[edge])
        own = np.diff(np.searchsorted(at, begin))
        location = before[at] + np.log(np.maximum(1.0 - walks.share[edge[at]], 1e-300))
        u = _uniform(np.repeat(_keyed(_GROUP, seeds[which], number), own), at - np.repeat(begin[:-1], own))
        group[at] = _below(location, np.repeat(top, own), u)
        found.append({"texts": which, "edge": edge, "part": part, "begin": begin, "top": top, "before": before, "group": group, "log": run[begin[1:] - 1] - run[begin[:-1]] + log[begin[:-1]]})
        taken.append({})
        settle(number)

    for number in range(k):
        if number == 0:
            which = full
            if not len(which):
                break
            part = np.arange(len(cut.which))
            text = np.repeat(np.arange(texts), np.diff(cut.first))
            edge, cuts = walks.walk(first_node, seeds[text], part - cut.first[text], 0)
            begin = np.append(cuts[cut.first[which]], len(edge))
            top = -np.log(-np.log(_uniform(_keyed(_ROOT, seeds[which]))))
            add(0, which, edge, np.repeat(part, np.diff(cuts)), begin, top, np.ones(len(edge), bool))
            continue
        # The best group of each text; a new segmentation parts there.
        source = best_value[:number].argmax(axis=0)
        value = best_value[source, np.arange(texts)]
        which = np.flatnonzero(value > -np.inf)
        if not len(which):
            break
        source_of, place_of = source[which], best_place[source[which], which]
        edge_of, part_of, begin_of, before_of = (np.empty(len(which), kind) for kind in (np.int64, np.int64, np.int64, np.float64))
        for number_ in np.unique(source_of).tolist():
            s, at = found[number_], np.flatnonzero(source_of == number_)
            place = place_of[at]
            edge_of[at], part_of[at], before_of[at] = s["edge"][place], s["part"][place], s["before"][place]
            begin_of[at] = s["begin"][np.searchsorted(s["texts"], which[at])]
        low_of = walks.out[edges.start[edge_of]]
        high_of = walks.out[edges.start[edge_of] + 1]
        chance = _uniform(_keyed(_CHOICE, seeds[which], number))
        choices, left = [], []
        for source_, place, edge, low, high, u in zip(*(x.tolist() for x in (source_of, place_of, edge_of, low_of, high_of, chance)), strict=True):
            gone = taken[source_].setdefault(place, [edge])
            options = [e for e in range(low, high) if e not in gone]
            every = walks.share[low:high].tolist()
            share = [every[e - low] for e in options]
            sums = list(accumulate(share))
            pick = min(bisect_right(sums, u * sums[-1]), len(options) - 1)
            gone.append(options[pick])
            choices.append(options[pick])
            # Added up in order, as the sums of the shares are.
            left.append(reduce(plus, share[:pick] + share[pick + 1 :], 0.0) if len(share) > 1 else -1.0)
        choices, left = np.array(choices), np.array(left)
        location = before_of + np.log(np.maximum(left, 1e-300))
        again = _uniform(_keyed(_GROUP, seeds[which], number), 1 << 40)
        group = np.where(left < 0, -np.inf, _below(location, value[which], again))
        for number_ in np.unique(source_of).tolist():
            at = source_of == number_
            found[number_]["group"][place_of[at]] = group[at]
        nodes, node_part = edges.end[choices], part_of
        kept = [(found[n], a, place) for n, a, place in zip(source_of.tolist(), begin_of.tolist(), place_of.tolist(), strict=True)]
        for number_ in set(source[which].tolist()):
            settle(number_)
        # Free walks: the rest of the part, then all later parts.
        later = cut.first[which + 1] - node_part
        size = np.cumsum(later) - later
        part = np.repeat(node_part - size, later) + np.arange(int(later.sum()))
        start = first_node[part]
        start[size] = nodes
        text = np.repeat(which, later)
        edge, begin = walks.walk(start, seeds[text], part - cut.first[text], number)
        own_part = np.repeat(part, np.diff(begin))
        cuts = np.append(begin[size], len(edge)).tolist()
        pieces_, parts_, fresh, sizes = [], [], [], []
        for j, (s, a, place) in enumerate(kept):
            p, q = cuts[j], cuts[j + 1]
            pieces_ += [s["edge"][a:place], choices[j : j + 1], edge[p:q]]
            parts_ += [s["part"][a:place], node_part[j : j + 1], own_part[p:q]]
            fresh += [np.zeros(place - a + 1, bool), np.ones(q - p, bool)]
            sizes.append(place - a + 1 + q - p)
        begin = np.concatenate([[0], np.cumsum(sizes)])
        add(number, which, np.concatenate(pieces_).astype(np.int64), np.concatenate(parts_).astype(np.int64), begin, value[which], np.concatenate(fresh))
    rest = best_value[: len(found)].max(axis=0) if found else np.full(texts, -np.inf)
    return found, rest


def _inclusion(log: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Log of the chance that a segmentation's perturbed value is above ``rest``; 0 where nothing was left out."""
    with np.errstate(over="ignore", under="ignore", divide="ignore"):
        mean = np.exp(log - rest)
        # For small means the chance is the mean itself.
        return np.where(np.isneginf(rest), 0.0, np.where(mean < 1e-12, log - rest, np.log(-np.expm1(-mean))))


def segmentations(docs: DataFrame, vocabulary_path: str, k: int = SAMPLES, alpha: float = ALPHA, id: str = "doc_id", text: str = "text", ids: bool = True) -> DataFrame:
    """Up to ``k`` distinct sampled segmentations of every text of ``docs``.

    Rows: ``id``, ``sample`` (from 1, in order of ``perturbed``), ``n_pieces``, ``log_prob``, ``perturbed``
    (log-probability plus Gumbel noise), ``log_inclusion`` (of the chance to be among the samples, given the
    best value left out), ``round_trip`` (decoding gives the text), ``ids_sha256`` (of the ids as
    32-bit little-endian numbers) and, if asked for, ``ids``. A text with fewer
    segmentations gives them all; an empty or null text has one, without pieces. Rows are told apart by
    id: rows with equal id and text give equal samples. Other columns are not read.
    """
    vocabulary = pieces.load(vocabulary_path)
    probability = weights(vocabulary, alpha)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for part in rows.texts(batches, text, PART_BYTES):
            seeds = part.column("_seed").to_numpy(zero_copy_only=False).view(_U)
            walks = Walks(pieces.parts(part.data, part.starts), vocabulary, probability)
            found, rest = sampled(walks, seeds, k)
            empty = np.flatnonzero(np.diff(part.starts) == 0)
            none = hashlib.sha256(b"").hexdigest()
            if len(empty):
                n = len(empty)
                columns = [pa.array(np.ones(n, np.int32)), pa.array(np.zeros(n, np.int64)), *[pa.array(np.zeros(n))] * 3, pa.array([True] * n), pa.array([none] * n)]
                yield _rows(part, empty, columns + [pa.array([[]] * n, pa.list_(pa.int32()))] * ids, id, ids)
            for number, s in enumerate(found):
                which, begin = s["texts"], s["begin"]
                all_ids = walks.edges.id[s["edge"]].astype("<i4")
                same, digests = [], []
                spelled, ends = pieces.spelled(vocabulary, all_ids)
                ends = ends[begin].tolist()
                # Each text has a space in front.
                for t, a, b, p, q in zip(which.tolist(), begin[:-1].tolist(), begin[1:].tolist(), ends[:-1], ends[1:], strict=True):
                    same.append(spelled[p + 1 : q].tobytes() == part.text(t))
                    digests.append(hashlib.sha256(all_ids[a:b]).hexdigest())
                columns = [
                    pa.array(np.full(len(which), number + 1, np.int32)), pa.array(np.diff(begin)), pa.array(s["log"]), pa.array(s["top"]),
                    pa.array(_inclusion(s["log"], rest[which])), pa.array(same), pa.array(digests),
                ]
                if ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(all_ids)))
                yield _rows(part, which, columns, id, ids)

    added = "sample int, n_pieces bigint, log_prob double, perturbed double, log_inclusion double, round_trip boolean, ids_sha256 string" + ", ids array<int>" * ids
    seeded = docs.select(id, text).withColumn("_seed", F.xxhash64(id))
    return seeded.mapInArrow(draw, rows.schema(docs, [id], added))


def _rows(part: rows.Texts, which: np.ndarray, columns: list, id: str, ids: bool) -> pa.RecordBatch:
    names = [id, "sample", "n_pieces", "log_prob", "perturbed", "log_inclusion", "round_trip", "ids_sha256"] + ["ids"] * ids
    return pa.RecordBatch.from_arrays([part.column(id).take(pa.array(which)), *columns], names=names)


def decode(vocabulary: pieces.Vocabulary, ids: list[int]) -> str:
    """The text that a list of piece ids spells; inverse of every segmentation."""
    return pieces.decoded(vocabulary, np.asarray(ids, np.int64)).decode("utf-8", "replace")
