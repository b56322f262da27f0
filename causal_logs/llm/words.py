"""Words of many texts as arrays of hashes."""

from typing import NamedTuple

import numpy as np

U64 = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finalizer of SplitMix64)."""
    x = np.asarray(x, U64)
    # A new array, and then in place.
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` odd 64-bit numbers that depend on ``seed`` and their place only."""
    return mixed(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


BYTES = stream(11, 256)

_ascii = np.arange(256, dtype=np.uint8)
LOWER = np.where((_ascii >= 65) & (_ascii <= 90), _ascii + 32, _ascii).astype(np.uint8)
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
# Bytes of the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text.
ALNUM = ((_ascii >= 0x30) & (_ascii <= 0x39)) | ((_ascii >= 0x61) & (_ascii <= 0x7A)) | (_ascii >= 0x80)


class Words(NamedTuple):
    """Words in text order: where they start and end, their hashes, and ``first[i]:first[i + 1]``, those of text i."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def spans(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of True that do not cross ``starts``: first places, ends, and the index of each text's first run."""
    n = len(inside)
    edge = np.empty(n + 1, bool)
    edge[0], edge[n] = True, True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:n])
    edge[starts] = True
    at = np.flatnonzero(edge)
    begin, end = at[:-1], at[1:]
    word = inside[begin] if n else np.zeros(0, bool)
    begin, end = begin[word], end[word]
    return begin, end, np.searchsorted(begin, starts)


def hashed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch ``data[start:end]``; the stretches are in order, apart and not empty."""
    if not len(start):
        return np.zeros(0, U64)
    size = end - start
    total = np.zeros(len(start), U64)
    longest = int(size.max())
    powers = stream(7, longest)
    if longest <= 64:
        # Place by place over the words that are long enough, longest first.
        order = np.argsort(-size.astype(np.int16), kind="stable")
        live = np.searchsorted(-size[order], -np.arange(1, longest + 1), "right")
        begin, out = start[order], np.zeros(len(start), U64)
        for place, many in enumerate(live):
            out[:many] += BYTES[data[begin[:many] + place]] * powers[place]
        total[order] = out
    else:
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        value = BYTES[data[np.repeat(start, size) + place]] * powers[place]
        total = np.add.reduceat(value, np.cumsum(size) - size)
    return mixed(total + size.astype(U64))


def words(data: np.ndarray, starts: np.ndarray, inside: np.ndarray) -> Words:
    """The words of lower-cased texts; ``inside`` tells for each byte value if it belongs to words."""
    begin, end, first = spans(inside[data], starts)
    return Words(begin, end, hashed(data, begin, end), first)


def shingled(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` values, by its first place."""
    out = np.zeros(max(0, len(values) - size + 1), U64)
    for k, factor in enumerate(stream(23, size)):
        out += values[k : len(values) - size + 1 + k] * factor
    return mixed(out + U64(size))
