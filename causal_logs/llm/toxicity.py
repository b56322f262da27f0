"""Toxicity of texts whose words may be disguised: noisy-channel restoring, then scoring.

Words with digits or signs among or for their letters, stretched letters or spaced-out letters
are read as a lattice: every run of a character may stand for some letters, for nothing
or for a word end, at a cost; so may every gap in a run of spaced letters, neighbours like "a" included. The best path under a character trigram model (Viterbi, states
are the last two letters) is the restored text; of spaced letters, the words of the next best paths count as well. Other words have one path and
stay. The trigram model is counted over all texts; labels are not used for it.

Scoring: words and beginnings of words that labelled toxic texts have far more often
(log-likelihood ratio) than others carry a cautious estimate of how often a text with them is toxic;
a text's score is the chance that at least one of its words is, each word taken at its strongest sign.
"""

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import rows

# Labelled texts used for training: about so many, chosen by the hash of their id.
SAMPLE_ROWS = 8000
# Signs kept, the strongest first; the least log-likelihood ratio of a sign and the least (cautious) share of toxic texts with it.
MAX_SIGNS = 5000
LEAST_RATIO = 20.0
LEAST_SHARE = 0.6
PREFIXES = range(3, 9)
_END = "$"

# What a character may stand for besides itself.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
# Put between letters to hide a word, and marks that part words anyway.
_HIDING, _PARTING = "*.-_~'^", "/\\,:;=#%&?\"()[]{}<>"
_PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”‘’…–—¡¿"
# Two or more letters, digits or signs that stand apart, whatever parts them. A sign at either end belongs to no other word.
_SIGNS = "".join(re.escape(c) for c in LEET if not c.isdigit())
_ALONE = r"(?<![^\W_])([^\W_])\{}*+(?![^\W_])"
_GAP = re.compile(rf"(?:[^\w{_SIGNS}]|_)+")
_SPACED = re.compile(rf"(?:{_ALONE.format(1)}|(?<!\S)[{_SIGNS}])(?:(?:[^\w{_SIGNS}]|_)*+(?:{_ALONE.format(2)}|[{_SIGNS}]))+(?:(?<=[^\W_])|(?!\S))")
_AGAIN = re.compile(r"([^\W\d_])(?: ++\1){2,}")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")
_COST_LEET, _COST_DROP, _COST_DROP_INSIDE, _COST_END = 1.0, 2.5, 7.0, 4.0
# Of a gap between spaced letters: another reading than its width suggests.
_COST_GAP = 1.0
# Spaced letters keep so many readings at most that cost this much more than the best: a trigram model alone parts words badly.
_READINGS, _SLACK = 16, 6.0

# Symbols of the character model: word end, a to z, any other letter.
_ENDS, _OTHER, _SYMBOLS = 0, 27, 28


class Channel(NamedTuple):
    """Costs (negative log-probabilities) of a symbol after two others."""

    cost: np.ndarray


def _symbols(data: np.ndarray) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[97:123] = np.arange(1, 27)
    table[65:91] = np.arange(1, 27)
    table[128:] = _OTHER
    return table[data]


def train_channel(docs: DataFrame, text: str = "text") -> Channel:
    """The trigram model of the letters of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SYMBOLS**3, np.int64)
        for part in rows.texts(batches, "text"):
            s = _symbols(part.data)
            if not len(s):
                continue
            # Bytes of one letter after another, signs and spaces as one end; texts apart.
            s[part.starts[1:-1][part.starts[1:-1] < len(s)]] = _ENDS
            s = np.concatenate([[0, 0], s[(s != _ENDS) | np.append(True, s[:-1] != _ENDS)], [0]])
            total += np.bincount((s[:-2] * _SYMBOLS + s[1:-1]) * _SYMBOLS + s[2:], minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["gram", "n"])

    counted = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    grams = np.zeros(_SYMBOLS**3)
    for r in counted.collect():  # at most 28 ** 3 rows
        grams[r.gram] = r.n
    three = grams.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    one = (one + 1) / (one.sum() + _SYMBOLS)
    two = (two + 5 * one) / (two.sum(axis=1, keepdims=True) + 5)
    return Channel(-np.log((three + 5 * two) / (three.sum(axis=2, keepdims=True) + 5)))


def _symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else _OTHER if c.isalpha() else _ENDS


def _options(c: str, run: int, inside: bool, letterless: bool) -> list[tuple[str, float]]:
    """What a run of one character may stand for, ``inside`` a token or at its ends; digits of a ``letterless`` token are letters."""
    if c == " ":
        # A gap wider than others is likelier a word end.
        return [("", 0.0), (" ", _COST_GAP)] if run == 1 else [(" ", 0.0), ("", _COST_GAP)]
    if c.isalpha():
        if run == 1:
            return [(c, 0.0)]
        return [(c * 2, 0.0), (c, 1.5)] if run == 2 else [(c, 0.5), (c * 2, 1.0)]
    if c in _HIDING:
        return [("", 0.5), (" ", 2.0)]
    if c in _PARTING:
        return [(" ", 0.0), ("", 4.0)]
    if letterless and (c.isdigit() or c in "@$"):
        return [(x * n, _COST_LEET * n) for x in LEET.get(c, "") for n in ([run] if run <= 2 else [1, 2])] or [("", 0.0)]
    out = [(x * n, _COST_LEET + (n - 1)) for x in LEET.get(c, "") for n in range(1, min(run, 2) + 1)]
    return [*out, ("", _COST_DROP_INSIDE if inside else _COST_DROP), (" ", _COST_END)]


def readings(token: str, channel: Channel, most: int = _READINGS, slack: float = _SLACK) -> list[str]:
    """The likeliest plain texts behind a lower-case token, or behind spaced letters (see ``_gaps``), the best first; words are parted by spaces."""
    cost, letterless = channel.cost, not any(map(str.isalpha, token))
    states: dict[tuple[int, int], list[tuple[float, tuple]]] = {(0, 0): [(0.0, ())]}
    at = 0
    while at < len(token):
        end = at + 1
        while end < len(token) and token[end] == token[at]:
            end += 1
        new: dict[tuple[int, int], list[tuple[float, tuple]]] = {}
        for option, price in _options(token[at], end - at, 0 < at and end < len(token), letterless):
            symbols = [_symbol(c) for c in option]
            for (a, b), paths in states.items():
                more = price
                for s in symbols:
                    if s == _ENDS == b:
                        continue
                    more += cost[a, b, s]
                    a, b = b, s
                new.setdefault((a, b), []).extend((total + more, (path, option) if option else path) for total, path in paths)
        for state, paths in new.items():
            if len(paths) > most:
                new[state] = sorted(paths, key=lambda p: p[0])[:most]
        states, at = new, end
    found = [(total + (cost[a, b, _ENDS] if b != _ENDS else 0.0), path) for (a, b), paths in states.items() for total, path in paths]
    found.sort(key=lambda p: p[0])
    out = []
    for total, path in found[:most]:
        if total > found[0][0] + slack:
            break
        parts = []
        while path:
            path, option = path
            parts.append(option)
        out.append(" ".join("".join(reversed(parts)).split()))
    return out


def restore(token: str, channel: Channel) -> str:
    """The likeliest of the ``readings``."""
    return readings(token, channel, 1)[0]


def _gaps(spaced: str) -> str:
    """Spaced letters with one space for each gap, two for those wider than the narrowest; none in a stretched letter."""
    narrow = min((len(gap) for gap in _GAP.findall(spaced)), default=0)
    gaps = _GAP.sub(lambda gap: " " if len(gap[0]) == narrow else "  ", spaced)
    return _AGAIN.sub(lambda m: m[1] * 3, gaps)


class Restorer:
    """Plain words of texts; the last tokens' restored forms are kept."""

    KEPT = 50_000
    # Longer runs of spaced letters are not kept.
    KEPT_CHARS = 200

    def __init__(self, channel: Channel):
        self.channel, self.known = channel, {}

    def _restored(self, token: str) -> list[str]:
        found = self.known.get(token)
        if found is None:
            found = restore(token, self.channel).split()
            self._keep(token, found)
        return found

    def _keep(self, token: str, found: list[str] | set[str]) -> None:
        if len(token) <= self.KEPT_CHARS:
            if len(self.known) >= self.KEPT:
                self.known.clear()
            self.known[token] = found

    def _parted(self, spaced: str) -> set[str]:
        """Words of all readings of spaced letters, and of them as one word."""
        gaps = _gaps(spaced)
        found = self.known.get(gaps)
        if found is None:
            whole = gaps.replace(" ", "")
            found = {whole, *self._restored(whole)} if whole.isalpha() else set(self._restored(whole))
            found.update(*(r.split() for r in readings(gaps, self.channel)))
            self._keep(gaps, found)
        return found

    def words(self, text: str) -> set[str]:
        """Distinct words of a text, with disguised ones restored."""
        low = text.lower()
        plain, stretched = set(), _STRETCHED.search(low) is not None
        for word in set(low.split()):
            if not word.isalpha():
                bare = word.strip(_PUNCTUATION)
                if not bare.isalpha():
                    if any(map(str.isalpha, word)) or (len(word) > 1 and any(c in LEET for c in word)):
                        plain.update(self._restored(word.lstrip("\"'([{<").rstrip("\"')]}>.,;:?*%&#")))
                    continue
                # Signs at the ends may stand for letters.
                if len(word) <= len(bare) + 2 and (word[0] in "@$" or word[-1] in "@$"):
                    plain.update(self._restored(word))
                word = bare
            plain.add(word)
            if stretched and _STRETCHED.search(word):
                plain.update(self._restored(word))
        for spaced in _SPACED.finditer(low):
            plain.update(self._parted(spaced[0]))
        return plain


def restored_text(text: str, channel: Channel) -> str:
    """A text with its disguised words restored (in lower case), for reading; tokens without letters stay."""
    tokens = []
    spaced = _SPACED.sub(lambda m: restore(_gaps(m[0]), channel), text.lower())
    for token in spaced.split():
        bare = token.strip(_PUNCTUATION)
        clean = (bare.isalpha() and not _STRETCHED.search(bare)) or not any(map(str.isalpha, token))
        tokens.append(token if clean else restore(token, channel))
    return " ".join(tokens)


def _signs(word: str) -> list[str]:
    return [word[:n] for n in PREFIXES if n <= len(word)] + [word + _END]


class Model(NamedTuple):
    channel: Channel
    signs: dict[str, float]
    base: float


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Learn from the texts of about ``sample_rows`` of the ids in ``labels`` (id, 0/1 label); the character model from all ``docs``.

    The sample of ids is small by construction and is broadcast, so no text is shuffled.
    """
    channel = train_channel(docs, text)
    chosen = rows.sampled(labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("label")).dropna(), "id", sample_rows)
    known = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).dropna().join(F.broadcast(chosen), "id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, counts = Restorer(channel), {}
        for part in rows.texts(batches, "text"):
            labels = part.column("label").to_pylist()
            for i, y in enumerate(labels):
                for word in restorer.words(part.text(i).decode("utf-8", "replace")) | {""}:
                    own = counts.setdefault(word, [0, 0])
                    own[0] += 1
                    own[1] += y == 1
            if len(counts) > 500_000:
                yield _counts(counts)
                counts = {}
        yield _counts(counts)

    counted = known.mapInArrow(count, "word string, n bigint, p bigint")
    # ``p`` of the ``n`` labelled texts with a word are toxic.
    counted = written(counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("p").alias("p")), "words")
    total = counted.where("word = ''").first()
    if total is None or not total.p or total.p == total.n:
        return Model(channel, {}, float(bool(total and total.p)))
    lengths = F.array(*[F.lit(k) for k in PREFIXES])
    begun = F.transform(F.filter(lengths, lambda k: k <= F.length("word")), lambda k: F.substring("word", F.lit(1), k))
    signs = counted.where("word <> ''").select(F.explode(F.concat(begun, F.array(F.concat("word", F.lit(_END))))).alias("sign"), "n", "p")
    # What a beginning says of words not seen: its counts without those of its commonest toxic word.
    signs = signs.groupBy("sign").agg(F.sum("n").alias("n"), F.sum("p").alias("p"), F.max(F.struct("p", "n")).alias("top"))
    whole = F.endswith(F.col("sign"), F.lit(_END))
    less = lambda name: F.when(whole, F.col(name)).otherwise(F.col(name) - F.col("top")[name])
    signs = signs.select("sign", less("n").cast("double").alias("n"), less("p").cast("double").alias("p")).where("p >= 3")
    n, p = float(total.n), float(total.p)
    part = lambda a, b: F.when(a > 0, a * F.log(a / b)).otherwise(0.0)
    have, toxic = F.col("n"), F.col("p")
    ratio = 2 * (part(toxic, have * p / n) + part(have - toxic, have * (n - p) / n))
    # Lower end of the Wilson interval.
    z2, share = F.lit(1.28**2), toxic / have
    low = (share + z2 / (2 * have) - F.sqrt(z2 * (share * (1 - share) / have + z2 / (4 * have * have)))) / (1 + z2 / have)
    strong = signs.select("sign", ratio.alias("ratio"), low.alias("low")).where((F.col("ratio") >= LEAST_RATIO) & (F.col("low") >= LEAST_SHARE))
    signs = {r.sign: r.low for r in strong.orderBy(F.desc("ratio"), "sign").limit(MAX_SIGNS).collect()}
    return Model(channel, signs, 0.0)


def _counts(counts: dict[str, list[int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), pa.array([a for a, _ in counts.values()], pa.int64()), pa.array([b for _, b in counts.values()], pa.int64())],
        names=["word", "n", "p"],
    )


def _score(words: set[str], model: Model, heads: set[str]) -> tuple[float, list[str]]:
    clean, seen = 1.0 - model.base, []
    for word in words:
        if word[:3] in heads:
            best = max((model.signs.get(s, 0.0) for s in _signs(word)), default=0.0)
            if best:
                clean *= 1.0 - best
                seen.append(word)
    return 1.0 - clean, sorted(seen)


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: likelier toxic), ``predicted`` (1 from 0.5 on) and ``toxic_words``, the restored
    words that carry the score.

    Null and empty texts have no words and score 0 (1 if all that was learnt from is toxic).
    Repeated rows are judged alike; columns of those names are replaced.
    """
    made = ["score", "predicted", "toxic_words"]
    kept = [c for c in docs.columns if c.lower() not in made]
    heads = {s.removesuffix(_END)[:3] for s in model.signs}

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model.channel)
        for part in rows.texts(batches, text):
            found = [_score(restorer.words(part.text(i).decode("utf-8", "replace")), model, heads) for i in range(len(part))]
            score = np.array([f[0] for f in found])
            columns = [pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array([f[1] for f in found], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *columns], names=[*kept, *made])

    return docs.select(*kept).mapInArrow(judge, rows.schema(docs, kept, "score double, predicted int, toxic_words array<string>"))
