"""Language of texts by unigram piece models over one fixed vocabulary.

Each language has probabilities of the pieces of a public SentencePiece vocabulary. A
text's likelihood is the sum over all its segmentations, found part by part by the
forward algorithm; the posterior over the languages, all equally likely before, gives
language and score. Piece probabilities are expected counts (forward-backward) in a
bounded sample of the labelled texts, smoothed with those of all languages together.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pieces, rows

# Labelled texts used for training: about so many, as many of each language, chosen by the hash of their text.
SAMPLE_ROWS = 6000
MAX_LANGUAGES = 500
# Bytes of text whose lattice is held at a time, for up to four languages; less for more.
LATTICE_BYTES = 1 << 19
# Bytes of likelihoods of parts that a task keeps for its next texts.
KEPT_BYTES = 1 << 24
UNKNOWN = "und"
_FLOOR = 1e-6


class Model(NamedTuple):
    vocabulary: pieces.Vocabulary
    languages: list[str]
    probability: np.ndarray  # languages by pieces


def _prior(vocabulary: pieces.Vocabulary) -> np.ndarray:
    """Probabilities by Zipf's law from the ranks of the vocabulary."""
    share = 1.0 / (vocabulary.rank + 10.0)
    return share / share.sum()


def train(labelled: DataFrame, vocabulary_path: str, sample_rows: int = SAMPLE_ROWS, id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Piece probabilities from about ``sample_rows`` of the rows with a text and a language; of a rare language, from all of its rows."""
    vocabulary = pieces.load(vocabulary_path)
    known = labelled.select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).dropna(subset=["text", "lang"])
    prior = _prior(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for part in rows.texts(batches, "text", LATTICE_BYTES):
            langs = np.array(part.column("lang").to_pylist(), object)
            for name in sorted(set(langs.tolist())):
                chosen = np.flatnonzero(langs == name)
                size = part.starts[chosen + 1] - part.starts[chosen]
                data = np.concatenate([part.data[part.starts[i] : part.starts[i + 1]] for i in chosen])
                cut = pieces.parts(data, np.concatenate([[0], np.cumsum(size)]))
                if not len(cut.which):
                    continue
                edges = pieces.lattice(vocabulary, cut.data, cut.starts)
                nodes = np.diff(edges.first)
                times = np.bincount(cut.which, minlength=len(nodes))
                share = pieces.expected(edges, prior[edges.id]) * np.repeat(times, nodes)[edges.start]
                totals[name] = totals.get(name, 0) + np.bincount(edges.id, share, minlength=vocabulary.size)
        for name, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(total[used], pa.float64())],
                names=["lang", "piece", "n"],
            )

    counted = rows.sampled_by(known, "text", "lang", sample_rows, MAX_LANGUAGES).mapInArrow(count, "lang string, piece int, n double")
    # At most languages x pieces rows.
    found = counted.groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r.lang for r in found})
    counts = np.zeros((vocabulary.size, len(languages)))
    for r in found:
        counts[r.piece, languages.index(r.lang)] = r.n
    share = counts / np.maximum(counts.sum(axis=0), 1.0)
    common = share.mean(axis=1, keepdims=True) if languages else share
    probability = np.maximum(0.98 * share + 0.01 * common + 0.01 * prior[:, None], _FLOOR)
    return Model(vocabulary, languages, np.ascontiguousarray(probability.T))


def _letters(part: rows.Texts) -> np.ndarray:
    """Texts with a letter."""
    low = part.data | 0x20
    ascii_ = np.concatenate([[0], np.cumsum((low >= 0x61) & (low <= 0x7A) & (part.data < 0x80))])
    some = ascii_[part.starts[1:]] > ascii_[part.starts[:-1]]
    for i in np.flatnonzero(~some):
        some[i] = any(map(str.isalpha, part.text(i).decode("utf-8", "replace")))
    return some


def _lattice_bytes(languages: int) -> int:
    """Sums are kept for each language, so that more of them leave room for less text."""
    return max(1 << 14, 4 * LATTICE_BYTES // max(4, languages))


class _Scorer:
    """Log-likelihoods of parts, those of the latest parts kept by their hash."""

    def __init__(self, model: Model):
        self.model = model
        self.room = _lattice_bytes(len(model.languages))
        self.most = KEPT_BYTES // (8 * (1 + len(model.languages)))
        self.known, self.values = np.zeros(0, np.uint64), np.zeros((0, len(model.languages)))

    def __call__(self, cut: pieces.Parts) -> np.ndarray:
        """Of each distinct part and language."""
        at = np.searchsorted(self.known, cut.hash)
        old = at < len(self.known)
        old[old] = self.known[at[old]] == cut.hash[old]
        out = np.empty((len(cut.hash), self.values.shape[1]))
        out[old] = self.values[at[old]]
        new = np.flatnonzero(~old)
        if len(new):
            # A few parts at a time, also of one very long text.
            block = np.cumsum(np.diff(cut.starts)[new]) // self.room
            for some in np.split(new, np.flatnonzero(np.diff(block)) + 1):
                size = np.diff(cut.starts)[some]
                own = np.concatenate([[0], np.cumsum(size)])
                data = cut.data[np.arange(own[-1]) + np.repeat(cut.starts[some] - own[:-1], size)]
                edges = pieces.lattice(self.model.vocabulary, data, own)
                out[some] = pieces.log_totals(edges, self.model.probability[:, edges.id]).T
            if len(self.known) > self.most:
                self.known, self.values = self.known[:0], self.values[:0]
            known = np.concatenate([self.known, cut.hash[new]])
            order = np.argsort(known)
            self.known, self.values = known[order], np.concatenate([self.values, out[new]])[order]
        return out


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the posterior of that language.

    A null text, or one without a letter, is ``und`` with score 0, as is every text if
    nothing was learnt. Repeated rows are judged alike; columns of those names are replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    names = np.array([*model.languages, UNKNOWN], object)
    many = len(model.languages)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        for part in rows.texts(batches, text, scorer.room):
            total = np.zeros((len(part), many))
            cut = pieces.parts(part.data, part.starts)
            if many and len(cut.which):
                of_part = scorer(cut)[cut.which]
                full = np.flatnonzero(np.diff(cut.first))
                total[full] = np.add.reduceat(of_part, cut.first[full])
            best = total.argmax(axis=1) if many else np.zeros(len(part), int)
            unsure = ~_letters(part) | part.missing | (many == 0)
            top = np.where(unsure, many, best)
            value = np.zeros(len(part))
            if many:
                share = np.exp(total - total.max(axis=1, keepdims=True))
                value = np.where(unsure, 0.0, share.max(axis=1) / share.sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in kept], pa.array(names[top].tolist(), pa.string()), pa.array(value, pa.float64())],
                names=[*kept, "lang_pred", "score"],
            )

    return docs.select(*kept).mapInArrow(score, rows.schema(docs, kept, "lang_pred string, score double"))
