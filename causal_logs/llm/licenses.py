"""License notices in texts: exact phrases, and short notices with a few edits.

A notice may differ from the text by some edits. Cut into one piece more than that,
at least one piece stands in the text unchanged (pigeonhole), so one pass of a
multi-pattern automaton over the pieces finds all candidate places; there the
bounded-error matching of the regex library verifies the notice and gives its span.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; matching
is done on the words with single spaces between them.
"""

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from . import rows
from .words import LOWER

# Exact phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Short notices as published, and their labels.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "under the terms of the gnu lesser general public license": "lgpl",
    "subject to the terms of the mozilla public license v 2 0": "mpl-2",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under a creative commons attribution noncommercial": "cc-by-nc",
    "licensed under a creative commons attribution 4 0 international license": "cc-by",
}
# One edit allowed for so many characters of a notice.
CHARS_PER_EDIT = 10

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = bytes(LOWER)


class _Notice(NamedTuple):
    label: str
    text: str
    edits: int
    pattern: object


def _notices(notices: dict[str, str], chars_per_edit: int):
    """The notices, and an automaton of their pieces that gives (notice, place of the piece's end)."""
    import ahocorasick
    import regex

    known, seeds = [], {}
    for text, label in notices.items():
        edits = len(text) // chars_per_edit
        known.append(_Notice(label, text, edits, regex.compile(f"(?b)(?<= )(?:{regex.escape(text)}){{e<={edits}}}(?= )")))
        cuts = [len(text) * k // (edits + 1) for k in range(edits + 2)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            seeds.setdefault(text[a:b], []).append((len(known) - 1, b))
    automaton = ahocorasick.Automaton()
    for seed, places in seeds.items():
        automaton.add_word(seed, places)
    if seeds:
        automaton.make_automaton()
    return known, automaton


def _fuzzy(text: str, known: list[_Notice], automaton) -> list[tuple[int, int, int, int]]:
    """(start, end, notice, edits) of the notices in ``text``, which has a space at both ends."""
    windows: dict[int, list[list[int]]] = {}
    for end, places in automaton.iter(text):
        for notice, until in places:
            edits = known[notice].edits
            start = end + 1 - until
            a, b = max(0, start - edits - 1), min(len(text), start + len(known[notice].text) + edits + 1)
            own = windows.setdefault(notice, [])
            if own and a <= own[-1][1] and a >= own[-1][0]:
                own[-1][1] = max(b, own[-1][1])
            else:
                own.append([a, b])
    found = []
    for notice, own in windows.items():
        pattern, last = known[notice].pattern, 0
        for a, b in sorted(own):
            at = max(a, last)
            while match := pattern.search(text, at, b):
                found.append((match.start(), match.end(), notice, sum(match.fuzzy_counts)))
                at = last = max(match.end(), match.start() + 1)
    return sorted(found)


def licenses(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES, chars_per_edit: int = CHARS_PER_EDIT, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each row of ``docs``: ``id``, ``n_words``, ``n_base`` (places of all phrases), ``first_word`` and ``last_word`` (their
    smallest and largest first word, from 0, else null), ``base_labels``, ``labels`` (arrays, sorted), ``score`` and
    ``spans`` (label, first word, number of words, edits) of the notices.

    ``score`` is 1 with a phrase, else the largest share of a found notice's characters
    that is unedited, else 0. A null text is empty. Phrases are of words as above;
    places overlap freely. Repeated rows are judged alike; other columns are not read.
    """
    wanted = [(f" {p} ".encode(), label) for p, label in phrases.items()]
    spans_type = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("n", pa.int64()), ("edits", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, automaton = _notices(notices, chars_per_edit)
        for part in rows.texts(batches, text):
            out = []
            for i in range(len(part)):
                words = _WORD.findall(part.text(i).translate(_LOWER))
                line = b" " + b" ".join(words) + b" "
                places, base = [], set()
                for phrase, label in wanted:
                    at, word, seen = line.find(phrase), 0, 0
                    while at >= 0:
                        base.add(label)
                        word, seen = word + line.count(b" ", seen, at), at
                        places.append(word)
                        at = line.find(phrase, at + 1)
                spans, score = [], 1.0 if places else 0.0
                # One character for each byte: places in the line are places in the text.
                for start, end, notice, edits in _fuzzy(line.decode("latin-1"), known, automaton) if known else []:
                    first = line.count(b" ", 0, start) - 1
                    spans.append((known[notice].label, first, line.count(b" ", start, end) + 1, edits))
                    score = max(score, 1.0 - edits / len(known[notice].text))
                labels = sorted(base | {s[0] for s in spans})
                out.append((len(words), len(places), min(places, default=None), max(places, default=None), sorted(base), labels, score, [dict(zip(("label", "word", "n", "edits"), s, strict=True)) for s in spans]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.float64(), spans_type]
            columns = [pa.array(list(c), kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)]
            names = [id, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
            yield pa.RecordBatch.from_arrays([part.column(id), *columns], names=names)

    added = (
        "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, labels array<string>, "
        "score double, spans array<struct<label:string,word:bigint,n:bigint,edits:int>>"
    )
    return docs.select(id, text).mapInArrow(scan, rows.schema(docs, [id], added))
