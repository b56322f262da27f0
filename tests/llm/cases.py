"""Small tables that every operator of the package must take."""

import random

LONG = " ".join(f"word{i % 700} der the la" for i in range(8000))


def texts():
    random.seed(3)
    syllables = ["the", "and", "tion", "er", "st", "ou", "la", "der", "é", "ñ"]
    line = lambda n: " ".join("".join(random.choices(syllables, k=random.randint(1, 3))) for _ in range(n))
    base = [line(60) for _ in range(8)]
    out = []
    for i in range(60):
        words = base[i % 8].split()
        if i >= 8:
            words[random.randrange(60)] = f"new{i}"
        if i % 7 == 3:
            words = words[20:50] + line(40).split()
        out.append((i, " ".join(words)))
    out += [(100, None), (101, ""), (102, " \n\t "), (103, "one"), (104, "One two three four"), (105, "one two three four"), (106, LONG), (107, LONG + " end"), (108, "é" * 70), (109, "a\x00b ▁ 🙂 \r\n x")]
    return out


# Names that operators use themselves.
_EXTRA = ("score", "host", "path", "n_words", "doc", "node", "component", "batch", "block", "kept", "lang_pred", "predicted", "spans", "labels", "_words", "sample", "ids", "answers")


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in _EXTRA)
    full = [(i, t, "en" if i is None or i % 2 else "de", None, len(t or ""), *["x"] * len(_EXTRA)) for i, t in rows]
    return spark.createDataFrame(full, schema).repartition(3)


def odd(spark):
    """The small table, with a repeated row and rows without an id."""
    rows = texts()
    return documents(spark, [*rows, rows[5], (None, rows[6][1]), (None, None), (None, "alone here without any friend at all")])
