"""Language, toxicity, licenses and quality: single texts."""

import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import LONG, documents, odd, texts
from causal_logs.llm import language, licenses, pieces, quality, queries, toxicity
from causal_logs.llm.rows import held_out

_SPACE = re.compile(r"[^\x20\x09-\x0D]+")
_ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- quality ----------------------------------------------------------------


def _plain_counts(text):
    text = text or ""
    words = _SPACE.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)} if len(words) < 2000 else None
    lines = [x for x in text.split("\n") if _SPACE.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), None if covered is None else len(covered))


def test_quality_counts(spark):
    some = [(i, t) for i, t in texts() if len(t or "") < 5000] + [(200, "a b c a b c a b c"), (201, "x\nx\n \nx\r\ny #$%"), (202, "a a a a"), (203, "b b"), (204, "1 2 3 4 1 2 3")]
    got = {r[0]: tuple(r[1:]) for r in quality.quality(documents(spark, some)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()}
    assert got == {i: _plain_counts(t) for i, t in some}


def test_quality_rules(spark):
    found = quality.quality(odd(spark))
    assert found.count() == len(texts()) + 4
    by = {r.doc_id: r for r in found.collect()}
    assert by[100].failed[0] == "too_short" and by[101].base_failed and not by[102].kept
    assert by[106].n_words == len(LONG.split()) and by[106].base_failed and by[106]["component"] == "x"
    assert quality.quality(documents(spark, [])).count() == 0
    # Columns named like those it uses itself come back as they are.
    named = documents(spark).selectExpr("doc_id", "text", "'x' as _words", "'y' as _Lines", "'z' as __starts", "1 as symbols")
    assert {(r["_words"], r["_Lines"], r["__starts"], r.symbols) for r in quality.quality(named).collect()} == {("x", "y", "z", 1)}
    own = quality.quality(documents(spark), (quality.Rule("few", "n_words", low=3),))
    assert {r.doc_id for r in own.where("NOT kept").collect()} == {100, 101, 102, 103, 108}


# --- licenses ---------------------------------------------------------------


def test_licenses(spark):
    rows = [
        (1, "x Under THE MIT-License under the mit license"), (2, "Apache License, Version 2.0"), (3, "cc-by-nc cc by ncx"),
        (4, "Permission is hereby grantd, free of charge to any persn obtaining a copy of it"), (5, None), (6, ""), (7, LONG),
        (8, "this work is licensed under GNU general public licence version 3"), (9, "permission to go is hereby given"),
    ]
    by = {r.doc_id: r for r in licenses.licenses(documents(spark, rows)).collect()}
    assert (by[1].n_words, by[1].n_base, by[1].first_word, by[1].last_word, by[1].base_labels) == (9, 2, 1, 5, ["mit"])
    assert by[2].base_labels == ["apache-2"] and by[3].n_base == 1 and by[3].first_word == 0
    assert by[4].base_labels == [] and by[4].labels == ["mit"] and by[4].spans[0].edits == 2 and 0.9 < by[4].score < 1
    assert (by[4].spans[0].word, by[4].spans[0].n) == (0, 13)
    assert by[5].n_words == by[6].n_words == 0 and by[5].first_word is None and by[6].score == 0.0
    assert by[7].n_words == len(_ALNUM.findall(LONG.lower())) and by[8].labels == ["gpl"] and by[9].labels == []
    assert licenses.licenses(documents(spark, [])).count() == 0 and licenses.licenses(odd(spark)).count() == len(texts()) + 4


def test_fuzzy_search_finds_what_a_full_scan_finds():
    import random

    import regex

    random.seed(5)
    known, automaton = licenses._notices(licenses.NOTICES, licenses.CHARS_PER_EDIT)
    for n in known:
        for _ in range(15):
            text = list(n.text)
            for _ in range(random.randint(0, n.edits)):
                k = random.randrange(len(text))
                random.choice([lambda: text.pop(k), lambda: text.insert(k, "q"), lambda: text.__setitem__(k, "z")])()
            line = f" alpha beta {''.join(text).strip()} gamma "
            plain = any(regex.search(m.pattern, line) for m in known if m.label == n.label)
            assert plain == any(known[f[2]].label == n.label for f in licenses._fuzzy(line, known, automaton))


def _plain_licenses(text, phrases):
    """Phrases word by word."""
    words = _ALNUM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    found = [(i, label) for phrase, label in phrases.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    places = [i for i, _ in found]
    return len(words), len(found), min(places, default=None), max(places, default=None), sorted({label for _, label in found})


def test_license_phrases_like_a_plain_scan(spark):
    import random

    random.seed(8)
    phrases = licenses.PHRASES | {"mit": "short", "cc by nc cc by nc": "twice", "a b a": "overlapping"}
    parts = [*phrases, "under", "the mit", "MIT", "license", "cc", "by-nc", "a b", "é", "Éa", "nc cc", "a", ", ", "apache  license;version"]
    rows = [(300 + i, random.choice([" ", "-", "\n"]).join(random.choices(parts, k=random.randint(0, 30)))) for i in range(200)] + texts()
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.licenses(documents(spark, rows), phrases).collect()}
    assert got == {i: _plain_licenses(t, phrases) for i, t in rows}
    assert sum(g[1] > 2 for g in got.values()) > 50


# --- language ---------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(queries.VOCABULARY)


def _sum_of_segmentations(model, k, part):
    """By listing them all."""
    if not part:
        return 1.0
    total = 0.0
    known = {bytes(model.vocabulary.bytes[a:b]): i for i, (a, b) in enumerate(zip(model.vocabulary.starts[:-1], model.vocabulary.starts[1:], strict=True)) if b > a and i >= 259}
    for n in range(1, len(part) + 1):
        if part[:n] in known:
            total += model.probability[k, known[part[:n]]] * _sum_of_segmentations(model, k, part[n:])
    return total


def test_forward_sums_all_segmentations(vocabulary):
    model = language.Model(vocabulary, ["a", "b"], np.random.default_rng(1).random((2, vocabulary.size)))
    for text in (b"the", b"thent", b"a"):
        cut = pieces.parts(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        edges = pieces.lattice(vocabulary, cut.data, cut.starts)
        sums = pieces.forward(edges, model.probability[:, edges.id])[:, -1]
        back = pieces.backward(edges, model.probability[:, edges.id])[:, 0]
        plain = [_sum_of_segmentations(model, k, b" " + text) for k in range(2)]
        assert np.allclose(sums, plain) and np.allclose(back, plain)


@pytest.mark.parametrize("text", ["语言模型把所有的切分加起来" * 12, "a" + " " * 9 + "b" + " " * 40 + "c  d", "государственного " * 2 + "правительства" * 9, "https://example.com/" + "Zm9vYmFy" * 30, "one\ttwo\n" * 200, "the cat"])
def test_whole_lattice_of_long_parts_and_spaces(vocabulary, text):
    """Sums over all pieces at all places, by a plain loop in logarithms."""
    data = b" " + text.encode()
    model = language.Model(vocabulary, ["a", "b"], np.random.default_rng(1).random((2, vocabulary.size)) / 100 + 1e-6)
    known = {bytes(vocabulary.bytes[a:b]): i for i, (a, b) in reversed(list(enumerate(zip(vocabulary.starts[:-1], vocabulary.starts[1:], strict=True)))) if b > a and i >= 259}
    edges, at = [], 0
    while at < len(data):
        width = len(data[at : at + 4].decode("utf-8", "ignore")[0].encode())
        ends = [(n, known[data[at : at + n]]) for n in range(1, max(map(len, known)) + 1) if at + n <= len(data) and data[at : at + n] in known]
        edges += [(at, at + n, i) for n, i in ends]
        if not any(n == width for n, _ in ends):
            edges += [(at + k, at + k + 1, vocabulary.first_byte + data[at + k]) for k in range(width)]
        at += width
    want = np.full((2, len(data) + 1), -np.inf)
    want[:, 0] = 0
    for a, b, i in sorted(edges):
        want[:, b] = np.logaddexp(want[:, b], want[:, a] + np.log(model.probability[:, i]))
    raw = np.frombuffer(data[1:], np.uint8)
    cut = pieces.parts(raw, np.array([0, len(raw)]))
    assert np.allclose(language._Scorer(model)(cut)[cut.which].sum(axis=0), want[:, -1])
    lattice = pieces.lattice(vocabulary, cut.data, cut.starts)
    share, chance = pieces.shares(lattice, model.probability[0, lattice.id]), pieces.expected(lattice, model.probability[0, lattice.id])
    out = np.bincount(lattice.start, share)
    assert np.allclose(out[out > 0], 1) and np.allclose(np.bincount(lattice.start, chance)[lattice.first[:-1]], 1)
    assert len(lattice.id) <= len(edges) and set(lattice.id.tolist()) == {i for _, _, i in edges}


def test_language_edges(spark):
    model = queries.language_model(documents(spark))
    assert model.languages == ["de", "en"]
    by = {r.doc_id: r for r in language.predict(odd(spark), model).collect() if r.doc_id is not None}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (100, 101, 102))
    assert by[108].lang_pred in ("de", "en") and by[106].score >= 0.5 and by[5]["component"] == "x"
    none = language.train(documents(spark, []), queries.VOCABULARY)
    assert {r.lang_pred for r in language.predict(documents(spark), none).collect()} == {"und"}
    assert language.predict(documents(spark, []), model).count() == 0


def test_language_held_out(spark):
    found = queries.op10_language_id(spark, "/root/testdata/sf0.001").join(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "doc_id")
    right = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.9


# --- toxicity ---------------------------------------------------------------


def test_restoring(spark):
    docs = spark.createDataFrame([(i, f"you are an idiot and a moron said the stupid loser number {i} for the pathetic scum") for i in range(20)], "doc_id int, text string")
    channel = toxicity.train_channel(docs)
    for hidden, plain in [("idiooot", "idiot"), ("m0r0n", "moron"), ("s.c.u.m", "scum"), ("p@thetic", "pathetic"), ("l0s3r", "loser"), ("stup1d", "stupid"), ("the", "the")]:
        assert toxicity.restore(hidden, channel) == plain
    assert {"idiot", "moron"} <= toxicity.Restorer(channel).words("such an i d i o t, m*o*r*o*n!!")
    assert toxicity.restored_text("A M0R0N, you", channel) == "a moron you"


@pytest.mark.parametrize("hidden, plain", [
    ("you are a m o r o n", "moron"), ("a i d i o t", "idiot"), ("I i d i o t", "idiot"), ("s c u m a", "scum"), ("i d i o t m o r o n", "idiot moron"),
    ("b @ s t a r d", "bastard"), ("m  o  r  o  n", "moron"), ("m, o,\nr, o, n", "moron"), ("i d i o o o t!", "idiot"), ("a s s", "ass"), ("455", "ass"), ("@$$", "ass"), ("5417", "salt"),
])
def test_spaced_letters_beside_others(spark, hidden, plain):
    docs = spark.createDataFrame([(i, f"you are an idiot and a moron said the stupid loser number {i} for the pathetic scum, an ass and a bastard with salt") for i in range(20)], "doc_id int, text string")
    restorer = toxicity.Restorer(toxicity.train_channel(docs))
    assert set(plain.split()) <= restorer.words(hidden)
    assert restorer.words("what, I (think) is 7 + x") >= {"what", "i", "think", "is"} and "imoron" not in restorer.words("I moron")


def _all_readings(token, channel):
    """(cost, text) of every way to read a token, the cheapest first."""
    runs = [m[0] for m in re.finditer(r"(?s)(.)\1*", token)]
    letterless = not any(map(str.isalpha, token))
    options = [toxicity._options(r[0], len(r), 0 < i and i + 1 < len(runs), letterless) for i, r in enumerate(runs)]
    found = []
    for chosen in itertools.product(*options):
        cost, before = 0.0, [0, 0]
        for symbol in [toxicity._symbol(c) for option, _ in chosen for c in option]:
            if symbol or before[-1]:
                cost += channel.cost[before[-2], before[-1], symbol]
                before.append(symbol)
        if before[-1]:
            cost += channel.cost[before[-2], before[-1], 0]
        found.append((cost + sum(price for _, price in chosen), " ".join("".join(option for option, _ in chosen).split())))
    return sorted(found)


@pytest.mark.parametrize("token", ["1d10t", "m0r0n", "s.c.u.m", "id1ooo7", "p@th3t1c", "aa55", "455", "i d i o t", "a  s s", "l0$3r!", "x-1/2", "ssttuu", "é1é"])
def test_readings_are_the_cheapest_of_all(spark, token):
    docs = spark.createDataFrame([(i, f"you are an idiot and a moron said the stupid loser number {i} for the pathetic scum, an ass") for i in range(20)], "doc_id int, text string")
    channel = toxicity.train_channel(docs)
    every = _all_readings(token, channel)
    cost = {}
    for price, reading in every:
        cost.setdefault(reading, price)
    for most, slack in ((1, 6.0), (16, 6.0), (4, 100.0)):
        got = toxicity.readings(token, channel, most, slack)
        best = [(price, reading) for price, reading in every[:most] if price <= every[0][0] + slack]
        assert len(got) == len(best) and got[0] in {reading for price, reading in every if price < every[0][0] + 1e-9}
        # One reading may be reached at several costs, and ties may stand in any order.
        edge = best[-1][0] - 1e-9
        assert sorted(r for r in got if cost[r] < edge) == sorted(r for _, r in best if cost[r] < edge)


def test_scores_like_a_plain_sum():
    model = toxicity.Model(None, {"idi": 0.7, "idiot$": 0.9, "scu": 0.8, "as$": 0.6, "x$": 0.99}, 0.1)
    heads = {s.removesuffix("$")[:3] for s in model.signs}
    for words in ([], ["idiot"], ["idiotic", "scum"], ["as", "ass", "asset"], ["x", "xx"], ["idiot", "idi", "scu", "as", "x", "plain"]):
        clean = 0.9
        for word in words:
            ways = [v for s, v in model.signs.items() if (s[:-1] == word if s.endswith("$") else len(s) <= 8 and word.startswith(s))]
            clean *= 1 - max(ways, default=0.0)
        assert toxicity._score(set(words), model, heads)[0] == pytest.approx(1 - clean)


def test_long_runs_of_letters_are_not_kept(spark):
    restorer = toxicity.Restorer(toxicity.train_channel(documents(spark)))
    assert "ab" * 300 in restorer.words("a b " * 300) and max(map(len, restorer.known), default=0) <= restorer.KEPT_CHARS


def test_toxicity_edges(spark):
    rows = [(i, ("what an awful idiot " if i % 3 == 0 else "what a nice day ") + f"w{i}") for i in range(300)] + [(900, None), (901, ""), (902, "1d10t 1diot idi0t"), (903, LONG), (904, "...")]
    docs = documents(spark, rows)
    labelled = docs.withColumn("toxic", F.when(F.col("doc_id") < 300, (F.col("doc_id") % 3 == 0).cast("int"))).where(~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    model = toxicity.train(docs, labelled)
    by = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    assert all(by[i].predicted == (i % 3 == 0) for i in range(300))
    assert by[900].score == by[901].score == by[903].score == by[904].score == 0 and by[902].predicted == 1
    none = toxicity.train(docs, labelled.where("false"))
    assert toxicity.scored(odd(spark), none).where("score > 0 OR predicted = 1").count() == 0
    assert toxicity.scored(documents(spark, []), model).count() == 0


def test_toxicity_held_out(spark):
    found = queries.op2_toxicity(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    right = found.where("held_out").agg(F.avg((F.col("toxic") == F.col("predicted")).cast("int"))).first()[0]
    assert right > 0.85
