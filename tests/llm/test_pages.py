"""URL filters, web archives and sampled segmentations."""

import base64
import hashlib
import io
import math
import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from cases import LONG, documents, odd, texts
from causal_logs.llm import pieces, queries, sampling, urls, warc
from causal_logs.llm.words import mixed
from causal_logs.session import new_path

URLS = [
    (1, "http://A.Example.NET/en/x?y#z"), (2, "https://example.net/de"), (3, "http://example.com/de/1"), (4, "http://www.example.com/dex"),
    (5, "https://q.org/fr/"), (6, "q.org/fr/"), (7, None), (8, ""), (9, "http://net/"), (10, "http://net"), (11, "ftp://user@x.y?net/"),
    (12, "http://notnet/a"), (13, "http://x.com://y.net/"), (14, "http://" + "a" * 50_000 + ".net/"), (2, "https://example.net/de"),
]


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "own", 1.0, "r", "v") for r in rows], "page_id int, url string, host string, f_length double, rule string, blocked string")


def _plain_rule(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    end = min([rest.find(c, cut) for c in "?#" if rest.find(c, cut) >= 0] or [len(rest)])
    path = rest[cut:end]
    fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.place), default=None)
    return host, path, best and best.place, best and best.verdict


def test_url_rules(spark):
    found = urls.judged(_pages(spark, URLS), queries.URL_RULES)
    assert found.count() == len(URLS)
    for r in found.collect():
        host, path, rule, verdict = _plain_rule(dict(URLS)[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block")
        assert verdict is None or r.verdict == verdict
        assert 0 <= r.score <= 1


def test_url_training(spark):
    rng = random.Random(1)
    rows = [(i, f"http://{'bad-cheap-' if i % 2 else ''}site{rng.randint(0, 99)}.com/{'a' * rng.randint(1, 5)}" + "?x=1&y=2" * (i % 2)) for i in range(400)]
    labelled = spark.createDataFrame([(u, "block" if i % 2 else "allow") for i, u in rows[:300]], "url string, verdict string")
    found = urls.judged(_pages(spark, rows[300:]), [], labelled=labelled)
    assert all((r.verdict == "block") == bool(r.page_id % 2) for r in found.collect())
    assert urls.judged(_pages(spark, []), queries.URL_RULES).count() == 0
    one = urls.judged(_pages(spark, rows[:4]), [urls.Rule("block", "com/")])
    assert {r.verdict for r in one.collect()} == {"block"}


# --- archives ---------------------------------------------------------------


def _html(spark):
    rows = [(i, f"http://h/{i} x\né", f"<p>{i % 7}</p>" if i % 3 else LONG[i:]) for i in range(60)] + [(70, None, None), (71, "u", ""), (72, "u", None), (73, "u", "\r\n\r\nWARC/1.1 x")]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "page_id int, url string, html string, payload string").repartition(4)


@pytest.mark.parametrize("split", [1 << 24, 700])
def test_archives(spark, split):
    rows, pages = _html(spark)
    files = warc.write_warc(pages, new_path(spark, "warc"), file_bytes=20_000)
    assert files.count() > 4
    found = {int(r.id): r for r in warc.read_warc(files, split_bytes=split).collect()}
    first = {}
    for i, _, html in sorted(rows, key=lambda r: r[0]):
        first.setdefault(html or "", i)
    assert set(found) == {r[0] for r in rows}
    for i, _, html in rows:
        payload, r = (html or "").encode(), found[i]
        assert (r.payload_bytes, r.payload_digest) == (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
        new = first[html or ""] == i
        assert (r.record_type, r.refers_to) == (("response", None) if new else ("revisit", str(first[html or ""])))
        assert r.payload == (payload if new else None)


def test_archive_edges(spark):
    _, pages = _html(spark)
    assert warc.read_warc(warc.write_warc(pages.where("false"), new_path(spark, "warc"))).count() == 0
    files = warc.write_warc(pages.where("page_id in (1, 8, 71, 72)"), new_path(spark, "warc"), least_bytes=100)
    assert {r.record_type for r in warc.read_warc(files).collect()} == {"response"}
    whole = warc._record("response", "1", "u", b"data" * 5000, None, "d")
    noise = b"\x1f\x8b\x08junk" + warc.MAGIC
    assert [warc.parsed(r)["payload"] for r in warc.members(io.BytesIO(noise + whole + whole), 0, 10_000)] == [b"data" * 5000] * 2
    assert list(warc.members(io.BytesIO(noise + whole), len(noise) + 1, 10_000)) == []


# --- segmentations ----------------------------------------------------------


def _all_segmentations(walks):
    def below(node):
        if walks.last[node]:
            yield (), 1.0
            return
        for e in range(walks.out[node], walks.out[node + 1]):
            for rest, p in below(walks.edges.end[e]):
                yield (int(walks.edges.id[e]), *rest), p * walks.share[e]

    out = {(): 1.0}
    for part in walks.cut.which:
        out = {a + b: p * q for a, p in out.items() for b, q in below(walks.edges.first[part])}
    return out


def test_sampling_without_replacement():
    vocabulary = pieces.load(queries.VOCABULARY)
    probability = sampling.weights(vocabulary, 0.3)
    n, text = 4000, b"ab to"
    walks = sampling.Walks(pieces.parts(np.frombuffer(text * n, np.uint8), np.arange(n + 1) * len(text)), vocabulary, probability)
    share = _all_segmentations(sampling.Walks(pieces.parts(np.frombuffer(text, np.uint8), np.array([0, len(text)])), vocabulary, probability))
    assert abs(sum(share.values()) - 1) < 1e-9
    k = len(share) + 2
    found, rest = sampling.sampled(walks, mixed(np.arange(n)), k)
    drawn = [{} for _ in found]
    for number, s in enumerate(found):
        ids = walks.edges.id[s["edge"]]
        for j, t in enumerate(s["texts"].tolist()):
            drawn[number][t] = (tuple(ids[s["begin"][j] : s["begin"][j + 1]].tolist()), s["top"][j], s["log"][j])
    # All of them come, each once, in falling order, and then nothing is left.
    assert len(found) == len(share) and np.isneginf(rest).all()
    for t in range(0, n, 97):
        own = [d[t] for d in drawn]
        assert {o[0] for o in own} == set(share) and [o[1] for o in own] == sorted((o[1] for o in own), reverse=True)
        assert all(abs(math.log(share[o[0]]) - o[2]) < 1e-9 for o in own)
    # First and second draws as without replacement.
    for seg, p in share.items():
        second = sum(q * p / (1 - q) for other, q in share.items() if other != seg)
        for want, number in ((p, 0), (second, 1)):
            got = sum(d[0] == seg for d in drawn[number].values()) / n
            assert abs(got - want) < 4 * math.sqrt(want * (1 - want) / n) + 1e-3


def test_segmentations_of_many_texts_are_drawn_together(monkeypatch):
    """The numbers drawn come in a few calls a batch, not in some for each text; each text's samples are those it has alone."""
    vocabulary = pieces.load(queries.VOCABULARY)
    probability = sampling.weights(vocabulary)
    texts = [f"the {i} words of text {i * i}".encode() for i in range(200)]
    seeds = mixed(np.arange(len(texts)))
    calls = []
    plain = sampling._uniform
    monkeypatch.setattr(sampling, "_uniform", lambda *a: calls.append(1) or plain(*a))

    def drawn(some, own):
        starts = np.concatenate([[0], np.cumsum([len(t) for t in some])])
        walks = sampling.Walks(pieces.parts(np.frombuffer(b"".join(some), np.uint8), starts), vocabulary, probability)
        found, _ = sampling.sampled(walks, own, 3)
        return [[walks.edges.id[s["edge"]][a:b].tolist() for a, b in zip(s["begin"][:-1], s["begin"][1:], strict=True)] for s in found]

    together = drawn(texts, seeds)
    assert len(calls) < 100
    for t in (0, 7, 199):
        assert [s[t] for s in together] == [s[0] for s in drawn(texts[t : t + 1], seeds[t : t + 1])]


def test_walks_take_shares_from_their_own_node(monkeypatch):
    """The sum of the shares before an edge draws that edge and the next smaller number the one before it, wherever its part lies in the batch."""
    vocabulary = pieces.load(queries.VOCABULARY)
    probability = sampling.weights(vocabulary)
    texts = [f"{i} segmentations {i * i}".encode() for i in range(300)]
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    walks = sampling.Walks(pieces.parts(np.frombuffer(b"".join(texts), np.uint8), starts), vocabulary, probability)
    many = 0
    for part in range(len(walks.cut.starts) - 1):
        node = int(walks.edges.first[part])
        low, high = int(walks.out[node]), int(walks.out[node + 1])
        before = 0.0
        for edge in range(low, high):
            for u, want in ((before, edge), (np.nextafter(before, 0), edge - 1))[: 1 + (edge > low)]:
                monkeypatch.setattr(sampling, "_uniform", lambda state, place=0, u=u: np.full(len(state), u))
                drawn, _ = walks.walk(np.array([node]), np.zeros(1, np.uint64), np.zeros(1, np.int64), 0)
                assert drawn[0] == want
            before += walks.share[edge]
            many += 1
    assert many > 100


def test_lattices_look_up_beginnings_once(monkeypatch):
    """A place's first byte costs no search of the vocabulary, and a longer run only one while it may go on; edges are as listed."""
    vocabulary = pieces.load(queries.VOCABULARY)
    spelled = [bytes(vocabulary.bytes[a:b]) for a, b in zip(vocabulary.starts[:-1], vocabulary.starts[1:], strict=True)]
    known = {t: i for i, t in reversed([*enumerate(spelled)]) if t and not vocabulary.first_byte <= i < vocabulary.first_byte + 256}
    begun = {t[:n] for t in known for n in range(1, len(t) + 1)}
    text = "the words of a text, \U0001fae8 and   spaces   ".encode() + " ".join(f"word{i * i}" for i in range(200)).encode() + b"\xf0\x80 \xe4\xbd\xa0\x80  "
    starts = np.array([0, 20, len(text) - 2, len(text)])
    cut = pieces.parts(np.frombuffer(text, np.uint8), starts)
    looked, plain = [], pieces._child
    monkeypatch.setattr(pieces, "_child", lambda v, keys: looked.append(len(keys)) or plain(v, keys))
    found = pieces.lattice(vocabulary, cut.data, cut.starts)
    want, searches = [], 256
    for part, first in enumerate(found.first[:-1].tolist()):
        data = cut.data[cut.starts[part] : cut.starts[part + 1]].tobytes()
        whole = [at for at in range(len(data)) if at == 0 or data[at] & 0xC0 != 0x80] + [len(data)]
        alone = {at for a, b in zip(whole[:-1], whole[1:], strict=True) if data[a:b] not in known for at in range(a, b)}
        for at in range(len(data)):
            runs = [data[at:end] for end in range(at + 1, len(data) + 1)]
            some = [run for run in runs if run in known]
            want += [(first + at, first + at + 1, vocabulary.first_byte + data[at])] * (at in alone)
            want += [(first + at, first + at + len(run), known[run]) for run in some]
            # Each beginning of a piece is looked up with the byte behind it, at the end of a part with none.
            searches += sum(run in begun for run in runs)
    assert sorted(zip(found.start.tolist(), found.end.tolist(), found.id.tolist(), strict=True)) == sorted(want)
    assert sum(looked) <= searches


def test_segmentations(spark):
    vocabulary = pieces.load(queries.VOCABULARY)
    model = sentencepiece.SentencePieceProcessor(model_file=queries.VOCABULARY)
    found = sampling.segmentations(odd(spark), queries.VOCABULARY, k=3).collect()
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append(r)
    for i, text in texts():
        own = by[i]
        assert all(r.round_trip for r in own)
        assert len({tuple(r.ids) for r in own}) == len({(r.sample, *r.ids) for r in own}) or i == 5
        for r in own[:1]:
            assert sampling.decode(vocabulary, r.ids) == (text or "") and len(r.ids) == r.n_pieces
            assert hashlib.sha256(np.array(r.ids, "<i4").tobytes()).hexdigest() == r.ids_sha256
            if text and "▁" not in text:
                assert model.decode(r.ids) == text
    assert len(by[101]) == 1 and by[101][0].ids == [] and len(by[0]) == 3
    assert all(r.log_inclusion <= 1e-9 for r in found)
    again = sampling.segmentations(documents(spark).repartition(7).where("doc_id = 3"), queries.VOCABULARY, k=3).collect()
    assert {r.ids_sha256 for r in again} == {r.ids_sha256 for r in by[3]}
    assert sampling.segmentations(documents(spark, []), queries.VOCABULARY).count() == 0


# --- archives of other writers ----------------------------------------------


def _foreign(*lines, block=b"", ends="\r\n"):
    return ends.join(["WARC/1.0", *lines]).encode() + (ends * 2).encode() + block + (ends * 2).encode()


def test_foreign_records():
    http = b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\nhello"
    one = _foreign("warc-type:response", "WARC-RECORD-ID: <urn:uuid:a-1>", "Content-Type:application/http; msgtype=response", f"content-length: {len(http)}", "X-Long: a", "  b", block=http)
    two = _foreign("WARC-Type: revisit", "WARC-Record-ID: <urn:uuid:a-2>", "WARC-Refers-To: <urn:uuid:a-1>", "WARC-Payload-Digest: sha1:ABC", "Content-Length: 0")
    three = _foreign("WARC-Type: resource", "WARC-Target-URI: http://x/", "Content-Length: 9", block=b"a\r\n\r\nb\r\nc", ends="\n")[: -len("\n\n")]
    got = list(warc.records(one + two + three))
    assert [(r["id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["fault"]) for r in got] == [
        ("urn:uuid:a-1", "response", None, 5, None), ("urn:uuid:a-2", "revisit", "urn:uuid:a-1", None, None), (None, "resource", None, 9, None),
    ]
    assert got[0]["payload"] == b"hello" and got[1]["payload_digest"] == "ABC" and got[2]["payload"] == b"a\r\n\r\nb\r\nc" and got[2]["url"] == "http://x/"
    assert [r["fault"] for r in warc.records(_foreign("WARC-Type: metadata", block=b"x"))] == ["no length"]
    assert [r["fault"] for r in warc.records(_foreign("Content-Length: 100", block=b"x"))] == ["cut off"]
    assert [r["fault"] for r in warc.records(two + b"rubbish")] == [None, "no record"]


@pytest.mark.parametrize("split", [1 << 24, 700])
def test_foreign_archives(spark, tmp_path, split):
    """Several records in a member, a member that is cut off, rubbish between members."""
    import gzip

    record = lambda k, n: _foreign("warc-type: resource", f"warc-record-id: <urn:uuid:{k}>", f"content-length:{n}", block=random.Random(k).randbytes(n))
    packed = gzip.compress(record(1, 500) + record(2, 0) + record(3, 900)) + b"\x1f\x8b\x08 no member" + gzip.compress(record(4, 300)) + gzip.compress(record(5, 4000))[:-600]
    (tmp_path / "a.warc.gz").write_bytes(packed)
    files = spark.createDataFrame([(f"file://{tmp_path}/a.warc.gz", len(packed))], "path string, bytes bigint")
    got = sorted((r.id, r.payload_bytes, r.fault) for r in warc.read_warc(files, split_bytes=split).collect())
    assert got[:4] == [("urn:uuid:1", 500, None), ("urn:uuid:2", 0, None), ("urn:uuid:3", 900, None), ("urn:uuid:4", 300, None)]
    assert len(got) == 5 and got[4][0] == "urn:uuid:5" and got[4][2] == "cut off"


def test_columns_named_like_those_of_the_trees(spark):
    rows = [(i, f"http://{'bad.net' if i % 2 else 'good.org'}/fr/{i}", "a", "b", "c", "d") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id int, url string, blocked string, Seen string, f_length string, _suffix string")
    got = urls.judged(pages, queries.URL_RULES)
    assert got.columns[:6] == pages.columns
    assert {(r.blocked, r.Seen, r.f_length, r["_suffix"]) for r in got.collect()} == {("a", "b", "c", "d")}
