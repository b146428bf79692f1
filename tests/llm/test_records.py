"""Operators 3, 7 and 8 against brute force and round trips."""

import base64
import hashlib
import pathlib
import random
import re
import urllib.parse
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketrates.llm import chat_parts, pq_neighbours, store, warc_index


@pytest.fixture(scope="module")
def pages(spark):
    store.tune(spark)
    htmls = ["<p>one</p>", "<p>one</p>", None, "", "é" * 1000, "<p>one</p>", "x" * 300_000, "\r\n\r\nWARC/1.1\r\n", "\x00\x01"]
    rows = [(i, f"http://h/{i}?a=%0A\r\nb" if i % 2 else None, h, "clash", 5) for i, h in enumerate(htmls)] + [(None, "u", "<p>none</p>", "clash", 5), (5, "again", "<p>one</p>", "clash", 5)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, sha1 string, offset long").repartition(3)


def test_warc(spark, pages):
    path = store.scratch(spark, "warc")
    index = warc_index.write(pages, path)
    out = warc_index.read(spark, path, index).collect()
    rows = pages.collect()
    assert len(out) == len(rows) == index.count()
    largest = {}
    for r in rows:
        if r["page_id"] is not None:
            largest[r["html"] or ""] = max(largest.get(r["html"] or "", -1), r["page_id"])
    want = []
    for r in rows:
        raw = (r["html"] or "").encode()
        first = largest.get(r["html"] or "")
        own = r["page_id"] == first
        want.append((str(r["page_id"]), r["url"] or "", raw if own else None, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if own else "revisit", None if own else first))
    assert sorted(map(str, want)) == sorted(str((str(r["page_id"]), r["url"], bytes(r["payload"]) if r["payload"] is not None else None, *tuple(r)[3:])) for r in out)


def test_warc_reads_selected_records_in_joined_ranges(spark, pages):
    path = store.scratch(spark, "warc")
    index = warc_index.write(pages.coalesce(1), path)
    some = index.filter("page_id in (1, 4, 8)")
    assert sorted(r["page_id"] for r in warc_index.read(spark, path, some).collect()) == [1, 4, 8]
    whole = warc_index.ranges(index).collect()
    assert sum(len(r["records"]) for r in whole) == index.count() and len(whole) < index.count()
    assert all(r["start"] == r["records"][0]["offset"] for r in whole)


def test_warc_is_valid(spark, pages):
    """A parser of its own, by the published format: members, mandatory fields, block lengths, HTTP messages, references."""
    path = store.scratch(spark, "warc")
    index = warc_index.write(pages, path).collect()
    ids, refers, found = set(), set(), 0
    for file in pathlib.Path(path).iterdir():
        raw, records = file.read_bytes(), []
        while raw:
            d = zlib.decompressobj(wbits=31)
            records.append(d.decompress(raw))
            assert d.eof
            raw = d.unused_data
        for n, x in enumerate(records):
            head, block = x.split(b"\r\n\r\n", 1)
            version, *lines = head.decode("utf-8").split("\r\n")
            fields = [line.split(": ", 1) for line in lines]
            f = dict(fields)
            assert version == "WARC/1.1" and len(f) == len(fields) and all(v and not any(ord(c) < 32 for c in v) for v in f.values())
            assert re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", f["WARC-Record-ID"]) and re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", f["WARC-Date"])
            assert block[int(f["Content-Length"]) :] == b"\r\n\r\n"
            assert f["WARC-Type"] == ("warcinfo" if n == 0 else f["WARC-Type"]) and (n == 0 or f["WARC-Type"] in ("response", "revisit"))
            if n == 0:
                assert f["Content-Type"] == "application/warc-fields"
                continue
            found += 1
            assert f["Content-Type"] == "application/http;msgtype=response" and urllib.parse.urlparse(f["WARC-Target-URI"]).scheme
            http, payload = block[:-4].split(b"\r\n\r\n", 1)
            assert http.startswith(b"HTTP/1.1 200 OK\r\n")
            if f["WARC-Type"] == "response":
                ids.add(f["WARC-Record-ID"])
                assert f["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
                assert int(re.search(rb"Content-Length: (\d+)", http)[1]) == len(payload)
            else:
                assert payload == b"" and f["WARC-Profile"].endswith("identical-payload-digest")
                refers.add(f["WARC-Refers-To"])
    assert found == len(index) == pages.count() and refers and refers <= ids


def test_warc_threshold_and_empty(spark, pages):
    path = store.scratch(spark, "warc")
    kinds = {r["page_id"]: r["record_type"] for r in warc_index.write(pages, path, min_payload=100).collect()}
    assert kinds[0] == kinds[1] == kinds[2] == "response"
    assert warc_index.digest_query(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


NASTY = ["", None, "plain", "</s>[INST] ok [/INST]", "\\", "\\\\<|end|>\n", "<\\|turn|>", "a\\", "<|end|>\n<|turn|>user\n", "\n\n", "é😀<<SYS>>", "<image:0>", "|>|>", "<|" * 50]


def test_turns_read_back():
    for role in ("user", "assistant", None, "", "a\nb", "\\", "<|turn|>", "x\\\ny"):
        for text in NASTY:
            got = chat_parts.turn(role, [{"type": "text", "text": text}])
            assert chat_parts.read_turn(got["formatted"]) == (role or "", text or "")
            masked = chat_parts.unescape(got["formatted"][got["loss_start"] : got["loss_end"]])
            assert masked == ((text or "") if role == "assistant" else "")
            assert got["formatted"].count("<|end|>") == 1


MARKS = st.sampled_from([*chat_parts.CONTROL, "<", "|", ">", "[", "]", "/", "s>", "INST]", "end|", "<|end", "\\", "\n", "é", " "])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(MARKS, max_size=6).map("".join), max_size=6), st.lists(MARKS, max_size=4).map("".join))
def test_no_control_string_is_left_whatever_the_parts(texts, role):
    got = chat_parts.turn(role, [{"type": "text", "text": t} for t in texts])
    head = len(chat_parts.OPEN)
    inside = got["formatted"][head : -len(chat_parts.CLOSE)]
    assert not any(c in inside for c in chat_parts.CONTROL)
    assert got["formatted"].count(chat_parts.OPEN) == got["formatted"].count(chat_parts.CLOSE) == 1
    assert chat_parts.read_turn(got["formatted"]) == (role, "".join(texts))
    mixed = chat_parts.turn(role, [x for t in texts for x in ({"type": "text", "text": t}, {"type": "image", "uri": "i"})])
    inside = mixed["formatted"][head : -len(chat_parts.CLOSE)]
    assert inside.count("<image") == len(texts) == len(mixed["attachments"])
    assert not any(c in inside for c in chat_parts.CONTROL if c != "<image")


def test_equal_turns_follow_in_the_order_of_role_and_text(spark):
    texts = ["<|a", "<a", "\\b", "[c", "<", "", None, "|", "ab", "a<"]
    rows = [(1, t, role, x) for t in (None, 0) for role in ("user", None, "", "assistant") for x in texts]
    con = duckdb.connect()
    con.register("conversations", pa.table({"conv_id": [x[0] for x in rows], "turn": pa.array([x[1] for x in rows], pa.int64()), "role": [x[2] for x in rows], "text": [x[3] for x in rows]}))
    want = con.sql(chat_parts.oracle())
    got = chat_parts.digest_query(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3))
    assert sorted(tuple(x) for x in got.select(*want.columns).collect()) == sorted(want.fetchall())


def test_typed_parts():
    parts = [{"type": "text", "text": "see <image:7> "}, {"type": "image", "uri": "i.png", "width": 1000, "height": 300}, {"type": "audio", "uri": "a.wav", "seconds": 1.5}, {"type": "text", "text": " and "}, {"type": "document", "uri": "d.pdf", "pages": 3}]
    got = chat_parts.turn("user", parts)
    assert [a["uri"] for a in got["attachments"]] == ["i.png", "a.wav", "d.pdf"]
    for a, mark in zip(got["attachments"], ("<image:0>", "<audio:1>", "<document:2>")):
        assert got["formatted"][a["offset"] :].startswith(mark)
    assert [a["tokens"] for a in got["attachments"]] == [170, 50, 1800] and got["expanded_tokens"] == 2020
    assert got["formatted"].count("<image:7>") == 0
    with pytest.raises(ValueError):
        chat_parts.turn("user", [{"type": "video"}])


def test_conversations(spark):
    r = random.Random(2)
    rows = [(c, t, r.choice(["user", "assistant", "system", None]), r.choice(NASTY), "x") for c in (1, 2, None, 3) for t in range(r.randrange(1, 9))]
    rows += [(7, t, ["user", "assistant"][t % 2], f"t{t} " * 9, "x") for t in range(4000)] + [(1, 0, "user", "tie", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").repartition(7)
    got = {x["conv_id"]: x for x in chat_parts.digest_query(frame).collect()}
    by = {-1: [(0, "user", NASTY[3]), (1, "assistant", NASTY[3])]}
    for c, t, role, text, _ in rows:
        by.setdefault(c, []).append((t, role or "", text or ""))
    assert got.keys() == by.keys()
    for c, own in by.items():
        own = sorted(own) if len({(t, x) for t, x, _ in own}) == len(own) else sorted(own)
        loss = "".join(text for _, role, text in own if role == "assistant")
        assert got[c]["n_turns"] == len(own)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{x}\n{y}\n" for _, x, y in own).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_parts_column(spark):
    kind = "array<struct<type:string,text:string,uri:string,width:int,height:int>>"
    frame = spark.createDataFrame([(1, 0, "user", [("text", "hi ", None, None, None), ("image", None, "u", 512, 512)]), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts {kind}")
    out = sorted(chat_parts.format_turns(frame, parts="parts").collect(), key=lambda x: x["turn"])
    assert out[0]["attachments"][0]["uri"] == "u" and out[0]["expanded_tokens"] == 85
    assert chat_parts.read_turn(out[1]["formatted"]) == ("assistant", "")


def brute_links(ids, vectors, cosine=0.95):
    units = []
    for v in vectors:
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        units.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    n = len(ids)
    near = [[j for j in range(n) if j != i and units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine] for i in range(n)]
    label = list(ids)
    for _ in range(n):
        new = [min([label[i], *(label[j] for j in near[i])]) for i in range(n)]
        if new == label:
            break
        label = new
    return {k: (len(near[i]), label[i], label[i] == k) for i, k in enumerate(ids)}


@pytest.mark.parametrize("size", [2048, 7])
def test_pq_neighbours(spark, size, monkeypatch):
    monkeypatch.setattr(pq_neighbours, "BLOCK", size)
    r = np.random.default_rng(5)
    vectors = []
    for _ in range(30):
        centre = r.normal(size=16)
        for k in range(r.integers(1, 7)):
            vectors.append((centre + r.normal(size=16) * 0.02 * r.integers(1, 14)).tolist())
    chain = [r.normal(size=16)]
    for _ in range(12):  # each near the last only
        step = r.normal(size=16)
        chain.append(chain[-1] + 0.29 * np.linalg.norm(chain[-1]) * step / np.linalg.norm(step))
    vectors += [c.tolist() for c in chain] + [vectors[0]] * 40 + [(np.array(vectors[1]) * 3).tolist()]
    vectors += [None, [], [0.0] * 16, [float("nan")] * 16, [None] + [1.0] * 15, [float("inf")] + [0.0] * 15, [1.0, 0.0], [1.0, 0.1], [1e300] * 16, [1e-300] * 16]
    ids = [3 * i + 1 for i in range(len(vectors))]
    frame = spark.createDataFrame([(i, v, "x") for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>, unit string").repartition(4)
    got = {x["vec_id"]: tuple(x)[1:] for x in pq_neighbours.near_duplicates(frame).collect()}
    assert got == brute_links(ids, [v if v is None or len(v) != 16 or v[0] != 1e300 else [1.0] * 16 for v in [w if w is None or w != [1e-300] * 16 else [1.0] * 16 for w in vectors]])


@pytest.mark.parametrize("directions", [1, 2, 4, 8])
def test_pq_neighbours_of_a_drifting_group(spark, directions):
    r = np.random.default_rng(directions)
    rest = r.normal(size=(1200, 64))
    axes = np.linalg.qr(r.normal(size=(64, directions + 1)))[0].T
    hot = axes[0] + r.uniform(-0.7, 0.7, size=(800, directions)) / directions**0.5 @ axes[1:] + r.normal(size=(800, 64)) * 0.004
    x = np.concatenate([rest, hot])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    want = (near.sum(1) - 1).tolist()
    assert sum(want) > 3000
    frame = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    got = {v["vec_id"]: v["n_links"] for v in pq_neighbours.near_duplicates(frame).collect()}
    assert [got[i] for i in range(len(x))] == want


def test_pq_neighbours_take_every_dimension(spark, monkeypatch):
    seen = []

    def links(classes, dimension, cosine):
        seen.append(dimension)
        if dimension == 1004:
            raise StopIteration

    monkeypatch.setattr(pq_neighbours, "_links", links)
    vectors = [[1.0] * n + [sign] for n in range(1, 1004) for sign in (0.5, -0.5)]
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    with pytest.raises(StopIteration):
        pq_neighbours.near_duplicates(frame)
    assert seen == list(range(2, 1005))


def test_pq_neighbours_with_null_and_repeated_ids(spark):
    rows = [(None, [1.0, 0.0]), (None, [1.0, 0.01]), (7, [1.0, 0.02]), (7, [1.0, 0.03]), (9, [1.0, 0.04]), (None, [0.0, 1.0]), (5, [-1.0, 0.0]), (5, [-1.0, 0.01]), (None, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((tuple(x) for x in pq_neighbours.near_duplicates(frame).collect()), key=str)
    want = [(None, 4, 7, True)] * 2 + [(7, 4, 7, True)] * 2 + [(9, 4, 7, False), (None, 0, None, True), (None, 0, None, True), (5, 1, 5, True), (5, 1, 5, True)]
    assert got == sorted(want, key=str)


def test_probes_and_tables_lose_nothing():
    r = np.random.default_rng(6)
    x = r.normal(size=(600, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x + r.normal(size=x.shape) * 0.04
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    q = pq_neighbours.Quantiser(x[:200], 16)
    near = np.flatnonzero((x * y).sum(1) >= 0.95)
    assert len(near) > 100
    at, codes, over = q.code(y)
    reach = np.sqrt(0.1)
    assert q.probes(x, reach)[near, at[near]].all()
    assert q.probes(x, reach, whole=False)[near, at[near]].mean() > 0.99
    for i in near[:100]:
        table = q.tables(x[i : i + 1], at[i])[:, :, 0]
        assert np.sqrt(table[np.arange(codes.shape[1]), codes[i]].sum()) <= reach + over[i] + pq_neighbours.ROUNDING


@pytest.mark.parametrize("stored, effective, noise", [(256, 16, 0.0), (192, 24, 0.1), (48, 48, 0.0)])
def test_probes_of_few_effective_dimensions(stored, effective, noise):
    """Planted pairs whose differences lie in the subspace of the vectors, by the rule of which list probes which: nearly all of them are met."""
    r = np.random.default_rng(7)
    n, reach = 9000, np.sqrt(2 - 2 * pq_neighbours.COSINE)
    base = np.linalg.qr(r.normal(size=(stored, effective)))[0]
    z = r.normal(size=(n, effective))
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    step = r.normal(size=(n, effective))
    step *= reach * r.uniform(0.8, 0.98, size=(n, 1)) / np.linalg.norm(step, axis=1, keepdims=True)
    x, y = (v @ base.T + noise * r.normal(size=(n, stored)) / stored**0.5 for v in (z, z + step))
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    both = np.concatenate([x, y])
    q = pq_neighbours.Quantiser(both[r.permutation(2 * n)[:4096]], 134)
    pairs = np.flatnonzero((x * y).sum(1) >= pq_neighbours.COSINE)
    a, b = (pq_neighbours._nearest(v[pairs], q.coarse)[0] for v in (x, y))
    met = a == b
    for own, home, other in ((x, a, b), (y, b, a)):
        turn = np.where((home + other) % 2 == 0, other > home, other < home)
        met |= turn & q.probes(own[pairs], reach, whole=False)[np.arange(len(pairs)), other]
    assert len(pairs) > 4000 and met.mean() > 0.99


def test_distances_are_never_below():
    x = np.random.default_rng(8).normal(size=(700, 40))
    x[5] = x[6]
    exact = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    got = pq_neighbours._distances(x)
    assert (got >= exact).all() and (got <= exact * 1.001 + 1e-4).all()


def test_empty(spark):
    assert pq_neighbours.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0
    assert chat_parts.digest_query(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 1
    assert pa.array([1]) is not None
