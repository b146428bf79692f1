"""Operators 1, 6 and 10 against the public libraries, on odd texts and on the small tables."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
import public_tokenizers as P  # noqa: E402

from marketrates.llm import byte_bpe, cost_packing, kernels, rans_files, store  # noqa: E402
from marketrates.llm.library_ids import Library  # noqa: E402

SCHEMA = "doc_id long, text string, ids string, n long, start long"
JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")


def odd_texts():
    r = random.Random(5)
    letters = list("ab'strevmld  \n\t é1²٣!?#😀　x'\x1c\x85\xa0")
    return ["".join(r.choice(letters) for _ in range(r.randrange(40))) for _ in range(400)] + ["", None, "a" * 3000, "'" * 99, " " * 300, "<|endoftext|> x", "<|endoftext|>", "a<|endoftext|><|endoftext|>\n b, c.<|endoftext|", "word <|endoftext|> word word\n<|endoftext|>\n", "<|endoftext", "it's we'll ''s don'ts", "same", "same"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "clash", 1, 2) for i, t in enumerate(odd_texts())] + [(None, "no id", "clash", 1, 2), (3, "repeated id", "clash", 1, 2)]
    store.tune(spark)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(JSON)
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_byte_bpe(odd, reference):
    out = byte_bpe.digest_query(odd, RANKS).collect()
    assert len(out) == odd.count()
    texts = {}
    for r in odd.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"] or "")
    for r in out:
        want = [(len(i := reference(t)), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for t in texts[r["doc_id"]]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) in want


def test_byte_bpe_keeps_columns_and_offsets(odd):
    out = byte_bpe.encode(odd, RANKS)
    assert out.columns == ["doc_id", "text", "n", "start", "ids", "piece_offsets"]
    row = out.filter("text like 'it%'").collect()[0]
    assert row["text"] == "it's we'll ''s don'ts"
    assert np.frombuffer(row["piece_offsets"], "<u4").tolist() == [0, 2, 4, 7, 10, 13, 14, 18, 20]


def test_long_piece_merges_like_short_ones():
    v = byte_bpe.vocabulary(RANKS)
    for size in (5, 30, 47, 48):
        piece = bytes(random.Random(size).choice(b"abcdeth") for _ in range(size))
        assert v._merge_long(piece) == v.merge(piece) == np.frombuffer(v.merge_many([piece])[0], "<u4").tolist()


def test_scan_equals_stepping():
    kinds = np.array([random.Random(1).randrange(11) for _ in range(5000)])
    element, _, _, act, _ = byte_bpe._machine()
    got, state = act[byte_bpe.scan(element[kinds]), 0], 0
    for k, s in zip(kinds.tolist(), got.tolist()):
        state = byte_bpe._step(state, k)[0]
        assert state == s


def test_library_cut_is_exact(library):
    lib = Library(JSON)
    texts = odd_texts()
    assert [np.frombuffer(x, lib.dtype).tolist() for x in lib.ids(texts)] == [library(t) for t in texts]


def test_token_files(odd, library):
    rows = sorted(((r["doc_id"] is not None, r["doc_id"], r["text"] or "") for r in odd.collect()), key=lambda x: (x[0], x[1] or 0, x[2].encode()))
    start, want = 0, []
    for _, key, text in rows:
        ids = library(text) + [2]
        want.append((key, start, len(ids), crc(ids)))
        start += len(ids)
    got = sorted((tuple(r)[:4] for r in rans_files.digest_query(odd, JSON).collect()), key=lambda r: r[1])
    assert got == want


def test_token_files_cut_long_documents(spark, library, monkeypatch):
    monkeypatch.setattr(rans_files, "BLOCK_IDS", 700)
    frame = spark.createDataFrame([(i, "word number %d " % i * (1 + 90 * (i % 7))) for i in range(30)], "doc_id long, text string")
    start = 0
    got = {r["doc_id"]: r for r in rans_files.digest_query(frame, JSON).collect()}
    assert any(r["n_pieces"] > 1 for r in got.values())
    for r in frame.orderBy("doc_id").collect():
        ids = library(r["text"]) + [2]
        assert tuple(got[r["doc_id"]])[:4] == (r["doc_id"], start, len(ids), crc(ids))
        start += len(ids)


def test_token_files_spread_repeated_rows(spark, library, tmp_path):
    frame = spark.createDataFrame([(7, "same words again", "x")] * 900 + [(8, "other", "y")], "doc_id long, text string, key string")
    rans_files.write_files(frame, str(tmp_path / "f"), JSON)
    blocks = spark.read.parquet(str(tmp_path / "f" / "blocks"))
    assert blocks.select("shard").distinct().count() == 4
    got = rans_files.read_files(spark, str(tmp_path / "f")).orderBy("start").collect()
    n = len(library("same words again")) + 1
    assert [(r["doc_id"], r["start"]) for r in got] == [(7, k * n) for k in range(900)] + [(8, 900 * n)]


def test_rans_checkpoints_and_checksums():
    r = np.random.default_rng(3)
    ids = (r.zipf(1.3, 420_000) % 50_000).astype(np.uint32)
    seen, counts = np.unique(ids, return_counts=True)
    freq = rans_files.frequencies(counts)
    assert int(freq.sum()) == 1 << rans_files.SCALE_BITS and freq.min() >= 1
    table = rans_files.Table(seen, freq)
    payload, points, sums = table.encode(ids)
    assert (table.decode(payload, points, sums, len(ids)) == ids).all()
    size = rans_files.LANES * rans_files.POINT_STEPS
    assert (table.decode(payload, points, sums, len(ids), range(2, 3)) == ids[2 * size : 3 * size]).all()
    entropy = -(counts / counts.sum() * np.log2(counts / counts.sum())).sum() / 8 * len(ids)
    assert len(payload) < 1.03 * entropy + 4096
    broken = bytearray(payload)
    broken[len(broken) // 2] ^= 1
    with pytest.raises(ValueError):
        table.decode(bytes(broken), points, sums, len(ids))


def test_crc_join():
    a, b = b"some bytes", bytes(range(256)) * 9
    assert kernels.crc32_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def check_pieces(rows, library, texts):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for key, text in texts.items():
        ids, at = library(text) + [0], 0
        for r in sorted(by_doc[key], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == crc(ids[at : at + r["length"]])
            at += r["length"]
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024 and at & (at - 1) == 0


def test_packing(odd, library):
    unique = odd.filter("doc_id is not null and text is distinct from 'repeated id'")
    texts = {r["doc_id"]: r["text"] for r in unique.collect()}
    check_pieces(cost_packing.digest_query(unique, JSON).collect(), library, texts)
    assert sum(r["length"] for r in cost_packing.digest_query(odd.filter("doc_id is null"), JSON).collect()) == len(library("no id")) + 1


def test_packing_balances_cost():
    sizes = [random.Random(2).randrange(1, 3000) for _ in range(3000)]
    pieces = cost_packing.pack(sizes)
    spent = {}
    for _, _, n, s, _ in pieces:
        spent.setdefault(s, []).append(n)
    full = [sum(map(cost_packing.cost, x)) for x in spent.values() if sum(x) == 1024 and len(x) > 1]
    assert np.std(full) < 0.1 * np.mean(full)
    assert len(pieces) < len(sizes) + 1.2 * len(spent)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.digest_query(none, RANKS).count() == 0
    assert rans_files.digest_query(none, JSON).count() == 0
    assert cost_packing.digest_query(none, JSON).count() == 0
