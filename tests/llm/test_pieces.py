"""Operator 11 against the public library, on odd texts, odd ids and the small tables."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
import public_tokenizers as P  # noqa: E402

from marketrates.llm import piece_bpe, store  # noqa: E402

MODEL = P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, ids string, decoded string, n_tokens int"
BITS = ["a", "b", "e", "t", "h", "ing", " ", "  ", "\n", "▁", "é", "日", "本", "😀", "\x00", "\t", "1", "23", "<s>", "</s>", "<unk>", "<0x41>", "ق", "\xad", "the", "\r", "\x85", " "]


def odd_texts(n, seed=4):
    r = random.Random(seed)
    return ["".join(r.choice(BITS) for _ in range(r.randrange(50))) for _ in range(n)] + ["", None, " ", "\n", "a" * 3000, " " * 777, "▁" * 50, "é" * 999, "ab" * 5000, "日本" * 3000, "same", "same", " x", "x "]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def own():
    return piece_bpe.Pieces(MODEL)


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_ids_and_texts(own, library):
    texts = odd_texts(3000)
    for x, got in zip(texts, own.encode(pa.array(texts, pa.string()))):
        want = library.encode(x or "", add_bos=True, add_eos=True)
        assert ids(got) == want and own.decode(got) == library.decode(want), x


def test_without_begin_and_end(own, library):
    assert [ids(x) for x in own.encode(pa.array(["the end", ""]), wrap=False)] == [library.encode("the end"), []]


def test_any_ids(own, library):
    r = random.Random(2)
    for _ in range(3000):
        some = [r.choice([0, 1, 2, r.randrange(3, 259), r.randrange(32000)]) for _ in range(r.randrange(12))]
        assert own.decode(np.array(some, "<u4").tobytes()) == library.decode(some), some


def test_backtracking_equals_merging(own):
    r = random.Random(1)
    for _ in range(2000):
        part = "".join(r.choice("▁aehinorst" if r.random() < 0.5 else "▁▁▁a") for _ in range(r.randrange(1, 40)))
        assert own.tokens(part) == own.merge(part), part


def test_caches_are_forgotten(own, library, monkeypatch):
    monkeypatch.setattr(piece_bpe, "CACHE_PARTS", 10)
    monkeypatch.setattr(piece_bpe, "CACHE_PAIRS", 10)
    monkeypatch.setattr(piece_bpe, "BLOCK_BYTES", 50)
    texts = [x or "" for x in odd_texts(200, 8)]
    assert [ids(x) for x in own.encode(pa.array(texts))] == [library.encode(x, add_bos=True, add_eos=True) for x in texts]


def test_query(spark, sf_dir, library):
    store.tune(spark)
    rows = [(i, t, "clash", "clash", 1) for i, t in enumerate(odd_texts(100))] + [(None, "no id", "clash", None, 2), (3, "repeated id", "clash", "", 3)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).unionByName(spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id + 1000 AS doc_id", "text", "'' AS ids", "'' AS decoded", "1 AS n_tokens"))

    def plain(row):
        coded = library.encode(row["text"] or "", add_bos=True, add_eos=True)
        return row["doc_id"], len(coded), hashlib.sha256(np.array(coded, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(coded).encode()).hexdigest()

    out = piece_bpe.digest_query(frame, MODEL)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(plain, frame.collect()), key=str)
    kept = piece_bpe.decode(piece_bpe.encode(frame, MODEL), MODEL)
    assert sorted(kept.columns) == sorted(frame.columns)
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "").replace("▁", " ") for r in kept.collect())
    assert piece_bpe.digest_query(frame.filter("doc_id < -1"), MODEL).collect() == []


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    model.ParseFromString(open(MODEL, "rb").read())
    model.trainer_spec.model_type = 1
    (tmp_path / "m").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        piece_bpe.Pieces(str(tmp_path / "m"))
