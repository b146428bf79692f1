"""The pipeline's stages: each acts on all that the one before kept, and its decisions take effect."""

import random

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("corpus_pipeline")
import corpus_pipeline as C  # noqa: E402

from marketrates.llm import bayes_quality, dart_minhash, kernels, ngram_quality, repeat_tree, store  # noqa: E402


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    store.tune(spark)
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, function in C.STAGES:
        before, docs = docs, store.written(function(spark, docs, sf_dir), name)
        out.append((name, before, docs))
    return out


def ids(frame):
    return sorted(r[0] for r in frame.select("doc_id").collect())


def test_columns(stages):
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns == C.COLUMNS


def test_decisions(spark, sf_dir, stages):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    _, docs, after = stages[0]
    assert ids(after) == ids(ngram_quality.quality(docs, labels).filter("kept"))
    _, docs, after = stages[1]
    assert ids(after) == ids(bayes_quality.quality(docs, labels).filter("kept"))
    _, docs, after = stages[2]
    assert ids(after) == ids(dart_minhash.near_duplicates(docs).filter("kept")) and len(ids(after)) < docs.count()


def test_passages_and_packing(stages):
    _, docs, after = stages[3]
    want = {r["doc_id"]: r for r in repeat_tree.remove_repeats(docs).collect()}
    for r in after.collect():
        kept = bytes(want[r["doc_id"]]["kept"])
        assert abs(len(r["text"].encode()) - len(kept)) <= 6 * max(1, len(want[r["doc_id"]]["spans"]))
        if not want[r["doc_id"]]["spans"]:
            assert r["text"].encode() == kept
        else:
            assert r["n_chars"] == len(r["text"])
    assert any(r["spans"] for r in want.values())
    _, docs, packed = stages[4]
    assert sorted({r[0] for r in packed.select("doc_id").collect()}) == ids(docs)


def test_rows_that_share_an_id_are_told_apart(spark):
    store.tune(spark)
    r = random.Random(6)
    words = lambda n: " ".join("".join(r.choices("abcdefgh", k=5)) for _ in range(n))
    a, b, c = words(80), words(80), words(80)
    rows = [(1, a, "en", "s", 1), (1, b, "en", "s", 1), (2, a + " end", "en", "s", 1), (2, c, "en", "s", 1), (3, c, "en", "s", 1), (3, c, "fr", "s", 1), (None, a, "en", "s", 1), (None, a, "en", "s", 1), (4, "", "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    out = C.near_duplicates(spark, spark.createDataFrame(rows, schema), "")
    assert sorted((x["doc_id"] or 0, x["text"]) for x in out.collect()) == sorted([(1, a), (1, b), (2, c), (0, a), (4, "")])
    odds = np.zeros(2 * bayes_quality.HALF)
    _, feature, _ = bayes_quality.tokens(*kernels.buffers(pa.array(["zzz"])))
    odds[feature[feature < bayes_quality.HALF]] = 9.0
    frame = spark.createDataFrame([(1, a, "en", "s", 1), (1, a + " zzz", "en", "s", 1)], schema)
    kept = bayes_quality.keep_good(frame, bayes_quality.Evidence(odds, np.array([-1.0, 0.0, 1.0])))
    assert [tuple(x) for x in kept.collect()] == [(1, a, "en", "s", 1)]


def test_intermediate_tables_can_be_cleared(spark):
    own = store.bucketed(spark.range(5), "numbers", "id")
    assert own.count() == 5 and any(t.name.startswith("numbers_") for t in spark.catalog.listTables())
    store.clear(spark)
    assert not any(t.name.startswith("numbers_") for t in spark.catalog.listTables())


def test_odd_rows(spark, sf_dir):
    store.tune(spark)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "a fine text of some words " * 9, None, None, None), (2, "a fine text of some words " * 9, None, None, None), (3, "é" * 5000, "fr", "s", 5000)]
    for frame in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, function in C.STAGES:
            assert function(spark, frame, sf_dir).count() >= 0


def test_whole_run_against_brute_force(spark, tmp_path):
    """Without labels the base rules decide and the classifier keeps all, so plain Python can say what is left after every stage, and what the packed ids are."""
    import hashlib
    import zlib

    import public_tokenizers as P
    from test_duplicates import brute_classes, brute_removed, words
    from test_quality import brute_base
    from tokenizers import Tokenizer

    r = random.Random(31)
    passage, near = words(r, 70), words(r, 90)
    texts = [words(r, r.randrange(5, 120)) for _ in range(60)]
    texts += [words(r, 40) + " " + passage + " " + words(r, 40) for _ in range(6)]
    texts += [near.replace(near.split()[k], "edited", 1) for k in range(8)] + [texts[30]] * 3 + ["again and again and again and so on " * 20, "", None, "\n".join([passage, words(r, 30)])]
    rows = [(i, t, r.choice(["en", "de"]), r.choice(["a", "b"]), len(t or "")) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = C.run(spark, str(tmp_path)).collect()

    kept = []
    for i, t in enumerate(texts):
        n, _, _, _, repeated = brute_base(t)
        if n >= ngram_quality.MIN_WORDS and 100 * repeated <= ngram_quality.MAX_REPEATED * n:
            kept.append((i, t))
    classes = brute_classes([t for _, t in kept])
    kept = [x for k, x in enumerate(kept) if classes[k] == k]
    assert 0 < len(kept) < len(texts) - 10
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want, cut = {}, 0
    for (i, t), (_, removed, _, digest) in zip(kept, brute_removed([t for _, t in kept])):
        left = t
        if removed:
            cut += 1
            left = _without(t, [x for _, x in kept])
            assert hashlib.sha256(left.encode()).hexdigest() == digest
        want[i] = library.encode(left, add_special_tokens=False).ids + [0]
    assert cut >= 6 and {x["doc_id"] for x in got} == want.keys()
    for i, ids_ in want.items():
        at = 0
        for x in sorted((x for x in got if x["doc_id"] == i), key=lambda x: x["start"]):
            assert (x["start"], x["doc_tokens"]) == (at, len(ids_)) and x["ids_crc32"] == zlib.crc32(np.array(ids_[at : at + x["length"]], "<u4").tobytes())
            at += x["length"]
        assert at == len(ids_)


def _without(text, texts, size=200):
    """The text without the characters of strings of this size that start more than once in all texts; plain letters."""
    import collections

    seen = collections.Counter(x[i : i + size] for x in texts for i in range(len(x) - size + 1))
    gone = [False] * len(text)
    for i in range(len(text) - size + 1):
        if seen[text[i : i + size]] > 1:
            gone[i : i + size] = [True] * size
    return "".join(c for c, g in zip(text, gone) if not g)
