"""Operators 4 and 5 against brute force."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from marketrates.llm import dart_minhash, kernels, repeat_tree, store

SCHEMA = "doc_id long, text string, rep string, bytes string, component long"


def words(r, n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randrange(1, 9))) for _ in range(n))


def corpus(seed=3):
    r = random.Random(seed)
    shared = [words(r, n) for n in (30, 60, 90)] + ["é" * 150]
    texts = []
    for _ in range(120):
        t = words(r, r.randrange(1, 150))
        for _ in range(r.randrange(3)):
            k = r.randrange(len(t) + 1)
            t = t[:k] + r.choice(shared) + t[k:]
        texts.append(t)
    near = words(r, 120)
    for _ in range(40):
        w = near.split(" ")
        for _ in range(r.randrange(1, 8)):
            w[r.randrange(len(w))] = f"edit{r.randrange(99)}"
        texts.append(" ".join(w))
    texts += [texts[0]] * 4 + [texts[1] + "!"] + ["", "", None, " \n", "ab" * 400, "x" * 1000, "short one", "short one", "a b c d", "a b c d e"]
    return texts


@pytest.fixture(scope="module")
def frame(spark):
    store.tune(spark)
    rows = [(i, t, "clash", "clash", 7) for i, t in enumerate(corpus())] + [(None, "null id " * 3, "clash", "clash", 7)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def brute_removed(texts):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(x[i : i + 200] for x in raw for i in range(len(x) - 199))
    out = []
    for x in raw:
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - 199):
            if seen[x[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(b for b, g in zip(x, gone) if not g)
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(x) else 0
        out.append((len(x), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [20_000, 3])
def test_repeat_tree(frame, hot, monkeypatch):
    monkeypatch.setattr(repeat_tree, "GROUP_ROWS", 50)
    monkeypatch.setattr(repeat_tree.remove_repeats, "__defaults__", ("doc_id", "text", hot))
    texts = corpus()
    want = dict(enumerate(brute_removed([*texts, "null id " * 3])))
    got = {r["doc_id"]: tuple(r)[1:] for r in repeat_tree.digest_query(frame).collect()}
    for i in range(len(texts)):
        assert got[i] == want[i], (i, texts[i])
    assert len(got) == frame.count() and None in got


@pytest.mark.parametrize("hot", [2, 5, 12, 40])
def test_hot_anchors_are_split_by_prefixes(spark, hot, monkeypatch):
    """A passage with surroundings that are alike for longer or shorter stretches on either side, some of them equal: groups are split until none is hot, down to whole windows."""
    store.tune(spark)
    monkeypatch.setattr(repeat_tree.remove_repeats, "__defaults__", ("doc_id", "text", hot))
    r = random.Random(17)
    letters = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    core, left, right = letters(60), [letters(220) for _ in range(3)], [letters(220) for _ in range(3)]
    texts = []
    for _ in range(70):
        a, b = r.choice(left), r.choice(right)
        i, j = r.choice([0, 30, 90, 150, 220]), r.choice([0, 20, 60, 110, 220])
        texts.append(letters(r.randrange(40)) + (a[len(a) - i :] if i else "") + core + b[:j] + letters(r.randrange(200)))
    texts += texts[:6] + [left[0] + core + right[0]] * 5 + [core + right[1] + "é" * 100]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {x["doc_id"]: tuple(x)[1:] for x in repeat_tree.digest_query(frame).collect()}
    want = brute_removed(texts)
    assert sum(x[1] for x in want) > 1000 and [got[i] for i in range(len(texts))] == want


def test_repeat_groups_have_all_occurrences(spark):
    r = random.Random(9)
    a, b = words(r, 60), words(r, 50)
    texts = [f"{words(r, 20)} {a} {words(r, 9)}" for _ in range(5)] + [f"{words(r, 20)} {b} {a} {words(r, 9)}" for _ in range(3)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = collections.defaultdict(set)
    for g in repeat_tree.repeats(frame).collect():
        groups[g["group_id"], g["length"]].add((g["row_id"], g["start"]))
    assert all(n >= 200 for _, n in groups)
    assert max(map(len, groups.values())) == 8
    assert any(len(x) == 3 for x in groups.values())


def test_repeat_groups_of_copies_and_hot_anchors(spark):
    r = random.Random(11)
    a, b = words(r, 60), words(r, 50)
    texts = [f"{words(r, 20)} {a} {words(r, 9)}" for _ in range(3)] + [f"{words(r, 20)} {b} {a} {words(r, 9)}" for _ in range(2)]
    lone = words(r, 90)
    texts += [texts[0]] * 2 + [lone] * 3
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = []
    for hot in (20_000, 2, 1):
        groups = collections.defaultdict(set)
        for g in repeat_tree.repeats(frame, hot=hot).collect():
            groups[g["group_id"], g["length"]].add((g["doc_id"], g["start"]))
        found.append(groups)
    assert found[0] == found[1] == found[2]
    raw = [t.encode() for t in texts]
    for (name, length), members in found[0].items():
        doc, start = min(members)
        passage = raw[doc][start : start + length]
        assert len(passage) == length >= 200 and hashlib.sha256(passage).hexdigest()[:32] == name
        assert members == {(i, k) for i, x in enumerate(raw) for k in range(len(x)) if x.startswith(passage, k)} and len(members) > 1
    assert any({i for i, _ in m} == {7, 8, 9} for m in found[0].values())
    covered = {(i, k) for (_, n), m in found[0].items() for i, s in m for k in range(s, s + n)}
    assert covered >= {(i, k) for i in (0, 5, 6, 7, 8, 9) for k in range(len(raw[i]))}


def test_repeated_rows_are_searched_once(spark, monkeypatch):
    r = random.Random(5)
    text, other = words(r, 150), words(r, 150)
    seen = []
    contexts = repeat_tree._contexts

    def counted(own, places):
        seen.append(places.count())
        return contexts(own, places)

    monkeypatch.setattr(repeat_tree, "_contexts", counted)
    for n in (2, 40):
        frame = spark.createDataFrame([(1, text)] * n + [(2, other), (2, other + text)], "doc_id long, text string")
        rows = repeat_tree.digest_query(frame).collect()
        assert [x["n_removed"] for x in rows if x["doc_id"] == 1] == [len(text)] * n
        assert sorted(x["n_removed"] for x in rows if x["doc_id"] == 2) == [len(other), len(other + text)]
    assert seen[0] == seen[1] > 0


def test_anchors_cover_all_windows():
    r = random.Random(1)
    raw = words(r, 30_000).encode()
    data, offsets = np.frombuffer(raw, np.uint8), np.array([0, 100, 350, len(raw)])
    text, at, near, far, _ = repeat_tree.anchors(data, offsets)
    seen = sorted((t, p - d) for t, p, a, b in zip(text.tolist(), at.tolist(), near.tolist(), far.tolist()) for d in range(a, b + 1))
    assert seen == [(1, s) for s in range(250 - 199)] + [(2, s) for s in range(len(raw) - 350 - 199)]


def multiset(text):
    w = (text or "").split()
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def jaccard(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0.0


def brute_classes(texts):
    sets = [multiset(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("block", [1024, 3])
def test_dart_minhash(frame, block, monkeypatch):
    monkeypatch.setattr(dart_minhash, "BLOCK", block)
    texts = corpus()
    want = brute_classes(texts)
    rows = dart_minhash.near_duplicates(frame).collect()
    assert len(rows) == frame.count()
    got = {r["doc_id"]: r["class_id"] for r in rows if r["doc_id"] is not None}
    assert [got[i] for i in range(len(texts))] == want
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in rows if r["doc_id"] is not None)


@pytest.mark.parametrize("limit", [("BLOCK", 20), ("TASK_BYTES", 20_000)])
def test_strangers_are_dealt_in_blocks(spark, limit, monkeypatch):
    """Many texts that meet one component in its buckets and are too far from it: no task holds more than its blocks, whether by number or by bytes."""
    r = random.Random(21)
    base = words(r, 140).split()
    near = [" ".join(base[:k] + ["x"] + base[k + 1 :]) for k in range(0, 140, 2)]
    strange = [" ".join(base[:112] + words(r, 28).split()) for _ in range(300)]
    texts = [" ".join(base), *near, *strange]
    across, most = dart_minhash._across, 60

    def watched(ordered):
        run = across(ordered)

        def checked(key, left, right):
            assert max(len(left), len(right)) <= most, (key, len(left), len(right))
            return run(key, left, right)

        return checked

    monkeypatch.setattr(dart_minhash, *limit)
    monkeypatch.setattr(dart_minhash, "_across", watched)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x["class_id"] for x in dart_minhash.near_duplicates(frame).collect()}
    assert [got[i] for i in range(len(texts))] == brute_classes(texts)


def test_long_and_short_texts_side_by_side():
    import pandas as pd

    r = random.Random(22)
    long = words(r, 300_000)
    side = lambda rep, label, text: pd.DataFrame({"rep": rep, "component": label, "text": text})
    left, right = side([1, 2], [1, 2], [long, "a b c d e f"]), side([3, 4, 5], [9, 9, 9], [long + " more", "a b c d e f", "a b"])
    assert sorted(map(tuple, dart_minhash._across(False)(None, left, right).to_numpy().tolist())) == [(1, 3), (2, 4)]


def test_dart_minhash_with_several_texts_of_one_id(spark):
    r = random.Random(12)
    a, b = words(r, 150), words(r, 150)
    rows = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (4, words(r, 150))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(x) for x in dart_minhash.near_duplicates(frame).collect())
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True)]


def test_signatures_estimate_weighted_similarity():
    r = random.Random(4)
    base = [f"w{r.randrange(40)}" for _ in range(400)]
    texts = []
    for edits in (0, 5, 20, 60):
        w = list(base)
        for _ in range(edits):
            w[r.randrange(len(w))] = f"e{r.randrange(99)}"
        texts.append(" ".join(w))
    data, offsets = kernels.buffers(pa.array(texts))
    cells, doc = dart_minhash.elements(data, offsets)
    s = dart_minhash.signatures(cells, doc, len(texts))
    assert (s != 0).all()
    for i in range(1, len(texts)):
        assert abs((s[0] == s[i]).mean() - jaccard(multiset(texts[0]), multiset(texts[i]))) < 0.17
    a, b = pa.array(texts[:1] * 3), pa.array(texts[1:])
    assert dart_minhash.similar(a, b).tolist() == [jaccard(multiset(texts[0]), multiset(t)) >= 0.8 for t in texts[1:]]


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert repeat_tree.digest_query(none).count() == 0
    assert dart_minhash.near_duplicates(none).count() == 0
