"""Operator 13 against a plain version: odd fields, ties, repeated rows, trees of every small size, written levels of several steps."""

import hashlib
import zlib

import pytest

from marketrates.llm import merkle_manifest as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree int, at int, key string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, change=0):
    out = []
    for c in M.COLUMNS:
        v = row[c]
        v = v + change if c == "n_chars" and v is not None else v
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return h(*out)


def climb(nodes):
    """(root, path of each node)"""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, at in enumerate(places):
            other = nodes[at ^ 1] if at ^ 1 < len(nodes) else ""
            paths[k].append((other, at % 2 == 1))
        nodes = [h(*nodes[k : k + 2]) for k in range(0, len(nodes), 2)]
        places = [at // 2 for at in places]
    return nodes[0], paths


def plain(rows):
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = [sorted((r for r in rows if r["lang"] == x), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for x in langs]
    trees = [climb([leaf(r) for r in g]) for g in groups]
    root, tops = climb([t[0] for t in trees])
    out = []
    for group, (subroot, paths), top in zip(groups, trees, tops):
        for r, path in zip(group, paths):
            steps = path + top
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            at = leaf(r, 1 if hit else 0)
            for other, before in steps:
                at = h(other, at) if before else h(at, other)
            out.append((r["doc_id"], leaf(r), subroot, root, h(*[s for s, _ in steps]), at, at == root))
    return sorted(out, key=str)


def check(spark, rows):
    frame = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], "clash", 1, 2, "x") for r in rows], SCHEMA)
    out = M.digest_query(frame)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, out.collect()), key=str) == plain(rows)


def row(i, text="t", lang="en", source="s", n=1):
    return {"doc_id": i, "text": text, "lang": lang, "source": source, "n_chars": n}


def test_odd_rows(spark):
    rows = [row(None), row(None, None, None, None, None), row(3), row(3), row(3, "other"), row(4, ""), row(5, "é😀" * 20000, "de"), row(-7, "x", ""), row(8, "x", "é"), row(9, "x", None, "", 0)]
    check(spark, rows + [row(i, lang="fr", n=None if i % 3 else i) for i in range(10, 60)])


@pytest.mark.parametrize("step", [1, 2, 8])
def test_sizes(spark, step, monkeypatch):
    monkeypatch.setattr(M, "STEP", step)
    check(spark, [row(100 * n + i, str(i), f"l{n:02}") for n in (1, 2, 3, 5, 8, 9) for i in range(n)])


def test_one_leaf_and_hot_tree(spark):
    check(spark, [row(1)])
    check(spark, [row(i, str(i % 7)) for i in range(700)] + [row(9000 + i, lang="de") for i in range(3)])


def test_empty(spark):
    assert M.digest_query(spark.createDataFrame([], SCHEMA)).collect() == []
