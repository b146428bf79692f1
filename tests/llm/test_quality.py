"""Operators 2 and 9: base statistics against brute force, models on held-out labels, odd rows."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from marketrates.llm import bayes_quality, kernels, ngram_quality, store


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen, hit = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            hit.update(range(i, i + 8))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def odd_texts():
    r = random.Random(8)
    out = ["", None, " \n\t", "one", "a b\n" * 30, "é ü x y ### $$\n" * 4, "\n\na\n\na\na \n", "x " * 500]
    for _ in range(200):
        out.append("".join(r.choice(["aa", "b", " ", "\n", "#", "é", "cc dd ee ff gg hh ii jj ", "\r", "\x1c"]) for _ in range(r.randrange(60))))
    return out


def test_base_statistics():
    texts = odd_texts()
    got = ngram_quality.base(*kernels.buffers(pa.array(texts, pa.string())))
    rows = list(zip(*(got[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))))
    assert rows == [brute_base(t) for t in texts]


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    store.tune(spark)
    return spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet"), spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/labels.parquet")


def test_ngram_quality_on_held_out_labels(tables):
    documents, labels = tables
    seen = labels.filter("doc_id % 3 <> 0")
    out = {r["doc_id"]: r for r in ngram_quality.rate(documents, ngram_quality.train(documents, seen)).collect()}
    held = labels.filter("doc_id % 3 = 0").collect()
    fair = [r for r in held if not out[r["doc_id"]]["base_failed"]]
    right = [out[r["doc_id"]]["kept"] == (r["quality"] == 1) for r in fair]
    assert sum(right) / len(right) > 0.93
    for r in documents.limit(50).collect():
        o = out[r["doc_id"]]
        n, chars, symbols, lines, repeats = brute_base(r["text"])
        assert tuple(o)[1:6] == (n, chars, symbols, lines, repeats)
        assert o["base_failed"] == (n < 20 or 100 * repeats > 30 * n)
        assert o["kept"] == (not o["base_failed"] and o["probability"] >= ngram_quality.KEEP)


def test_bayes_quality_on_held_out_labels(tables):
    documents, labels = tables
    out = {r["doc_id"]: r for r in bayes_quality.judge(documents, bayes_quality.train(documents, labels.filter("doc_id % 3 <> 0"))).collect()}
    held = labels.filter("doc_id % 3 = 0").collect()
    good = [out[r["doc_id"]]["kept"] for r in held if r["quality"] == 1 and r["toxic"] == 0]
    poor = [not out[r["doc_id"]]["kept"] for r in held if r["quality"] == 0]
    assert sum(good) / len(good) > 0.93 and sum(poor) / len(poor) > 0.8
    assert all(0 < r["path_rate"] < 1 and 0 < r["host_rate"] < 1 for r in out.values())


def brute_posteriors(rows):
    """(host rate, path rate, score) of each (evidence, host, path), in plain Python from the published formulas."""
    chance = lambda x: min(max(1 / (1 + math.exp(-x)), 1e-6), 1 - 1e-6)
    logit = lambda p: math.log(p / (1 - p))
    hosts, paths = collections.defaultdict(list), collections.defaultdict(list)
    for x, host, path in rows:
        hosts[host].append(chance(x))
        paths[host, path].append(chance(x))
    everything = [p for own in hosts.values() for p in own]
    overall = sum(everything) / len(everything)
    mean = lambda own: sum(own) / len(own)

    def strength(rate, variance):
        return min(max(rate * (1 - rate) / variance - 1, 2.0), 1000.0) if variance > 0 else 50.0

    a = strength(overall, sum(len(o) * mean(o) ** 2 for o in hosts.values()) / len(everything) - overall**2)
    b = strength(overall, sum(len(o) * (mean(o) - mean(hosts[h])) ** 2 for (h, _), o in paths.items()) / len(everything))
    out = []
    for x, host, path in rows:
        h, p = hosts[host], paths[host, path]
        host_rate = (sum(h) + a * overall) / (len(h) + a)
        path_rate = (sum(p) + b * host_rate) / (len(p) + b)
        out.append((host_rate, path_rate, 1 / (1 + math.exp(-(x + logit(path_rate) - logit(overall))))))
    return out


def test_posteriors_against_plain_python(spark):
    r = random.Random(3)
    names = [f"w{chr(97 + i)}" for i in range(12)]
    odds = np.zeros(2 * bayes_quality.HALF)
    for i, w in enumerate(names):
        _, feature, _ = bayes_quality.tokens(*kernels.buffers(pa.array([w])))
        odds[feature[feature < bayes_quality.HALF]] = i / 3
    model = bayes_quality.Evidence(odds, np.array([-1.0, 0.0, 1.5]))
    urls = [f"http://{h}.example/{p}/page" for h in ("a", "b", "c", "d") for p in "xyz" for _ in range(r.randrange(1, 40))] + [None, "no url", "http://e.example/top"]
    rows = [(i, " ".join(r.choices(names[:4] if u and "a.ex" in u else names, k=2)), u, "clash") for i, u in enumerate(urls)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, url string, host string").repartition(3)
    got = {x["doc_id"]: x for x in bayes_quality.judge(frame, model, url="url").collect()}
    site = lambda u: ("<none>", "<none>") if not u or ":" not in u else (u.split("/")[2], "/" + u.split("/")[3] if u.count("/") > 3 else "<none>")
    own = [(got[i]["evidence"], *site(u)) for i, _, u, _ in rows]
    for (i, *_), want in zip(rows, brute_posteriors(own)):
        assert (got[i]["host_rate"], got[i]["path_rate"], got[i]["score"]) == pytest.approx(want, rel=1e-9)
        assert got[i]["kept"] == (want[2] >= bayes_quality.KEEP)
    kept = bayes_quality.judge(frame, model, url="url", carry=True).filter("kept").select("carried.*")
    assert kept.columns == frame.columns and {x["doc_id"] for x in kept.collect()} == {i for i in got if got[i]["kept"]}


def test_sparse_sites_shrink_further(spark):
    rows = [(i, "bad", "big", "p") for i in range(400)] + [(900, "bad", "small", "p")] + [(1000 + i, "fine", "other", "q") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    odds = np.zeros(2 * bayes_quality.HALF)
    _, feature, _ = bayes_quality.tokens(*kernels.buffers(pa.array(["bad"])))
    odds[feature[feature < bayes_quality.HALF]] = 1.0
    out = {r["source"]: r for r in bayes_quality.judge(frame, bayes_quality.Evidence(odds, np.array([-3.0, 0.0, 1.0]))).join(frame.select("doc_id", "source"), "doc_id").collect()}
    assert out["big"]["evidence"] == out["small"]["evidence"] == -2.0 and out["other"]["evidence"] == 1.0
    assert out["big"]["host_rate"] < out["small"]["host_rate"] < out["other"]["host_rate"]
    assert out["big"]["path_rate"] < out["small"]["path_rate"] and out["big"]["score"] < out["small"]["score"]
    assert all(r["kept"] for r in bayes_quality.judge(frame.withColumn("lang", bayes_quality.F.lit(None).cast("string")), None).collect())


@pytest.mark.parametrize("operator", [ngram_quality, bayes_quality])
def test_odd_tables(spark, operator):
    schema = "doc_id long, text string, lang string, source string, kept boolean, evidence double, probability double"
    rows = [(1, None, None, None, True, 1.0, 1.0), (1, "", "en", None, True, 1.0, 1.0), (None, "word " * 30, None, "s", None, None, None), (2, "x" * 200_000, "en", "s", None, None, None)]
    frame = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, None), (None, 1, 1), (2, None, 0), (2, 1, None)], "doc_id long, quality int, toxic int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for given in (labels, none):
        out = operator.quality(frame, given).collect()
        assert len(out) == 4 and all(r["kept"] is not None for r in out)
    assert operator.quality(spark.createDataFrame([], schema), labels).count() == 0
