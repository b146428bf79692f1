"""Quality classifier: hierarchical empirical Bayes over documents, paths and hosts (operator 2).

Document evidence: each word of letters, and each 4-gram of the text's shape (letter, capital, digit or the mark itself), has counts among labelled good and bad
documents, gathered by grouped aggregation into a table of fixed size; a document's evidence is the sum of its three strongest words' log odds, shrunk toward
the global rate, and the mean log odds of its shape. A logistic curve fitted on cross-fitted evidence turns both into one log odds of being good.

Sites: the documents' probabilities are summed by host and by path, over all documents. How far hosts differ gives the strength of the global prior, how far
paths of a host differ that of the host's (moments); each host's posterior shrinks to the global rate and each path's to its host's, the more so the fewer
documents it has. A document's score adds its path's log odds, less the global ones, to its own evidence; it is kept at KEEP or more.

Where documents have a URL, site_columns() gives its host and the first folder of its path; `documents` of the query has none, so there source stands for the host and
lang for the path, which is a coarser site than a path is.

good means quality 1 and not toxic. Labels of the FIT_ROWS documents of least hash are used, the one bound; all documents are scored, and all count for their sites.
Null or empty text: no words, no evidence beyond the curve's constant. A null host or path is a site of its own ('<none>'). Without labels of both kinds all are kept.
A doc_id with several labels is good only if all say so. Rows that repeat are scored alike and count as often as they occur. Ties in evidence change nothing: sums
do not depend on their order. Texts of any length are scored whole, in blocks of BLOCK_BYTES, a longer text as a block. Other columns, whatever their names, are left
out of the result, or carried in a struct by keep_good(). An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .store import written

FIT_ROWS = 20_000
HALF = 1 << 17  # hashed words, and as many hashed shapes
WORD_PRIOR, SHAPE_PRIOR = 4.0, 2.0
TOP = 3
KEEP = 0.5
BLOCK_BYTES = 1 << 19

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_letter = np.zeros(256, bool)
_letter[65:91] = _letter[97:123] = _letter[128:] = True
_shape = np.arange(256, dtype=np.uint8)
_shape[65:91], _shape[97:123], _shape[128:], _shape[48:58] = ord("A"), ord("a"), ord("a"), ord("0")


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, count) of hashed words and shapes, each pair once, texts ascending."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    spaced = np.where(_letter[data], _lower[data], 0x20).astype(np.uint8)
    start, end, first = K.words(spaced, offsets)
    word = (K.spans(K.prefix(spaced), start, end) % K.U(HALF)).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    at = np.arange(max(0, len(data) - 3))
    own = np.searchsorted(offsets, at, "right") - 1
    inside = at + 4 <= offsets[own + 1]
    at, own = at[inside], own[inside]
    shape = (K.spans(K.prefix(_shape[data]), at, at + 4) % K.U(HALF)).astype(np.int64) + HALF
    key = np.sort(np.concatenate([text, own]) << 18 | np.concatenate([word, shape]))
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(new, len(key)))
    return key[new] >> 18, key[new] & (2 * HALF - 1), count


def shares(text: np.ndarray, feature: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """1 for a word that occurs; a shape's share of all the text's shapes."""
    shape = feature >= HALF
    total = np.bincount(text[shape], count[shape], minlength=n)
    return np.where(shape, count / np.maximum(total, 1)[text], 1.0)


def table(good: np.ndarray, bad: np.ndarray, n_good: float, n_bad: float) -> np.ndarray:
    """Log odds of being bad for each feature, shrunk toward none."""
    rate = n_bad / (n_good + n_bad)
    out = np.zeros(2 * HALF)
    posterior = (bad[:HALF] + WORD_PRIOR * rate) / (good[:HALF] + bad[:HALF] + WORD_PRIOR)
    out[:HALF] = np.log(posterior / (1 - posterior)) - np.log(rate / (1 - rate))
    overall = (good[HALF:] + bad[HALF:]) / (n_good + n_bad)
    out[HALF:] = np.log((bad[HALF:] + SHAPE_PRIOR * overall + 1e-6) / (n_bad + SHAPE_PRIOR)) - np.log((good[HALF:] + SHAPE_PRIOR * overall + 1e-6) / (n_good + SHAPE_PRIOR))
    return out


def evidence(text: np.ndarray, feature: np.ndarray, count: np.ndarray, n: int, odds: np.ndarray) -> np.ndarray:
    """(n, 2): the strongest words' log odds, the shapes' mean log odds."""
    out = np.zeros((n, 2))
    word = feature < HALF
    t, o = text[word], odds[feature[word]]
    order = np.lexsort((-o, t))
    t, o = t[order], np.maximum(o[order], 0)
    place = np.arange(len(t)) - np.searchsorted(t, t)
    out[:, 0] = np.bincount(t[place < TOP], o[place < TOP], minlength=n)
    share = shares(text, feature, count, n)
    out[:, 1] = np.bincount(text[~word], share[~word] * odds[feature[~word]], minlength=n)
    return out


def curve(x: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Coefficients of the logistic curve, constant last, by Newton steps with a small ridge."""
    x, beta = np.column_stack([x, np.ones(len(x))]), np.zeros(x.shape[1] + 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(beta))
        beta = beta - np.linalg.solve(h, x.T @ (p - good) + 1e-2 * beta)
    return beta


def _counts(batches):
    """Sums of the features' shares by fold and label over a whole task, then one row for each feature seen."""
    sums = np.zeros((2, 2, 2 * HALF))
    docs = np.zeros((2, 2))
    for batch in batches:
        data, offsets = K.buffers(batch.column(0))
        label, fold = (np.asarray(batch.column(c)) for c in (1, 2))
        for a, b in K.blocks(offsets, BLOCK_BYTES):
            t, f, c = tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            s = shares(t, f, c, b - a)
            for i in (0, 1):
                for j in (0, 1):
                    own = (fold[a:b] == i) & (label[a:b] == j)
                    docs[i, j] += own.sum()
                    sums[i, j] += np.bincount(f[own[t]], s[own[t]], minlength=2 * HALF)
    i, j, f = np.nonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (i * 2 + j, f, sums[i, j, f])], ["kind", "feature", "total"])
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(4)), pa.array(np.full(4, -1)), pa.array(docs.ravel())], ["kind", "feature", "total"])


class Evidence:
    """A table of the features' log odds and the curve's coefficients."""

    def __init__(self, odds: np.ndarray, beta: np.ndarray):
        self.odds, self.beta = odds, beta

    def log_odds(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.empty(len(offsets) - 1)
        for a, b in K.blocks(offsets, BLOCK_BYTES):
            t = tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            out[a:b] = np.column_stack([evidence(*t, b - a, self.odds), np.ones(b - a)]) @ self.beta
        return out


def train(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Evidence | None:
    good = ((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).cast("int")
    own = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min(good).alias("good"))
    sample = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # a bounded side, so it is broadcast
    found = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "good", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).alias("fold"))
    found = written(found, "labelled")
    totals = found.mapInArrow(_counts, "kind long, feature long, total double").groupBy("kind", "feature").agg(F.sum("total").alias("total")).toPandas()
    sums, docs = np.zeros((4, 2 * HALF)), np.zeros(4)
    real = totals[totals.feature >= 0]
    np.add.at(sums, (real.kind.to_numpy(), real.feature.to_numpy()), real.total.to_numpy())
    heads = totals[totals.feature < 0]
    np.add.at(docs, heads.kind.to_numpy(), heads.total.to_numpy())
    sums, docs = sums.reshape(2, 2, -1), docs.reshape(2, 2)  # fold, label
    if not docs.sum(0).all():
        return None
    odds = table(sums[:, 1].sum(0), sums[:, 0].sum(0), *docs.sum(0)[::-1])
    crossed = [table(sums[1 - f, 1], sums[1 - f, 0], docs[1 - f, 1], docs[1 - f, 0]) if docs[1 - f].all() else odds for f in (0, 1)]
    held = documents.sparkSession.sparkContext.broadcast(crossed)

    def crossing(batches):
        for batch in batches:
            data, offsets = K.buffers(batch.column(0))
            label, fold = (np.asarray(batch.column(c)) for c in (1, 2))
            for a, b in K.blocks(offsets, BLOCK_BYTES):
                t = tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                both = [evidence(*t, b - a, o) for o in held.value]
                x = np.where((fold[a:b] == 0)[:, None], both[0], both[1])
                yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), pa.array(label[a:b])], ["x0", "x1", "good"])

    points = found.mapInArrow(crossing, "x0 double, x1 double, good int").toPandas().sort_values(["x0", "x1", "good"])  # as many as the bound on labels
    return Evidence(odds, curve(points[["x0", "x1"]].to_numpy(), points["good"].to_numpy(float)))


def _logit(p):
    return F.log(p / (1 - p))


def _strength(mean, square, weight, prior):
    """Prior size from the spread of rates: m(1-m)/variance - 1, kept in sensible bounds; prior where there is nothing to measure."""
    spread = square / weight - (mean / weight) ** 2
    m = mean / weight
    return F.coalesce(F.least(F.greatest(m * (1 - m) / F.when(spread > 0, spread) - 1, F.lit(2.0)), F.lit(1000.0)), F.lit(prior))


def site_columns(url) -> tuple:
    """(host, first folder of the path) of a URL column, in lower case; null where it has none."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    return host, F.nullif(F.regexp_extract(F.try_parse_url(url, F.lit("PATH")), "^(/[^/]*)/", 1), F.lit(""))


def judge(documents: DataFrame, model: Evidence | None, host: str = "source", path: str = "lang", keep: float = KEEP, url: str | None = None, carry: bool = False) -> DataFrame:
    """doc_id, evidence (log odds), host_rate, path_rate (posterior means), score, kept for each row.

    url: a column to take host and path from instead of the columns named; carry: also `carried`, a struct of all the row's columns.
    """
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for batch in batches:
            data, offsets = K.buffers(batch.column(1))
            x = m.log_odds(data, offsets) if m else np.full(len(batch), 35.0)
            rest = batch.columns[4:]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), *rest, pa.array(x)], ["doc_id", "host", "path", *["carried"] * len(rest), "evidence"])

    none = F.lit("<none>")
    site = site_columns(F.col(url)) if url else (F.col(host).cast("string"), F.col(path).cast("string"))
    whole = [F.struct(*documents.columns).alias("carried")] * carry
    own = documents.select("doc_id", "text", F.coalesce(site[0], none).alias("host"), F.coalesce(site[1], none).alias("path"), *whole)
    kinds = ", ".join(f"{c} {t}" for c, t in own.dtypes if c != "text")
    scored = written(own.mapInArrow(run, f"{kinds}, evidence double"), "evidence")
    chance = F.least(F.greatest(1 / (1 + F.exp(-F.col("evidence"))), F.lit(1e-6)), F.lit(1 - 1e-6))
    paths = written(scored.groupBy("host", "path").agg(F.sum(chance).alias("good"), F.count("*").alias("n")), "sites")
    hosts = paths.groupBy("host").agg(F.sum("good").alias("host_good"), F.sum("n").alias("host_n"))
    # Sums over all sites, one row each; what is shrunk is every site, however sparse.
    rate = F.col("host_good") / F.col("host_n")
    overall = hosts.agg(F.sum("host_good").alias("good"), F.sum("host_n").alias("n"), F.sum(rate * F.col("host_n")).alias("m"), F.sum(rate * rate * F.col("host_n")).alias("m2")).select(
        (F.col("good") / F.col("n")).alias("global_rate"), _strength(F.col("m"), F.col("m2"), F.col("n"), 50.0).alias("host_prior")
    )
    inner = F.col("good") / F.col("n")
    within = paths.join(hosts, "host").agg(F.sum(inner * F.col("n")).alias("m"), F.sum((inner - rate) ** 2 * F.col("n")).alias("v"), F.sum("n").alias("n")).select(
        F.coalesce(
            F.least(F.greatest(F.col("m") / F.col("n") * (1 - F.col("m") / F.col("n")) / F.when(F.col("v") > 0, F.col("v") / F.col("n")) - 1, F.lit(2.0)), F.lit(1000.0)), F.lit(50.0)
        ).alias("path_prior")
    )
    shrunk = paths.join(hosts, "host").crossJoin(F.broadcast(overall)).crossJoin(F.broadcast(within))  # one row each
    host_rate = (F.col("host_good") + F.col("host_prior") * F.col("global_rate")) / (F.col("host_n") + F.col("host_prior"))
    sites = shrunk.withColumn("host_rate", host_rate).withColumn("path_rate", (F.col("good") + F.col("path_prior") * F.col("host_rate")) / (F.col("n") + F.col("path_prior")))
    shift = (_logit(F.col("path_rate")) - _logit(F.col("global_rate"))).alias("shift")
    sites = sites.select("host", "path", "host_rate", "path_rate", shift)
    sites = written(sites, "rates")  # a table, so that a hot site's side of the join can be split
    joined = scored.join(sites, ["host", "path"], "left")
    score = 1 / (1 + F.exp(-(F.col("evidence") + F.coalesce("shift", F.lit(0.0)))))
    return joined.select("doc_id", "evidence", "host_rate", "path_rate", score.alias("score"), (score >= keep).alias("kept"), *["carried"] * carry)


def keep_good(documents: DataFrame, model: Evidence | None) -> DataFrame:
    """The rows that judge() keeps, with all their columns; rows of equal doc_id are told apart."""
    return judge(documents, model, carry=True).filter("kept").select("carried.*")


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(documents, train(documents, labels))
