"""Quality rules: base statistics and a hashed n-gram logistic regression (operator 9).

Base: texts of fewer than MIN_WORDS words, or with more than MAX_REPEATED percent of their words inside 8-word windows that occur twice, fail. Verdict: runs of
one and two words and of 1 to 4 bytes are hashed to 2**BITS features, counted on a logarithmic scale and scaled to length 1 for words and for bytes; a logistic
regression is trained on labelled quality rows, its probabilities are calibrated on rows kept out of training (Platt), and a text is kept at KEEP or more.

Training takes the FIT_ROWS labelled documents of least hash: a documented bound, the only one. Every text is scored whole, in Arrow batches. A null text has no
words and fails the base; labels that are null are not used; documents labelled twice count as their least label. Without labels of both kinds, the base decides. Repeated rows are rated each, equal
texts alike (there are no other ties); a text longer than a block is a block of its own; an empty table gives no rows. `rate` reads doc_id and text only, `keep_good` keeps all columns, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K

MIN_WORDS, MAX_REPEATED, WINDOW = 20, 30, 8
FIT_ROWS = 2000
BITS = 18
KEEP = 0.5
BLOCK_BYTES = 1 << 18
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


def base(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    n = len(offsets) - 1
    start, end, first = K.words(data, offsets)
    p = K.prefix(data)
    full = ~K.SPACE[data]
    points = full & ((data & 0xC0) != 0x80)

    breaks = np.flatnonzero(data == 0x0A)
    line_start = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    text = np.concatenate([np.arange(n), np.searchsorted(offsets, breaks, "right") - 1])
    order = np.lexsort((np.concatenate([offsets[:-1], breaks + 1]), text))
    line_start, text = np.concatenate([offsets[:-1], breaks + 1])[order], text[order]
    line_end = np.append(line_start[1:] - 1, 0)
    last = np.append(text[1:] != text[:-1], True) if len(text) else np.zeros(0, bool)
    line_end[last] = offsets[1:][text[last]]
    filled = np.zeros(len(data) + 1, np.int64)
    np.cumsum(full, out=filled[1:])
    some = filled[line_end] > filled[line_start]
    line_hash, line_text = K.spans(p, line_start[some], line_end[some]), text[some]
    o = np.lexsort((line_hash, line_text))
    h, t = line_hash[o], line_text[o]
    dup_lines = np.bincount(t[1:][(h[1:] == h[:-1]) & (t[1:] == t[:-1])], minlength=n)

    hashes = K.spans(p, start, end)
    w, at = K.windows(hashes, first[1:], WINDOW)
    owner = np.searchsorted(first, at, "right") - 1
    o = np.lexsort((w, owner))
    h, t = w[o], owner[o]
    same = (h[1:] == h[:-1]) & (t[1:] == t[:-1])
    twice = np.zeros(len(w), bool)
    twice[o[1:]] |= same
    twice[o[:-1]] |= same
    cover = np.zeros(len(start) + WINDOW + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    covered = (np.cumsum(cover) > 0)[: len(start)]
    return {
        "n_words": np.diff(first),
        "word_chars": K.sums(points, offsets),
        "n_symbols": K.sums(SYMBOLS[data], offsets),
        "n_dup_lines": dup_lines,
        "n_repeat_words": K.sums(covered, first),
    }


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) of each hashed n-gram, texts ascending; half of the features are for words, half for bytes."""
    n, half = len(offsets) - 1, 1 << (BITS - 1)
    p = K.prefix(data)
    start, end, first = K.words(data, offsets)
    hashes = K.spans(p, start, end)
    parts = []
    for kind, sizes in ((0, (1, 2)), (1, (1, 2, 3, 4))):
        texts, codes = [], []
        for size in sizes:
            if kind == 0:
                h, at = K.windows(hashes, first[1:], size)
                text = np.searchsorted(first, at, "right") - 1
            else:
                at = np.arange(max(0, len(data) - size + 1))
                text = np.searchsorted(offsets, at, "right") - 1
                inside = at + size <= offsets[text + 1]
                at, text = at[inside], text[inside]
                h = K.spans(p, at, at + size)
            texts.append(text)
            codes.append((h % K.U(half)).astype(np.int64) + kind * half)
        key = np.sort(np.concatenate(texts) << BITS | np.concatenate(codes))
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        value = 1 + np.log(np.diff(np.append(new, len(key))))
        key = key[new]
        text = key >> BITS
        norm = np.sqrt(np.bincount(text, value**2, minlength=n))
        parts.append((text, key & ((1 << BITS) - 1), value / norm[text]))
    order = np.argsort(np.concatenate([x[0] for x in parts]), kind="stable")
    return tuple(np.concatenate([x[i] for x in parts])[order] for i in range(3))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Model:
    """Weights, their bias, and Platt's slope and offset."""

    def __init__(self, weight: np.ndarray, bias: float, slope: float, offset: float):
        self.weight, self.bias, self.slope, self.offset = weight, bias, slope, offset

    def margin(self, n: int, text: np.ndarray, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        return np.bincount(text, self.weight[feature] * value, minlength=n) + self.bias

    def probability(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.empty(len(offsets) - 1)
        for a, b in K.blocks(offsets, BLOCK_BYTES):
            f = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            out[a:b] = _sigmoid(self.slope * self.margin(b - a, *f) + self.offset)
        return out


def fit(data: np.ndarray, offsets: np.ndarray, good: np.ndarray, ridge: float = 1e-4, rounds: int = 120) -> Model | None:
    """Gradient descent with momentum on the logistic loss; every fifth text is kept out and calibrates the probabilities."""
    n = len(good)
    if len(set(good.tolist())) < 2:
        return None
    parts = []
    for a, b in K.blocks(offsets, BLOCK_BYTES):
        text, feature, value = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        parts.append(((text + a).astype(np.int32), feature.astype(np.int32), value.astype(np.float32)))
    text, feature, value = (np.concatenate([x[i] for x in parts]) for i in range(3))
    del parts
    held = np.arange(n) % 5 == 4
    if len(set(good[held].tolist())) < 2:
        held[:] = False
    seen = np.flatnonzero(np.bincount(feature, minlength=1 << BITS))
    column = np.zeros(1 << BITS, np.int32)
    column[seen] = np.arange(len(seen))
    column = column[feature]
    weight, speed, bias, bias_speed = np.zeros(len(seen)), np.zeros(len(seen)), 0.0, 0.0
    use, share = ~held, 1 / max(1, int((~held).sum()))
    step = 8.0
    for _ in range(rounds):
        error = np.where(use, _sigmoid(np.bincount(text, weight[column] * value, minlength=n) + bias) - good, 0.0) * share
        speed = 0.9 * speed - step * (np.bincount(column, error[text] * value, minlength=len(seen)) + ridge * weight)
        bias_speed = 0.9 * bias_speed - step * error.sum()
        weight, bias = weight + speed, bias + bias_speed
    full = np.zeros(1 << BITS)
    full[seen] = weight
    model = Model(full, float(bias), 1.0, 0.0)
    if held.any():
        model.slope, model.offset = platt(model.margin(n, text, feature, value)[held], good[held])
    return model


def platt(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through the margins, by Newton steps with smoothed targets."""
    yes, no = good.sum(), len(good) - good.sum()
    target = np.where(good > 0, (yes + 1) / (yes + 2), 1 / (no + 2))
    x, beta = np.stack([margin, np.ones(len(margin))], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ beta)
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        beta = beta - np.linalg.solve(h, x.T @ (p - target) + 1e-6 * (beta - [1.0, 0.0]))
    return max(float(beta[0]), 1e-3), float(beta[1])


def labelled_sample(documents: DataFrame, labels: DataFrame, label, rows: int) -> list:
    """(text, label) of the labelled documents of least hash, at most rows of them: the bound also holds for what is broadcast."""
    own = labels.select("doc_id", label.cast("int").alias("label")).filter("doc_id is not null and label is not null")
    own = own.groupBy("doc_id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = documents.select("doc_id", "text").join(F.broadcast(own), "doc_id").select("doc_id", "text", "label")
    return sorted(found.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect(), key=lambda r: (r["doc_id"] * 2654435761 % (1 << 32), r["doc_id"], r["text"] or ""))


def train(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model | None:
    sample = labelled_sample(documents, labels, F.col("quality"), rows)
    data, offsets = K.buffers(pa.array([r["text"] for r in sample], pa.string()))
    return fit(data, offsets, np.array([r["label"] for r in sample], float))


def verdict(model: Model | None, data: np.ndarray, offsets: np.ndarray, keep: float) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray | None, np.ndarray]:
    """(base statistics, whether the base fails, probability, whether it is kept) of each text."""
    s = base(data, offsets)
    failed = (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEATED * s["n_words"])
    good = model.probability(data, offsets) if model else None
    return s, failed, good, ~failed & (good >= keep) if model else ~failed


def rate(documents: DataFrame, model: Model | None, keep: float = KEEP) -> DataFrame:
    """doc_id, the base statistics, base_failed, probability (null without a model), kept for each row."""
    held = documents.sparkSession.sparkContext.broadcast(model)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches):
        m = held.value
        for batch in batches:
            data, offsets = K.buffers(batch.column(1))
            for a, b in K.blocks(offsets, BLOCK_BYTES):
                part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                s, failed, good, kept = verdict(m, part, own, keep)
                columns = [batch.column(0).slice(a, b - a), *(pa.array(s[x], pa.int64()) for x in names), pa.array(failed), pa.array(good) if m else pa.nulls(b - a, pa.float64()), pa.array(kept)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *names, "base_failed", "probability", "kept"])

    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {', '.join(f'{x} long' for x in names)}, base_failed boolean, probability double, kept boolean")


def keep_good(documents: DataFrame, model: Model | None, keep: float = KEEP) -> DataFrame:
    """The rows that rate() keeps, with all their columns."""
    held = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index("text")

    def run(batches):
        m = held.value
        for batch in batches:
            data, offsets = K.buffers(batch.column(at))
            yield batch.filter(pa.array(np.concatenate([verdict(m, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], keep)[3] for a, b in K.blocks(offsets, BLOCK_BYTES)] or [np.zeros(0, bool)])))

    return documents.mapInArrow(run, documents.schema)


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return rate(documents, train(documents, labels))
