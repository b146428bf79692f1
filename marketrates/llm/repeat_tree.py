"""Removal of repeated passages by an enhanced suffix array's interval tree (operator 4).

A string of SPAN bytes is repeated if it also starts anywhere else, in the same text or another. Every window of SPAN bytes has one anchor: its run of GRAM bytes
with the least hash, the leftmost among equals. Equal windows have equal anchors at equal distances, so windows can only meet at anchors of one hash. Anchors whose
hash is met once are dropped before any text is moved. The others are grouped by hash; the suffixes that start at them are sorted with their longest common prefixes
(a sparse enhanced suffix array), a stack scan gives the intervals of the prefix tree, and in each interval the members are sorted by what stands to their left: where
left extensions of two members agree for so long that the repeat reaches SPAN bytes, both are covered. Intervals have all occurrences as members, not just neighbours.

Anchors of more than HOT occurrences are not gathered in one task. Equal surroundings are one there, searched as two, and the group is split by longer prefixes: where two members agree over SPAN
bytes, a to the right of the anchor's beginning and b to its left being known, they agree over half of the rest on one side at least, so those alike in that much to the right and those alike in that
much to the left are groups of their own, each split again while it is hot. What is hot no longer goes through the same tree; a group that is alike over SPAN bytes is covered by them as it is.

Texts are UTF-8 bytes; null is the empty text. Repeated rows are copies like any others, each with an id of its own. Texts with exact copies are covered whole where
they have SPAN bytes, and are searched once. Ties between anchors go to the leftmost. Texts of any length go through in pieces of CHUNK bytes; a text itself is one
row. Other columns are carried in a struct, so their names clash with nothing. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .store import bucketed, partitions, written

SPAN, GRAM = 200, 40
WIDTH = SPAN - GRAM + 1  # runs of GRAM bytes in a window
HOT = 20_000
CHUNK = 1 << 16
PLACE = K.U((1 << 18) - 1)
GROUP_ROWS = 8_000


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, place, least distance, greatest distance, hash) of each anchor; its windows start that far before it."""
    n = len(data)
    out = [[], [], [], [], []]
    for s0 in range(0, max(0, n - SPAN + 1), CHUNK):
        part = data[s0 : s0 + CHUNK + SPAN - 1]
        grams = len(part) - GRAM + 1
        p = K.prefix(part)
        g = K.spans(p, np.arange(grams), np.arange(GRAM, len(part) + 1))
        order = (g & ~PLACE) | np.arange(grams).astype(K.U)
        rows = -(-grams // WIDTH)
        grid = np.full(rows * WIDTH, ~K.U(0))
        grid[:grams] = order
        grid = grid.reshape(rows, WIDTH)
        ahead = np.minimum.accumulate(grid, 1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
        windows = grams - WIDTH + 1
        at = (np.minimum(behind[:windows], ahead[WIDTH - 1 : WIDTH - 1 + windows]) & PLACE).astype(np.int64)
        start = np.arange(s0, s0 + windows)
        text = np.searchsorted(offsets, start, "right") - 1
        fits = start + SPAN <= offsets[text + 1]
        start, text, at = start[fits], text[fits], at[fits]
        if not len(start):
            continue
        new = np.ones(len(start), bool)
        new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        place = at[first] + s0
        for o, x in zip(out, (text[first], place, place - start[last], place - start[first], g[at[first]])):
            o.append(x)
    if not out[0]:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, K.U),)
    text, place, near, far, key = (np.concatenate(o) for o in out)
    new = np.ones(len(text), bool)  # an anchor whose windows lie in two chunks is one
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    text, key, at = text[first], key[first], place[first]
    near, far = np.minimum.reduceat(near, first), np.maximum.reduceat(far, first)
    return text, at - offsets[text], near, far, key


def _anchor_rows(batches):
    for batch in batches:
        data, offsets = K.buffers(batch.column(1))
        for a, b in K.blocks(offsets, 1 << 21):
            text, at, near, far, key = anchors(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            ids = batch.column(0).take(pa.array(text + a))
            yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), ids, pa.array(at << 16 | near << 8 | far)], ["key", "row_id", "place"])


def _context_rows(batches):
    """Each of a text's kept anchors with the bytes that its windows cover."""
    for batch in batches:
        data, offsets = K.buffers(batch.column(1))
        lists = batch.column(2)
        counts = np.diff(np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1])
        flat = lists.flatten()
        key, place = flat.field(0), np.asarray(flat.field(1))
        row = np.repeat(np.arange(len(batch)), counts)
        at, near, far = place >> 16, place >> 8 & 255, place & 255
        raw = data.tobytes()
        begin = offsets[row] + at
        spans = [raw[x:y] for x, y in zip((begin - far).tolist(), (begin + SPAN - near).tolist())]
        yield pa.RecordBatch.from_arrays([key, batch.column(0).take(pa.array(row)), pa.array(place), pa.array(spans, pa.binary())], ["key", "row_id", "place", "bytes"])


def _matrix(flat: np.ndarray, begin: np.ndarray, count: np.ndarray, width: int, step: int) -> np.ndarray:
    """Rows of up to width bytes from begin on, forwards or backwards; 0xFF, no byte of UTF-8, stands beyond the end."""
    out, j = np.empty((len(begin), width), np.uint8), np.arange(width)
    for a in range(0, len(begin), 2000):  # the places take eight times the bytes
        inside = j < count[a : a + 2000, None]
        out[a : a + 2000] = np.where(inside, flat[np.where(inside, begin[a : a + 2000, None] + step * j, 0)], np.uint8(0xFF))
    return out


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each two rows."""
    different = a != b
    return np.where(different.any(1), different.argmax(1), a.shape[1])


def intervals(common: np.ndarray, floor: int) -> list[tuple[int, int, int]]:
    """(value, first, last) of each interval of the prefix tree: the maximal runs of a suffix array whose neighbours share at least that much, by a stack scan."""
    out, stack = [], []  # stack: (value, first)
    for i, value in enumerate([*common.tolist(), -1]):
        first = i
        while stack and stack[-1][0] > value:
            top, first = stack.pop()
            out.append((top, first, i))
        if value >= floor and (not stack or stack[-1][0] < value):
            stack.append((value, first))
    return out


def tree(key: np.ndarray, near: np.ndarray, far: np.ndarray, spans: list[bytes], groups: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(bytes before, bytes after) the anchor that repeats cover, 0 and 0 for none; groups gets (length, before, members) of each maximal repeat."""
    m = len(key)
    flat = np.frombuffer(b"".join(spans), np.uint8)
    size = np.fromiter(map(len, spans), np.int64, m)
    anchor = np.cumsum(size) - size + far
    ahead = SPAN - near
    right, left = _matrix(flat, anchor, ahead, SPAN, 1), _matrix(flat, anchor - 1, far, SPAN - GRAM, -1)
    code = key.astype(np.uint64).astype(">u8").view(np.uint8).reshape(m, 8)
    joined = lambda side: np.ascontiguousarray(np.concatenate([code, side], 1)).view(f"S{8 + side.shape[1]}").ravel()
    order = np.argsort(joined(right), kind="stable")
    rank = np.empty(m, np.int64)
    rank[np.argsort(joined(left), kind="stable")] = np.arange(m)
    key, right, ahead, far, left, rank = key[order], right[order], ahead[order], far[order], left[order], rank[order]
    before, after = np.zeros(m, np.int64), np.zeros(m, np.int64)
    if m > 1:
        common = np.where(key[1:] == key[:-1], _common(right[1:], right[:-1]), -1)
        found = intervals(common, GRAM)
        pairs = np.array([x for x in found if x[2] - x[1] == 1], np.int64).reshape(-1, 3)
        if len(pairs):
            i, j = pairs[:, 1], pairs[:, 2]
            r = np.minimum(pairs[:, 0], np.minimum(ahead[i], ahead[j]))
            shared = np.minimum(_common(left[i], left[j]), np.minimum(far[i], far[j]))
            good = shared + r >= SPAN
            for side in (i[good], j[good]):
                np.maximum.at(before, side, shared[good])
                np.maximum.at(after, side, r[good])
            if groups is not None:
                groups += [(int(a + b), int(a), [int(order[x]), int(order[y])]) for a, b, x, y in zip(shared[good], r[good], i[good], j[good])]
        for value, first, last in (x for x in found if x[2] - x[1] > 1):
            own = np.arange(first, last + 1)
            own = own[np.argsort(rank[own])]
            r = min(value, int(ahead[own[0]]))
            shared = np.minimum(_common(left[own[1:]], left[own[:-1]]), np.minimum(far[own[1:]], far[own[:-1]]))
            best = np.zeros(len(own), np.int64)
            best[1:] = shared
            best[:-1] = np.maximum(best[:-1], shared)
            good = best + r >= SPAN
            side = own[good]
            before[side] = np.maximum(before[side], best[good])
            after[side] = np.maximum(after[side], r)
            if groups is not None:
                # Members of one left interval that all go on alike to the right beyond this interval's value belong to a deeper one.
                for deep, a, b in intervals(shared, max(0, SPAN - r)):
                    inner = np.sort(own[a : b + 1])
                    if (common[inner[0] : inner[-1]] == value).any():
                        groups.append((deep + r, deep, [int(order[x]) for x in inner]))
    out = np.zeros((2, m), np.int64)
    out[0, order], out[1, order] = before, after
    return out[0], out[1]


def _whole_groups(batches):
    """Batches sorted by key -> tables that hold all rows of each of their keys."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows < GROUP_ROWS:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        key = np.asarray(table.column("key"))
        cut = int(np.searchsorted(key, key[-1])) if key[0] <= key[-1] else 0
        if cut:
            yield table.slice(0, cut)
        held, rows = table.slice(cut).to_batches(), len(table) - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _covered(batches):
    for table in _whole_groups(batches):
        if not len(table):
            continue
        key, place = (np.asarray(table.column(c)) for c in ("key", "place"))
        at, near, far = place >> 16, place >> 8 & 255, place & 255
        before, after = tree(key, near, far, table.column("bytes").to_pylist())
        hit = np.flatnonzero(after)
        yield pa.RecordBatch.from_arrays([table.column("row_id").combine_chunks().take(pa.array(hit)), pa.array((at - before)[hit]), pa.array((at + after)[hit])], ["row_id", "start", "end"])


def _repeat_groups(batches):
    for table in _whole_groups(batches):
        if not len(table):
            continue
        key, place = (np.asarray(table.column(c)) for c in ("key", "place"))
        at, near, far = place >> 16, place >> 8 & 255, place & 255
        spans, groups = table.column("bytes").to_pylist(), []
        tree(key, near, far, spans, groups)
        ids, rows = table.column("row_id").to_pylist(), []
        for length, before, members in groups:
            x = members[0]
            text = spans[x][int(far[x]) - before :][:length]
            name = hashlib.sha256(text).hexdigest()[:32]
            rows += [{"group_id": name, "length": length, "row_id": ids[i], "start": int(at[i]) - before} for i in members]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("group_id", pa.string()), ("length", pa.int64()), ("row_id", pa.int64()), ("start", pa.int64())]))


def _cut(whole_characters: bool):
    """Merge a text's covered ranges into runs and take them out; a run may first be narrowed to the characters that lie in it whole."""

    def run(batches):
        for batch in batches:
            data, offsets = K.buffers(batch.column(1))
            raw, spans, kept = data.tobytes(), [], []
            for k, ranges in enumerate(batch.column(2).to_pylist()):
                text, at, parts, runs = raw[offsets[k] : offsets[k + 1]], 0, [], []
                for a, b in sorted((x["start"], x["end"]) for x in ranges or ()):
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], b)
                    else:
                        runs.append([a, b])
                if whole_characters:
                    for r in runs:
                        while r[0] < r[1] and text[r[0]] & 0xC0 == 0x80:
                            r[0] += 1
                        while r[0] < r[1] < len(text) and text[r[1]] & 0xC0 == 0x80:
                            r[1] -= 1
                for a, b in runs:
                    parts.append(text[at:a])
                    at = b
                spans.append([{"start": a, "end": b} for a, b in runs if a < b])
                kept.append(b"".join([*parts, text[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())], ["carried", "spans", "kept"])

    return run


def _identified(documents: DataFrame, key: str, text: str) -> DataFrame:
    """The text, the other columns in a struct, and what tells texts and rows apart."""
    carried = F.struct(*[F.col(c) for c in documents.columns if c != text]).alias("carried")
    own = documents.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), carried).withColumn("text_hash", F.md5("text"))
    # Each row has an id of its own, equal ones too; a lost task gives the same ids again where documents are read again in the same order, as files are.
    return bucketed(own.withColumn("row_id", F.monotonically_increasing_id()), "texts", "row_id")  # two joins with the texts follow


def _contexts(own: DataFrame, places: DataFrame) -> DataFrame:
    lists = places.groupBy("row_id").agg(F.collect_list(F.struct("key", "place")).alias("places"))  # as many as a text has anchors
    texts = own.select("row_id", "text").join(lists, "row_id").select("row_id", "text", "places")
    return texts.mapInArrow(_context_rows, "key long, row_id long, place long, bytes binary")


def _met(own: DataFrame, hot: int) -> DataFrame:
    """Places of anchors whose hash is met twice or more; hot: more than that often."""
    slim = written(own.select("row_id", "text").mapInArrow(_anchor_rows, "key long, row_id long, place long"), "anchors")
    again = written(slim.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "keys")  # a table, so that a hot key's side of the join can be split
    return slim.join(again, "key").withColumn("hot", F.col("n") > hot).drop("n")


def _found(own: DataFrame, hot: int):
    """(places of anchors met twice or more, exact copies): written tables."""
    whole = written(own.groupBy("text_hash").agg(F.count("*").alias("n"), F.min("row_id").alias("first")).filter("n > 1"), "copied")
    copies = written(own.select("row_id", "text_hash").join(whole, "text_hash").select("row_id", (F.col("row_id") == F.col("first")).alias("first")).distinct(), "copies")
    return written(_met(own, hot).join(copies.filter("not first").select("row_id"), "row_id", "left_anti"), "places"), copies


def repeats(documents: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """group_id, length, doc_id, row_id, start: every occurrence of each maximal repeat of SPAN bytes or more within the windows of an anchor.

    A longer repeat has several anchors and is reported as overlapping groups, one or more for each. Exact copies have equal repeats: a text that has copies is
    searched as two, and what is found in it is reported for each of its rows. Anchors of more than hot occurrences are grouped by Spark instead of in one task.
    """
    own = _identified(documents, key, text)
    counts = own.groupBy("text_hash").agg(F.count("*").alias("n"))
    each = own.select("text_hash", "text").dropDuplicates(["text_hash"]).join(counts, "text_hash")
    each = each.withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(F.col("n") > 1, 1).otherwise(0))))
    each = each.sortWithinPartitions("text_hash", "copy").select("text_hash", "text", F.monotonically_increasing_id().alias("row_id"))  # sorted, so that a lost task gives the same ids again
    each = bucketed(each, "searched", "row_id")
    places = written(_met(each, hot), "places")
    spans = _contexts(each, places.filter("not hot")).repartition(partitions(own.sparkSession), "key").sortWithinPartitions("key")
    found = spans.mapInArrow(_repeat_groups, "group_id string, length long, row_id long, start long")
    if not places.filter("hot").isEmpty():
        found = found.unionByName(_hot_groups(_contexts(each, places.filter("hot"))))
    found = written(found.join(each.select("row_id", "text_hash"), "row_id").select("group_id", "length", "text_hash", "start").distinct(), "groups")
    return found.join(own.select("text_hash", "doc_id", "row_id"), "text_hash").select("group_id", "length", "doc_id", "row_id", "start")


def _hot_groups(contexts: DataFrame) -> DataFrame:
    """What _repeat_groups finds, by grouped aggregation: strings that occur twice or more and do not all go on alike to one side within their windows."""
    held = contexts.withColumn("near", F.expr("place >> 8 & 255")).withColumn("far", F.expr("place & 255")).withColumn("at", F.expr("place >> 16"))
    held = held.withColumn("context", F.sha2(F.concat(F.col("bytes"), F.encode(F.concat_ws(" ", F.lit(""), "key", "near", "far"), "utf-8")), 256))
    held = written(held, "contexts")
    alike = held.groupBy("context").agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("key", "near", "far", "bytes")))
    strings = alike.select("context", "n", "key", "near", "far", "bytes").mapInArrow(
        _strings, "context string, n long, key long, before long, length long, group_id string, left int, right int"
    )
    strings = written(strings, "strings")
    same = ["key", "before", "length", "group_id"]
    ends = strings.groupBy(same).agg(F.sum("n").alias("n"), *(f(c).alias(f"{c}_{name}") for c in ("left", "right") for f, name in ((F.min, "low"), (F.max, "high"))))
    open_ = lambda c: (F.col(f"{c}_low") < 0) | (F.col(f"{c}_low") != F.col(f"{c}_high"))  # noqa: E731  -1 stands beyond the windows
    whole = written(ends.filter((F.col("n") > 1) & open_("left") & open_("right")).select(same), "maximal")
    return strings.join(whole, same).select("context", "before", "length", "group_id").join(held.select("context", "row_id", "at"), "context").select(
        "group_id", "length", "row_id", (F.col("at") - F.col("before")).alias("start")
    )


def _split_hot(contexts: DataFrame, hot: int) -> DataFrame:
    """(row_id, start, end) that the windows of hot anchors cover, by the tree over groups of longer and longer prefixes."""
    near, far = F.shiftright("place", 8).bitwiseAND(F.lit(255)), F.col("place").bitwiseAND(F.lit(255))
    held = contexts.withColumns({"near": near.cast("int"), "far": far.cast("int"), "at": F.shiftright("place", 16)})
    held = written(held.withColumn("context", F.md5(F.concat("bytes", F.encode(F.concat_ws(" ", F.lit(""), "key", "near", "far"), "utf-8")))), "contexts")
    alike = held.groupBy("context").agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("key", "near", "far", "bytes")))
    # Two stand for all of equal surroundings: each has another that is like it.
    nodes = alike.withColumn("copy", F.explode(F.sequence(F.lit(0), F.least(F.col("n") - 1, F.lit(1)).cast("int")))).drop("n")
    nodes = written(nodes.withColumns({"a": F.lit(GRAM), "b": F.lit(0), "code": F.col("key")}), "nodes")
    half = F.ceil((F.lit(SPAN) - F.col("a") - F.col("b")) / 2).cast("int")
    own = ["context", "copy", "key", "near", "far", "bytes"]
    ready, leaves = [], []
    while True:
        sizes = written(nodes.groupBy("code").agg(F.count("*").alias("n")), "sizes")
        big = sizes.filter(F.col("n") > hot).select("code")
        ready.append(nodes.join(big, "code", "left_anti").join(sizes.filter("n > 1").select("code"), "code", "left_semi").select(*own, "code"))
        if big.isEmpty():
            break
        left = nodes.join(big, "code", "left_semi")
        leaves.append(left.filter(F.col("a") + F.col("b") >= SPAN).select("context", "a", "b"))
        split = left.filter(F.col("a") + F.col("b") < SPAN)
        sides = [split.select(*own, (F.col("a") + half).alias("a"), "b"), split.select(*own, "a", (F.col("b") + half).alias("b"))]
        fits = (F.col("a") <= SPAN - F.col("near")) & (F.col("b") <= F.col("far"))
        children = sides[0].unionByName(sides[1]).filter(fits).dropDuplicates(["context", "copy", "a", "b"])  # two ways may lead to one prefix
        prefix = F.substring("bytes", F.col("far") - F.col("b") + 1, F.col("a") + F.col("b"))
        nodes = written(children.withColumn("code", F.xxhash64("key", "a", "b", prefix)), "nodes")
    grouped = reduce(DataFrame.unionByName, ready).select(F.col("code").alias("key"), F.col("context").alias("row_id"), (F.col("near") * 256 + F.col("far")).cast("long").alias("place"), "bytes")
    grouped = grouped.repartition(partitions(contexts.sparkSession), "key").sortWithinPartitions("key")
    ranges = grouped.mapInArrow(_covered, "row_id string, start long, end long").withColumnRenamed("row_id", "context")
    for x in leaves:
        ranges = ranges.unionByName(x.select("context", (-F.col("b")).cast("long").alias("start"), F.col("a").cast("long").alias("end")))
    ranges = written(ranges.groupBy("context").agg(F.collect_set(F.struct("start", "end")).alias("ranges")), "context_ranges")  # a context has at most SPAN ranges
    found = held.select("context", "row_id", "at").join(ranges, "context").select("row_id", "at", F.explode("ranges").alias("x"))
    return found.select("row_id", (F.col("at") + F.col("x.start")).alias("start"), (F.col("at") + F.col("x.end")).alias("end"))


def _strings(batches):
    """Each string of SPAN bytes or more around an anchor within its windows, with the bytes that stand next to it there."""
    schema = pa.schema([("context", pa.string()), ("n", pa.int64()), ("key", pa.int64()), ("before", pa.int64()), ("length", pa.int64()), ("group_id", pa.string()), ("left", pa.int32()), ("right", pa.int32())])
    for batch in batches:
        for context, n, key, near, far, span in zip(*(c.to_pylist() for c in batch.columns)):
            rows = []
            for a in range(far - near + 1):
                for b in range(a + SPAN, len(span) + 1):
                    name = hashlib.sha256(span[a:b]).hexdigest()[:32]
                    rows.append((context, n, key, far - a, b - a, name, span[a - 1] if a else -1, span[b] if b < len(span) else -1))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)


def _spans(documents: DataFrame, key: str, text: str, hot: int, whole_characters: bool) -> DataFrame:
    """carried (the other columns), spans, kept for each row."""
    own = _identified(documents, key, text)
    places, copies = _found(own, hot)
    cool = _contexts(own, places.filter("not hot")).repartition(partitions(own.sparkSession), "key").sortWithinPartitions("key")
    ranges = cool.mapInArrow(_covered, "row_id long, start long, end long")
    if not places.filter("hot").isEmpty():
        ranges = ranges.unionByName(_split_hot(_contexts(own, places.filter("hot")), hot))
    lists = written(ranges.groupBy("row_id").agg(F.collect_list(F.struct("start", "end")).alias("ranges")), "ranges")
    struct = "array<struct<start:bigint,end:bigint>>"
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.octet_length("text").cast("long").alias("end"))).cast(struct)
    marked = own.join(copies.select("row_id", F.lit(True).alias("copied")), "row_id", "left").join(lists, "row_id", "left")
    ranges = F.when(F.col("copied") & (F.octet_length("text") >= SPAN), everything).otherwise(F.when(F.col("copied").isNull(), F.col("ranges")))
    cut = marked.select("carried", "text", ranges.alias("ranges"))
    return cut.mapInArrow(_cut(whole_characters), f"carried {dict(own.dtypes)['carried']}, spans {struct}, kept binary")


def remove_repeats(documents: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, spans (start, end of each maximal removed run of bytes), kept (the remaining bytes) for each row."""
    own = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    cut = _spans(own, "doc_id", "text", hot, False)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])
    return cut.select("carried.doc_id", (F.octet_length("kept") + removed).cast("long").alias("n_bytes"), "spans", "kept")


def cut_texts(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with repeated passages cut out of the text, whole characters only, and cut: whether any were. A null text becomes empty."""
    columns = [F.col(f"carried.{c}") if c != text else F.col("kept").cast("string").alias(text) for c in documents.columns]
    return _spans(documents, key, text, HOT, True).select(*columns, (F.size("spans") > 0).alias("cut"))


def digest_query(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])
    return remove_repeats(documents).select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
