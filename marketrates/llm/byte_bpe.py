"""Byte-level BPE encoding and decoding (operator 10).

Pre-tokenisation is done on arrays: every code point gets a class (one look ahead is folded into the class), a class is a function from scanner state to
scanner state, and the functions are composed with an associative scan over blocks; the state before a character and its class say whether a piece starts
there. No regular expression locates a boundary. The pieces are byte slices of the batch; each distinct slice is merged once and cached.

Nulls count as the empty text; an empty text has no ids. Equal rows give equal rows. Of pairs of equal rank in a piece the leftmost is merged first; there are no other ties. Texts of any length are taken
whole, a longer one than a block as a block of its own. Other columns pass through untouched; one that has the name of what is added is replaced. An empty table gives an empty one.
"""

from __future__ import annotations

import base64
import functools
import heapq
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K

#: Bytes of text scanned at once, and pieces remembered by a Python worker.
BLOCK_BYTES = 1 << 19
CACHE_PIECES = 400_000
MERGED = 8_000  # pieces merged together
#: Above every id.
NO_PAIR = 1 << 40

FRESH, AFTER_SPACE, LETTERS, NUMBERS, MARKS, QUOTE, INSIDE, SUFFIX, BLANKS = range(9)
LETTER, LETTER_ONE, LETTER_TWO, NUMBER, MARK, APOSTROPHE, SPACE_MORE, SPACE_LAST, BLANK_MORE, BLANK_LAST, RESET = range(11)


def _step(state: int, kind: int) -> tuple[int, bool]:
    """(next state, whether a piece starts at this character)."""
    if kind == RESET:
        return FRESH, True
    if kind in (SPACE_MORE, BLANK_MORE):
        return BLANKS, state != BLANKS
    if kind in (SPACE_LAST, BLANK_LAST):
        return (AFTER_SPACE if kind == SPACE_LAST else FRESH), True
    if kind == NUMBER:
        return NUMBERS, state not in (AFTER_SPACE, NUMBERS)
    if kind in (MARK, APOSTROPHE):
        if state in (AFTER_SPACE, MARKS, QUOTE):
            return MARKS, False
        return (QUOTE if kind == APOSTROPHE else MARKS), True
    if state == INSIDE:
        return SUFFIX, False
    if state == QUOTE and kind == LETTER_ONE:
        return SUFFIX, False
    if state == QUOTE and kind == LETTER_TWO:
        return INSIDE, False
    return LETTERS, state not in (AFTER_SPACE, LETTERS)


@functools.cache
def _machine():
    """Class -> element, element x element -> element, element x state -> state, state x class -> piece starts."""
    generators = [tuple(_step(s, k)[0] for s in range(9)) for k in range(11)]
    elements = [tuple(range(9))]
    index = {elements[0]: 0}
    for g in generators:
        if g not in index:
            index[g] = len(elements)
            elements.append(g)
    grown = 0
    while grown < len(elements):
        f = elements[grown]
        grown += 1
        for g in generators:
            h = tuple(g[x] for x in f)
            if h not in index:
                index[h] = len(elements)
                elements.append(h)
    m = len(elements)
    compose = np.array([[index[tuple(g[x] for x in f)] for g in elements] for f in elements], np.uint16)
    act = np.array(elements, np.uint8)
    starts = np.array([[_step(s, k)[1] for k in range(11)] for s in range(9)], bool)
    return np.array([index[g] for g in generators], np.uint16), compose.ravel(), m, act, starts


def scan(elements: np.ndarray, width: int = 64) -> np.ndarray:
    """Inclusive composition of all elements up to each place: within blocks, then over the blocks' totals, then joined."""
    _, compose, m, _, _ = _machine()
    n = len(elements)
    if n <= width:
        out = np.empty(n, np.uint16)
        acc = 0
        for i, e in enumerate(elements.tolist()):
            acc = int(compose[acc * m + e])
            out[i] = acc
        return out
    rows = -(-n // width)
    grid = np.zeros(rows * width, np.uint16)
    grid[:n] = elements
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    for j in range(1, width):
        grid[j] = compose[grid[j - 1].astype(np.int32) * m + grid[j]]
    before = np.zeros(rows, np.uint16)
    before[1:] = scan(grid[-1], width)[:-1]
    grid = compose[before.astype(np.int32)[None, :] * m + grid]
    return grid.T.ravel()[:n]


@functools.cache
def _classes() -> np.ndarray:
    """Letter, number, white space or mark for each code point, from the Unicode properties of the regex package."""
    import regex

    table = np.full(0x110000, MARK, np.uint8)
    points = np.array([c for c in range(0x110000) if not 0xD800 <= c < 0xE000])
    everything = "".join(map(chr, points.tolist()))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", BLANK_MORE)):
        for hit in regex.finditer(pattern, everything):
            table[points[hit.start() : hit.end()]] = kind
    table[0x20] = SPACE_MORE
    table[0x27] = APOSTROPHE
    return table


def piece_starts(points: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each code point; docs are the first code points of the texts, in order, then the number of points."""
    n = len(points)
    if not n:
        return np.zeros(0, bool)
    element, compose, m, act, starts = _machine()
    kind = _classes()[points]
    blank = (kind == SPACE_MORE) | (kind == BLANK_MORE)
    firsts = docs[:-1][docs[:-1] < docs[1:]]
    ends = docs[1:][docs[:-1] < docs[1:]] - 1
    follows = np.zeros(n, bool)
    follows[:-1] = ~blank[1:]
    follows[ends] = False
    kind[(kind == SPACE_MORE) & follows] = SPACE_LAST
    kind[(kind == BLANK_MORE) & follows] = BLANK_LAST
    after = np.zeros(n, points.dtype)
    after[:-1] = points[1:]
    after[ends] = 0
    for c in "stmd":
        kind[points == ord(c)] = LETTER_ONE
    for c, second in (("r", "e"), ("v", "e"), ("l", "l")):
        kind[(points == ord(c)) & (after == ord(second))] = LETTER_TWO
    e = element[kind]
    e[firsts] = compose[int(element[RESET]) * m + e[firsts].astype(np.int32)]
    state = np.empty(n, np.uint8)
    state[0] = FRESH
    state[1:] = act[scan(e)[:-1], FRESH]
    out = starts[state, kind]
    out[firsts] = True
    return out


class Vocabulary:
    """Ranks of a .tiktoken file: one line per id, base64 of its bytes and the id."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes = [b""] * (max(self.rank.values()) + 1)
        for piece, i in self.rank.items():
            self.bytes[i] = piece
        self.cache: dict[bytes, bytes] = {}
        self.byte_id = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for piece, i in self.rank.items():
            for k in range(1, len(piece)):
                if (x := self.rank.get(piece[:k])) is not None and (y := self.rank.get(piece[k:])) is not None:
                    pairs[x << 32 | y] = i
        self.pair = np.array(sorted(pairs) or [0], np.int64)
        self.joined = np.array([pairs.get(k, NO_PAIR) for k in self.pair.tolist()], np.int64)

    def _pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the joined pair, NO_PAIR where it has none or a side is missing (-1)."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where((self.pair[at] == key) & (left >= 0) & (right >= 0), self.joined[at], NO_PAIR)

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of distinct pieces as little-endian unsigned 32-bit integers; pieces of one width class are merged together, a pair each a round."""
        out: list[bytes] = [b""] * len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        low = 0
        for width in (4, 8, 12, 16, 24, 48):
            rows = np.flatnonzero((sizes > low) & (sizes <= width))
            low = width
            for a in range(0, len(rows), MERGED):
                own = rows[a : a + MERGED]
                raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in own.tolist()), np.uint8).reshape(-1, width)
                parts = np.where(np.arange(width) < sizes[own][:, None], self.byte_id[raw], -1)
                rank = self._pair_rank(parts[:, :-1], parts[:, 1:])
                live, column = np.arange(len(own)), np.arange(width)
                while True:
                    at = rank[live].argmin(1)
                    best = rank[live, at]
                    more = best < NO_PAIR
                    live, at, best = live[more], at[more], best[more]
                    if not len(live):
                        break
                    p = np.take_along_axis(np.pad(parts[live], ((0, 0), (0, 1)), constant_values=-1), column + (column > at[:, None]), 1)
                    k = np.arange(len(live))
                    p[k, at] = best
                    r = np.take_along_axis(np.pad(rank[live], ((0, 0), (0, 1)), constant_values=NO_PAIR), column[:-1] + (column[:-1] > at[:, None]), 1)
                    inner = at < width - 1
                    r[k[inner], at[inner]] = self._pair_rank(best[inner], p[k[inner], at[inner] + 1])
                    inner = at > 0
                    r[k[inner], at[inner] - 1] = self._pair_rank(p[k[inner], at[inner] - 1], best[inner])
                    parts[live], rank[live] = p, r
                count = (parts >= 0).sum(1)
                flat = parts[parts >= 0].astype("<u4").tobytes()
                ends = (np.cumsum(count) * 4).tolist()
                for i, x, y in zip(own.tolist(), [0, *ends], ends):
                    out[i] = flat[x:y]
        for i in np.flatnonzero(sizes > low).tolist():
            out[i] = np.array(self.merge(pieces[i]), "<u4").tobytes()
        return out

    def merge(self, piece: bytes) -> list[int]:
        """Join the adjacent pair of lowest rank, the leftmost among equals, until no pair has a rank."""
        rank = self.rank
        if piece in rank:
            return [rank[piece]]
        if len(piece) > 48:
            return self._merge_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = [rank.get(a + b, 1 << 60) for a, b in itertools.pairwise(parts)]
        while ranks and (low := min(ranks)) < 1 << 60:
            i = ranks.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank.get(parts[i] + parts[i + 1], 1 << 60)
            if i:
                ranks[i - 1] = rank.get(parts[i - 1] + parts[i], 1 << 60)
        return [rank[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap and linked parts, for pieces of any length."""
        rank, n = self.rank, len(piece)
        end, left, right = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(rank[x], i, 2) for i in range(n - 1) if (x := piece[i : i + 2]) in rank]
        heapq.heapify(heap)
        alive = [True] * n

        def offer(i: int) -> None:
            if i >= 0 and right[i] < n and (x := piece[i : end[right[i]]]) in rank:
                heapq.heappush(heap, (rank[x], i, len(x)))

        while heap:
            _, i, size = heapq.heappop(heap)
            if not alive[i] or right[i] >= n or end[right[i]] - i != size:
                continue
            j = right[i]
            alive[j] = False
            end[i], right[i] = end[j], right[j]
            if right[i] < n:
                left[right[i]] = i
            offer(i)
            offer(left[i])
        return [rank[piece[i : end[i]]] for i in range(n) if alive[i]]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], list[bytes]]:
        """Ids of each text and the byte offsets of its pieces, both as little-endian unsigned 32-bit integers."""
        ids, places = [], []
        for a, b in K.blocks(offsets, BLOCK_BYTES):
            own = offsets[a : b + 1] - offsets[a]
            part = data[offsets[a] : offsets[b]]
            raw = part.tobytes()
            points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
            at = np.flatnonzero((part & 0xC0) != 0x80)
            cut = at[piece_starts(points, np.searchsorted(at, own))]
            ends = np.append(cut[1:], len(raw)).tolist()
            pieces = [raw[x:y] for x, y in zip(cut.tolist(), ends)]
            if len(self.cache) > CACHE_PIECES:
                self.cache.clear()
            cache = self.cache
            missing = list(set(pieces) - cache.keys())
            cache.update(zip(missing, self.merge_many(missing)))
            coded = list(map(cache.__getitem__, pieces))
            bounds = np.searchsorted(cut, own)
            for k, (x, y) in enumerate(itertools.pairwise(bounds.tolist())):
                ids.append(b"".join(coded[x:y]))
                places.append((cut[x:y] - own[k]).astype("<u4").tobytes())
        return ids, places


    def decode(self, ids: bytes) -> bytes:
        """The bytes that little-endian unsigned 32-bit ids stand for."""
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _with(batch: pa.RecordBatch, **more: pa.Array) -> pa.RecordBatch:
    kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n not in more]
    return pa.RecordBatch.from_arrays([c for _, c in kept] + list(more.values()), [n for n, _ in kept] + list(more))


def _added(frame: DataFrame, *names: str) -> T.StructType:
    return T.StructType([f for f in frame.schema.fields if f.name not in names] + [T.StructField(n, T.BinaryType()) for n in names])


def encode(frame: DataFrame, ranks: str, text: str = "text", ids: str = "ids", pieces: str = "piece_offsets", decoded: str | None = None, keep_text: bool = True) -> DataFrame:
    """Add the ids of the text and the byte offsets of its pieces, as binary columns of little-endian unsigned 32-bit integers.

    A column that already has one of these names is replaced. ranks: path of the rank file, the same on each executor. decoded: also what the ids decode to, in the same
    pass through Python; keep_text: whether the text goes back to Spark.
    """
    names = [ids, pieces, *[decoded] * bool(decoded)]
    gone = [] if keep_text else [text]

    def run(batches):
        v = vocabulary(ranks)
        for batch in batches:
            a, b = v.encode(*K.buffers(batch.column(batch.schema.names.index(text))))
            columns = [a, b, *[[v.decode(x) for x in a]] * bool(decoded)]
            yield _with(batch.drop_columns(gone), **{n: pa.array(c, pa.binary()) for n, c in zip(names, columns)})

    return frame.mapInArrow(run, _added(frame.drop(*gone), *names))


def decode(frame: DataFrame, ranks: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the bytes that the ids stand for; null ids are none. An id outside the vocabulary is an error."""

    def run(batches):
        v = vocabulary(ranks)
        for batch in batches:
            texts = [v.decode(x.as_buffer() or b"") if x.is_valid else b"" for x in batch.column(batch.schema.names.index(ids))]
            yield _with(batch, **{out: pa.array(texts, pa.binary())})

    return frame.mapInArrow(run, _added(frame, out))


def digest_query(documents: DataFrame, ranks: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text, and the number of its pieces."""
    back = encode(documents.select("doc_id", "text"), ranks, decoded="decoded", keep_text=False)
    return back.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.octet_length("piece_offsets") / 4).cast("long").alias("n_pieces"),
    )
