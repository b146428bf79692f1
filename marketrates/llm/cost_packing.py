"""Cost-balanced packing of documents into training sequences (operator 6).

The cost of a piece of n ids is n + QUADRATIC * n * n, the quadratic term standing for attention within the piece. In each window of documents of one task the
sequences are laid out first: as many of `length` ids as fill up, and the rest of the ids as sequences whose sizes are the powers of two it is made of, which
need no padding. Full `length` cuts of longer documents fill sequences of their own. The remainders, longest first, each go to the sequence of lowest cost that
has room for them; a remainder that fits nowhere whole is cut over the sequences of lowest cost that have room left.

A task packs what it scans, a window at a time: nothing is shuffled, and a worker holds one window. Ids of sequences are unique, not dense. A null text is the
empty text (its end id alone); null or repeated doc_ids are documents of their own; of remainders equally long the one read first goes first, of sequences equally cheap the first; other columns
are not read, whatever their names; an empty table gives no pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .library_ids import library

LENGTH = 1024
WINDOW_IDS = 1 << 22
#: Attention's share in the cost: at 2048 ids the quadratic term equals the linear one.
QUADRATIC = 1 / 2048


class Bins:
    """Open sequences by room left: for each room a heap of (cost, sequence), and a tree over the rooms with the lowest cost below each node."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(self.size)]
        self.tree: list[tuple[float, int]] = [(float("inf"), 0)] * (2 * self.size)

    def _lift(self, room: int) -> None:
        t, i = self.tree, room + self.size
        t[i] = (self.heaps[room][0][0], room) if self.heaps[room] else (float("inf"), 0)
        while i > 1:
            i >>= 1
            t[i] = min(t[2 * i], t[2 * i + 1])

    def push(self, room: int, cost: float, sequence: int) -> None:
        import heapq

        heapq.heappush(self.heaps[room], (cost, sequence))
        self._lift(room)

    def pop(self, room: int) -> tuple[int, float, int] | None:
        """(room, cost, sequence) of lowest cost with at least that room."""
        import heapq

        best, a, b = (float("inf"), 0), room + self.size, 2 * self.size
        while a < b:
            if a & 1:
                best = min(best, self.tree[a])
                a += 1
            if b & 1:
                b -= 1
                best = min(best, self.tree[b])
            a, b = a >> 1, b >> 1
        if best[0] == float("inf"):
            return None
        cost, sequence = heapq.heappop(self.heaps[best[1]])
        self._lift(best[1])
        return best[1], cost, sequence


def cost(n: int) -> float:
    return n + QUADRATIC * n * n


def pack(sizes: list[int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """(document, start, n, sequence, offset) of each piece of documents of these sizes; all sequences end up full."""
    pieces, sequence, rest = [], 0, []
    for k, n in enumerate(sizes):
        for a in range(0, n - n % length, length):
            pieces.append((k, a, length, sequence, 0))
            sequence += 1
        if n % length:
            rest.append((n % length, k))
    total = sum(n for n, _ in rest)
    rooms = [length] * (total // length) + [1 << b for b in range(length.bit_length()) if total % length >> b & 1]
    bins, used = Bins(length), {}
    for i, room in enumerate(rooms):
        bins.push(room, 0.0, sequence + i)
        used[sequence + i] = 0
    for n, k in sorted(rest, key=lambda x: (-x[0], x[1])):
        at = sizes[k] - n
        while n:
            room, spent, s = bins.pop(n) or bins.pop(1)
            take = min(n, room)
            pieces.append((k, at, take, s, used[s]))
            used[s] += take
            at, n = at + take, n - take
            if room > take:
                bins.push(room - take, spent + cost(take), s)
    return pieces


def pack_documents(documents: DataFrame, tokenizer: str, end_id: int = 0, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, cost, ids (little-endian unsigned 32-bit)."""
    schema = pa.schema([*((n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")), ("cost", pa.float64()), ("ids", pa.binary())])

    def run(batches):
        from pyspark import TaskContext

        lib, task, count = library(tokenizer), TaskContext.get().partitionId(), 0
        end, width = np.array([end_id], lib.dtype).tobytes(), lib.dtype.itemsize
        keys, held, total = [], [], 0

        def window():
            nonlocal keys, held, total, count
            sizes = [len(x) // width for x in held]
            pieces = pack(sizes, length)
            for a in range(0, len(pieces), 4000):
                own = pieces[a : a + 4000]
                ids = [np.frombuffer(held[k], lib.dtype, n, s * width).astype("<u4").tobytes() for k, s, n, _, _ in own]
                columns = [[keys[p[0]] for p in own], [p[1] for p in own], [p[2] for p in own], [sizes[p[0]] for p in own], [(task << 36) + count + p[3] for p in own], [p[4] for p in own], [cost(p[2]) for p in own], ids]
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)
            count += 1 + max((p[3] for p in pieces), default=0)
            keys, held, total = [], [], 0

        for batch in batches:
            keys += batch.column(0).to_pylist()
            own = [x + end for x in lib.ids(batch.column(1))]
            held += own
            total += sum(map(len, own)) // width
            if total >= WINDOW_IDS:
                yield from window()
        if held:
            yield from window()

    return documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, cost double, ids binary"
    )


def digest_query(documents: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece with the CRC-32 of its ids."""
    return pack_documents(documents, tokenizer).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "cost")
