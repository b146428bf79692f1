"""Array kernels over the UTF-8 bytes of one Arrow batch of texts."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Base of the polynomial hash and multipliers of a 64-bit finaliser.
BASE = 0x9E3779B97F4A7C15
MIX1 = 0xFF51AFD7ED558CCD
MIX2 = 0xC4CEB9FE1A85EC53
#: Space and the controls from tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int):
    """(first, last) document ranges of about size bytes each; one longer document is a block of its own."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(BASE, -1, 1 << 64)
    out = []
    for b in (BASE, inverse):
        p = np.full(n, b, U)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0..n at least."""
    return _powers(1 << max(16, int(n + 1).bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(33))
    x *= U(MIX1)
    x ^= x >> U(33)
    x *= U(MIX2)
    x ^= x >> U(33)
    return x


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of (value + 1) * base**i, modulo 2**64; values of 64 bits are taken as they are."""
    out = np.zeros(len(values) + 1, U)
    if len(values):
        v = values if values.dtype == U else values.astype(U) + U(1)
        np.cumsum(v * powers(len(values))[0][: len(values)], out=out[1:])
    return out


def spans(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the runs [start, end), alike wherever they stand."""
    h = (p[end] - p[start]) * powers(len(p))[1][start]
    return mix(h + (end - start).astype(U) * U(MIX2))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) bytes of each word, a run without space, tab..carriage return; and where each document's words begin."""
    full = ~SPACE[data]
    n = len(data)
    first = full.copy()
    first[1:] &= ~full[:-1]
    last = full.copy()
    last[:-1] &= ~full[1:]
    edge = offsets[(offsets > 0) & (offsets < n)]
    first[edge] = full[edge]
    last[edge - 1] = full[edge - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offsets)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values in each range between two offsets, 0 for an empty one."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def windows(hashes: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of each run of size words that stays in its document."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    at = np.arange(n)
    doc = np.searchsorted(starts, at, "right")
    at = at[at + size <= starts[np.minimum(doc, len(starts) - 1)]]
    h = np.zeros(len(at), U)
    for j in range(size):
        h = h * U(BASE) + hashes[at + j]
    return mix(h), at


def crc32_join(first: int, second: int, length: int) -> int:
    """CRC-32 of two runs of bytes from the CRC of each and the second's length: multiplies by x**(8*length) modulo the polynomial."""
    poly = 0xEDB88320  # fixed value: the reversed CRC-32 polynomial

    def times(a: int, b: int) -> int:
        out = 0
        while a:
            if a & 0x80000000:
                out ^= b
            a = (a << 1) & 0xFFFFFFFF
            b = (b >> 1) ^ (poly if b & 1 else 0)
        return out

    power, square, bits = 0x80000000, 0x40000000, 8 * length
    while bits:
        if bits & 1:
            power = times(square, power)
        square = times(square, square)
        bits >>= 1
    return times(power, first) ^ second
