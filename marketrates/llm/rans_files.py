"""Token-ID files coded by a static range asymmetric numeral system (operator 1).

Layout of a file set, all written by Spark:

* `blocks`: one row per block of at most BLOCK_IDS ids, in ascending order of (shard, block). `payload` holds the 32-bit words of LANES interleaved coders, in
  reading order; `points` holds, for each checkpoint, the lanes' 64-bit states and the words read so far; `sums` the CRC-32 of the ids from each checkpoint to
  the next. A reader may start at any checkpoint of any block. `doc_ids`, `pieces`, `lengths` say which document each run of ids belongs to.
* `table`: the shared frequency table: id and frequency, adding up to 2**SCALE_BITS, made from the counts of all ids.

Documents are ordered by (id, text), those that share an id and their first 64 characters in no order among themselves; null ids come first; a null text is the empty text, which still has its
end id; repeated rows are documents of their own, spread over tasks however many they are. A document longer than a block is cut into pieces. Other columns are not read, whatever their names. An
empty table gives empty files.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .library_ids import library
from .store import partitions, scratch

SCALE_BITS = 20
LANES = 2048
BLOCK_IDS = 1 << 19
POINT_STEPS = 64  # checkpoints every so many steps of all lanes
LOW = np.uint64(1 << 31)

_plain = "shard long, block long, doc_ids binary, nulls binary, pieces binary, lengths binary, ids binary, n long, inside long, seen_ids binary, seen_counts binary"
_coded = "shard long, block long, first_id long, n long, doc_ids binary, nulls binary, pieces binary, lengths binary, payload binary, points binary, sums binary"


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Frequencies that add up to 2**SCALE_BITS, at least 1 for each id seen, in proportion otherwise."""
    total, size = int(counts.sum()), 1 << SCALE_BITS
    if not total:
        return np.zeros(len(counts), np.uint64)
    seen = counts > 0
    if int(seen.sum()) > size:
        raise ValueError(f"more than {size} different ids")
    f = np.where(seen, np.maximum(1, (counts * (size / total)).astype(np.int64)), 0)
    over = int(f.sum()) - size
    for i in np.argsort(-f, kind="stable"):  # the largest give or take the rounding
        if over == 0:
            break
        step = min(over, int(f[i]) - 1) if over > 0 else over
        f[i] -= step
        over -= step
    return f.astype(np.uint64)


class Table:
    def __init__(self, ids: np.ndarray, freq: np.ndarray):
        """ids in ascending order and their frequencies."""
        self.ids, self.freq = ids.astype(np.uint32), freq.astype(np.uint64)
        self.start = np.zeros(len(freq) + 1, np.uint64)
        np.cumsum(self.freq, out=self.start[1:])
        self.slot = np.repeat(np.arange(len(freq), dtype=np.int32), freq.astype(np.int64))
        self.index = np.zeros(int(self.ids[-1]) + 1 if len(ids) else 1, np.int32)
        self.index[self.ids] = np.arange(len(ids))

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
        """(payload, points, sums) of one block."""
        n, bits = len(ids), np.uint64(SCALE_BITS)
        symbol = self.index[ids]
        freq, start = self.freq[symbol], self.start[symbol]
        state = np.full(LANES, LOW, np.uint64)
        words, points = [], []
        steps = -(-n // LANES)
        for i in range(steps - 1, -1, -1):
            a, b = i * LANES, min(n, (i + 1) * LANES)
            f, x = freq[a:b], state[: b - a]
            full = x >= (f << np.uint64(63 - SCALE_BITS))
            words.append(x[full].astype("<u4"))
            x = np.where(full, x >> np.uint64(32), x)
            q = x // f
            state[: b - a] = (q << bits) + (x - q * f) + start[a:b]
            if i % POINT_STEPS == 0:
                points.append((sum(map(len, words)), state.copy()))
                words = [np.concatenate(words[::-1])] if len(words) > 1 else words
        payload = words[0] if words else np.zeros(0, "<u4")
        total = len(payload)
        marks = [np.append(s, np.uint64(total - w)) for w, s in reversed(points)]
        raw = ids.astype("<u4")
        size = LANES * POINT_STEPS
        sums = [zlib.crc32(raw[a : a + size].tobytes()) for a in range(0, n, size)]
        return payload.tobytes(), np.array(marks, "<u8").tobytes(), np.array(sums, "<u4").tobytes()

    def decode(self, payload: bytes, points: bytes, sums: bytes, n: int, segments: range | None = None) -> np.ndarray:
        """Ids of the block, or of some of its segments between checkpoints; an error where a checksum differs."""
        words, marks = np.frombuffer(payload, "<u4").astype(np.uint64), np.frombuffer(points, "<u8").reshape(-1, LANES + 1)
        checks, mask, bits = np.frombuffer(sums, "<u4"), np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS)
        out = []
        for k in segments if segments is not None else range(len(marks)):
            state, at = marks[k, :LANES].copy(), int(marks[k, LANES])
            first, last = k * POINT_STEPS * LANES, min(n, (k + 1) * POINT_STEPS * LANES)
            got = np.empty(last - first, np.int32)
            for a in range(first, last, LANES):
                b = min(last, a + LANES)
                x = state[: b - a]
                low = x & mask
                s = self.slot[low]
                x = self.freq[s] * (x >> bits) + low - self.start[s]
                need = np.flatnonzero(x < LOW)
                x[need] = x[need] << np.uint64(32) | words[at : at + len(need)]
                at += len(need)
                state[: b - a] = x
                got[a - first : b - first] = s
            ids = self.ids[got].astype("<u4")
            if zlib.crc32(ids.tobytes()) != int(checks[k]):
                raise ValueError(f"segment {k}: its checksum differs")
            out.append(ids)
        return np.concatenate(out) if out else np.zeros(0, "<u4")


def _packed(x, kind: str) -> bytes:
    return np.array(x, kind).tobytes()


def _blocks(tokenizer: str, end_id: int):
    """Ordered documents of one partition -> rows of plain ids, then one row of the partition's id counts."""

    def run(batches):
        from pyspark import TaskContext

        lib, shard = library(tokenizer), TaskContext.get().partitionId()
        end, counts = np.array([end_id], lib.dtype).tobytes(), np.zeros(max(lib.tokenizer.get_vocab_size(), end_id + 1), np.int64)
        size, block, held, total, before = lib.dtype.itemsize, 0, [], 0, 0

        def row():
            nonlocal block, held, total, before
            raw = b"".join(x[3] for x in held)
            counts[:] += np.bincount(np.frombuffer(raw, lib.dtype), minlength=len(counts))
            out = {
                "shard": shard, "block": block, "doc_ids": _packed([x[0] or 0 for x in held], "<i8"), "nulls": _packed([x[0] is None for x in held], "u1"),
                "pieces": _packed([x[1] for x in held], "<i8"), "lengths": _packed([x[2] for x in held], "<i8"), "ids": raw, "n": total, "inside": before, "seen_ids": None, "seen_counts": None,
            }
            block, held, before, total = block + 1, [], before + total, 0
            return pa.RecordBatch.from_pylist([out], _schema)  # one block, however many documents

        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), (x + end for x in lib.ids(batch.column(1)))):
                n = len(ids) // size
                if total and total + n > BLOCK_IDS:
                    yield row()
                for piece, a in enumerate(range(0, n, BLOCK_IDS)):
                    part = ids[a * size : (a + BLOCK_IDS) * size]
                    held.append((key, piece, len(part) // size, part))
                    total += len(part) // size
                    if total >= BLOCK_IDS:
                        yield row()
        if total:
            yield row()
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pylist([{"shard": shard, "block": -1, "seen_ids": _packed(seen, "<u4"), "seen_counts": _packed(counts[seen], "<i8"), "n": int(counts.sum())}], _schema)

    return run


_binary = lambda *names: [(n, pa.binary()) for n in names]
_schema = pa.schema([("shard", pa.int64()), ("block", pa.int64()), *_binary("doc_ids", "nulls", "pieces", "lengths", "ids"), ("n", pa.int64()), ("inside", pa.int64()), *_binary("seen_ids", "seen_counts")])
_files = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("first_id", pa.int64()), ("n", pa.int64()), *_binary("doc_ids", "nulls", "pieces", "lengths", "payload", "points", "sums")])


def write_files(documents: DataFrame, path: str, tokenizer: str, end_id: int = 2, key: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text by the tokenizers library, append end_id, and write the ids in ascending order of the key to path."""
    spark = documents.sparkSession
    own = documents.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # By the text's beginning and then by row, too: many rows of one id, or of none, are spread, also where they repeat.
    own = own.withColumn("row", F.monotonically_increasing_id())
    ordered = own.repartitionByRange(partitions(spark), "key", F.substring("text", 1, 64), "row").sortWithinPartitions("key", "text").drop("row")
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        ordered.mapInArrow(_blocks(tokenizer, end_id), _plain).write.option("compression", "snappy").parquet(plain := scratch(spark, "ids"))
    finally:
        spark.conf.set(setting, before)
    ids = spark.read.schema(_plain).parquet(plain)

    # One row of the vocabulary's size at most for each shard, summed up on the executors: the table is bounded by the vocabulary.
    width = "<u4"
    pairs = ids.filter("block = -1").select("seen_ids", "seen_counts").mapInArrow(_unpacked(width), "id long, count long")
    totals = pairs.groupBy("id").agg(F.sum("count").alias("count")).orderBy("id").collect()
    seen, counts = np.array([r["id"] for r in totals], np.uint32), np.array([r["count"] for r in totals], np.int64)
    freq = frequencies(counts)
    spark.createDataFrame(zip(seen.tolist(), freq.astype(np.int64).tolist()), "id long, frequency long").coalesce(1).write.parquet(f"{path}/table")

    # Ids before each shard: a sum over the shards, a row for each partition of the write above.
    sizes = ids.filter("block = -1").select("shard", F.col("n").alias("shard_n"))
    bases = sizes.withColumn("base", F.sum("shard_n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))).select("shard", F.coalesce("base", F.lit(0)).alias("base"))
    held = spark.sparkContext.broadcast((seen, freq))
    itemsize = library(tokenizer).dtype.str

    def run(batches):
        table = Table(*held.value)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                payload, points, sums = table.encode(np.frombuffer(r["ids"], itemsize))
                rows.append({n: r[n] for n in ("shard", "block", "first_id", "n", "doc_ids", "nulls", "pieces", "lengths")} | {"payload": payload, "points": points, "sums": sums})
                if len(rows) >= 4:
                    yield pa.RecordBatch.from_pylist(rows, _files)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _files)

    plainly = ids.filter("block >= 0").select("shard", "block", "n", "inside", "doc_ids", "nulls", "pieces", "lengths", "ids")
    coded = plainly.join(F.broadcast(bases), "shard").withColumn("first_id", F.col("base") + F.col("inside")).drop("base", "inside")
    few = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")  # a row is a block of ids
    spark.conf.set(setting, "true")
    try:
        coded.mapInArrow(run, _coded).write.option("compression", "none").parquet(f"{path}/blocks")
    finally:
        spark.conf.set(setting, before)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", few)


def _unpacked(width: str):
    def run(batches):
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(a, width).astype(np.int64)), pa.array(np.frombuffer(b, "<i8"))], ["id", "count"])

    return run


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, piece (0 unless the document is longer than a block), start (ids of all documents before this piece), n, ids (little-endian 32-bit)."""
    rows = spark.read.parquet(f"{path}/table").orderBy("id").collect()  # bounded by the vocabulary
    held = spark.sparkContext.broadcast((np.array([r["id"] for r in rows], np.uint32), np.array([r["frequency"] for r in rows], np.uint64)))
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        table = Table(*held.value)
        for batch in batches:
            for r in batch.to_pylist():
                ids = table.decode(r["payload"], r["points"], r["sums"], r["n"])
                lengths = np.frombuffer(r["lengths"], "<i8")
                ends = np.cumsum(lengths)
                keys = pa.array(np.frombuffer(r["doc_ids"], "<i8"), pa.int64(), mask=np.frombuffer(r["nulls"], "u1").astype(bool))
                parts = [ids[b - n : b].tobytes() for b, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays([keys, pa.array(np.frombuffer(r["pieces"], "<i8")), pa.array(r["first_id"] + ends - lengths), pa.array(lengths), pa.array(parts, pa.binary())], schema=schema)

    files = spark.read.schema(_coded).parquet(f"{path}/blocks").drop("shard", "block")
    return files.mapInArrow(run, "doc_id long, piece long, start long, n long, ids binary")


@F.pandas_udf(T.LongType())
def _joined_crc(parts):
    """CRC-32 of a document from those of its pieces, (piece, length in bytes, crc) in order."""
    import functools

    def one(rows):
        rows = sorted((r["piece"], r["bytes"], r["crc"]) for r in rows)
        return functools.reduce(lambda a, r: K.crc32_join(a, r[2], r[1]), rows[1:], rows[0][2])

    return parts.map(one)


def digest_query(documents: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    spark = documents.sparkSession
    path = scratch(spark, "token-files")
    write_files(documents, path, tokenizer)
    pieces = read_files(spark, path).select("doc_id", "piece", "start", "n", F.crc32("ids").alias("crc"))
    # A document's pieces share start - BLOCK_IDS * piece, as all but the last are whole blocks.
    document = (F.col("start") - F.col("piece") * BLOCK_IDS).alias("start")
    part = F.struct("piece", (F.col("n") * 4).alias("bytes"), "crc")
    whole = pieces.groupBy("doc_id", document).agg(F.sum("n").alias("n_tokens"), F.collect_list(part).alias("parts"))
    crc = F.when(F.size("parts") == 1, F.col("parts")[0]["crc"]).otherwise(_joined_crc("parts"))
    return whole.select("doc_id", "start", "n_tokens", crc.alias("ids_crc32"), F.size("parts").cast("long").alias("n_pieces"))
