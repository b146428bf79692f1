"""Published files as they are, of any size: digests, encodings, heads and lines, read in pieces.

Spark lists the files without opening them and deals their paths to tasks; a task streams each of its files through a running digest and an incremental decoder, so what it holds does not grow with a
file. Files are opened by pyarrow's file systems, which know local and shared folders, HDFS and object stores; a store that only Spark reads needs Spark's own readers.
"""

from __future__ import annotations

import codecs
import csv
import hashlib
import io
import re
import uuid
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

PIECE, HEAD = 1 << 20, 1 << 18
#: Lines in one batch, and how long a line may be in characters before it is handed over in several rows.
BATCH, LONGEST = 5000, 1 << 26
_HIGH = {b: bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def listed(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path, length, modified of each file below root that has a byte (Spark lists no empty ones); contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def _uri(path: str) -> str:
    return re.sub("^file:/(?!/)", "file:///", path) if ":" in path.split("/")[0] else f"file://{path}"


def _open(path: str):
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(_uri(path))
    return system.open_input_stream(inner)


def write_files(lines: DataFrame, root: str, name: str, order: list[str], line: str, suffix: str = ".txt") -> DataFrame:
    """A file <root>/<name><suffix> for each name, its lines in order, each ended by \\n; returns path and length of each, as a table written beside them, so that what reads the files need not list them.

    Tasks stream their files one after another and hold a batch. The files stand in one folder, so listing them is one call, and are written without the two folders, the checksum and the renames that
    a partitioned write makes for each of them. A file appears whole, by a rename; a task that runs again writes the same.
    """

    def run(batches):
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(_uri(root))
        held, at, stream, size, done = None, "", None, 0, []

        def close():
            stream.close()
            system.move(at, f"{inner}/{_file_name(held)}{suffix}")
            done.append((f"{root.rstrip('/')}/{_file_name(held)}{suffix}", size))

        def told():
            rows = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.string(), pa.int64()))], ["path", "length"])
            done.clear()
            return rows

        for batch in batches:
            texts, begin, runs = pc.fill_null(batch.column(1), ""), 0, pc.run_end_encode(batch.column(0))
            for own, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if not own:
                    raise ValueError("lines without a file's name")
                if own != held:
                    if stream:
                        close()
                    held, at, size = own, f"{inner}/.{uuid.uuid4().hex}", 0
                    stream = system.open_output_stream(at)
                piece = "".join([x + "\n" for x in texts.slice(begin, end - begin).to_pylist()]).encode()
                stream.write(piece)
                size, begin = size + len(piece), end
            if done:
                yield told()
        if stream:
            close()
            yield told()

    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(_uri(root))
    system.create_dir(inner, recursive=True)
    dealt = lines.repartition(name).sortWithinPartitions(name, *order).select(F.col(name).cast("string"), F.col(line).cast("string"))
    return shared.written(dealt.mapInArrow(run, "path string, length long"), "files")


def write_lines(lines: DataFrame, root: str, name: str, order: list[str], line: str, suffix: str = ".txt") -> int:
    """write_files; returns how many there are."""
    return write_files(lines, root, name, order, line, suffix).count()


def _file_name(name: str) -> str:
    """Letters, digits, - and ~ only: paths and URIs have it alike, and Spark, which skips names that begin with . or _, reads it."""
    return quote(name, safe="").replace("~", "%7E").replace("_", "%5F").replace(".", "%2E").replace("%", "~")


def name_of(path: Column | str, suffix: str = ".txt") -> Column:
    """The name under which write_lines wrote a file, of its path or URI."""
    return F.url_decode(F.translate(F.regexp_extract(path, f"([^/]+){re.escape(suffix)}$", 1), "~", "%"))


def content(path: str) -> bytes:
    """A small file's bytes."""
    return b"".join(_pieces(path))


def _pieces(path: str, size: int = 0):
    with _open(path) as stream:
        while piece := stream.read(size or PIECE):
            yield piece


class _Western:
    """Windows-1252 piece by piece; its five free bytes are the control characters of their number."""

    def decode(self, piece: bytes, final: bool = False) -> str:
        return piece.decode("latin-1").translate(_HIGH)


def _is_utf8(path: str) -> bool:
    decoder = codecs.getincrementaldecoder("utf-8")()
    try:
        for piece in _pieces(path):
            decoder.decode(piece)
        decoder.decode(b"", True)
    except UnicodeDecodeError:
        return False
    return True


def digests(files: DataFrame) -> DataFrame:
    """files (with path) with byte_count, file_hash (SHA-256) and encoding ('utf-8' or 'windows-1252'): one reading of each file in pieces."""

    def run(batches):
        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                digest, decoder, n = hashlib.sha256(), codecs.getincrementaldecoder("utf-8")(), 0
                for piece in _pieces(path):
                    digest.update(piece)
                    n += len(piece)
                    try:
                        decoder = decoder and (decoder.decode(piece), decoder)[1]
                    except UnicodeDecodeError:
                        decoder = None
                try:
                    utf = decoder is not None and decoder.decode(b"", True) is not None
                except UnicodeDecodeError:
                    utf = False
                rows.append((n, digest.hexdigest(), "utf-8" if utf else "windows-1252"))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else ((), (), ()), (pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "byte_count", "file_hash", "encoding"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields], "byte_count long, file_hash string, encoding string"])
    return dealt(files).mapInArrow(run, schema)


def decoded_lines(files: DataFrame) -> DataFrame:
    """path, line_ordinal from 0, line: UTF-8 without its mark, where the whole file is that, else Windows-1252; two readings of each file in pieces.

    Lines end at \\n or \\r\\n. A line of more than LONGEST characters comes in several rows of one ordinal, in order of part.
    """
    names = ["path", "line_ordinal", "part", "line"]

    def rows(path: str):
        decoder = codecs.getincrementaldecoder("utf-8-sig")() if _is_utf8(path) else _Western()
        held, n, part = "", 0, 0
        for piece in _pieces(path):
            *whole, held = (held + decoder.decode(piece)).split("\n")
            for x in whole:
                yield path, n, part, x.removesuffix("\r")
                n, part = n + 1, 0
            while len(held) > LONGEST:
                yield path, n, part, held[:LONGEST]
                held, part = held[LONGEST:], part + 1
        held += decoder.decode(b"", True)
        if held or part:
            yield path, n, part, held.removesuffix("\r")

    def run(batches):
        out, size = [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.string()))], names)

        for given in batches:
            for path in given.column("path").to_pylist():
                for row in rows(path):
                    out.append(row)
                    size += len(row[3])
                    if len(out) >= BATCH or size >= LONGEST:
                        yield batch()
                        out, size = [], 0
        if out:
            yield batch()

    return dealt(files.select("path")).mapInArrow(run, "path string, line_ordinal long, part long, line string")


def _layout(head: bytes, whole: bool) -> tuple[str, str | None]:
    """(layout, version) told from a file's first bytes; whole: whether these are all."""
    try:
        text = codecs.getincrementaldecoder("utf-8-sig")().decode(head)
    except UnicodeDecodeError:
        text = _Western().decode(head)
    if text.lstrip()[:1] in ("{", "["):
        found = re.search(r'"version"\s*:\s*"([^"]*)"', text)
        return "json", found[1] if found else None
    csv.field_size_limit(2**31 - 1)
    cut = text if whole else text[: text.rfind("\n") + 1]
    rows = [[x.strip() for x in row] for row, _ in zip(csv.reader(io.StringIO(cut, newline="")), range(3))]
    keys, values, names = [*rows, [], [], []][:3]
    version = next((v for k, v in zip(keys, values) if k.lower() == "version"), None) or None
    lower = [x.lower() for x in names]
    if "payer_name" in lower:
        return "csv_tall", version
    if any(re.match(r"standard_charge\|[^|]*\|[^|]*\|", x) for x in lower):
        return "csv_wide", version
    return "unknown", version


def layouts(files: DataFrame, head: int = HEAD) -> DataFrame:
    """files (with path) with layout ('json', 'csv_tall', 'csv_wide', 'unknown') and version: one reading of at most `head` bytes of each file."""

    def run(batches):
        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                with _open(path) as stream:
                    first = stream.read(head)
                found.append(_layout(first, len(first) < head))
            columns = [pa.array([x[k] for x in found], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "layout", "version"])

    return dealt(files).mapInArrow(run, ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields], "layout string, version string"]))


def dealt(files: DataFrame) -> DataFrame:
    """Paths over all tasks: a listing has few partitions and few bytes, however much the files hold, so how many tasks take them is said here."""
    return files.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("path"))
