"""Chat formatting with typed content parts (operator 7).

A turn's content is a text, or a list of parts of type text, image, audio or document. A visitor flattens the parts, in order, into one text with a placeholder
for each attachment; it records the attachment's reference and how many tokens its placeholder expands to. Formatted, a turn is

    <|turn|>role NEWLINE text <|end|>NEWLINE

where role and text are escaped: every backslash, each character that a control string can begin with and line ends in a role are written as a backslash and a
letter. So no control string stands in an escaped text, whatever is overlapped, and none arises where parts meet; reading back restores any text. The loss mask
holds the characters of assistant turns' text.

Turns are formatted row by row, without a shuffle; a conversation's output is its turns in order, a null turn first. Null role or text is empty; rows of equal turn
follow in the order of role and text, and rows that repeat are turns of their own; a null conv_id is a conversation. Unknown part types are an error; other
columns, whatever their names, are left out; an empty table gives no rows. A turn of any length is one row; a conversation's digests run over its rows in order in
one task, as a hash over all its text has to, with one batch of rows held.
"""

from __future__ import annotations

import hashlib
import itertools
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import partitions

#: Strings that a chat template or tokenizer may give a meaning.
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<image", "<audio", "<document")
OPEN, CLOSE = "<|turn|>", "<|end|>\n"
#: Tokens for an image tile, a second of audio and a page of a document.
TILE_TOKENS, TILE_PIXELS, SECOND_TOKENS, PAGE_TOKENS = 85, 512, 25, 600

#: What stands for each character that a control string begins with.
LETTERS = {"<": "l", "|": "p", "[": "b"}
_codes = str.maketrans({"\\": "\\\\"} | {c: "\\" + x for c, x in LETTERS.items()})
_plain = {x: c for c, x in LETTERS.items()} | {"\\": "\\", "n": "\n"}
_escaped = re.compile(r"\\(.)")


def escape(text: str) -> str:
    return text.translate(_codes)


def unescape(text: str) -> str:
    return _escaped.sub(lambda m: _plain[m[1]], text)


def unescaped(column):
    """unescape in Spark: a letter is a code after an odd number of backslashes."""
    for c, x in [*LETTERS.items(), ("\n", "n")]:
        column = F.regexp_replace(column, rf"(?<!\\)((?:\\\\)*)\\{x}", f"$1{c}")
    return F.regexp_replace(column, r"\\\\", r"\\")


class Visitor:
    """Flattens parts: each visit_* adds to the text and, for attachments, to the references."""

    def __init__(self):
        self.text: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        method = getattr(self, f"visit_{part.get('type')}", None)
        if method is None:
            raise ValueError(f"unknown part type {part.get('type')!r}")
        method(part)

    def visit_text(self, part: dict) -> None:
        self.text.append(escape(part.get("text") or ""))

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        at = sum(map(len, self.text))
        self.text.append(f"<{kind}:{len(self.attachments)}>")
        self.attachments.append({"kind": kind, "uri": part.get("uri"), "offset": at, "tokens": tokens})

    def visit_image(self, part: dict) -> None:
        tiles = -(-(part.get("width") or TILE_PIXELS) // TILE_PIXELS) * -(-(part.get("height") or TILE_PIXELS) // TILE_PIXELS)
        self._attach("image", part, tiles * TILE_TOKENS)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, int(-(-(part.get("seconds") or 0) // 1)) * SECOND_TOKENS)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part.get("pages") or 1) * PAGE_TOKENS)


def turn(role: str | None, parts: list[dict]) -> dict:
    """formatted, loss_start, loss_end (both 0 where there is no loss), attachments, expanded_tokens of one turn."""
    v = Visitor()
    for part in parts:
        v.visit(part)
    head = OPEN + escape(role or "").replace("\n", "\\n") + "\n"
    body = "".join(v.text)
    loss = role == "assistant"
    return {
        "formatted": head + body + CLOSE,
        "loss_start": len(head) if loss else 0,
        "loss_end": len(head) + len(body) if loss else 0,
        "attachments": [x | {"offset": x["offset"] + len(head)} for x in v.attachments],
        "expanded_tokens": sum(x["tokens"] for x in v.attachments),
    }


def read_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of a formatted turn; placeholders stay in the text."""
    if not formatted.startswith(OPEN) or not formatted.endswith(CLOSE):
        raise ValueError("not a formatted turn")
    cut = formatted.index("\n", len(OPEN)) + 1
    return unescape(formatted[len(OPEN) : cut - 1]), unescape(formatted[cut : len(formatted) - len(CLOSE)])


_part = "struct<kind:string,uri:string,offset:bigint,tokens:bigint>"
_attachment = pa.struct([("kind", pa.string()), ("uri", pa.string()), ("offset", pa.int64()), ("tokens", pa.int64())])


def format_turns(turns: DataFrame, text: str = "text", parts: str | None = None) -> DataFrame:
    """conv_id, turn, role, formatted, loss_start, loss_end, attachments, expanded_tokens for each row.

    parts: a column of arrays of structs with type and, as the type asks for, text, uri, width, height, seconds, pages; else the text column is the one part.
    """
    content = F.col(parts or text).alias("content")

    def run(batches):
        for batch in batches:
            rows = []
            for role, content in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                own = [{"type": "text", "text": content}] if parts is None else content or []
                rows.append(turn(role, own))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), batch.column(2), pa.array([r["formatted"] for r in rows], pa.string()),
                    *(pa.array([r[k] for r in rows], pa.int64()) for k in ("loss_start", "loss_end")),
                    pa.array([r["attachments"] for r in rows], pa.list_(_attachment)), pa.array([r["expanded_tokens"] for r in rows], pa.int64()),
                ],
                ["conv_id", "turn", "role", "formatted", "loss_start", "loss_end", "attachments", "expanded_tokens"],
            )

    own = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", content)
    return own.mapInArrow(run, f"conv_id long, turn long, role string, formatted string, loss_start long, loss_end long, attachments array<{_part}>, expanded_tokens long")


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its formatted turns: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A conversation's turns are sorted in one partition and pass through running digests a batch at a time: none is gathered, however long it is.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches):
        key, state = None, None

        def row():
            n, turns, chars, loss, size = state
            return {"conv_id": key[0], "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars, "loss_sha256": loss.hexdigest(), "formatted_chars": size}

        for batch in batches:
            rows = []
            columns = (batch.column(batch.schema.names.index(c)).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end"))
            for conv, text, start, end in zip(*columns):
                if key is None or key[0] != conv:
                    if key is not None:
                        rows.append(row())
                    key, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, said = read_turn(text)
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
                masked = unescape(text[start:end])
                state[2] += len(masked)
                state[3].update(masked.encode())
                state[4] += len(text)
            yield pa.RecordBatch.from_pylist(rows, schema)
        if key is not None:
            yield pa.RecordBatch.from_pylist([row()], schema)

    spark = formatted.sparkSession
    said = unescaped(F.expr(f"substr(formatted, 1, length(formatted) - {len(CLOSE)})"))
    own = formatted.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), said.alias("said"), "formatted", "loss_start", "loss_end")
    sorted_rows = own.repartition(partitions(spark), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "said").drop("said")
    return sorted_rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def digest_query(conversations: DataFrame) -> DataFrame:
    own = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = own.sparkSession.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return digests(format_turns(own.unionByName(probe)))


def oracle() -> str:
    """The query in SQL, the lengths of the escaped texts included."""
    special = "".join(LETTERS)
    escaped = lambda x: f"(length({x}) + length({x}) - length(translate({x}, '\\{special}', '')))"
    frame = len(OPEN) + 1 + len(CLOSE)
    return f"""
        WITH t AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
        SELECT conv_id, count(*) AS n_turns,
          sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
          cast(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
          sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
          cast(sum({escaped("text")} + {escaped("role")} + length(role) - length(replace(role, chr(10), '')) + {frame}) AS BIGINT) AS formatted_chars
        FROM t GROUP BY conv_id"""
