"""Exact encoding and decoding with a SentencePiece BPE model by backtracking (operator 11).

The model joins two neighbouring symbols whenever their text is a piece, the piece of highest score first and the leftmost among equals, until no two make a piece. A sequence of tokens
is what that ends in if and only if each two neighbours, joined and merged again by themselves, give the same two: the first merge across a border would be the best merge of
these two as well. So a part of a text is encoded from left to right: an Aho-Corasick automaton over the reversed pieces, run over the reversed part, finds the longest piece that
starts at each place; it is taken if it goes with the token before it, else the next shorter piece that begins it is tried; where none is left the place is marked in a bit field as one
that no encoding reaches, the token before is taken back and shortened in turn. Every place fails once at most, so the work is linear in the part, however often it goes back.

Texts are cut into parts where no merge can cross: before a space sign (U+2581) after another character, since no piece holds one there, and around characters that no piece holds, which become
bytes. Parts are made distinct by Arrow, and each worker remembers the ids of those it has met, up to CACHE_PARTS and CACHE_IDS.

Null is the empty text, which has no ids but the begin and end ids. Texts of any length are taken whole; rows, ties and repeated rows stay as they are, an empty table gives an empty one; `encode` and
`decode` keep all other columns and replace one that already has the name of what they add.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .byte_bpe import _added, _with
from .library_ids import Parts, _gather, _strings

SPACE = "▁"  # fixed value: the sign that stands for a space
#: Parts and ids remembered by a Python worker, pairs of tokens whose fit is remembered, and bytes of texts taken at once.
CACHE_PARTS, CACHE_IDS, CACHE_PAIRS, BLOCK_BYTES = 1_000_000, 1 << 24, 1_000_000, 1 << 22
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # fixed values: kinds of pieces in a model file
WORDS = pa.list_(pa.string())
#: Parts of a text with all spaces as signs: a line end with what follows, or signs with what follows.
_parts = re.compile(f"\n[^{SPACE}\n]*|{SPACE}+[^{SPACE}\n]*")
#: Texts whose parts a split at spaces would not give.
ODD = f"  |^ |{SPACE}"


class Pieces(Parts):
    """path: a model file of kind BPE with a dummy prefix and spaces kept as they are, without normalisation or user-defined pieces."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, rules = model.trainer_spec, model.normalizer_spec
        if spec.model_type != spec.BPE or spec.treat_whitespace_as_suffix or rules.precompiled_charsmap or rules.remove_extra_whitespaces or not (rules.add_dummy_prefix and rules.escape_whitespaces):
            raise ValueError("a BPE model with a dummy prefix, without normalisation, is needed")
        if not spec.byte_fallback:
            raise ValueError("a model that turns unknown characters into bytes is needed")
        kinds = {p.type for p in model.pieces}
        if not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("user-defined and unused pieces are not known here")
        self.score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        if any(SPACE in x.lstrip(SPACE) for x in self.score):
            raise ValueError("a piece holds a space sign after another character")
        self.chars = set("".join(self.score))
        self.lines = "\n" not in self.chars  # a line end is a border too
        follow = {b for x in self.score for a, b in zip(x, x[1:]) if a.isalnum()}
        self.loose = "".join(sorted(c for c in self.chars - follow if not c.isalnum() and c != SPACE))  # no merge brings these to a letter or digit before them
        self.unknown = re.compile("([^" + re.escape("".join(sorted(self.chars))) + "]+)")
        self.bos, self.eos = spec.bos_id, spec.eos_id
        at = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.bytes = {int(p.piece[3:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.ids = {x: (at[x],) if x in at else self._foreign(x) for x in self.chars | at.keys()}
        self.automaton = ahocorasick.Automaton()
        for x in self.ids:
            self.automaton.add_word(x[::-1], x)
        self.automaton.make_automaton()
        self.shorter: dict[str, str | None] = {}
        self.fit: dict[tuple[str | None, str], bool] = {}
        self.own = [self._surface(p, spec.unk_surface) for p in model.pieces]
        self.kind = [p.type for p in model.pieces]
        self.begins = np.array([p.type == NORMAL and p.piece.startswith(SPACE) for p in model.pieces])
        self.silent = {i for i, p in enumerate(model.pieces) if p.type == CONTROL}
        self.forget()

    @staticmethod
    def _surface(piece, unknown: str) -> bytes:
        if piece.type == CONTROL:
            return b""
        if piece.type == BYTE:
            return bytes([int(piece.piece[3:-1], 16)])
        return (unknown if piece.type == UNKNOWN else piece.piece.replace(SPACE, " ")).encode()

    def _foreign(self, text: str) -> tuple[int, ...]:
        """Ids of characters that are no pieces: those of their bytes."""
        return tuple(self.bytes[b] for b in text.encode())

    def merge(self, text: str) -> list[str]:
        """The symbols that the model's own merging ends in; for texts of a few pieces."""
        symbols, score = list(text), self.score.get
        ranks = [score(a + b) for a, b in zip(symbols, symbols[1:])]
        while some := [x for x in ranks if x is not None]:
            i = ranks.index(max(some))
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = score(symbols[i] + symbols[i + 1])
            if i:
                ranks[i - 1] = score(symbols[i - 1] + symbols[i])
        return symbols

    def fits(self, before: str | None, token: str) -> bool:
        """Whether the two, merged again, are the same two; a first token must be one by itself."""
        known = self.fit.get((before, token))
        if known is None:
            if len(self.fit) > CACHE_PAIRS:
                self.fit.clear()
            known = self.fit[before, token] = self.merge((before or "") + token) == ([token] if before is None else [before, token])
        return known

    def next_shorter(self, token: str) -> str | None:
        """The longest shorter token that begins this one."""
        if token not in self.shorter:
            self.shorter[token] = next((token[:k] for k in range(len(token) - 1, 0, -1) if token[:k] in self.ids), None)
        return self.shorter[token]

    def tokens(self, part: str) -> list[str]:
        """The tokens of a part whose characters all are in pieces."""
        n, out = len(part), []
        longest = dict(reversed(list(self.automaton.iter(part[::-1]))))  # by the place's distance from the end; of a place's matches the longest comes first, so it stays
        failed = bytearray(n // 8 + 1)  # a bit for each place
        at, token, before = 0, longest.get(n - 1), None
        while at < n:
            while token is not None:
                end = at + len(token)
                if not failed[end >> 3] >> (end & 7) & 1 and self.fits(before, token):
                    break
                token = self.next_shorter(token)
            if token is not None:
                out.append(token)
                at, before = end, token
                token = longest.get(n - 1 - at)
            else:
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(before)
                token = self.next_shorter(out.pop())
                before = out[-1] if out else None
        return out

    def part_ids(self, part: str) -> list[int]:
        out: list[int] = []
        runs = [part] if self.chars.issuperset(part) else self.unknown.split(part)
        for k, run in enumerate(runs):
            if k % 2:
                out += self._foreign(run)
            else:
                for x in self.tokens(run):
                    out += self.ids[x]
        return out

    def learn(self, missing: list[str]) -> None:
        """Remember parts; one that ends in loose signs after a letter or digit is what stands before them, then the signs."""
        cores = [c if (c := x.rstrip(self.loose)) and c[-1].isalnum() else x for x in missing]
        whole = list(dict.fromkeys(c for c in cores if c not in self.index))
        self._remember(whole, [self.part_ids(c if c[:1] == "\n" and self.lines else SPACE + c) for c in whole])
        rest = [(x, c) for x, c in zip(missing, cores) if x is not c]
        flat, start, size = self.flat, self.start, self.size
        found = []
        for x, c in rest:
            k = self.index[c]
            tail = x[len(c) :]
            if tail not in self.tails:
                self.tails[tail] = self.part_ids(tail)
            found.append(flat[start[k] : start[k] + size[k]].tolist() + self.tails[tail])
        self._remember([x for x, _ in rest], found)

    def _remember(self, parts: list[str], found: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        n = len(self.index)
        self.add(np.fromiter((i for x in found for i in x), self.dtype, int(sizes.sum())), sizes, n)
        self.index.update(zip(parts, range(n, n + len(parts))))

    def forget(self) -> None:
        super().forget()
        self.tails: dict[str, list[int]] = {}

    def cut(self, text: str) -> list[str]:
        """The text's parts; one that begins with a sign lost it."""
        signs = SPACE + text.replace(" ", SPACE)
        parts = _parts.findall(signs) if self.lines else re.findall(f"{SPACE}+[^{SPACE}]*", signs)
        return [x if x[0] == "\n" and self.lines else x[1:] for x in parts]

    def _encoded(self, parts: pa.ListArray, wrap: bool) -> list[bytes]:
        bounds = np.asarray(parts.offsets) - parts.offsets[0].as_py() if len(parts) else np.zeros(1, np.int64)
        words = parts.flatten().dictionary_encode()
        own, codes = _strings(words.dictionary), np.asarray(words.indices)
        if missing := [x for x in own if x not in self.index]:
            self.learn(missing)
        at = np.fromiter(map(self.index.__getitem__, own), np.int64, len(own))[codes]
        size = self.size[at]
        ids = _gather(self.flat, self.start[at], size).tobytes()
        ends = np.concatenate([[0], np.cumsum(size)])[bounds] * self.dtype.itemsize
        head, tail = (np.array([x], self.dtype).tobytes() if wrap else b"" for x in (self.bos, self.eos))
        return [head + ids[a:b] + tail for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def encode(self, texts: pa.Array, wrap: bool = True) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, with the begin and end ids if wrap; null is the empty text."""
        texts, out = pc.fill_null(texts, ""), []
        for a, b in K.blocks(K.buffers(texts)[1], BLOCK_BYTES):
            if len(self.index) > CACHE_PARTS or self.used > CACHE_IDS:
                self.forget()
            part = texts.slice(a, b - a)
            odd = pc.match_substring_regex(part, ODD)
            none = pc.equal(part, "")
            spaced = pc.replace_substring(part, "\n", " \n") if self.lines else part
            plain = spaced.filter(pc.invert(pc.or_(odd, none)))
            even = iter(self._encoded(pc.split_pattern(plain, " ").cast(WORDS), wrap))
            rest = iter(self._encoded(pa.array([self.cut(x) if x else [] for x in part.filter(pc.or_(odd, none)).to_pylist()], WORDS), wrap))
            out += [next(rest if x else even) for x in pc.or_(odd, none).to_pylist()]
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids as the library's decode gives it: spaces for signs, none for the dummy prefix, bytes joined, U+FFFD for each that is not UTF-8."""
        codes = np.frombuffer(ids, "<u4").tolist()
        while codes and codes[-1] in self.silent:
            codes.pop()
        first = next((k for k, i in enumerate(codes) if i not in self.silent), 0)
        codes = codes[first:]
        raw = b"".join([self.own[i] for i in codes])
        if codes and self.begins[codes[0]]:
            raw = raw[1:]
        try:
            if self.silent.isdisjoint(codes):
                return raw.decode()
        except UnicodeDecodeError:
            pass
        out, run = [], []  # bytes that no text has in a row, or with a begin or end id between them
        for k, i in enumerate([*codes, self.bos]):
            if self.kind[i] == BYTE:
                run.append(self.own[i])
            else:
                out.append(_lenient(b"".join(run)))
                out.append(self.own[i].decode()[1 if k == 0 and self.begins[i] else 0 :])
                run = []
        return "".join(out)


def _lenient(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            at += 1
    return "".join(out)


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode(frame: DataFrame, model: str, text: str = "text", ids: str = "ids", decoded: str | None = None, keep_text: bool = True, wrap: bool = True) -> DataFrame:
    """Add the ids of the text as a binary column of little-endian unsigned 32-bit integers, begin and end ids with it if wrap.

    model: path of the model file, the same on each executor. decoded: also the bytes of the text that the ids decode to, in the same pass; keep_text: whether the text goes back to Spark.
    """
    names, gone = [ids, *[decoded] * bool(decoded)], [] if keep_text else [text]

    def run(batches):
        own = pieces(model)
        for batch in batches:
            coded = own.encode(batch.column(batch.schema.names.index(text)), wrap)
            columns = [coded, *[[own.decode(x).encode() for x in coded]] * bool(decoded)]
            yield _with(batch.drop_columns(gone), **{n: pa.array(c, pa.binary()) for n, c in zip(names, columns)})

    return frame.mapInArrow(run, _added(frame.drop(*gone), *names))


def decode(frame: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the UTF-8 bytes of the text that the ids stand for; null ids are none. An id outside the vocabulary is an error."""

    def run(batches):
        own = pieces(model)
        for batch in batches:
            texts = [own.decode(x.as_buffer() or b"").encode() if x.is_valid else b"" for x in batch.column(batch.schema.names.index(ids))]
            yield _with(batch, **{out: pa.array(texts, pa.binary())})

    return frame.mapInArrow(run, _added(frame, out))


def digest_query(documents: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text, begin and end ids counted."""
    back = encode(documents.select("doc_id", "text"), model, decoded="decoded", keep_text=False)
    return back.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
