"""Ids of whole texts by the tokenizers library, as byte strings, with repeated words encoded once.

A byte-level pre-tokeniser parts the last white space of a run from what stands before it, and lets a last space lead the next piece, so a text may be cut before each
space or line end that no white space follows without changing its ids; so may a word before a comma or full stop at its end. The parts are encoded by the
library, many at a time in one text, told apart by the tokens that begin with the space or line end before them, and remembered in one array of ids; a text's ids
are gathered from it. A text that holds a string of one of the tokenizer's added tokens, as <|endoftext|>, goes to the library whole: it becomes that token's id, as the library
gives it with add_special_tokens=False.
"""

from __future__ import annotations

import functools
import itertools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import kernels as K

#: Parts remembered by a Python worker, parts encoded as one text, and bytes of texts taken at once.
CACHE_PARTS, TOGETHER, BLOCK_BYTES = 1_300_000, 128, 1 << 22
#: A space or line end before white space (all that Unicode names so, or more) or the end.
ODD = r"[ \n]([\s\x0b\x1c-\x1f\x{85}\p{Z}]|\z)"
_cut = re.compile(r"(?=[ \n]\S)")
#: Letters in every version of Unicode.
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZàáâãäåæçèéêëìíîïñòóôõöøùúûüß")
WORDS = pa.list_(pa.string())


def cut(text: str) -> list[str]:
    """The text before its first cut, then the parts; a part that began with a space lost it, one that begins with a line end keeps it."""
    first, *rest = _cut.split(text)
    return [first, *(x[1:] if x[0] == " " else x for x in rest)]


def _gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of values that begin at start and have these sizes, joined."""
    ends = np.cumsum(size)
    return values[np.repeat(start - ends + size, size) + np.arange(ends[-1])] if len(size) else values[:0]


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


class Parts:
    """Parts of texts remembered by number: the ids of each are a run in one array."""

    dtype = np.dtype("<u4")

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.start, self.size = np.zeros(1 << 20, self.dtype), np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int64)
        self.used = 0

    def add(self, ids: np.ndarray, size: np.ndarray, at: int) -> None:
        """Put the runs of ids into the arrays as entries from `at` on."""
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while at + len(size) > len(self.size):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[at : at + len(size)] = self.used + np.cumsum(size) - size
        self.size[at : at + len(size)] = size
        self.used += len(ids)


class Library(Parts):
    """path: a tokenizers JSON file with a byte-level pre-tokeniser."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.marks = {x: self.raw([x])[0] for x in ",."}
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        own = {x: self.tokenizer.id_to_token(int(self.raw([x])[0][0]))[0] for x in " \n"}  # how the vocabulary writes them
        self.begins = {x: np.array([t[:1] == c for t in tokens]) for x, c in own.items()}
        self.forget()

    def raw(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has)."""
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(itertools.chain.from_iterable(ids), self.dtype), np.fromiter(map(len, ids), np.int64, len(ids))

    def parted(self, parts: list[str], before: str) -> tuple[np.ndarray, np.ndarray]:
        """The same of parts without spaces or line ends, each after `before`: TOGETHER of them as one text, one by one where the library parts it otherwise."""
        groups = [parts[k : k + TOGETHER] for k in range(0, len(parts), TOGETHER)]
        ids, sizes = self.raw([before + before.join(g) for g in groups])
        first = self.begins[before][ids]
        if (np.add.reduceat(first, np.cumsum(sizes) - sizes).tolist() if groups else []) != list(map(len, groups)):
            return self.raw([before + x for x in parts])
        return ids, np.diff(np.append(np.flatnonzero(first), len(ids)))

    def learn(self, missing: list[str]) -> None:
        """Encode parts that are not remembered; of one that ends in a mark after a letter, what stands before the mark."""

        def take(words: list[str], ids: np.ndarray, size: np.ndarray) -> None:
            self.add(ids, size, n := len(self.index))
            self.index.update(zip(words, range(n, n + len(words))))

        marked, plain, lines = [], set(), []
        for x in missing:
            if x[0] == "\n":
                lines.append(x)
            elif x[-1] in ",." and x[-2:-1] in LETTERS:
                marked.append(x)
                plain.add(x[:-1])
            else:
                plain.add(x)
        plain = list(plain - self.index.keys())
        take(plain, *self.parted(plain, " "))
        take(lines, *self.parted([x[1:] for x in lines], "\n"))
        for mark, own in self.marks.items():
            words = [x for x in marked if x[-1] == mark]
            at = np.fromiter((self.index[x[:-1]] for x in words), np.int64, len(words))
            size = self.size[at] + len(own)
            ids = np.empty(size.sum(), self.dtype)
            ends = np.cumsum(size)
            tail = (ends[:, None] - np.arange(len(own), 0, -1)).ravel()
            head = np.ones(len(ids), bool)
            head[tail] = False
            ids[tail] = np.tile(own, len(words))
            ids[head] = _gather(self.flat, self.start[at], self.size[at])
            take(words, ids, size)

    def _ids(self, parts: pa.ListArray) -> list[bytes]:
        """Ids of texts given as their parts, the first of each a head."""
        bounds = np.asarray(parts.offsets) - parts.offsets[0].as_py()
        flat, heads = parts.flatten(), bounds[:-1]
        body = np.ones(len(flat), bool)
        body[heads] = False
        words = flat.filter(pa.array(body)).dictionary_encode()
        own, codes = _strings(words.dictionary), np.asarray(words.indices)
        places = list(map(self.index.get, own))
        if missing := [k for k, x in enumerate(places) if x is None]:
            self.learn([own[k] for k in missing])
            for k in missing:
                places[k] = self.index[own[k]]
        at = np.empty(len(flat), np.int64)
        at[body] = np.array(places, np.int64)[codes]
        at[heads] = len(self.index) + np.arange(len(heads))  # heads have no space before them: entries for now
        used = self.used
        self.add(*self.raw(_strings(flat.take(pa.array(heads)))), len(self.index))
        self.used = used
        ids = _gather(self.flat, self.start[at], self.size[at]).tobytes()
        ends = np.concatenate([[0], np.cumsum(self.size[at])])[bounds] * self.dtype.itemsize
        return [ids[a:b] for a, b in itertools.pairwise(ends.tolist())]

    def ids(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian integers of self.dtype; null is the empty text."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if len(self.index) > CACHE_PARTS:
            self.forget()
        out = []
        for a, b in K.blocks(K.buffers(texts)[1], BLOCK_BYTES):
            part = texts.slice(a, b - a)
            whole = functools.reduce(pc.or_, [pc.match_substring(part, t) for t in self.added], pa.array(np.zeros(len(part), bool)))
            odd = pc.or_(whole, pc.match_substring_regex(part, ODD))
            even = self._ids(pc.split_pattern(pc.replace_substring(part.filter(pc.invert(odd)), "\n", " \n"), " ").cast(WORDS))
            rest = self._ids(pa.array([[x] if w else cut(x) for x, w in zip(part.filter(odd).to_pylist(), whole.filter(odd).to_pylist())], WORDS))
            even, rest = iter(even), iter(rest)
            out += [next(rest if x else even) for x in odd.to_pylist()]
        return out


@functools.lru_cache(maxsize=2)
def library(path: str) -> Library:
    return Library(path)
