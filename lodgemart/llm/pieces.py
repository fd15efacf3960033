"""Token ids of whole texts through a table of pre-tokens, each encoded by the library once per worker.

The pre-tokens of all texts of a slice are cut at once, by the classes of their characters,
and looked up by a 64-bit hash; only new ones are handed to the library. Texts that hold a
special string go to the library whole, whose default then holds.
"""

from __future__ import annotations

import os
import sys
import types
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa

from lodgemart.llm import text as X

MAX_PIECES = 3_000_000
LETTER, NUMBER, SPACE, OTHER, UNKNOWN = 0, 1, 2, 3, 9


def worker_state() -> dict:
    """A place that outlives a task in a reused Python worker."""
    return sys.modules.setdefault("_lodgemart_worker", types.ModuleType("_lodgemart_worker")).__dict__


def tokenizer(path: str):
    """The tokenizer of a file, loaded once per worker, one thread."""
    state = worker_state()
    if ("tokenizer", path) not in state:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        state["tokenizer", path] = Tokenizer.from_file(path)
    return state["tokenizer", path]


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    at = np.repeat(starts - ends + sizes, sizes)
    at += np.arange(ends[-1])
    return flat.take(at)


def upto(sizes: np.ndarray) -> np.ndarray:
    """0 and the running sums."""
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


class Cuts:
    """Pre-tokens of a column of texts: character and byte bounds, and the first of each text."""

    def __init__(self, column: pa.Array, classes: np.ndarray, classify):
        self.bytes, self.offsets = X.flat(column)
        self.string = self.bytes.tobytes().decode()
        points = np.frombuffer(self.string.encode("utf-32-le"), np.uint32)
        self.char_at = np.append(np.flatnonzero((self.bytes & 0xC0) != 0x80), len(self.bytes))
        self.texts = np.searchsorted(self.char_at, self.offsets)  # first character of each text
        kinds = classes[points]
        if (kinds == UNKNOWN).any():
            for point in np.unique(points[kinds == UNKNOWN]):
                classes[point] = classify(chr(point))
            kinds = classes[points]
        n = len(points)
        begins = np.zeros(n + 4, bool)  # where a text begins
        begins[self.texts] = True
        edge = np.ones(n + 1, bool)
        np.not_equal(kinds[1:], kinds[:-1], out=edge[1:n])
        edge |= begins[: n + 1]
        space = kinds == SPACE
        white = np.flatnonzero(space & edge[1:] & ~begins[1 : n + 1])  # ends a run, more text behind it
        edge[white] = True
        edge[white[points[white] == 0x20] + 1] = False
        quote = np.flatnonzero(points == 0x27)
        quote = quote[edge[quote] & edge[quote + 1] & ~begins[quote + 1] & (quote + 1 < n)]
        padded = np.append(points, np.zeros(3, np.uint32))
        one, two = padded[quote + 1], padded[quote + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == 0x72) | (one == 0x76)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C)
        long &= ~begins[quote + 2]
        for at, size in ((quote[short], 2), (quote[long], 3)):
            edge[at + 1] = False
            edge[at + size] = True
        self.chars = np.flatnonzero(edge)
        self.points = points
        self.first = np.searchsorted(self.chars, self.texts)
        self.bounds = self.char_at[self.chars]

    def word(self, k: int) -> str:
        return self.string[self.chars[k] : self.chars[k + 1]]


class PieceTable:
    """Pre-tokens seen so far, by hash, and for each of them a stretch of numbers: its ids."""

    def __init__(self, path: str):
        self.tok = tokenizer(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.flat, self.bounds = array("I"), array("q", [0])

    def classify(self, char: str) -> int:
        """The class the library's pre-tokenizer puts a character in."""
        cut = self.tok.pre_tokenizer.pre_tokenize_str
        if len(cut("a" + char)) == 1:
            return LETTER
        if len(cut("1" + char)) == 1:
            return NUMBER
        return OTHER if len(cut("+" + char)) == 1 else SPACE

    def values(self, words: list[str]) -> list:
        """What is stored for each pre-token: its ids."""
        return [e.ids for e in self.tok.encode_batch_fast(words, add_special_tokens=False)]

    def whole(self, text: str) -> list:
        """The same for a text with special strings."""
        return self.values([text])[0]

    def lookup(self, cuts: Cuts) -> np.ndarray:
        """The place of each pre-token in the table; new ones are added."""
        codes, found = pd.factorize(X.stretch_hashes(cuts.bytes, cuts.bounds))
        if not len(found):
            return codes
        if len(self.keys) + len(found) > MAX_PIECES:
            self.clear()
        order = np.argsort(found)
        ranked = found[order]
        at = np.searchsorted(self.keys, ranked)
        known = np.zeros(len(found), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == ranked[inside]
        place = np.empty(len(found), np.int64)
        place[order[known]] = self.place[at[known]]
        new = order[~known]
        if len(new):
            first = np.empty(len(found), np.int64)
            first[codes[::-1]] = np.arange(len(codes))[::-1]
            place[new] = len(self.bounds) - 1 + np.arange(len(new))
            ends = []
            size = len(self.flat)
            for stretch in self.values([cuts.word(k) for k in first[new].tolist()]):
                self.flat.extend(stretch)
                size += len(stretch)
                ends.append(size)
            self.bounds.extend(ends)
            self.keys = np.insert(self.keys, at[~known], ranked[~known])
            self.place = np.insert(self.place, at[~known], place[new])
        return place[codes]

    def stretches(self, cuts: Cuts) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all pre-tokens in a row, and the size of each stretch of them."""
        place = self.lookup(cuts)
        at = np.frombuffer(self.bounds, np.int64)
        flat = np.frombuffer(self.flat, np.uint32) if len(self.flat) else np.zeros(1, np.uint32)
        starts = at[place]
        sizes = at[place + 1] - starts
        return gather(flat, starts, sizes), sizes

    def cut(self, column: pa.Array) -> Cuts:
        return Cuts(column, self.classes, self.classify)

    def patched(self, cuts: Cuts, out: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replaces the rows of texts with special strings."""
        if not any(s in cuts.string for s in self.special):
            return out, bounds
        rows = [out[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        for row in range(len(rows)):
            text = cuts.string[cuts.texts[row] : cuts.texts[row + 1]]
            if any(s in text for s in self.special):
                rows[row] = np.asarray(self.whole(text), out.dtype)
        return np.concatenate(rows), upto(np.array([len(r) for r in rows]))

    def run(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row and the bounds of each text in them."""
        cuts = self.cut(column)
        out, sizes = self.stretches(cuts)
        return self.patched(cuts, out, upto(sizes)[cuts.first])


def table_of(path: str, kind: type = PieceTable) -> PieceTable:
    """The worker's table of a kind for a tokenizer file."""
    state = worker_state()
    key = (kind.__name__, path)
    if key not in state:
        state[key] = kind(path)
    return state[key]
