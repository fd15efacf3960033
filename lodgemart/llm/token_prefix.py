"""Token counts of every prefix of a text, by dynamic programming.

A sequence of BPE tokens is the encoding of its text exactly if each token is its own
encoding and each neighbouring pair is the encoding of its own text. So the last token of a
prefix's encoding is the one token that ends there and goes with the last token of the
prefix before it, and the count is that prefix's count plus one. The states hang on a trie of
pieces kept per worker: a prefix that two words share is worked out once. A state is a number,
found by its parent's number and the next letter, so a word takes memory by its length; past
``MAX_STATES`` states the trie starts anew, also in the middle of a word. The counts answer
what a truncated text would cost and where a budget ends, without encoding it again.

Counts are those of the library for the prefix as a text of its own: white space at its end
is one run, and a contraction cut short is not one.

Defined cases: a null text is empty, its counts are [0]; a null id is carried through;
repeated rows are counted one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgemart.llm import pieces as P
from lodgemart.llm import text as X

LIMIT = 1_024
MAX_STATES = 1_000_000
LETTER_BITS = 10  # a vocabulary's letters for bytes are below x200

# Contractions of more than one letter, which the pre-tokenizer keeps whole.
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")
# The characters with Unicode's White_Space property.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WHITE_RUN = re.compile(f"[{WHITE}]{{2,}}")


class PrefixTable(P.PieceTable):
    """For each pre-token the token counts of its prefixes, one per character."""

    def __init__(self, path: str):
        super().__init__(path)
        self.letters = {token: token for token in self.tok.get_vocab(with_added_tokens=False)}
        self.longest = max(map(len, self.letters))
        self.forget()

    def forget(self) -> None:
        """Empties the trie: state 0 is the empty prefix, each other has its count and its last token."""
        self.child: dict[int, int] = {}
        self.count, self.last = array("I", [0]), [""]
        self.pair: dict[tuple[str, str], bool] = {}

    def goes(self, left: str, right: str) -> bool:
        """Whether the encoding of both tokens' text is these two tokens."""
        known = self.pair.get((left, right))
        if known is None:
            found = self.tok.model.tokenize(left + right)
            known = len(found) == 2 and found[0].value == left
            if len(self.pair) >= MAX_STATES:
                self.pair.clear()
            self.pair[left, right] = known
        return known

    def step(self, word: str, end: int, counts: array, lasts: list[str]) -> tuple[int, str]:
        """Count and last token of the prefix up to ``end``, from those of the shorter prefixes."""
        for size in range(min(end, self.longest), 0, -1):
            token = self.letters.get(word[end - size : end])
            if token is None:
                continue
            if size == end:
                if len(self.tok.model.tokenize(token)) == 1:
                    return 1, token
            elif self.goes(lasts[end - size], token):
                return counts[end - size] + 1, token
        raise ValueError(f"no encoding ends at {end} of a pre-token")

    def counts(self, word: str) -> array:
        """Token counts of the prefixes of one pre-token, given in the vocabulary's letters for bytes."""
        counts, lasts, state = array("I", [0]), [""], 0
        for end in range(1, len(word) + 1):
            key = state << LETTER_BITS | ord(word[end - 1])
            state = self.child.get(key, -1)
            if state < 0:
                count, last = self.step(word, end, counts, lasts)
                if len(self.last) >= MAX_STATES:
                    self.forget()
                    # The rest of this word has no place in the new trie.
                    for rest in range(end, len(word) + 1):
                        if rest > end:
                            count, last = self.step(word, rest, counts, lasts)
                        counts.append(count)
                        lasts.append(last)
                    break
                state = self.child[key] = len(self.last)
                self.count.append(count)
                self.last.append(last)
            counts.append(self.count[state])
            lasts.append(self.last[state])
        return counts[1:]

    def at_chars(self, body: str) -> array:
        """The same at the characters of a pre-token's text."""
        (word, _), *more = self.tok.pre_tokenizer.pre_tokenize_str(body)
        if more:
            raise ValueError(f"not one pre-token: {body!r}")
        own = self.counts(word)
        if len(word) > len(body):
            own = array("I", (own[i - 1] for i in np.cumsum([len(c.encode()) for c in body])))
        if body in LONG_CONTRACTIONS:
            own[1] = 2
        return own

    def values(self, words: list[str]) -> list:
        return [self.at_chars(w) for w in words]

    def whole(self, text: str) -> list[int]:
        """Counts in a text with special strings, each of which is one token from its last character on."""
        cut = re.split("(" + "|".join(map(re.escape, self.special)) + ")", text)
        before, out = 0, []
        for part, mark in zip(cut[::2], [*cut[1::2], ""], strict=True):
            out += [before + n for n in self.plain(part + mark[:-1])]
            if mark:
                before += (self.plain(part) or [0])[-1] + 1
                out.append(before)
        return out

    def plain(self, text: str) -> list[int]:
        counts, bounds = self.columns(self.cut(pa.array([text])))
        return counts[bounds[0] : bounds[1]].tolist()

    def columns(self, cuts: P.Cuts) -> tuple[np.ndarray, np.ndarray]:
        own, sizes = self.stretches(cuts)
        own = own.astype(np.int64)
        full = P.upto(own[np.cumsum(sizes) - 1])
        of = np.repeat(np.arange(len(cuts.texts) - 1), np.diff(cuts.first))
        own += np.repeat(full[:-1] - full[cuts.first[:-1]][of], sizes)
        for run in WHITE_RUN.finditer(cuts.string):
            # A prefix that ends in a run of white space holds it as one pre-token.
            a, b = run.span()
            inner = np.searchsorted(cuts.texts, [a, b], "right")
            edges = [a, *(int(t) for t in cuts.texts[inner[0] : inner[1]] if a < t < b), b]
            for x, y in zip(edges[:-1], edges[1:], strict=True):
                if y - x > 1:
                    before = 0 if x in cuts.texts[inner[0] - 1 : inner[1]] else own[x - 1]
                    own[x:y] = before + np.array(self.at_chars(cuts.string[x:y]))
        return own, cuts.texts

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Counts at all characters of all texts in a row, and the bounds of each text in them."""
        cuts = self.cut(column)
        return self.patched(cuts, *self.columns(cuts))


def _each(batches: Iterator[pa.RecordBatch], path: str):
    table = P.table_of(path, PrefixTable)
    for batch in batches:
        for piece in X.slices(batch, "text"):
            yield piece, *table.texts(piece.column("text"))


def prefix_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The id and ``counts``: token counts of the prefixes of 0, 1, 2, ... characters."""

    def run(batches):
        for piece, counts, bounds in _each(batches, path):
            padded = np.insert(counts, bounds[:-1], 0).astype(np.int32)
            edges = pa.array(bounds + np.arange(len(bounds)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.ListArray.from_arrays(edges, pa.array(padded))], ["id", "counts"]
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"id {kind}, counts array<int>").withColumnRenamed("id", id_col)


def tokens_at(counts: Column, chars: Column | int) -> Column:
    """Tokens of the text cut after so many characters."""
    chars = F.lit(chars) if isinstance(chars, int) else chars
    return F.get(counts, F.least(chars, F.size(counts) - 1))


def chars_within(counts: Column, budget: Column | int) -> Column:
    """Characters of the longest prefix that takes at most so many tokens."""
    budget = F.lit(budget) if isinstance(budget, int) else budget
    return F.size(counts) - 1 - (F.array_position(F.transform(F.reverse(counts), lambda n: n <= budget), True) - 1)


def count_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", limit: int = LIMIT
) -> DataFrame:
    """The id, ``n_bytes``, ``n_tokens``, ``over_limit``, and ``limit_chars``: the longest prefix within the limit."""

    def run(batches):
        for piece, counts, bounds in _each(batches, path):
            last = np.zeros(piece.num_rows, np.int64)
            some = bounds[1:] > bounds[:-1]
            last[some] = counts[bounds[1:][some] - 1]
            within = np.where(counts <= limit, np.arange(1, len(counts) + 1), 0)
            chars = np.zeros(piece.num_rows, np.int64)
            if some.any():
                best = np.maximum.reduceat(within, bounds[:-1][some])
                chars[some] = np.maximum(best - bounds[:-1][some], 0)
            _, offsets = X.flat(piece.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("id"),
                    pa.array(np.diff(offsets).astype(np.int64)),
                    pa.array(last),
                    pa.array(last > limit),
                    pa.array(chars),
                ],
                ["id", "n_bytes", "n_tokens", "over_limit", "limit_chars"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    schema = f"id {dict(rows.dtypes)['id']}, n_bytes long, n_tokens long, over_limit boolean, limit_chars long"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
