"""Personal data: e-mail addresses, IP addresses, card and phone numbers, disguised ones too.

Plain forms are found in the text as it stands. A chain of transducers then rewrites disguises:
look-alike letters and digits of other alphabets, characters without width, ``(at)`` and
``dot``, ``plus``, and digits spelled as words. Each rewritten text carries the place in the
source of every piece that was changed, so what is found in it is mapped back to characters
of the source. Spans found only after rewriting are added where they touch no plain one, or
where a plain one is a part of them that a look-alike or hidden character cut off.

A word ``at`` counts as a disguise only if its host goes on with a disguised dot; bracketed
forms always do. A spelled digit counts only beside another one.

Defined cases: a null text is empty and has no spans; a null id is carried through; repeated
rows give repeated results; an empty table gives an empty result; other columns are ignored,
whatever their names. Every pattern runs in time proportional to the text, very long ones
included: runs of digits and names are entered at their start only. A text is held whole by
its task, with twice its size for a rewritten one.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds in the order in which equal starts are listed.
KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:long,end:long>>"

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++")
# An address begins where a run of digits does: from inside one the rest would be the same.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int, int]  # start, number of the kind, end


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d)
        total += n if k % 2 == 0 else sum(divmod(2 * n, 10))
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    end = 0
    for host in _HOST.finditer(text):
        start = host.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < host.start():
            end = host.end()
            yield start, 0, end


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def plain_spans(text: str) -> list[Span]:
    """Spans of all kinds in a text as it stands, by start and kind."""
    found = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(map(_small, m.groups())):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text) if "+" in text else ():
            if 10 <= len(_DIGIT.findall(m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


# Letters and signs that look like ASCII ones, and what they look like.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d",
    "һ": "h", "ӏ": "l", "ԛ": "q", "ԝ": "w", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O",
    "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "α": "a", "ε": "e", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H",
    "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ɑ": "a", "ɡ": "g",
    "ı": "i", "․": ".", "。": ".", "｡": ".", "‐": "-", "\u2011": "-", "–": "-", "−": "-", "﹫": "@",
    "\u00a0": " ", "\u2009": " ", "\u202f": " ", "\u3000": " ",
}
# Full-width forms stand 0xFEE0 above ASCII; Arabic-Indic digits in two rows of ten.
_LOOKS = {ord(k): v for k, v in LOOK_ALIKES.items()}
_LOOKS |= {0xFEE0 + c: chr(c) for c in range(0x21, 0x7F)}
_LOOKS |= {row + d: str(d) for row in (0x0660, 0x06F0) for d in range(10)}
# Characters without width.
NO_WIDTH = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
_STRANGE = re.compile(f"[{re.escape(''.join(map(chr, _LOOKS)))}]")
_HIDDEN = re.compile(f"[{NO_WIDTH}]+")
_ODD = re.compile(f"{_STRANGE.pattern}|{_HIDDEN.pattern}")

# Spelled digits.
DIGIT_WORDS = {w: str(d) for d, w in enumerate("zero one two three four five six seven eight nine".split())}
_WORD = "(?:" + "|".join(DIGIT_WORDS) + ")"
_SPELLED = re.compile(rf"\b{_WORD}(?:[\x20\t,-]{{1,3}}(?:{_WORD}|oh)\b)+", re.I)
_ONE_WORD = re.compile(rf"{_WORD}|oh", re.I)
_PLUS = re.compile(r"(?:\bplus|[\[({]\s?plus\s?[\])}])[\x20\t]{1,3}(?=\(?[0-9])", re.I)
_DOT = re.compile(r"\s{0,3}[\[({<]\s?(?:dot|point|punkt|punto)\s?[\])}>]\s{0,3}|(?<=[A-Za-z0-9])\s{1,3}dot\s{1,3}(?=[A-Za-z0-9])", re.I)
_NAMED_AT = re.compile(r"\s{0,3}[\[({<]\s?(?:at|arroba)\s?[\])}>]\s{0,3}", re.I)
_PLAIN_AT = re.compile(r"(?<=[A-Za-z0-9_%+-])\s{1,3}at\s{1,3}(?=[A-Za-z0-9-]{1,63}\0)", re.I)
# What any transducer could change, but for look-alikes: texts without it need no second look.
_SEED = re.compile(rf"[\[({{<\x20\t\n](?:dot|point|punkt|punto|at\s?[\])}}>]|arroba)|\b{_WORD}[\x20\t,-]{{1,3}}(?:{_WORD}|oh)\b|\bplus\b", re.I)


@dataclass
class Rewritten:
    """A text after some changes, and where its pieces stand in the source.

    ``at[k]`` is the first character of piece k, ``source[k]`` its place in the source. A kept
    piece runs along with the source; a replacement stands as a whole for the source up to
    ``until[k]``, which is -1 for a kept one.
    """

    text: str
    at: list[int]
    source: list[int]
    until: list[int]

    @classmethod
    def of(cls, text: str) -> Rewritten:
        return cls(text, [0], [0], [-1])

    def _along(self, k: int, place: int) -> int:
        return self.source[k] + (place - self.at[k] if self.until[k] < 0 else 0)

    def start(self, place: int) -> int:
        """Source character that the character at ``place`` stands for, the first of several."""
        return self._along(bisect_right(self.at, place) - 1, place)

    def end(self, place: int) -> int:
        """Source place behind what the character before ``place`` stands for."""
        k = bisect_right(self.at, place - 1) - 1
        return self._along(k, place) if self.until[k] < 0 else self.until[k]

    def changed(self, changes: list[tuple[int, int, str]]) -> Rewritten:
        """The text with each stretch (start, end, new) replaced, in order and apart, none empty."""
        if not changes:
            return self
        pieces, out, size, before = [], Rewritten("", [], [], []), 0, 0

        def put(text: str, source: int, until: int) -> None:
            nonlocal size
            pieces.append(text)
            out.at.append(size)
            out.source.append(source)
            out.until.append(until)
            size += len(text)

        def keep(start: int, end: int) -> None:
            k = bisect_right(self.at, start) - 1
            while start < end:
                stop = min(self.at[k + 1] if k + 1 < len(self.at) else end, end)
                put(self.text[start:stop], self._along(k, start), self.until[k])
                start, k = stop, k + 1

        for start, end, new in changes:
            keep(before, start)
            if new:
                put(new, self.start(start), self.end(end))
            before = end
        keep(before, len(self.text))
        out.text = "".join(pieces)
        return out


def _each(pattern: re.Pattern, new: str):
    return lambda text: [(m.start(), m.end(), new) for m in pattern.finditer(text)]


def _digits(text: str) -> list[tuple[int, int, str]]:
    return [
        (m.start(), m.end(), "".join(DIGIT_WORDS.get(w.lower(), "0") for w in _ONE_WORD.findall(m.group())))
        for m in _SPELLED.finditer(text)
    ]


def _weak_at(dotted: Rewritten) -> list[tuple[int, int, str]]:
    """Places of a plain word ``at`` whose host goes on with a dot that was a disguise."""
    disguised = [a for a, u in zip(dotted.at, dotted.until) if u >= 0 and dotted.text.startswith(".", a)]
    if not disguised:
        return []
    marked = list(dotted.text)
    for a in disguised:
        marked[a] = "\0"
    return [(m.start(), m.end(), "@") for m in _PLAIN_AT.finditer("".join(marked))]


def deobfuscated(text: str) -> Rewritten | None:
    """The text without its disguises, or nothing if it has none."""
    strange = not text.isascii() and _ODD.search(text)
    if not strange and not _SEED.search(text):
        return None
    now = Rewritten.of(text)
    if strange:
        now = Rewritten.of(text.translate(_LOOKS)) if _STRANGE.search(text) else now
        now = now.changed(_each(_HIDDEN, "")(now.text))
    now = now.changed(_digits(now.text))
    now = now.changed(_each(_DOT, ".")(now.text))
    now = now.changed(_weak_at(now))
    now = now.changed(_each(_NAMED_AT, "@")(now.text))
    now = now.changed(_each(_PLUS, "+")(now.text))
    return now


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and these with the ones that only a rewritten text shows."""
    plain = plain_spans(text)
    clear = deobfuscated(text)
    if clear is None:
        return plain, plain
    taken = sorted((s, e) for s, _, e in plain)
    starts, ends, reach = [s for s, _ in taken], [], 0
    for _, e in taken:
        reach = max(reach, e)
        ends.append(reach)
    added, known = [], set(plain)
    for s, kind, e in plain_spans(clear.text):
        s, e = clear.start(s), clear.end(e)
        k = bisect_right(starts, e - 1)
        apart = not k or ends[k - 1] <= s
        # What looks like a part only because a sign in it was not plain is given whole as well.
        if apart or ((s, kind, e) not in known and _ODD.search(text, s, e)):
            added.append((s, kind, e))
    return plain, sorted(plain + added)


def _column(rows: list[list[Span]]) -> pa.Array:
    flat = [x for spans in rows for x in spans]
    edges, size = [0], 0
    for spans in rows:
        size += len(spans)
        edges.append(size)
    items = pa.StructArray.from_arrays(
        [
            pa.array([KINDS[k] for _, k, _ in flat], pa.string()),
            pa.array([s for s, _, _ in flat], pa.int64()),
            pa.array([e for _, _, e in flat], pa.int64()),
        ],
        ["kind", "start", "end"],
    )
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), items)


def find_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The id, the ``plain`` spans and all ``spans`` of each row: kind, start, end in code points."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            # One text at a time: a batch may hold many long ones.
            both = [all_spans(t.as_py() or "") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _column([p for p, _ in both]), _column([a for _, a in both])],
                ["id", "plain", "spans"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, plain {SPANS}, spans {SPANS}"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping ones the first."""
    first = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(done: Column, span: Column) -> Column:
        clear = F.substr(text, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        put = F.struct(
            F.concat(done["out"], clear, F.lit("["), span["kind"], F.lit("]")).alias("out"), span["end"].alias("at")
        )
        return F.when(span["start"] >= done["at"], put).otherwise(done)

    return F.aggregate(
        spans, first, step, lambda done: F.concat(done["out"], F.substr(text, (done["at"] + 1).cast("int")))
    )


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the plain spans by kind, their digest, and all spans as one string."""

    def count(kind: str) -> Column:
        return F.size(F.filter("plain", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col(id_col),
        *[count(k) for k in KINDS],
        F.sha2(joined(F.col("plain")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
