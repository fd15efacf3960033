"""Lexicon sentiment as native expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# A score beyond +-1 leaves the neutral band.
NEUTRAL_BAND = 1.0

WORD_CHARS = r"[\p{L}\p{N}_]"

# Fixed value: white space of a pattern's \\s.
WHITE = " \t\n\x0b\f\r"

# A text falls into tokens: a whole word or a single other character, each with the white space before it.
TOKEN = rf"\s*(?:{WORD_CHARS}+|[^\p{{L}}\p{{N}}_\s])"

#: Entries and characters of a lexicon that may stand in a plan; larger ones are joined.
MAX_IN_PLAN = 2_000
MAX_CHARS_IN_PLAN = 60_000


def normalise_entry(entry: str) -> str:
    return re.sub(r"\s+", " ", entry.lower(), flags=re.ASCII).strip(" ")


def normalised(lexicon: Mapping[str, float]) -> dict[str, float]:
    """Entries in lower case with single spaces; of repeats the largest value holds."""
    out: dict[str, float] = {}
    for entry, value in lexicon.items():
        key = normalise_entry(entry)
        if key:
            out[key] = max(float(value), out.get(key, float(value)))
    return out


def _alternatives(entries: list[str]) -> str:
    """A pattern for ``entries`` that branches once per letter, the longest entry first.

    A flat ``a|b|c`` would try every entry at every word of the text. A space stands for any
    white space.
    """
    by_head: dict[str, list[str]] = {}
    for entry in entries:
        if entry:
            by_head.setdefault(entry[0], []).append(entry[1:])
    branches = [
        (r"\s+" if head == " " else re.escape(head)) + _alternatives(tails)
        for head, tails in sorted(by_head.items())
    ]
    if not branches:
        return ""
    optional = "?" if "" in entries else ""
    if len(branches) == 1 and not optional:
        return branches[0]
    return f"(?:{'|'.join(branches)}){optional}"


def entry_pattern(entries: Iterable[str]) -> str:
    """Finds entries from left to right, the longest at each place.

    Whole words only: an entry that begins with a word character begins a word, and no word
    character follows any entry. Nothing else of the text is taken out of it.
    """
    held = sorted(set(entries))
    worded = [e for e in held if re.match(r"\w", e)]
    others = [e for e in held if not re.match(r"\w", e)]
    found = [f"(?<!{WORD_CHARS}){_alternatives(worded)}"] * bool(worded) + [_alternatives(others)] * bool(others)
    return f"(?:{'|'.join(found)})(?!{WORD_CHARS})"


def _valence(unit: Column, lexicon: Mapping[str, float]) -> Column:
    """The value of a lexicon entry, else 0: one hash-set test per distinct value."""
    by_value: dict[float, list[str]] = {}
    for entry, value in lexicon.items():
        by_value.setdefault(value, []).append(entry)
    result = F.when(F.lit(False), F.lit(0.0))
    for value, entries in sorted(by_value.items()):
        result = result.when(unit.isin(*entries), F.lit(value))
    return result.otherwise(F.lit(0.0))


def sentiment_score(text: Column | str, lexicon: Mapping[str, float]) -> Column:
    """Sum of the valences of all lexicon entries found in the whole text.

    Matching ignores case, takes whole words only and runs left to right, the longest
    entry winning at each position. Null text scores 0. The lexicon becomes part of the
    plan, so its size is bounded; ``score_by_table`` gives the same scores from a table of
    any size.
    """
    entries = normalised(lexicon)
    if not fits_in_plan(entries):
        raise ValueError(f"a lexicon of over {MAX_IN_PLAN} entries or {MAX_CHARS_IN_PLAN} characters needs a table")
    if not entries:
        return F.lit(0.0)
    text = F.col(text) if isinstance(text, str) else text
    found = F.regexp_extract_all(F.lower(text), F.lit(entry_pattern(entries)), F.lit(0))
    if any(" " in e for e in entries):
        found = F.transform(found, lambda u: F.regexp_replace(u, r"\s+", " "))
    total = F.aggregate(found, F.lit(0.0), lambda acc, u: acc + _valence(u, entries))
    return F.coalesce(total, F.lit(0.0))


def tokens(text: Column) -> Column:
    """Words and other characters of a text in lower case and in order, with the white space before them."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def fits_in_plan(lexicon: Mapping[str, float]) -> bool:
    return len(lexicon) <= MAX_IN_PLAN and sum(map(len, lexicon)) <= MAX_CHARS_IN_PLAN


def sentiment_label(score: Column | str) -> Column:
    score = F.col(score) if isinstance(score, str) else score
    return (
        F.when(score > NEUTRAL_BAND, "positive")
        .when(score < -NEUTRAL_BAND, "negative")
        .otherwise("neutral")
    )
