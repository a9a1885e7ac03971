"""Keywords of all lists of a rule pack, found in one pass of an automaton over each text."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, fields, is_dataclass

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scan:
    """A text's keywords as a column, in the place of the text in the functions of ``text`` that ask for keywords."""

    found: Column

    def hits(self, keywords: Iterable[str]) -> Column:
        """Keywords of the list that the text has, in the list's order; none in a null text."""
        listed = tuple(keywords)
        asked = F.array(*map(F.lit, listed)) if listed else F.array().cast("array<string>")
        found = F.coalesce(self.found, F.array().cast("array<string>"))
        return F.array_intersect(asked, found) if len(set(listed)) == len(listed) else F.filter(asked, lambda k: F.array_contains(found, k))

    def any_hit(self, keywords: Iterable[str]) -> Column:
        """Whether the text has a keyword of the list; null in a null text if the list has one."""
        listed = tuple(keywords)
        return F.arrays_overlap(self.found, F.array(*map(F.lit, listed))) if listed else F.lit(False)


def words_of(rules: object) -> set[str]:
    """All strings of a rule pack: its lists are tuples, dicts and tuples of (label, keywords)."""
    if isinstance(rules, str):
        return {rules}
    if isinstance(rules, dict):
        return words_of(tuple(rules.keys())) | words_of(tuple(rules.values()))
    if isinstance(rules, list | tuple | set | frozenset):
        return set().union(*map(words_of, rules)) if rules else set()
    if is_dataclass(rules):
        return words_of(tuple(getattr(rules, f.name) for f in fields(rules)))
    return set()


_automata: dict[tuple[str, ...], object] = {}


def _automaton(words: tuple[str, ...]):
    """The automaton of some words, one for each Python worker and pack."""
    if words not in _automata:
        import ahocorasick

        made = ahocorasick.Automaton()
        for w in words:
            if w:
                made.add_word(w, w)
        made.make_automaton()
        if len(_automata) > 8:
            _automata.clear()
        _automata[words] = made
    return _automata[words]


def _across(texts: list[str], reach: int) -> list[str]:
    """Pieces of the texts, joined by spaces, that hold all words of up to reach + 1 characters that no single text has."""
    pieces = [""]
    for i, t in enumerate(texts):
        if i:
            pieces[-1] += " "
        if len(t) <= 2 * reach:
            pieces[-1] += t
        else:
            pieces[-1] += t[:reach]
            pieces.append(t[len(t) - reach :])
    return pieces


def scanner(words: Iterable[str], joined: int = 0):
    """A column function: an array of texts to an array of the keywords that each has; null for a null text.

    With ``joined``, one more item holds the keywords of the first ``joined``
    texts joined by spaces, nulls left out; each text is sent and read once.
    """
    listed = tuple(sorted(set(words)))
    always = [w for w in listed if not w]
    reach = max(map(len, listed), default=1) - 1

    @F.arrow_udf("array<array<string>>")
    def scan(rows: pa.Array) -> pa.Array:
        automaton = _automaton(listed)
        find = automaton.iter if len(automaton) else lambda _: ()

        def of_row(row: pa.ListScalar) -> list | None:
            texts = row.as_py()  # one row's texts at a time, so a batch isn't held twice
            if texts is None:
                return None
            found = [None if t is None else {w for _, w in find(t)} for t in texts]
            if joined:
                pieces = _across([t for t in texts[:joined] if t is not None], reach)
                found.append({w for p in pieces for _, w in find(p)}.union(*(f for f in found[:joined] if f is not None)))
            return [None if f is None else [*always, *f] for f in found]

        return pa.array(map(of_row, rows), pa.list_(pa.list_(pa.string())))

    return scan

