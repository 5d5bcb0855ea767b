"""Concept names: number words, temporal phrases, and decomposition into a head and modifiers by a lexicon."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product

#: Number words.
UNITS = {w: k for k, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split())}
TENS = {w: 10 * k for k, w in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split(), 2)}
SCALES = {"hundred": 100, "thousand": 1000, "million": 10**6}
ORDINALS = {w: k for k, w in enumerate("first second third fourth fifth sixth seventh eighth ninth tenth".split(), 1)}
SPANS = {"day": 1, "days": 1, "week": 7, "weeks": 7, "month": 30, "months": 30, "quarter": 91, "quarters": 91, "year": 365, "years": 365}


def number_phrase(tokens: Sequence[str], start: int = 0) -> tuple[int, int] | None:
    """(value, first place after it) of a number written in words or digits at this place, or None."""
    total = part = 0
    k, seen = start, False
    while k < len(tokens):
        t = tokens[k].lower()
        if t.isdigit() and not seen:
            part, seen = int(t), True
        elif t in UNITS and (not seen or part % 100 == 0 or part % 10 == 0 and part % 100 >= 20):
            part, seen = part + UNITS[t], True
        elif t in TENS and (not seen or part % 100 == 0):
            part, seen = part + TENS[t], True
        elif t in SCALES and seen:
            part *= SCALES[t]
            if SCALES[t] >= 1000:
                total, part = total + part, 0
        elif not (t == "and" and seen and k + 1 < len(tokens) and tokens[k + 1].lower() in UNITS | TENS):
            break
        k += 1
    return (total + part, k) if seen else None


def temporal(tokens: Sequence[str]) -> tuple[str, int] | None:
    """(kind, size): an ordinal period ("third quarter": quarter, 3) or a span in days ("two years": days, 730)."""
    for k, t in enumerate(tokens):
        low = t.lower()
        if low in ORDINALS and k + 1 < len(tokens) and tokens[k + 1].lower() in ("quarter", "month", "year"):
            return tokens[k + 1].lower(), ORDINALS[low]
        if (n := number_phrase(tokens, k)) and n[1] < len(tokens) and tokens[n[1]].lower() in SPANS:
            return "days", n[0] * SPANS[tokens[n[1]].lower()]
    return None


def words(name: str) -> list[str]:
    """The words of a CamelCase name, its prefix left out."""
    local = name.rpartition(":")[2]
    return re.findall(r"[A-Z]+(?=[A-Z][a-z])|[A-Z]?[a-z]+|[A-Z]+|\d+", local)


@dataclass(frozen=True)
class Atom:
    head: str
    modifiers: frozenset[str] = frozenset()

    def is_a(self, other: Atom) -> bool:
        return self.head == other.head and self.modifiers >= other.modifiers

    def meet(self, other: Atom) -> Atom | None:
        return Atom(self.head, self.modifiers | other.modifiers) if self.head == other.head else None

    def join(self, other: Atom) -> Atom | None:
        return Atom(self.head, self.modifiers & other.modifiers) if self.head == other.head else None


def most_specific(atoms: Sequence[Atom]) -> list[Atom]:
    return [a for a in dict.fromkeys(atoms) if not any(b != a and b.is_a(a) for b in atoms)]


def most_general(atoms: Sequence[Atom]) -> list[Atom]:
    return [a for a in dict.fromkeys(atoms) if not any(b != a and a.is_a(b) for b in atoms)]


def decompose(name: str, heads: Mapping[str, str], modifiers: Mapping[str, str]) -> tuple[Atom | None, tuple[str, ...]]:
    """(atom, words left over): the longest phrase claims first, anywhere in the name; the last head claimed is the head,
    others are modifiers.  ``heads`` and ``modifiers`` map lower-case phrases to their canonical names."""
    tokens = [w.lower() for w in words(name)]
    claimed: list[str | None] = [None] * len(tokens)
    found: list[tuple[int, str, str]] = []
    phrases = sorted([(p.split(), c, "head") for p, c in heads.items()] + [(p.split(), c, "mod") for p, c in modifiers.items()], key=lambda x: (-len(x[0]), x[0]))
    for phrase, canonical, kind in phrases:
        n = len(phrase)
        for k in range(len(tokens) - n + 1):
            if tokens[k : k + n] == phrase and not any(claimed[k : k + n]):
                claimed[k : k + n] = [canonical] * n
                found.append((k, canonical, kind))
    head = max((f for f in found if f[2] == "head"), default=None)
    rest = tuple(t for t, c in zip(tokens, claimed, strict=True) if c is None)
    return (Atom(head[1], frozenset(c for k, c, _ in found if (k, c) != head[:2])) if head else None), rest


def compounds(*slots: Sequence[str], sep: str = " ") -> tuple[str, ...]:
    """Every phrase of one choice a slot, longest first; an empty choice leaves its slot out."""
    made = {sep.join(filter(None, choice)) for choice in product(*slots)}
    return tuple(sorted(made, key=lambda p: (-len(p), p)))


def heal_dates(lines: Sequence[str], window: int = 4) -> list[str]:
    """Lines joined where a written date was broken over them."""
    month = r"(?:January|February|March|April|May|June|July|August|September|October|November|December)"
    out, k = [], 0
    while k < len(lines):
        for n in range(min(window, len(lines) - k), 1, -1):
            joined = " ".join(x.strip() for x in lines[k : k + n])
            m = re.search(rf"{month}\s+\d{{1,2}},?\s+\d{{4}}$", joined)
            if m and not any(re.search(rf"{month}\s+\d{{1,2}},?\s+\d{{4}}", x) for x in lines[k : k + n]) and re.search(rf"{month}\b", lines[k]):
                out.append(joined)
                k += n
                break
        else:
            out.append(lines[k])
            k += 1
    return out
