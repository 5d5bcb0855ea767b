"""Typed tables: cells read as numbers, arithmetic over rows, families by evidence, and a filing's tables put together.

A grid (rows of texts) becomes a ``Typed`` table.  ``arithmetic`` finds rows that
are sums of the rows above them.  ``classify`` weighs each family's words,
confirmed sums and shape; a signature block or page furniture is refused first,
the best family wins with ties by priority, and below the floor a table is
residual.  ``assemble`` joins a family's tables across pages and keeps the one
with most evidence where several claim a family that a filing has once.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

_NUMBER = re.compile(r"(?:[($-]\s*)*(\d[\d,]*\.?\d*|\.\d+)\s*\)?\s*%?")
_BLANK = frozenset({"", "-", "–", "—", "--", "n/a", "N/A"})
_TOTAL = re.compile(r"\b(sub)?total|^net\b|\bin all\b", re.IGNORECASE)
_SIGNED = re.compile(r"/s/|\bsignature|\bduly authorized|\bhereunto", re.IGNORECASE)


def number(cell: str | None) -> float | None:
    """A cell's number: brackets and a minus are negative, signs and separators fall away; None where it is none."""
    text = (cell or "").strip()
    m = _NUMBER.fullmatch(text)
    if not m:
        return None
    value = float(m[1].replace(",", ""))
    return -value if "(" in text or "-" in text else value


@dataclass(frozen=True)
class Typed:
    """``labels``: a row's first cell that is no number; ``values``: the numbers of each row by column, the label's left out."""

    caption: str
    header: tuple[str, ...]
    labels: tuple[str, ...]
    values: tuple[tuple[float | None, ...], ...]
    start: int = 0

    @property
    def width(self) -> int:
        return max(map(len, self.values), default=0)


def typed(grid: Sequence[Sequence[str | None]], caption: str = "", start: int = 0) -> Typed:
    """Rows before the first that has a label and a number are the header; columns without any number or text are dropped."""
    width = max(map(len, grid), default=0)
    rows = [[(c or "").strip() for c in row] + [""] * (width - len(row)) for row in grid]
    used = [k for k in range(width) if any(row[k] not in _BLANK for row in rows)]
    rows = [[row[k] for k in used] for row in rows]
    numeric = [row[0] not in _BLANK and number(row[0]) is None and any(number(c) is not None for c in row[1:]) for row in rows if row]
    first = numeric.index(True) if True in numeric else len(rows)
    header = tuple(" ".join(x for x in column if x) for column in zip(*rows[:first], strict=True)) if first else ()
    body = [row for row in rows[first:] if any(c not in _BLANK for c in row)]
    return Typed(caption, header, tuple(row[0] for row in body), tuple(tuple(number(c) for c in row[1:]) for row in body), start)


@dataclass(frozen=True)
class Sum:
    """Row ``row`` of column ``column`` against the sum of the rows from ``first`` on."""

    row: int
    column: int
    first: int
    difference: float
    holds: bool


def arithmetic(table: Typed, tolerance: float = 1.0) -> list[Sum]:
    """For every row that is called a total, by column: the run of rows above it that it sums up.

    Runs begin after the last total, and grow upwards over whole earlier runs (a
    grand total counts subtotals once); the closest run is told where none fits.
    """
    out = []
    for column in range(table.width):
        value = lambda k: table.values[k][column] if column < len(table.values[k]) else None  # noqa: B023, E731
        parts: list[tuple[int, float]] = []  # what a total can sum up: (row, value), a subtotal standing for its run
        for k, label in enumerate(table.labels):
            v = value(k)
            if v is None:
                continue
            if _TOTAL.search(label) and parts:
                sums = [(first, sum(x for _, x in parts[first:])) for first in range(len(parts) - 1, -1, -1)]
                # a single row isn't a sum; of runs that fit the one that fits best, then the closest
                first, best = min(sums, key=lambda x: (abs(x[1] - v) > tolerance or len(parts) - x[0] < 2, abs(x[1] - v), -x[0]))
                holds = abs(best - v) <= tolerance and len(parts) - first > 1
                out.append(Sum(k, column, parts[first][0], best - v, holds))
                parts = [*(parts[:first] if holds else []), (k, v)]
            else:
                parts.append((k, v))
    return out


@dataclass(frozen=True)
class Family:
    """Words with weights looked for in caption, header and labels; ``sums``: what a confirmed sum adds; ``single``: a filing has one."""

    name: str
    words: Mapping[str, float]
    sums: float = 0.0
    single: bool = True
    least_rows: int = 2


#: This engine's own small vocabularies; callers may give theirs.  Their order is the priority on ties.
FAMILIES = (
    Family("balance_sheet", {"total assets": 3, "liabilities": 2, "stockholders equity": 2, "current assets": 1, "cash": 0.5}, 0.5),
    Family("income_statement", {"revenue": 2, "net income": 2, "net loss": 2, "operating expenses": 1, "per share": 1, "cost of": 1}, 0.5),
    Family("cash_flow", {"operating activities": 3, "investing activities": 3, "financing activities": 3}, 0.5),
    Family("holdings", {"cusip": 3, "shares": 1, "name of issuer": 3, "market value": 1}, 0, False),
    Family("compensation", {"salary": 3, "bonus": 2, "stock awards": 2, "name and principal position": 3}, 0, False),
)
FLOOR = 3.0


def evidence(table: Typed, families: Sequence[Family] = FAMILIES, sums: Sequence[Sum] | None = None) -> dict[str, float]:
    """The score of each family: every word once, and confirmed sums up to four."""
    said = re.sub(r"[^a-z0-9]+", " ", " ".join([table.caption, *table.header, *table.labels]).lower())
    held = sum(s.holds for s in (arithmetic(table) if sums is None else sums))
    scores = {}
    for f in families:
        words = sum(w for word, w in f.words.items() if f" {word}" in f" {said}")
        scores[f.name] = words + (f.sums * min(held, 4) if words else 0) if len(table.labels) >= f.least_rows else 0.0
    return scores


def classify(table: Typed, families: Sequence[Family] = FAMILIES, floor: float = FLOOR) -> tuple[str, float]:
    """(family, score): ``signature`` and ``furniture`` are refused first; ``residual`` below the floor."""
    if _SIGNED.search(" ".join([table.caption, *table.header, *table.labels])):
        return "signature", 0.0
    if not table.labels or not any(v is not None for row in table.values for v in row):
        return "furniture", 0.0
    scores = evidence(table, families)
    order = {f.name: k for k, f in enumerate(families)}
    best = max(scores, key=lambda n: (scores[n], -order[n]))
    return (best, scores[best]) if scores[best] >= floor else ("residual", scores[best])


@dataclass
class Assembled:
    family: str
    score: float
    tables: list[int] = field(default_factory=list)  # places in the filing, in order


def assemble(tables: Sequence[Typed], families: Sequence[Family] = FAMILIES, floor: float = FLOOR) -> list[Assembled]:
    """A filing's tables by family, in order of their first table.

    A residual table with the width of the family's table right before it
    continues that.  Of several groups of a family that a filing has once the
    one with the best score stays, the first on ties, and the others are residual.
    """
    single = {f.name for f in families if f.single}
    groups: list[Assembled] = []
    for k, table in enumerate(tables):
        family, score = classify(table, families, floor)
        last = groups[-1] if groups else None
        if family == "residual" and last and last.family in single and last.tables[-1] == k - 1 and tables[k - 1].width == table.width and not table.header:
            last.tables.append(k)
            last.score += score
        else:
            groups.append(Assembled(family, score, [k]))
    best: dict[str, Assembled] = {}
    for g in groups:
        if g.family in single and (g.family not in best or g.score > best[g.family].score):
            best[g.family] = g
    return [g if g.family not in single or best[g.family] is g else Assembled("residual", g.score, g.tables) for g in groups]
