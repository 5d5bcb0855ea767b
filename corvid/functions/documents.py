"""Document transformations: HTML to text and tables, page furniture, reflow, table rows, sections, notes, lexical evidence.

Every function is pure over one document; ``on_text`` and ``rows_of`` run them
over a column in Arrow batches, a document at a time, with errors as a column.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections import Counter, defaultdict, deque
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = frozenset("p div br tr li h1 h2 h3 h4 h5 h6 table section article header footer ul ol title blockquote pre hr dt dd".split())
HIDDEN = frozenset("script style head noscript template svg".split())


# HTML


@dataclass
class Cell:
    text: str
    rowspan: int = 1
    colspan: int = 1
    head: bool = False


class _Reader(HTMLParser):
    """Text pieces and tables of a page, in order; hidden blocks and inline-fact wrappers' tags leave no text of their own."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str | list[list[Cell]]] = []
        self.stack: list[list[list[Cell]]] = []
        self.cell: list[Cell | None] = []
        self.skip = 0

    def _put(self, text: str) -> None:
        if self.stack and self.cell[-1] is not None:
            self.cell[-1].text += text
        elif not self.stack:
            self.out.append(text)

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in HIDDEN and tag != "head" or (tag == "head"):
            self.skip += 1
            return
        if "display:none" in (a.get("style") or "").replace(" ", "").lower() and tag not in ("br", "img", "hr", "input", "meta", "link"):
            self._put("")
        if tag == "table":
            self.stack.append([])
            self.cell.append(None)
        elif tag == "tr" and self.stack:
            self.stack[-1].append([])
            self.cell[-1] = None
        elif tag in ("td", "th") and self.stack:
            if not self.stack[-1]:
                self.stack[-1].append([])
            span = lambda n: min(max(int(a[n]), 1), 1000) if (a.get(n) or "").isdigit() else 1
            self.cell[-1] = Cell("", span("rowspan"), span("colspan"), tag == "th")
            self.stack[-1][-1].append(self.cell[-1])
        elif tag in BLOCKS:
            self._put("\n")

    def handle_endtag(self, tag):
        if tag in HIDDEN:
            self.skip = max(0, self.skip - 1)
        elif tag in ("td", "th") and self.stack:
            self.cell[-1] = None
        elif tag == "table" and self.stack:
            done = self.stack.pop()
            self.cell.pop()
            if self.stack and self.cell[-1] is not None:
                self.cell[-1].text += " ".join(c.text for row in done for c in row)
            else:
                self.out.append(done)
        elif tag in BLOCKS:
            self._put("\n")

    def handle_data(self, data):
        if not self.skip:
            self._put(data)


def _read(html: str) -> list[str | list[list[Cell]]]:
    reader = _Reader()
    reader.feed(html)
    reader.close()
    while reader.stack:
        reader.handle_endtag("table")
    return reader.out


def span_matrix(rows: Sequence[Sequence[Cell]]) -> list[list[str | None]]:
    """The grid of a table: a spanning cell's text at its first place, "" at the places it covers, None where there is no cell."""
    grid: dict[tuple[int, int], str] = {}
    for r, row in enumerate(rows):
        c = 0
        for cell in row:
            while (r, c) in grid:
                c += 1
            for i in range(min(cell.rowspan, len(rows) - r)):
                for j in range(cell.colspan):
                    grid.setdefault((r + i, c + j), " ".join(cell.text.split()) if i == j == 0 else "")
            c += cell.colspan
    width = max((c for _, c in grid), default=-1) + 1
    return [[grid.get((r, c)) for c in range(width)] for r in range(len(rows))]


def table_text(rows: Sequence[Sequence[Cell]]) -> str:
    """An aligned text grid: empty rows and columns left out, numbers to the right, currency and signs joined to their numbers."""
    grid = [[(x or "") for x in row] for row in span_matrix(rows)]
    grid = [row for row in grid if any(row)]
    for row in grid:
        for k in range(len(row) - 1):
            if re.fullmatch(r"[$€£(]|\(\s*[$€£]", row[k]):
                row[k + 1], row[k] = row[k] + row[k + 1], ""
        for k in range(1, len(row)):
            if re.fullmatch(r"[)%]+", row[k]) and row[k - 1]:
                row[k - 1], row[k] = row[k - 1] + row[k], ""
    keep = [k for k in range(len(grid[0]) if grid else 0) if any(row[k] for row in grid)]
    grid = [[row[k] for k in keep] for row in grid]
    widths = [max(len(row[k]) for row in grid) for k in range(len(keep))]
    number = re.compile(r"[($€£ -]*[\d,.]+[)% ]*|[-–—]")
    lines = ["  ".join(x.rjust(w) if number.fullmatch(x) else x.ljust(w) for x, w in zip(row, widths, strict=True)).rstrip() for row in grid]
    return "\n".join(lines)


def continue_table(first: Sequence[Sequence[Cell]], second: Sequence[Sequence[Cell]]) -> list[list[Cell]]:
    """One table of two that a page break split: the second's repeated heading rows are dropped."""
    same = 0
    said = lambda row: [" ".join(c.text.split()) for c in row]
    while same < min(len(first), len(second)) and said(first[same]) == said(second[same]):
        same += 1
    return [*map(list, first), *map(list, second[same:])]


def html_to_text(html: str) -> str:
    """A page's text: blocks on lines of their own, tables as grids, white space collapsed outside them."""
    out: list[str] = []
    for part in _read(html or ""):
        if isinstance(part, str):
            out.append(part)
        else:
            out.append("\n\0" + table_text(part).replace("\n", "\n\0") + "\n")
    lines = "".join(out).replace("\xa0", " ").split("\n")
    lines = [x[1:] if x.startswith("\0") else " ".join(x.split()) for x in lines]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def html_tables(html: str) -> list[list[list[str | None]]]:
    return [span_matrix(p) for p in _read(html or "") if not isinstance(p, str)]


def representation(data: bytes) -> tuple[str, str]:
    """(kind, text): xml, html or ascii; UTF-8, else Latin-1."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        text = data.decode("latin-1")
    head = text[:2000].lstrip().lower()
    if head.startswith("<?xml") and "<html" not in head:
        return "xml", text
    return ("html" if re.search(r"<(?:html|body|div|p|table|font)\b", head) else "ascii"), text


# Pages

_LABEL = re.compile(r"^\s*(?:page\s+)?(?:-\s*)?((?:[A-Z]-)?\d{1,4}|[ivxlc]{1,7})(?:\s*-)?(?:\s+of\s+\d+)?\s*$", re.IGNORECASE)
_TAG = re.compile(r"^\s*<PAGE>\s*\S*\s*$", re.IGNORECASE)


def page_markers(text: str) -> list[tuple[int, str]]:
    """(line, label) of lines that number pages: tags, and bare numbers that form a rising run of three or more."""
    lines = text.split("\n")
    out = [(k, "") for k, x in enumerate(lines) if _TAG.match(x)]
    bare = [(k, int(m[1])) for k, x in enumerate(lines) if (m := _LABEL.match(x)) and m[1].isdigit()]
    best: list[list[tuple[int, int]]] = []
    for k, n in bare:
        for run in best:
            if n == run[-1][1] + 1:
                run.append((k, n))
                break
        else:
            best.append([(k, n)])
    run = max(best, key=len, default=[])
    if len(run) >= 3:
        out += [(k, str(n)) for k, n in run]
    return sorted(out)


def page_furniture(text: str, near: int = 3, least: int = 3) -> set[int]:
    """Lines that repeat (digits aside) within ``near`` lines of at least ``least`` page markers: running heads and feet."""
    lines, marks = text.split("\n"), [k for k, _ in page_markers(text)]
    seen: dict[tuple[str, str], set[int]] = defaultdict(set)
    for m in marks:
        for side, step in (("above", -1), ("below", 1)):
            found, k = 0, m + step
            while 0 <= k < len(lines) and found < near:
                if said := re.sub(r"\d+", "#", " ".join(lines[k].split())):
                    found += 1
                    seen[side, said].add(k)
                k += step
    return {k for (_, said), places in seen.items() if len(places) >= least and len(said) <= 80 for k in places}


def strip_pages(text: str) -> str:
    """The text without page markers and furniture."""
    drop = {k for k, _ in page_markers(text)} | page_furniture(text)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(x for k, x in enumerate(text.split("\n")) if k not in drop)) if drop else text


# Blocks and reflow


@dataclass(frozen=True)
class Block:
    start: int
    end: int
    lines: tuple[str, ...]


def blocks(text: str) -> list[Block]:
    """Runs of lines that aren't blank."""
    out, held, start = [], [], 0
    for k, line in enumerate([*text.split("\n"), ""]):
        if line.strip():
            if not held:
                start = k
            held.append(line)
        elif held:
            out.append(Block(start, k, tuple(held)))
            held = []
    return out


def decide(block: Block) -> str:
    """preserve, table or unwrap: the first rule that holds."""
    lines, n = block.lines, len(block.lines)
    wide = sum(bool(re.search(r"\S\s{3,}\S", x)) for x in lines)
    ruled = sum(bool(re.fullmatch(r"[\s\-=_.|+]{5,}", x)) for x in lines)
    numbers = sum(bool(re.search(r"(?:\s{2,}|\$)\(?[\d,.]+\)?%?\s*$", x)) for x in lines)
    letters = sum(c.isalpha() for x in lines for c in x) / max(1, sum(not c.isspace() for x in lines for c in x))
    rules = (
        ("table", ruled >= 1 and wide >= 1), ("table", n >= 2 and wide >= 0.6 * n), ("table", n >= 3 and numbers >= 0.6 * n), ("preserve", n == 1),
        ("preserve", letters < 0.5), ("preserve", max(map(len, lines)) < 45), ("preserve", any(re.match(r"\s*(?:[-*•]|\(?[a-z0-9]{1,3}[.)])\s", x) for x in lines[1:])),
    )
    return next((what for what, holds in rules if holds), "unwrap")


def reflow(text: str) -> str:
    """Prose blocks joined to one line each, hyphenated line ends healed; tables between tags; all else as it is."""
    out = []
    for b in blocks(text):
        match decide(b):
            case "unwrap":
                out.append(re.sub(r"(?<=[a-z])- (?=[a-z])", "", " ".join(x.strip() for x in b.lines)))
            case "table":
                out.append("<TABLE>\n" + "\n".join(b.lines) + "\n</TABLE>")
            case _:
                out.append("\n".join(b.lines))
    return "\n\n".join(out)


def heal_lines(lines: Sequence[str], phrases: Sequence[Sequence[str]]) -> list[str]:
    """Lines joined where a known phrase was split over their end."""
    out: list[str] = []
    for line in lines:
        if out:
            tail, head = out[-1].lower().split(), line.lower().split()
            if any(tail[-k:] == list(p[:k]) and head[: len(p) - k] == list(p[k:]) for p in phrases for k in range(1, len(p))):
                out[-1] = f"{out[-1].rstrip()} {line.lstrip()}"
                continue
        out.append(line)
    return out


def row_shape(line: str) -> tuple[tuple[int, ...], tuple[int, ...]] | None:
    """(starts of fields, places of numeric fields) of a line with two fields or more, one of them numeric."""
    fields = [(m.start(), m[0]) for m in re.finditer(r"\S+(?: \S+)*", line)]
    numeric = tuple(k for k, (_, x) in enumerate(fields) if re.fullmatch(r"[$(]*\s*-?[\d,]*\.?\d+\)?%?|[-–—]+", x))
    return (tuple(s for s, _ in fields), numeric) if len(fields) >= 2 and numeric and numeric != (0,) else None


def table_runs(text: str, least: int = 3, gap: int = 2, tolerance: int = 3) -> list[tuple[int, int, int]]:
    """(first line, line after the last, rows): greedy runs of numeric rows that fit the run's first row, with few blank lines between."""
    lines, out, k = text.split("\n"), [], 0
    while k < len(lines):
        first = row_shape(lines[k])
        if first is None:
            k += 1
            continue
        rows, last, j = 1, k, k + 1
        while j < len(lines) and j - last <= gap + 1:
            if lines[j].strip():
                shape = row_shape(lines[j])
                if shape is None or len(shape[1]) != len(first[1]) or abs(shape[0][0] - first[0][0]) > 4 * tolerance:
                    break
                rows, last = rows + 1, j
            j += 1
        if rows >= least:
            out.append((k, last + 1, rows))
            k = last + 1
        else:
            k += 1
    return out


# Sections and notes

_ITEM = re.compile(r"^\s*item\s+(\d{1,2}[A-C]?(?:\.\d\d)?)\s*[.:\-–—]?\s*(.*)$", re.IGNORECASE)
_NOTE = re.compile(r"^\s*(?:note\s+)?(\d{1,2})\s*[.:\-–—)]\s+([A-Z].{2,100})$", re.IGNORECASE)


def _item_key(label: str) -> tuple[int, str]:
    m = re.match(r"(\d+)(.*)", label.upper())
    return int(m[1]), m[2]


def toc_span(text: str) -> tuple[int, int] | None:
    """(first, last) line of a table of contents: item lines close together that end in page numbers or dots."""
    lines = text.split("\n")
    hits = [k for k, x in enumerate(lines) if _ITEM.match(x) and re.search(r"(?:\.{2,}|\s{2,})\s*\d{1,4}\s*$", x)]
    return (hits[0], hits[-1]) if len(hits) >= 3 and hits[-1] - hits[0] <= 12 * len(hits) else None


def sections(text: str) -> list[tuple[str, str, int, int]]:
    """(item, heading, start line, end line), lines from 1: items outside the contents in rising order; an untitled heading gives way to a titled one
    of the same item within four lines; of repeated items the first that keeps the order wins."""
    lines, toc = text.split("\n"), toc_span(text)
    found = [(k, m[1].upper(), m[2].strip()) for k, x in enumerate(lines) if (m := _ITEM.match(x)) and not (toc and toc[0] <= k <= toc[1])]
    found = [c for i, c in enumerate(found) if c[2] or not any(d[1] == c[1] and d[2] and 0 < d[0] - c[0] <= 4 for d in found[i + 1 : i + 3])]
    if not found:
        return []
    # the longest rising chain of items, the earliest lines on ties
    best: list[tuple[int, int]] = []
    for i, (_, item, _) in enumerate(found):
        before = max(((best[j][0], -j) for j in range(i) if _item_key(found[j][1]) < _item_key(item)), default=(0, 1))
        best.append((before[0] + 1, -before[1] if before[0] else -1))
    chain, at = [], max(range(len(best)), key=lambda i: (best[i][0], -i), default=-1)
    while at >= 0:
        chain.append(found[at])
        at = best[at][1]
    chain.reverse()
    ends = [c[0] for c in chain[1:]] + [len(lines)]
    return [(item, title, k + 1, e) for (k, item, title), e in zip(chain, ends, strict=True)]


def notes(text: str, scope: tuple[int, int] | None = None) -> list[tuple[int, str, int, int]]:
    """(number, heading, start line, end line): notes counted from 1 upward without a gap, inside the scope's lines."""
    lines = text.split("\n")
    low, high = scope or (1, len(lines))
    out: list[list] = []
    for k in range(low - 1, min(high, len(lines))):
        m = _NOTE.match(lines[k])
        if m and int(m[1]) == len(out) + 1:
            out.append([int(m[1]), m[2].strip(), k + 1, high])
    for a, b in zip(out, out[1:], strict=False):
        a[3] = b[2] - 1
    return [tuple(x) for x in out]


# Phrases


class Phrases:
    """Token-level Aho-Corasick: every phrase of every category found in one pass."""

    def __init__(self, categories: Mapping[str, Sequence[str]]):
        self.next: list[dict[str, int]] = [{}]
        self.fail, self.out = [0], [[]]
        for category, phrases in categories.items():
            for phrase in phrases:
                node = 0
                for token in phrase.lower().split():
                    if token not in self.next[node]:
                        self.next[node][token] = len(self.next)
                        self.next.append({})
                        self.fail.append(0)
                        self.out.append([])
                    node = self.next[node][token]
                self.out[node].append((category, phrase, len(phrase.split())))
        queue = deque(self.next[0].values())
        while queue:
            node = queue.popleft()
            for token, child in self.next[node].items():
                back = self.fail[node]
                while back and token not in self.next[back]:
                    back = self.fail[back]
                self.fail[child] = self.next[back].get(token, 0) if self.next[back].get(token, 0) != child else 0
                self.out[child] = self.out[child] + self.out[self.fail[child]]
                queue.append(child)

    def find(self, text: str) -> list[tuple[str, str, int]]:
        """(category, phrase, place of its first word)."""
        out, node = [], 0
        for k, token in enumerate(re.findall(r"[\w']+", text.lower())):
            while node and token not in self.next[node]:
                node = self.fail[node]
            node = self.next[node].get(token, 0)
            out += [(c, p, k - n + 1) for c, p, n in self.out[node]]
        return out


@dataclass(frozen=True)
class Tier:
    """Phrases of one strength (3 strong, 2 middling, 1 weak) and how many different ones are needed."""

    strength: int
    phrases: tuple[str, ...]
    least: int = 1


@dataclass
class Evidence:
    """A label's tiers and the words that rule it out.  Confidence by strength and distinct hits h: 0.9 + 0.02h, 0.8 + 0.03h or
    0.45 + 0.05h, at most 0.98, 0.95 and 0.6 (fixed values)."""

    label: str
    tiers: tuple[Tier, ...]
    exclusions: frozenset[str] = frozenset()
    least_words: int = 1
    _phrases: Phrases | None = field(default=None, repr=False)

    def score(self, text: str) -> tuple[str, int, float]:
        """(label or no_match, score, confidence)."""
        words = re.findall(r"[\w']+", text.lower())
        if len(words) < self.least_words or self.exclusions & set(words):
            return "no_match", 0, 0.0
        if self._phrases is None:
            self._phrases = Phrases({str(k): t.phrases for k, t in enumerate(self.tiers)})
        hits: dict[int, set[str]] = defaultdict(set)
        for tier, phrase, _ in self._phrases.find(text):
            hits[int(tier)].add(phrase)
        score, confidence = 0, 0.0
        base = {3: (0.9, 0.02, 0.98), 2: (0.8, 0.03, 0.95), 1: (0.45, 0.05, 0.6)}
        for k, tier in enumerate(self.tiers):
            if len(hits[k]) >= tier.least:
                score += tier.strength * len(hits[k])
                start, step, most = base[tier.strength]
                confidence = max(confidence, min(most, start + step * len(hits[k])))
        return (self.label, score, round(confidence, 4)) if score else ("no_match", 0, 0.0)


def classify(text: str, packs: Sequence[Evidence], priority: Sequence[str] = (), floor: int = 1) -> tuple[str, int, float]:
    """The label of the greatest score, ties by priority then name; residual below the floor."""
    order = {p: k for k, p in enumerate(priority)}
    best = max((p.score(text) for p in packs), key=lambda s: (s[1], -order.get(s[0], len(order)), s[0] != "no_match"), default=("no_match", 0, 0.0))
    return best if best[1] >= floor else ("residual", best[1], best[2])


def partition_kind(values: Mapping[str, float], total: float, arcs: Sequence[tuple[str, str]] = (), tolerance: float = 0.5, most: int = 18) -> str:
    """How members of an axis meet a total: CLEAN, NESTED (a member holds others), OVERLAPPING (an exact subset sums up), OVER_UNEXPLAINED or INCOMPLETE.

    Subsets are searched in two halves; beyond twice ``most`` members that is too much, and the answer is OVER_UNDECIDED.
    """
    inner = {child for parent, child in arcs if parent in values and child in values}
    top = {m: v for m, v in values.items() if m not in inner}
    if abs(sum(top.values()) - total) <= tolerance:
        return "NESTED" if inner else "CLEAN"
    if sum(top.values()) < total:
        return "INCOMPLETE"
    if len(top) > 2 * most:
        return "OVER_UNDECIDED"
    parts = list(top.values())
    halves = [np.zeros(1), np.zeros(1)]
    for k, v in enumerate(parts):
        halves[k % 2] = np.concatenate([halves[k % 2], halves[k % 2] + v])
    one, two = np.sort(halves[0]), halves[1]
    near = np.searchsorted(one, total - tolerance - two)
    return "OVERLAPPING" if (one[np.minimum(near, len(one) - 1)] + two <= total + tolerance)[near < len(one)].any() else "OVER_UNEXPLAINED"


# Pages set by position

_STYLE = re.compile(r"(left|top)\s*:\s*(-?[\d.]+)(px|pt|in|cm|mm)?", re.IGNORECASE)
#: Points in a unit of length; a pixel is three quarters.
_POINTS = {"pt": 1.0, "px": 0.75, "in": 72.0, "cm": 72 / 2.54, "mm": 72 / 25.4, "": 0.75}


class _Placed(HTMLParser):
    """Texts with the place that their nearest positioned elements add up to, by page."""

    VOID = frozenset(["br", "img", "hr", "input", "meta", "link", "col", "area", "base", "wbr"])

    def __init__(self):
        super().__init__()
        self.open: list[tuple[str, float, float, bool]] = []
        self.found: list[tuple[int, float, float, str]] = []
        self.page = 0

    def handle_starttag(self, tag, attrs):
        if tag in self.VOID:
            return
        style = dict(attrs).get("style") or ""
        x, y, placed = self.open[-1][1:] if self.open else (0.0, 0.0, False)
        if re.search(r"page-break-(before|after)\s*:\s*always", style, re.IGNORECASE):
            self.page += 1
        if re.search(r"position\s*:\s*absolute", style, re.IGNORECASE):
            at = {m[1].lower(): float(m[2]) * _POINTS[(m[3] or "").lower()] for m in _STYLE.finditer(style)}
            x, y, placed = x + at.get("left", 0.0), y + at.get("top", 0.0), True
        self.open.append((tag, x, y, placed))

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        said = " ".join(data.split())
        if said and self.open and self.open[-1][3]:
            self.found.append((self.page, self.open[-1][2], self.open[-1][1], said))


def positioned_text(html: str, line: float = 4.0, letter: float = 5.0) -> str:
    """The lines of a page whose fragments are placed one by one: fragments within ``line`` points of each other's height are one
    line, set at their column (``letter`` points a character); pages are parted by a blank line.  Empty where nothing is placed."""
    reader = _Placed()
    reader.feed(html)
    out: list[str] = []
    rows: list[tuple[int, float, list[tuple[float, str]]]] = []
    for page, top, left, said in sorted(reader.found, key=lambda f: f[:3]):
        if rows and rows[-1][0] == page and top - rows[-1][1] <= line:
            rows[-1][2].append((left, said))
        else:
            rows.append((page, top, [(left, said)]))
    for k, (page, _, parts) in enumerate(rows):
        if k and rows[k - 1][0] != page:
            out.append("")
        text = ""
        for left, said in sorted(parts, key=lambda p: p[0]):
            text = text.ljust(max(round(left / letter), len(text) + bool(text))) + said
        out.append(text.rstrip())
    return "\n".join(out)


# The whole document


@dataclass(frozen=True)
class Normalized:
    """A document's text with what was found on the way; spans are lines from 1, the end included."""

    kind: str
    text: str
    cover: tuple[int, int]
    contents: tuple[int, int] | None
    sections: tuple[tuple[str, str, int, int], ...]
    notes: tuple[tuple[int, str, int, int], ...]


_CHECKED = {"☒": "[X]", "☑": "[X]", "þ": "[X]", "☐": "[ ]", "¨": "[ ]"}
_CLOSING = re.compile(r"^\s*(signatures?|pursuant to the requirements of the securities exchange act)\b", re.IGNORECASE)


def normalize_document(data: bytes, phrases: Sequence[Sequence[str]] = ()) -> Normalized:
    """A document in one ordered pass: decoded, taken to text by its kind, page furniture out, checkmarks spelled, white space and split
    phrases mended; the cover ends where the contents or the first item begins; the body between cover and closing is reflowed; then
    sections and notes are read from what came out.  Empty bytes give an empty text."""
    kind, text = representation(data)
    if kind == "html":
        # a page set by position has no order of its own
        text = positioned_text(text) if len(re.findall(r"(?i)position\s*:\s*absolute", text)) >= 20 else html_to_text(text)
    text = strip_pages(text)
    for mark, said in _CHECKED.items():
        text = text.replace(mark, said)
    lines = [re.sub(r"[^\S\n\t]", " ", x).rstrip() for x in text.split("\n")]
    if phrases:
        lines = heal_lines(lines, phrases)
    text = re.sub(r"\n{4,}", "\n\n\n", "\n".join(lines)).strip("\n")
    lines = text.split("\n")
    contents, found = toc_span(text), sections(text)
    first = min([k for k in (contents[0] if contents else None, found[0][2] - 1 if found else None) if k is not None], default=len(lines) if not found else 0)
    body = contents[1] + 1 if contents else first
    closing = max((k for k in range(body, len(lines)) if _CLOSING.match(lines[k])), default=len(lines))
    # headings stay lines of their own: each section's lines are reflowed by themselves
    heads = sorted({body, closing, *[a - 1 for _, _, a, _ in found if body <= a - 1 < closing]})
    parts = lines[:body]
    for a, b in zip(heads, heads[1:], strict=False):
        titled = a in {x - 1 for _, _, x, _ in found}
        parts += ([lines[a]] if titled else []) + reflow("\n".join(lines[a + titled : b])).split("\n")
    text = "\n".join([*parts, *lines[closing:]]) if len(heads) > 1 else "\n".join(lines)
    told = toc_span(text)
    return Normalized(kind, text, (1, first), (told[0] + 1, told[1] + 1) if told else None, tuple(sections(text)), tuple(notes(text)))


def normalize_documents(docs: DataFrame, key: str, content: str) -> DataFrame:
    """(key, kind, text, cover_end, sections, notes, error) of a column of bytes or text; a document that can't be read is a row with its error."""
    spans = "array<struct<label:string,heading:string,start_line:int,end_line:int>>"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for k, data in zip(frame[key], frame[content], strict=True):
                try:
                    n = normalize_document(data.encode() if isinstance(data, str) else bytes(data or b""))
                    told = [[{"label": str(x[0]), "heading": x[1], "start_line": x[2], "end_line": x[3]} for x in some] for some in (n.sections, n.notes)]
                    out.append((k, n.kind, n.text, n.cover[1], *told, None))
                except ValueError as e:
                    out.append((k, None, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=[key, "kind", "text", "cover_end", "sections", "notes", "error"], dtype=object)

    schema = f"{key} {docs.schema[key].dataType.simpleString()}, kind string, text string, cover_end int, sections {spans}, notes {spans}, error string"
    return docs.select(key, content).mapInPandas(run, schema)


# Rendering by form

_FORM_KIND = (("ownership", r"[345](?:/A)?"), ("holdings", r"13F-(?:HR|NT)(?:/A)?"), ("beneficial", r"SC(?:HEDULE)? 13[DG](?:/A)?"), ("offering", r"D(?:/A)?|1-A.*|C(?:-.*)?"), ("fund", r"N(?:PORT|-CEN|-MFP|-PX|CSR).*|NPORT.*|NMFP.*"), ("annual", r"10-K.*|20-F.*|40-F.*|11-K.*"), ("quarter", r"10-Q.*"), ("current", r"8-K.*|6-K.*"))


def form_kind(form: str) -> str:
    """The family of renderers a form code belongs to."""
    return next((kind for kind, pattern in _FORM_KIND if re.fullmatch(pattern, (form or "").strip().upper())), "other")


def xml_fields(data: str) -> list[tuple[str, str]]:
    """(path, text) of every leaf of an XML form, with repeated elements numbered."""
    out: list[tuple[str, str]] = []

    def walk(e: ET.Element, path: str) -> None:
        counts = Counter(c.tag.rpartition("}")[2] for c in e)
        seen: Counter = Counter()
        for c in e:
            name = c.tag.rpartition("}")[2]
            seen[name] += 1
            at = f"{path}/{name}" + (f"[{seen[name]}]" if counts[name] > 1 else "")
            if len(c):
                walk(c, at)
            elif (c.text or "").strip():
                out.append((at, c.text.strip()))

    root = ET.fromstring(data)
    walk(root, root.tag.rpartition("}")[2])
    return out


def render(data: bytes, form: str = "") -> tuple[str, str]:
    """(kind, text) of a document: XML forms as field lines, HTML as text, ASCII without page furniture and reflowed."""
    kind, text = representation(data)
    if kind == "xml":
        return f"xml:{form_kind(form)}", "\n".join(f"{p}: {v}" for p, v in xml_fields(text))
    if kind == "html":
        return "html", html_to_text(text)
    return "ascii", reflow(strip_pages(text))


class Handlers:
    """Operations by name, with versions: what users extend."""

    def __init__(self):
        self._known: dict[str, tuple[str, Callable]] = {}

    def register(self, operation: str, version: str = "1") -> Callable[[Callable], Callable]:
        def add(f: Callable) -> Callable:
            if operation in self._known:
                raise ValueError(f"{operation} is registered already")
            self._known[operation] = (version, f)
            return f

        return add

    def get(self, operation: str) -> Callable:
        return self._known[operation][1]

    def resolve(self, operation: str) -> tuple[str, str] | None:
        return (operation, self._known[operation][0]) if operation in self._known else None

    def names(self) -> list[str]:
        return sorted(self._known)

    def apply(self, rows: DataFrame, operations: Sequence[str], key: str, content: str) -> DataFrame:
        """(key, operation, version, output, error): each operation on each document, apart from the others."""
        chosen = [(o, *self._known[o]) for o in operations]

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                out = []
                for k, data in zip(frame[key], frame[content], strict=True):
                    for name, version, f in chosen:
                        try:
                            out.append((k, name, version, f(data), None))
                        except Exception as e:  # noqa: BLE001  one operation's failure is its own row
                            out.append((k, name, version, None, f"{type(e).__name__}: {e}"))
                yield pd.DataFrame(out, columns=["key", "operation", "version", "output", "error"])

        kind = rows.schema[key].dataType.simpleString()
        return rows.select(key, content).mapInPandas(run, f"key {kind}, operation string, version string, output string, error string")


HANDLERS = Handlers()
HANDLERS.register("html_to_text")(html_to_text)
HANDLERS.register("strip_pages")(strip_pages)
HANDLERS.register("reflow")(reflow)


def on_text(f: Callable[[str], str], text: Column) -> Column:
    """A pure text function over a column, in Arrow batches; null stays null."""

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(f, na_action="ignore")

    return run(text)


def rows_of(docs: DataFrame, f: Callable[[str], Sequence[Sequence[object]]], key: str, text: str, schema: str) -> DataFrame:
    """(key, schema) rows that a pure function makes of each document."""
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [(k, *row) for k, t in zip(frame[key], frame[text], strict=True) for row in (f(t) if t is not None else ())]
            yield pd.DataFrame(out, columns=[key, *names], dtype=object)

    return docs.select(key, text).mapInPandas(run, f"{key} {docs.schema[key].dataType.simpleString()}, {schema}")
