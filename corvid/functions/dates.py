"""Dates: a selection grammar compiled to Columns, text dates, period classes, two-digit years.

Grammar: a comma list of terms.  ``2024``, ``2024Q1``, ``2024-03``,
``2024-03-31`` and ranges ``a..b`` (either end may be open) are absolute;
``@Q1``, ``@M12`` recur every year, or in ``[2011..2015]``.
"""

from __future__ import annotations

import calendar
import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True, order=True)
class Span:
    """Days from start to end, both included; None is open."""

    start: date | None
    end: date | None


@dataclass(frozen=True, order=True)
class Recurring:
    kind: str  # Q or M
    values: tuple[int, ...]
    start: int | None
    end: int | None


def _atom(text: str) -> Span:
    if m := re.fullmatch(r"(\d{4})(?:Q([1-4])|-(\d\d)(?:-(\d\d))?)?", text):
        year, quarter, month, day = (int(x) if x else None for x in m.groups())
        try:
            if day is not None:
                return Span(date(year, month, day), date(year, month, day))
            first, last = (3 * quarter - 2, 3 * quarter) if quarter else (month, month) if month is not None else (1, 12)
            return Span(date(year, first, 1), date(year, last, calendar.monthrange(year, last)[1]))
        except ValueError as e:
            raise ValueError(f"not a date: {text!r}") from e
    raise ValueError(f"not a date, month, quarter or year: {text!r}")


def _absolute(text: str) -> Span:
    low, dots, high = text.partition("..")
    if not dots:
        return _atom(text)
    if not low and not high:
        raise ValueError("a range needs an end")
    span = Span(_atom(low).start if low else None, _atom(high).end if high else None)
    if span.start and span.end and span.start > span.end:
        raise ValueError(f"the range runs backwards: {text!r}")
    return span


def _recurring(text: str) -> Recurring:
    m = re.fullmatch(r"@([QM])(\d{1,2})(?:\[(\d{4})?(\.\.)(\d{4})?\])?", text)
    if not m or not 1 <= int(m[2]) <= (4 if m[1] == "Q" else 12) or (m[4] and not (m[3] or m[5])):
        raise ValueError(f"not a recurring period: {text!r}")
    start, end = (int(x) if x else None for x in (m[3], m[5]))
    if start and end and start > end:
        raise ValueError(f"the years run backwards: {text!r}")
    return Recurring(m[1], (int(m[2]),), start, end)


def merge_spans(spans: Sequence[Span]) -> list[Span]:
    """The least list of disjoint spans that covers the same days; touching spans join, open ends win."""
    out: list[Span] = []
    for s in sorted(spans, key=lambda s: (s.start or date.min, s.end or date.max)):
        if out and (out[-1].end is None or s.start is None or s.start <= out[-1].end + timedelta(1)):
            last = out[-1]
            out[-1] = Span(last.start, None if last.end is None or s.end is None else max(last.end, s.end))
        else:
            out.append(s)
    return out


def _merge_recurring(clauses: Sequence[Recurring]) -> list[Recurring]:
    """One clause for each run of years in which the same periods recur."""
    out = []
    for kind in sorted({c.kind for c in clauses}):
        mine = [c for c in clauses if c.kind == kind]
        edges = sorted({y for c in mine for y in ((c.start,) if c.start is not None else ()) + ((c.end + 1,) if c.end is not None else ())})
        bounds = [None, *edges, None]
        runs: list[Recurring] = []
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            start, end = low, None if high is None else high - 1
            covers = lambda c: (c.start is None or (start is not None and c.start <= start)) and (c.end is None or (end is not None and end <= c.end))  # noqa: B023, E731
            values = tuple(sorted({v for c in mine if covers(c) for v in c.values}))
            if not values:
                continue
            if runs and runs[-1].values == values and runs[-1].end is not None and start == runs[-1].end + 1:
                runs[-1] = Recurring(kind, values, runs[-1].start, end)
            else:
                runs.append(Recurring(kind, values, start, end))
        out += runs
    return out


def parse_dates(text: str) -> tuple[Span | Recurring, ...]:
    """The canonical selection: equal selections are equal values; an empty text selects everything."""
    if not text.strip():
        return ()
    spans, recurring = [], []
    for term in (t.strip() for t in text.split(",")):
        if not term:
            raise ValueError(f"an empty term in {text!r}")
        (recurring if term.startswith("@") else spans).append((_recurring if term.startswith("@") else _absolute)(term))
    merged = merge_spans(spans)
    if merged == [Span(None, None)]:
        return ()
    return (*merged, *_merge_recurring(recurring))


def date_predicate(column: Column, selection: Sequence[Span | Recurring]) -> Column:
    """A predicate on a text or date column; an empty selection keeps rows without a date, any other drops them."""
    if not selection:
        return F.lit(True)
    day = F.try_to_date(column.cast("string"), "yyyy-MM-dd") if hasattr(F, "try_to_date") else column.try_cast("date")

    def one(clause: Span | Recurring) -> Column:
        if isinstance(clause, Span):
            low = day >= F.lit(clause.start) if clause.start else F.lit(True)
            return low & (day <= F.lit(clause.end)) if clause.end else low
        period = (F.quarter if clause.kind == "Q" else F.month)(day).isin(*clause.values)
        if clause.start is not None:
            period = period & (F.year(day) >= clause.start)
        return period & (F.year(day) <= clause.end) if clause.end is not None else period

    return F.coalesce(reduce(or_, map(one, selection)) & day.isNotNull(), F.lit(False))


def era(column: Column, bands: Sequence[tuple[str, str | None, str | None]]) -> Column:
    """The first band (name, first day, last day) that holds an ISO date; unknown where there is none."""
    text = column.cast("string")
    out = F.when(text.isNull() | (F.length(text) < 4), "unknown")
    for name, low, high in bands:
        test = F.lit(True)
        if low:
            test = test & (text >= low)
        if high:
            test = test & (text <= high)
        out = out.when(test, name)
    return out.otherwise("unknown")


def period_class(start: Column, end: Column) -> Column:
    """A duration's class by its days; the limits are fixed values."""
    days = F.datediff(end, start)
    return (
        F.when(start.isNull() | end.isNull(), "INSTANT").when(days.between(75, 105), "QUARTER").when(days.between(160, 200), "YTD_2Q")
        .when(days.between(250, 295), "YTD_3Q").when(days.between(340, 380), "ANNUAL").when(days > 380, "CUMULATIVE").otherwise("DURATION")
    )


def full_year(two_digits: Column, pivot: int = 90) -> Column:
    return F.when(two_digits >= pivot, 1900 + two_digits).otherwise(2000 + two_digits)


def years_in(text: Column, low: int = 1900, high: int = 2100) -> Column:
    found = F.transform(F.regexp_extract_all(text, F.lit(r"\b((?:19|20)\d\d)\b"), 1), lambda x: x.cast("int"))
    return F.filter(found, lambda y: y.between(low, high))


#: Written forms of dates, tried in this order.
FORMATS = ("yyyy-MM-dd", "yyyyMMdd", "MM/dd/yyyy", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy")


def parse_date(text: Column) -> Column:
    """The first written form that fits, as a date; null if none does."""
    clean = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.coalesce(*[F.try_to_timestamp(clean, F.lit(f)).cast("date") for f in FORMATS])
