"""Scalar text functions as Columns: normalization, tokens, identifiers, names, numbers."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Curly quotes, dashes and spaces and what they fold to.
QUOTES = ("‘’‚‛“”„‟′″", "''''\"\"\"\"'\"")
SPACES = "[   -     　]"
#: Suffixes of a form code, longest kinds first, stripped in this order.
FORM_SUFFIXES = ("/A", "_A", "-A")
MISSING = ("", "-", "--", "n/a", "na", "none", "null", "nil")


def fold_quotes(text: Column) -> Column:
    return F.translate(text, *QUOTES)


def plain_spaces(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, SPACES, " "), "[​﻿]", "")


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def collapse_blank_lines(text: Column, most: int = 1) -> Column:
    return F.regexp_replace(text, r"\n{%d,}" % (most + 2), "\n" * (most + 1))


def normalize(text: Column) -> Column:
    return collapse_spaces(plain_spaces(fold_quotes(text)))


def terms(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits, two or more long."""
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), 1), lambda t: F.length(t) >= 2)


def query_terms(text: str) -> list[str]:
    return list(dict.fromkeys(t for t in re.findall("[a-z0-9]+", text.lower()) if len(t) >= 2))


def form_family(form: Column, suffixes: Sequence[str] = FORM_SUFFIXES) -> Column:
    """The base of a form code: suffixes stripped in order, then ``_`` and ``-`` trimmed; the code itself if nothing is left."""
    base = F.upper(F.trim(form))
    for s in suffixes:
        base = F.regexp_replace(base, re.escape(s) + "$", "")
    base = F.regexp_replace(base, "^[_-]+|[_-]+$", "")
    return F.when(base == "", form).otherwise(base)


def has_suffix(name: Column, suffixes: Sequence[str]) -> Column:
    """The name ends in ``.`` and one of these; no suffixes keep every row."""
    return F.lower(name).rlike(r"\.(?:" + "|".join(map(re.escape, suffixes)) + ")$") if suffixes else F.lit(True)


def padded_cik(number: Column) -> Column:
    return F.lpad(number.cast("string"), 10, "0")


def accession_digits(raw: Column) -> Column:
    """The 18 digits of an accession number, or null."""
    digits = F.regexp_replace(F.trim(raw), "-", "")
    return F.when(digits.rlike(r"^\d{18}$"), digits)


def accession_year(raw: Column) -> Column:
    yy = F.substring(accession_digits(raw), 11, 2).cast("int")
    return F.when(yy >= 90, 1900 + yy).otherwise(2000 + yy)


def archive_path(cik: Column, accession: Column, primary: Column) -> Column:
    """struct(path, reason): the primary document's path; the bundle's where there is no document name."""
    digits = accession_digits(accession)
    folder = F.concat(F.lit("data/"), cik.cast("bigint").cast("string"), F.lit("/"), digits)
    blank = F.coalesce(F.trim(primary), F.lit("")) == ""
    path = F.when(blank, F.concat(folder, F.lit("/"), accession, F.lit(".txt"))).otherwise(F.concat(folder, F.lit("/"), F.trim(primary)))
    return F.struct(F.when(digits.isNotNull(), path).alias("path"), F.when(digits.isNull(), "invalid_accession").when(blank, "no_primary_document").otherwise("primary").alias("reason"))


def split_camel(name: Column) -> Column:
    """The words of a CamelCase name; digits stand apart, runs of capitals stay together."""
    spaced = F.regexp_replace(F.regexp_replace(name, "([a-z0-9])([A-Z])", "$1 $2"), "([A-Z]+)([A-Z][a-z])", "$1 $2")
    return F.split(F.trim(F.regexp_replace(spaced, r"[^A-Za-z0-9]+", " ")), " +")


def numeric_cell(value: Column) -> Column:
    """A whole table cell that is a number: currency, thousands, parentheses, percent, or a placeholder dash."""
    return F.trim(value).rlike(r"^(?:[$€£]?\s*\(?\s*[$€£]?\s*-?(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?|\(?-?\.\d+)\s*%?\s*\)?$|^[-–—]+$")


def cell_value(value: Column) -> Column:
    """The number of such a cell; parentheses are negative, dashes are null."""
    digits = F.regexp_replace(value, r"[^0-9.]", "")
    number = digits.try_cast("double")
    return F.when(numeric_cell(value), F.when(value.rlike(r"\(|^\s*[$€£]?\s*-"), -number).otherwise(number))


def missing_to_null(value: Column) -> Column:
    return F.when(~F.lower(F.trim(value)).isin(*MISSING), value)


def chunk_id(payload: Column, ordinal: Column) -> Column:
    return F.substring(F.sha2(F.concat(payload, F.lit(":"), ordinal.cast("string")), 256), 1, 32)


def canonical_hash(*columns: str) -> Column:
    """sha256 of a row as JSON with sorted keys, nulls kept."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


#: The numerals' worths.
ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}


def roman_value(text: Column) -> Column:
    """The value of a canonical Roman numeral below 4,000; null for anything else."""
    low = F.lower(F.trim(text))
    worth = F.create_map(*[x for k, v in ROMAN.items() for x in (F.lit(k), F.lit(v))])
    digits = F.transform(F.filter(F.split(low, ""), lambda c: c != ""), lambda c: worth[c])
    total = F.aggregate(digits, F.struct(F.lit(0).alias("sum"), F.lit(0).alias("last")), lambda a, d: F.struct((a["sum"] + d - F.when(a["last"] < d, 2 * a["last"]).otherwise(0)).alias("sum"), d.alias("last")))["sum"]
    return F.when(low.rlike("^(?=.)m{0,3}(cm|cd|d?c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3})$"), total)


def alternation(words: Sequence[str]) -> str:
    """One regular expression for many words, common beginnings shared."""
    trie: dict = {}
    for word in words:
        node = trie
        for c in word:
            node = node.setdefault(c, {})
        node[""] = {}

    def write(node: dict) -> str:
        parts = [re.escape(c) + write(sub) for c, sub in sorted(node.items()) if c]
        if not parts:
            return ""
        body = parts[0] if len(parts) == 1 and "" not in node else f"(?:{'|'.join(parts)})"
        return body + "?" if "" in node else body

    return write(trie)


def strip_jurisdiction(name: Column) -> Column:
    """A name without a jurisdiction after it: ``/DE/``, ``/NY``, ``(Delaware)`` or ``\\DE\\`` at the end."""
    return F.trim(F.regexp_replace(F.trim(name), r"(?:\s*[/\\][A-Z]{2}[/\\]?|\s*\([A-Z][A-Za-z ]{2,30}\))$", ""))
