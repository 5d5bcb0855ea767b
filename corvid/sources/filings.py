"""Parsers of filing files, as pure functions over bytes and as row transforms over (path, content).

Every parser returns rows or a row with an error; none raises for bad input.
"""

from __future__ import annotations

import json
import re
import tarfile
import io
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Row = dict[str, object]


def by_file(files: DataFrame, parse: Callable[[bytes], list[Row]], schema: str, content: str = "content", key: str = "path") -> DataFrame:
    """(key, schema, error) rows of every file; a file that can't be parsed gives one row with its error."""
    names = [c.strip().split(" ")[0] for c in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at, data in zip(frame[key], frame[content], strict=True):
                try:
                    rows = [[at, *[r.get(n) for n in names], None] for r in parse(bytes(data) if data is not None else b"")]
                except (ET.ParseError, ValueError, zipfile.BadZipFile, tarfile.TarError) as e:
                    rows = [[at, *[None] * len(names), f"{type(e).__name__}: {e}"]]
                yield pd.DataFrame(rows, columns=[key, *names, "error"], dtype=object)

    return files.select(key, content).mapInPandas(run, f"{key} string, {schema}, error string")


def _text(data: bytes) -> str:
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        return data.decode("latin-1")


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


# Index files

INDEX = "form string, company string, cik string, filed string, filename string, line int, malformed string"


def parse_index(data: bytes, flavour: str = "master") -> list[Row]:
    """Rows after the dashed rule of a quarterly index: ``master`` and ``xbrl`` are pipe-delimited, ``form``, ``company`` and ``crawler`` fixed-width
    under the header line before the rule."""
    out: list[Row] = []
    lines = _text(data).splitlines()
    rule = next((k for k, x in enumerate(lines) if len(x.strip()) >= 20 and set(x.strip()) == {"-"}), None)
    if rule is None:
        return out
    head = lines[rule - 1] if rule else ""
    names = ["Form Type", "Company Name", "CIK", "Date Filed", "File Name" if "File Name" in head else "Filename" if "Filename" in head else "URL"]
    places = sorted((head.index(n), n) for n in names if n in head)
    for k, line in enumerate(lines[rule + 1 :], rule + 2):
        if not line.strip():
            continue
        if flavour in ("master", "xbrl"):
            fields = [x.strip() for x in line.split("|")]
            bad = f"{len(fields)} fields" if len(fields) != 5 else None
            cik, company, form, filed, filename = fields if not bad else [None] * 5
        else:
            cut = {n: line[a : (places[i + 1][0] if i + 1 < len(places) else None)].strip() for i, (a, n) in enumerate(places)}
            form, company, cik, filed, filename = (cut.get(n) for n in names)
            bad = None if len(places) == 5 and filename else "columns"
        if not bad and not (cik or "").isdigit():
            bad = "key is not numeric"
        if not bad and not re.fullmatch(r"\d{4}-?\d\d-?\d\d", filed or ""):
            bad = "date"
        if bad:
            out.append({"line": k, "malformed": f"{bad}: {line}"})
        else:
            out.append({"form": form, "company": company, "cik": cik.zfill(10), "filed": f"{filed[:4]}-{filed[-5:-3] if '-' in filed else filed[4:6]}-{filed[-2:]}", "filename": filename, "line": k})
    return out


def index_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The same rows of a pipe-delimited index, without Python: a row has five fields, a numeric key and a date."""
    f = F.transform(F.split(column, r"\|"), F.trim)
    return lines.select(f.alias("f")).where((F.size("f") == 5) & F.element_at("f", 1).rlike(r"^\d+$") & F.element_at("f", 4).rlike(r"^\d{4}-\d\d-\d\d$")).select(
        F.col("f")[2].alias("form"), F.col("f")[1].alias("company"), F.lpad(F.col("f")[0], 10, "0").alias("cik"), F.col("f")[3].alias("filed"), F.col("f")[4].alias("filename"),
    )


# Index pages

ENTRY = "table_kind string, row_ordinal int, sequence int, description string, filename string, href string, document_type string, byte_size long"


class _Tables(HTMLParser):
    def __init__(self):
        super().__init__()
        self.tables: list[tuple[str, list[list[tuple[str, str | None]]]]] = []
        self.cell: list[str] | None = None
        self.href: str | None = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "table":
            self.tables.append((a.get("summary") or "", []))
        elif self.tables and tag == "tr":
            self.tables[-1][1].append([])
        elif tag in ("td", "th") and self.tables and self.tables[-1][1]:
            self.cell, self.href = [], None
        elif tag == "a" and self.cell is not None:
            self.href = a.get("href")

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None:
            self.tables[-1][1][-1].append((" ".join("".join(self.cell).split()), self.href))
            self.cell = None


def html_tables(data: bytes) -> list[tuple[str, list[list[tuple[str, str | None]]]]]:
    """(summary, rows of (text, link)) of every table of a page."""
    parser = _Tables()
    parser.feed(_text(data))
    return parser.tables


def parse_html_index(data: bytes) -> list[Row]:
    """Document and data files of a filing's index page; a page without such a table is an error."""
    out: list[Row] = []
    for summary, rows in html_tables(data):
        if not rows or not rows[0] or rows[0][0][0].lower() != "seq":
            continue
        kind = "data" if "data" in summary.lower() else "document"
        for k, row in enumerate(rows[1:], 1):
            if len(row) < 5:
                continue
            seq, said, name, doc_type, size = row[:5]
            out.append({"table_kind": kind, "row_ordinal": k, "sequence": int(seq[0]) if seq[0].isdigit() else None, "description": said[0] or None, "filename": name[0].split(" ")[0] or None, "href": name[1], "document_type": doc_type[0] or None, "byte_size": int(size[0]) if size[0].isdigit() else None})
    if not out:
        raise ValueError("no file table")
    return out


def parse_json_index(data: bytes) -> list[Row]:
    """Files of a directory's index.json."""
    try:
        items = json.loads(data)["directory"]["item"]
    except (KeyError, TypeError) as e:
        raise ValueError(f"not a directory index: {e}") from e
    return [{"table_kind": "document", "row_ordinal": k, "filename": i.get("name"), "href": i.get("href") or i.get("name"), "document_type": i.get("type"), "byte_size": int(i["size"]) if str(i.get("size", "")).isdigit() else None} for k, i in enumerate(items, 1)]


SERIES = "cik string, series_id string, series_name string, class_id string, class_name string, ticker string"


def parse_series_page(data: bytes) -> list[Row]:
    """Series and their classes of a browse page, each class with its series."""
    out: list[Row] = []
    cik = series = name = None
    for _, rows in html_tables(data):
        for row in rows:
            for k, (said, _) in enumerate(row):
                rest = next((t for t, _ in row[k + 1 :] if t), None)
                if re.fullmatch(r"\d{10}", said):
                    cik = said
                elif re.fullmatch(r"S\d{9}", said):
                    series, name = said, rest
                    out.append({"cik": cik, "series_id": series, "series_name": name})
                elif re.fullmatch(r"C\d{9}", said):
                    ticker = row[-1][0] if len(row) > k + 2 else None
                    out.append({"cik": cik, "series_id": series, "series_name": name, "class_id": said, "class_name": rest, "ticker": ticker or None})
    return out


# Feeds

EVENT = "accession string, form string, company string, cik string, filed string, accepted string, link string"


def parse_atom(data: bytes) -> list[Row]:
    """Entries of a current-filings feed; an entry without an accession number is left out by the caller's rules (accession null)."""
    out: list[Row] = []
    for e in (x for x in ET.fromstring(data).iter() if _local(x.tag) == "entry"):
        part = {_local(c.tag): c for c in e}
        said = lambda n: (part[n].text or "").strip() if n in part else ""  # noqa: B023, E731
        title = re.match(r"(?P<form>.+?) - (?P<company>.+?) \((?P<cik>\d{10})\)", said("title"))
        acc = re.search(r"\d{10}-\d\d-\d{6}", said("id") + " " + said("summary"))
        filed = re.search(r"Filed:\D*(\d{4}-\d\d-\d\d)", re.sub("<[^>]+>", " ", said("summary")))
        out.append({"accession": acc[0] if acc else None, "form": (part["category"].get("term") if "category" in part else None) or (title["form"] if title else None), "company": title["company"] if title else None, "cik": title["cik"] if title else None, "filed": filed[1] if filed else None, "accepted": said("updated") or None, "link": part["link"].get("href") if "link" in part else None})
    return out


def parse_rss(data: bytes) -> list[Row]:
    """Items of a structured-disclosure RSS feed."""
    out: list[Row] = []
    for item in ET.fromstring(data).iter("item"):
        said = {_local(x.tag): (x.text or "").strip() for x in item.iter()}
        month = re.fullmatch(r"(\d\d)/(\d\d)/(\d{4})", said.get("filingDate", ""))
        out.append({"accession": said.get("accessionNumber"), "form": said.get("formType"), "company": said.get("companyName"), "cik": (said.get("cikNumber") or "").zfill(10) or None, "filed": f"{month[3]}-{month[1]}-{month[2]}" if month else None, "accepted": said.get("acceptanceDatetime"), "link": said.get("link")})
    return out


# Bundles

DOCUMENT = "sequence int, document_type string, filename string, description string, body string"


def strip_envelope(data: bytes) -> bytes:
    """A privacy-enhanced mail wrapper taken off, if there is one."""
    begin, end = b"-----BEGIN PRIVACY-ENHANCED MESSAGE-----", b"-----END PRIVACY-ENHANCED MESSAGE-----"
    a, b = data.find(begin), data.rfind(end)
    if a < 0 or b < a:
        return data
    inner = data[a + len(begin) : b]
    head = re.search(rb"\r?\n\r?\n", inner)
    return inner[head.end() if head else 0 :].lstrip(b"\r\n") + data[b + len(end) :]


def parse_bundle(data: bytes) -> list[Row]:
    """The documents of an SGML submission; a document that isn't closed ends at the next or at the end."""
    text = _text(strip_envelope(data))
    starts = [m.end() for m in re.finditer(r"(?i)<DOCUMENT>", text)]
    out: list[Row] = []
    for k, a in enumerate(starts):
        part = text[a : starts[k + 1] - len("<DOCUMENT>") if k + 1 < len(starts) else len(text)]
        part = re.split(r"(?i)</DOCUMENT>", part)[0]
        head, _, body = part.partition("<TEXT>") if "<TEXT>" in part else (part, "", "")
        tag = lambda n: (m[1].strip() or None) if (m := re.search(rf"(?im)^[ \t]*<{n}>([^\r\n<]*)", head)) else None  # noqa: B023, E731
        seq = tag("SEQUENCE")
        out.append({"sequence": int(seq) if seq and seq.isdigit() else None, "document_type": tag("TYPE"), "filename": tag("FILENAME"), "description": tag("DESCRIPTION"), "body": re.split(r"(?i)</TEXT>", body)[0].strip("\r\n")})
    return out


TAR = "member string, size long, accession string, form string, filed string, documents int"


def parse_tarball(data: bytes) -> list[Row]:
    """One row a bundle of a daily archive, from its header lines; payloads aren't kept."""
    out: list[Row] = []
    with tarfile.open(fileobj=io.BytesIO(data), mode="r:*") as tar:
        for m in tar:
            if not m.isfile():
                continue
            text = _text(tar.extractfile(m).read())
            tag = lambda *n: next((x[1].strip() for name in n if (x := re.search(rf"(?m)^(?:<{name}>|{name}:)[ \t]*([^\r\n]+)", text))), None)  # noqa: B023, E731
            out.append({"member": m.name, "size": m.size, "accession": tag("ACCESSION-NUMBER", "ACCESSION NUMBER"), "form": tag("TYPE", "CONFORMED SUBMISSION TYPE"), "filed": tag("FILING-DATE", "FILED AS OF DATE"), "documents": len(re.findall("<DOCUMENT>", text))})
    return out


def parse_package(data: bytes) -> list[Row]:
    """Files of a ZIP package as inventory rows."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return [{"table_kind": "package", "row_ordinal": k, "filename": i.filename, "href": i.filename, "byte_size": i.file_size} for k, i in enumerate((x for x in z.infolist() if not x.is_dir()), 1)]


def parse_filing_summary(data: bytes) -> list[Row]:
    """Input files, supplements and reports of a filing summary."""
    out: list[Row] = []
    root = ET.fromstring(data)
    for kind in ("InputFiles", "SupplementalFiles"):
        for node in root.iter(kind):
            out += [{"table_kind": kind, "row_ordinal": k, "filename": (x.text or "").strip(), "href": (x.text or "").strip()} for k, x in enumerate(node, 1)]
    for k, r in enumerate((x for x in root.iter("Report")), 1):
        said = {_local(c.tag): (c.text or "").strip() for c in r}
        name = said.get("HtmlFileName") or said.get("XmlFileName")
        if name:
            out.append({"table_kind": "Report", "row_ordinal": k, "description": said.get("ShortName"), "filename": name, "href": name, "document_type": said.get("ReportType")})
    return out


# XBRL

FACT = "concept string, numeric_value double, text_value string, unit string, decimals int, period_type string, start_date string, end_date string, instant_date string, dimensions string, context_id string"


def parse_instance(data: bytes) -> list[Row]:
    """Facts of an instance with their contexts and units; dimensions as JSON with sorted keys."""
    root = ET.fromstring(data)
    prefixes = {}
    for _, (p, uri) in ET.iterparse(io.BytesIO(data), events=["start-ns"]):
        prefixes.setdefault(uri, p)
    contexts: dict[str, Row] = {}
    units: dict[str, str] = {}
    for e in root:
        if _local(e.tag) == "context":
            c: Row = {"dims": {}}
            for x in e.iter():
                name, said = _local(x.tag), (x.text or "").strip()
                if name in ("startDate", "endDate", "instant"):
                    c[name] = said
                elif name in ("explicitMember", "typedMember") and x.get("dimension"):
                    c["dims"][x.get("dimension")] = said if name == "explicitMember" else "".join(x.itertext()).strip()
            contexts[e.get("id", "")] = c
        elif _local(e.tag) == "unit":
            measures = [(x.text or "").strip().rpartition(":")[2] for x in e.iter() if _local(x.tag) == "measure"]
            units[e.get("id", "")] = "/".join(measures)
    out: list[Row] = []
    for e in root:
        ref = e.get("contextRef")
        if ref is None:
            continue
        c = contexts.get(ref, {"dims": {}})
        uri, _, name = e.tag[1:].rpartition("}")
        said = "".join(e.itertext()).strip()
        number = None
        if e.get("unitRef") is not None:
            try:
                number = float(said)
            except ValueError:
                number = None
        dec = e.get("decimals")
        out.append({
            "concept": f"{prefixes.get(uri, '')}:{name}".lstrip(":"), "numeric_value": number, "text_value": said if number is None and said else None, "unit": units.get(e.get("unitRef", "")),
            "decimals": int(dec) if dec and re.fullmatch(r"-?\d+", dec) else None, "period_type": "instant" if "instant" in c else "duration", "start_date": c.get("startDate"),
            "end_date": c.get("endDate"), "instant_date": c.get("instant"), "dimensions": json.dumps(c["dims"], sort_keys=True), "context_id": ref,
        })
    return out


ARC = "kind string, source string, target string, weight double, arc_order double, arcrole string, role string, label string"


def parse_linkbase(data: bytes) -> list[Row]:
    """Calculation, presentation, definition and label arcs, locators resolved to concepts; prohibited arcs left out."""
    xl = "{http://www.w3.org/1999/xlink}"
    out: list[Row] = []
    for link in ET.fromstring(data).iter():
        kind = {"calculationLink": "calculation", "presentationLink": "presentation", "definitionLink": "definition", "labelLink": "label"}.get(_local(link.tag))
        if not kind:
            continue
        at = {x.get(xl + "label"): (x.get(xl + "href") or "").rpartition("#")[2].replace("_", ":", 1) for x in link if _local(x.tag) == "loc"}
        said = {}
        for x in link:
            if _local(x.tag) == "label":
                said.setdefault(x.get(xl + "label"), []).append((x.get(xl + "role"), (x.text or "").strip()))
        for x in link:
            if not _local(x.tag).endswith("Arc") or x.get("use") == "prohibited":
                continue
            a, b = x.get(xl + "from"), x.get(xl + "to")
            base = {"kind": kind, "source": at.get(a), "weight": float(x.get("weight")) if x.get("weight") else None, "arc_order": float(x.get("order")) if x.get("order") else None, "arcrole": x.get(xl + "arcrole"), "role": link.get(xl + "role")}
            if kind == "label":
                out += [base | {"role": role, "label": text} for role, text in said.get(b, [])]
            elif at.get(a) and at.get(b):
                out.append(base | {"target": at[b]})
    return out


DECLARATION = "concept string, name string, period_type string, balance string, substitution_group string, item_type string, abstract boolean"


def parse_schema(data: bytes, prefix: str | None = None) -> list[Row]:
    """Concepts declared by a taxonomy schema."""
    root = ET.fromstring(data)
    if prefix is None:
        prefix = next((p for _, (p, uri) in ET.iterparse(io.BytesIO(data), events=["start-ns"]) if uri == root.get("targetNamespace") and p), "")
    xb = "{http://www.xbrl.org/2003/instance}"
    return [
        {"concept": f"{prefix}:{e.get('name')}", "name": e.get("name"), "period_type": e.get(xb + "periodType"), "balance": e.get(xb + "balance"), "substitution_group": e.get("substitutionGroup"), "item_type": e.get("type"), "abstract": e.get("abstract") == "true"}
        for e in root if _local(e.tag) == "element" and e.get("name")
    ]


#: Parser and row schema by name: the registry that ``by_file`` callers look up.
PARSERS: dict[str, tuple[Callable[[bytes], list[Row]], str]] = {
    "index": (parse_index, INDEX), "html_index": (parse_html_index, ENTRY), "json_index": (parse_json_index, ENTRY), "series": (parse_series_page, SERIES), "atom": (parse_atom, EVENT), "rss": (parse_rss, EVENT),
    "bundle": (parse_bundle, DOCUMENT), "tarball": (parse_tarball, TAR), "package": (parse_package, ENTRY), "filing_summary": (parse_filing_summary, ENTRY),
    "instance": (parse_instance, FACT), "linkbase": (parse_linkbase, ARC), "schema": (parse_schema, DECLARATION),
}


def parse_files(files: DataFrame, kind: str) -> DataFrame:
    """Rows of every file by the named parser."""
    parse, schema = PARSERS[kind]
    return by_file(files, parse, schema)
