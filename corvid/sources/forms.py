"""Structured forms: one declarative reader for every family.

A family names its XML row elements and the code pattern of its forms; a
filing becomes a header row and a row for each such element, its leaves as a
map from path to text.  Text filings give labelled cover fields, items and
table regions.  Adding a family is adding a line to FAMILIES.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

from corvid.functions.documents import representation, sections, html_to_text, strip_pages, table_runs


@dataclass(frozen=True)
class Family:
    """``forms``: a pattern of form codes; ``rows``: XML elements that repeat; ``labels``: cover labels of text filings."""

    forms: str
    rows: tuple[str, ...] = ()
    labels: tuple[str, ...] = ()


COVER = ("Commission File Number", "IRS Employer Identification No.", "State of Incorporation", "For the fiscal year ended", "For the quarterly period ended", "Date of Report", "CUSIP No.", "Name of Issuer", "Title of Class of Securities")

#: The schemas' row elements by family.
FAMILIES: dict[str, Family] = {
    "ownership": Family(r"[345](/A)?", ("reportingOwner", "nonDerivativeTransaction", "nonDerivativeHolding", "derivativeTransaction", "derivativeHolding", "footnote", "ownerSignature")),
    "holdings": Family(r"13F-(HR|NT)(/A)?", ("infoTable", "otherManager", "otherManager2"), ("Form 13F File Number", "Report for the Calendar Year or Quarter Ended")),
    "beneficial": Family(r"SC(HEDULE)? 13[DG](/A)?", ("reportingPersonInfo", "coverPageHeaderReportingPersonDetails"), ("CUSIP No.", "Name of Issuer", "Title of Class of Securities")),
    "proposed_sale": Family(r"144(/A)?", ("securitiesInformation", "securitiesToBeSold", "securitiesSoldInPast3Months")),
    "exempt_offering": Family(r"D(/A)?", ("primaryIssuer", "relatedPersonInfo", "salesCompensationList", "recipient")),
    "crowdfunding": Family(r"C(-[A-Z]+)?(/A)?", ("signaturePerson", "coIssuer")),
    "small_offering": Family(r"1-[AKUZ](/A)?|1-A POS", ("securitiesIssued", "juridictionSecuritiesOffered")),
    "removal": Family(r"25(-NSE)?(/A)?", ("issuer", "exchange")),
    "portfolio": Family(r"N-?PORT.*", ("invstOrSec", "debtSec", "monthlyReturn")),
    "money_market": Family(r"N-?MFP\d?.*", ("scheduleOfPortfolioSecuritiesInfo", "classLevelInfo")),
    "fund_census": Family(r"N-CEN(/A)?", ("managementInvestmentQuestion", "director", "investmentAdviser", "custodian")),
    "proxy_votes": Family(r"N-PX(/A)?", ("proxyTable", "vote", "voteRecord")),
    "loan_assets": Family(r"ABS-EE(/A)?", ("assets",)),
    "annual": Family(r"(10-K|10-KT|20-F|40-F|11-K|10-K405|10-KSB).*", labels=COVER),
    "quarter": Family(r"10-Q.*", labels=COVER),
    "current": Family(r"(8-K|6-K).*", labels=COVER),
    "proxy": Family(r"(PRE|DEF|DEFA|DEFM|PREM)[A-Z]?14[AC].*", labels=COVER),
    "registration": Family(r"(S-\d+|F-\d+|N-\dA|N-2|10-12[BG]|8-A12[BG]).*", labels=COVER),
    "prospectus": Family(r"(424B\d?|425|497.*|FWP)", labels=COVER),
    "tender": Family(r"SC TO-[ICT].*|SC 14D9.*", labels=COVER),
    "notice": Family(r"(NT .*|15-.*|15F.*|SD|DRS.*|CORRESP|UPLOAD)", labels=COVER),
    "asset_pool": Family(r"(10-D|10-DS?K?|ABS-15G|ABS DD-15E)(/A)?", ("assets", "repurchaseRequest"), COVER),
    "foreign_notice": Family(r"F-N(/A)?", labels=COVER),
    "supplement": Family(r"(SUPPL|497K?|497AD|485[AB]POS|485BXT)(/A)?", labels=COVER),
    "fund_report": Family(r"(N-CSRS?|N-Q|NSAR-.*|N-30D).*", labels=COVER),
}


def register_family(name: str, family: Family) -> None:
    """Add a family, or put one in another's place; it is tried before those that are there."""
    rest = {k: v for k, v in FAMILIES.items() if k != name}
    FAMILIES.clear()
    FAMILIES.update({name: family, **rest})


def family_of(form: str) -> str:
    code = re.sub(r"[\s]+", " ", (form or "").strip().upper())
    return next((name for name, f in FAMILIES.items() if re.fullmatch(f.forms, code)), "other")


def _leaves(e: ET.Element, path: str, skip: frozenset[str]) -> Iterator[tuple[str, str]]:
    for child in e:
        name = child.tag.rpartition("}")[2]
        if name in skip:
            continue
        at = f"{path}/{name}" if path else name
        for key, value in child.attrib.items():
            yield f"{at}@{key.rpartition('}')[2]}", value
        if len(child):
            yield from _leaves(child, at, skip)
        elif (child.text or "").strip():
            yield at, child.text.strip()


def parse_xml_form(data: bytes, family: str) -> list[tuple[str, int, dict[str, str]]]:
    """(kind, ordinal, fields): ``header`` with what stands outside the rows, then each row element; a repeated path is numbered."""
    root = ET.fromstring(data)
    wanted = frozenset(FAMILIES[family].rows if family in FAMILIES else ())

    def fields(pairs: Iterator[tuple[str, str]]) -> dict[str, str]:
        out: dict[str, str] = {}
        for path, text in pairs:
            k, key = 2, path
            while key in out:
                key, k = f"{path}[{k}]", k + 1
            out[key] = text
        return out

    rows = [("header", 0, fields(_leaves(root, "", wanted)))]
    count: dict[str, int] = {}
    for e in root.iter():
        name = e.tag.rpartition("}")[2]
        if name in wanted:
            count[name] = count.get(name, 0) + 1
            own = fields(_leaves(e, "", frozenset()))
            if not len(e) and (e.text or "").strip():
                own["text"] = e.text.strip()
            own |= {f"@{k.rpartition('}')[2]}": v for k, v in e.attrib.items()}
            rows.append((name, count[name], own))
    return rows


def parse_text_form(text: str, family: str) -> list[tuple[str, int, dict[str, str]]]:
    """``header`` with the cover's labelled values, then ``item`` and ``table`` rows with their lines."""
    labels = FAMILIES[family].labels if family in FAMILIES else ()
    found = sections(text)
    cover = "\n".join(text.split("\n")[: found[0][2] - 1]) if found else text  # all of it before the first item
    header = {}
    for label in labels:
        pattern = r"\s+".join(map(re.escape, label.split()))
        if m := re.search(rf"(?i){pattern}\s*[:.]?[ \t]*([^\n:]*\S)", cover):
            header[label] = " ".join(m[1].split()).strip(" :._")
    out = [("header", 0, header)]
    out += [("item", k, {"item": i, "heading": h, "start_line": str(a), "end_line": str(b)}) for k, (i, h, a, b) in enumerate(found, 1)]
    out += [("table", k, {"start_line": str(a + 1), "end_line": str(b), "rows": str(n)}) for k, (a, b, n) in enumerate(table_runs(text), 1)]
    return out


def parse_form(data: bytes, form: str) -> tuple[str, list[tuple[str, int, dict[str, str]]]]:
    """(family, rows) of a filing's document by its form code and its own kind."""
    family = family_of(form)
    kind, text = representation(data)
    if kind == "xml":
        return family, parse_xml_form(data, family)
    return family, parse_text_form(html_to_text(text) if kind == "html" else strip_pages(text), family)


ROWS = "family string, kind string, ordinal int, fields map<string,string>, error string"


def form_rows(docs: DataFrame, key: str, form: str, content: str) -> DataFrame:
    """(key, family, kind, ordinal, fields, error): every document read by its family; one that can't be is one row with its error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for k, code, data in zip(frame[key], frame[form], frame[content], strict=True):
                try:
                    family, rows = parse_form(data.encode() if isinstance(data, str) else bytes(data or b""), code)
                    out += [(k, family, kind, n, fields, None) for kind, n, fields in rows]
                except ET.ParseError as e:
                    out.append((k, family_of(code), None, None, None, f"ParseError: {e}"))
            yield pd.DataFrame(out, columns=[key, "family", "kind", "ordinal", "fields", "error"], dtype=object)

    return docs.select(key, form, content).mapInPandas(run, f"{key} {docs.schema[key].dataType.simpleString()}, {ROWS}")


#: The schemas' fields that are rows' columns, by family and row element: (column, path of the field, type).
TYPED: dict[tuple[str, str], tuple[tuple[str, str, str], ...]] = {
    ("holdings", "infoTable"): (
        ("issuer", "nameOfIssuer", "string"), ("class_title", "titleOfClass", "string"), ("cusip", "cusip", "string"), ("value", "value", "decimal(24,2)"),
        ("shares", "shrsOrPrnAmt/sshPrnamt", "decimal(24,4)"), ("share_kind", "shrsOrPrnAmt/sshPrnamtType", "string"), ("put_call", "putCall", "string"),
        ("discretion", "investmentDiscretion", "string"), ("vote_sole", "votingAuthority/Sole", "bigint"), ("vote_shared", "votingAuthority/Shared", "bigint"), ("vote_none", "votingAuthority/None", "bigint"),
    ),
    ("ownership", "nonDerivativeTransaction"): (
        ("security", "securityTitle/value", "string"), ("transacted", "transactionDate/value", "date"), ("code", "transactionCoding/transactionCode", "string"),
        ("shares", "transactionAmounts/transactionShares/value", "decimal(24,4)"), ("price", "transactionAmounts/transactionPricePerShare/value", "decimal(24,6)"),
        ("acquired", "transactionAmounts/transactionAcquiredDisposedCode/value", "string"), ("held_after", "postTransactionAmounts/sharesOwnedFollowingTransaction/value", "decimal(24,4)"),
        ("direct", "ownershipNature/directOrIndirectOwnership/value", "string"),
    ),
    ("ownership", "derivativeTransaction"): (
        ("security", "securityTitle/value", "string"), ("exercise_price", "conversionOrExercisePrice/value", "decimal(24,6)"), ("transacted", "transactionDate/value", "date"),
        ("code", "transactionCoding/transactionCode", "string"), ("shares", "transactionAmounts/transactionShares/value", "decimal(24,4)"), ("expires", "expirationDate/value", "date"),
        ("underlying", "underlyingSecurity/underlyingSecurityTitle/value", "string"), ("underlying_shares", "underlyingSecurity/underlyingSecurityShares/value", "decimal(24,4)"),
    ),
    ("portfolio", "invstOrSec"): (
        ("name", "name", "string"), ("lei", "lei", "string"), ("title", "title", "string"), ("cusip", "cusip", "string"), ("balance", "balance", "decimal(30,8)"), ("units", "units", "string"),
        ("currency", "curCd", "string"), ("value_usd", "valUSD", "decimal(30,8)"), ("percent", "pctVal", "double"), ("payoff", "payoffProfile", "string"), ("asset_kind", "assetCat", "string"), ("country", "invCountry", "string"),
    ),
    ("proposed_sale", "securitiesInformation"): (
        ("class_title", "securitiesClassTitle", "string"), ("broker", "brokerOrMarketmakerDetails/name", "string"), ("units", "noOfUnitsSold", "decimal(24,4)"), ("market_value", "aggregateMarketValue", "decimal(24,2)"),
        ("outstanding", "noOfUnitsOutstanding", "decimal(24,4)"), ("sale_date", "approxSaleDate", "string"), ("exchange", "securitiesExchangeName", "string"),
    ),
}


def typed_rows(rows: DataFrame, key: str, family: str, kind: str) -> DataFrame:
    """(key, ordinal, ...): rows of ``form_rows`` of one family and element, with their fields as typed columns; what doesn't fit is null."""
    from pyspark.sql import functions as F

    mine = rows.where((F.col("family") == family) & (F.col("kind") == kind))
    return mine.select(key, "ordinal", *[F.try_element_at("fields", F.lit(path)).try_cast(as_).alias(name) for name, path, as_ in TYPED[family, kind]])


def earnings(rows: DataFrame, key: str) -> DataFrame:
    """(key, start_line, end_line): current reports that announce results, by their item 2.02."""
    from pyspark.sql import functions as F

    item = F.try_element_at("fields", F.lit("item"))
    line = lambda name: F.try_element_at("fields", F.lit(name)).cast("int").alias(name)
    return rows.where((F.col("family") == "current") & (F.col("kind") == "item") & (item == "2.02")).select(key, line("start_line"), line("end_line"))


def family_counts(rows: DataFrame) -> DataFrame:
    """(family, kind, documents, rows, failed): the summary of a review run."""
    from pyspark.sql import functions as F

    return rows.groupBy("family", "kind").agg(F.count("*").alias("rows"), F.count_if(F.col("error").isNotNull()).alias("failed"))
