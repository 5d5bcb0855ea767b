"""Nested relations: parallel arrays to rows, maps of maps to rows, star joins, panels of JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.functions.text import accession_digits, archive_path


def zipped(columns: Sequence[str], struct: str) -> Column:
    """Parallel arrays of a struct column as one array of structs, the shorter ones padded with null."""
    return F.arrays_zip(*[F.col(f"{struct}.{c}").alias(c) for c in columns])


def ragged(columns: Sequence[str], struct: str) -> Column:
    """The names of arrays shorter than the longest: what a padded zip hides."""
    sizes = [F.coalesce(F.size(f"{struct}.{c}"), F.lit(0)) for c in columns]
    most = F.greatest(*sizes) if len(sizes) > 1 else sizes[0]
    return F.filter(F.array(*[F.when(n < most, F.lit(c)) for c, n in zip(columns, sizes, strict=True)]), lambda x: x.isNotNull())


SUBMISSION = "struct<cik:string,name:string,formerNames:array<struct<name:string,`from`:string,`to`:string>>,filings:struct<recent:struct<accessionNumber:array<string>,filingDate:array<string>,reportDate:array<string>,form:array<string>,size:array<bigint>,primaryDocument:array<string>,isXBRL:array<int>>>>"
RECENT = ("accessionNumber", "filingDate", "reportDate", "form", "size", "primaryDocument", "isXBRL")


def submissions(raw: DataFrame, column: str = "json") -> DataFrame:
    """One nested row a registrant: (cik, name, former_names, filings, anomalies) from its JSON."""
    parsed = raw.select(F.from_json(column, SUBMISSION).alias("s"))
    return parsed.select(
        F.lpad("s.cik", 10, "0").alias("cik"), F.col("s.name").alias("name"), F.col("s.formerNames").alias("former_names"),
        zipped(RECENT, "s.filings.recent").alias("filings"), F.transform(ragged(RECENT, "s.filings.recent"), lambda c: F.concat(F.lit("ragged:"), c)).alias("anomalies"),
    )


def occurrences(registrants: DataFrame) -> DataFrame:
    """One row a filing of (cik, filings): identifiers, paths and a digest key; of equal keys one row."""
    rows = registrants.select("cik", F.inline("filings"))
    path = archive_path(F.col("cik"), F.col("accessionNumber"), F.col("primaryDocument"))
    told = rows.withColumns({"accession": F.col("accessionNumber"), "accession_normalized": accession_digits(F.col("accessionNumber")), "_p": path})
    out = told.select("cik", "accession", "accession_normalized", "form", F.col("filingDate").alias("filing_date"), F.col("reportDate").alias("report_date"), "size", F.col("_p.path").alias("document_path"), F.col("_p.reason").alias("document_path_source"))
    return out.withColumn("occurrence_id", F.sha2(F.concat_ws("|", "cik", "accession", F.coalesce("document_path", F.lit(""))), 256)).dropDuplicates(["occurrence_id"])


def company_facts(raw: DataFrame, column: str = "json") -> DataFrame:
    """One row a fact: taxonomy, tag, unit and period out of nested maps."""
    shape = "struct<cik:bigint,facts:map<string,map<string,struct<label:string,units:map<string,array<struct<start:string,`end`:string,val:double,accn:string,fy:bigint,fp:string,form:string,filed:string,frame:string>>>>>>>"
    a = raw.select(F.from_json(column, shape).alias("f")).select("f.cik", F.explode("f.facts").alias("taxonomy", "tags"))
    b = a.select("cik", "taxonomy", F.explode("tags").alias("tag", "body"))
    c = b.select("cik", "taxonomy", "tag", F.explode("body.units").alias("unit", "rows"))
    return c.select("cik", "taxonomy", "tag", "unit", F.inline("rows")).withColumnsRenamed({"val": "value", "accn": "accession", "fy": "fiscal_year", "fp": "fiscal_period"})


def attachment_role(table_kind: Column, document_type: Column, form: Column) -> Column:
    kind, form_ = F.upper(F.trim(document_type)), F.upper(F.trim(form))
    return (
        F.when(table_kind == "data", "data_file").when(kind == "GRAPHIC", "graphic").when(kind == form_, "primary").when(F.startswith(kind, F.lit("EX-")), "exhibit")
    )


def linkbase_kind(document_type: Column, filename: Column, description: Column) -> Column:
    """instance, schema, calculation, definition, label, presentation or reference, by type, then name ending, then description."""
    kind, name, said = F.upper(document_type), F.lower(filename), F.lower(F.coalesce(description, F.lit("")))
    out = F.when(F.lit(False), "")
    for label, code, ending, word in (("schema", "SCH", ".xsd", "schema"), ("calculation", "CAL", "_cal.xml", "calculation"), ("definition", "DEF", "_def.xml", "definition"), ("label", "LAB", "_lab.xml", "label"), ("presentation", "PRE", "_pre.xml", "presentation"), ("reference", "REF", "_ref.xml", "reference"), ("instance", "INS", "_htm.xml", "instance")):
        out = out.when(F.endswith(kind, F.lit("." + code)) | F.endswith(name, F.lit(ending)) | F.contains(said, F.lit(word + " linkbase")), label)
    return out


def is_exhibit(document_type: Column, filename: Column) -> Column:
    return F.startswith(F.upper(document_type), F.lit("EX-")) | F.lower(filename).rlike(r"^(?:.*[-_.])?ex[-_]?\d+[a-z0-9_.-]*\.(?:htm|html|txt|pdf)$")


def gathered(rows: DataFrame, key: str, columns: list[str], name: str) -> DataFrame:
    """(key, name): one array of structs a key."""
    return rows.groupBy(key).agg(F.collect_list(F.struct(*columns)).alias(name))


def unnested(nested: DataFrame, key: str, name: str) -> DataFrame:
    """(key, ...): a row for each element of an array of structs; empty and null arrays have none."""
    return nested.select(key, F.inline(name))


def entries(rows: DataFrame, key: str, name: str) -> DataFrame:
    """(key, key of the map, value): a row for each entry of a map column."""
    return rows.select(F.col(key), F.explode(name).alias("key", "value"))


def json_value(column: str, path: str, kind: str) -> Column:
    """A field of a JSON text as this type; null where it is missing or doesn't fit."""
    return F.get_json_object(column, path).try_cast(kind)
