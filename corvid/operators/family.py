"""Entity families from names: stems, canonical spellings, sponsors by the longest known prefix."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from corvid.functions.text import strip_jurisdiction

#: Vocabularies of this engine; callers may give their own.
LEGAL = ("inc", "corp", "corporation", "co", "company", "llc", "ltd", "limited", "lp", "plc", "sa", "ag", "nv", "the")
VEHICLE = ("trust", "receivables", "funding", "securitization", "certificates", "mortgage", "pool")
BOUNDARY = ("trust", "series", "funding", "auto", "mortgage", "receivables", "pool", "certificates")
UMBRELLA = "a series of "
MIN_SQUASHED = 8


def tokens(name: Column) -> Column:
    return F.filter(F.split(F.trim(F.regexp_replace(F.lower(name), r"[^\w]+", " ")), " +"), lambda t: t != "")


def stem(name: Column, legal: Sequence[str] = LEGAL) -> Column:
    """The name's words without legal forms and numbers, joined by spaces."""
    plain = F.filter(tokens(name), lambda t: ~t.isin(*legal) & ~t.rlike(r"\d"))
    return F.array_join(plain, " ")


#: This engine's own short forms; callers may give theirs.
SHORT = {"intl": "international", "natl": "national", "assoc": "association", "mfg": "manufacturing", "svcs": "services", "hldgs": "holdings", "hldg": "holding", "bancorp": "bancorporation", "mtg": "mortgage", "fin": "financial", "grp": "group", "tr": "trust"}
ORDINALS = {"1st": "first", "2nd": "second", "3rd": "third", "4th": "fourth", "5th": "fifth", "6th": "sixth", "7th": "seventh", "8th": "eighth", "9th": "ninth", "10th": "tenth"}


def normalized_name(name: Column, legal: Sequence[str] = LEGAL, short: Mapping[str, str] = SHORT) -> Column:
    """A name to compare by: no jurisdiction after it, ordinals and short forms spelled out, ``u s`` joined, plurals of more than
    four letters without their s, legal forms dropped from the end only."""
    words = tokens(F.regexp_replace(strip_jurisdiction(name), r"(?i)\bu\.?\s?s\.?(?=\W|$)", "us"))
    told = F.create_map(*[F.lit(x) for kv in {**ORDINALS, **short}.items() for x in kv])
    full = F.transform(words, lambda w: F.coalesce(told[w], w))
    one = F.transform(full, lambda w: F.when((F.length(w) > 4) & w.rlike("[^s]s$"), F.substr(w, F.lit(1), F.length(w) - 1)).otherwise(w))
    # legal forms count only where nothing else comes after them
    last = F.array_max(F.filter(F.transform(one, lambda w, i: F.when(~w.isin(*legal), i)), lambda x: x.isNotNull()))
    return F.array_join(F.slice(one, 1, F.coalesce(last + 1, F.size(one))), " ")


def has_marker(key: Column, vehicle: Sequence[str] = VEHICLE) -> Column:
    return F.arrays_overlap(F.split(key, " "), F.array(*[F.lit(v) for v in vehicle]))


def before_boundary(key: Column, boundary: Sequence[str] = BOUNDARY) -> Column:
    """The words before the first boundary word."""
    words = F.split(key, " ")
    cuts = F.filter(F.transform(words, lambda w, i: F.when(w.isin(*boundary), i)), lambda x: x.isNotNull())
    return F.array_join(F.slice(words, 1, F.coalesce(F.try_element_at(cuts, F.lit(1)), F.size(words))), " ")


def umbrella_parent(name: Column) -> Column:
    """The words after "a series of", or null."""
    text = F.trim(F.regexp_replace(F.regexp_replace(F.lower(name), r"[^\w]+", " "), " +", " "))
    at = F.instr(text, F.lit(UMBRELLA))
    return F.when(at > 0, F.nullif(F.trim(F.substring(text, at + len(UMBRELLA), F.lit(1 << 20))), F.lit("")))


def canonical_spelling(stems: DataFrame, key: str, least: int = MIN_SQUASHED) -> DataFrame:
    """(key, canonical): of stems equal but for spaces, the one with most members, then the least."""
    counted = stems.where(F.col(key) != "").groupBy(key).agg(F.count("*").alias("members")).withColumn("squashed", F.replace(key, F.lit(" "), F.lit("")))
    first = F.first(key).over(W.Window.partitionBy("squashed").orderBy(F.desc("members"), key).rowsBetween(W.Window.unboundedPreceding, W.Window.unboundedFollowing))
    return counted.select(key, F.when(F.length("squashed") >= least, first).otherwise(F.col(key)).alias("canonical"))


def prefixes(words: Column) -> Column:
    """Every prefix of an array of words, joined by spaces."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1))), lambda n: F.array_join(F.slice(words, 1, n), " "))


def longest_prefix(names: DataFrame, key: str, name: str, known: DataFrame, stem_col: str) -> DataFrame:
    """(key, sponsor): the longest known stem that shares a prefix of words with the name; ties go to the least stem.

    Of all known stems with a prefix only the best is kept before the join, so a
    common first word costs each name one row and not one for every stem.
    """
    mine = names.select(key, F.explode(prefixes(F.split(name, " "))).alias("_p"))
    order = F.struct((-F.length(stem_col)).alias("n"), F.col(stem_col).alias("sponsor"))
    best = known.select(order.alias("_o"), F.explode(prefixes(F.split(stem_col, " "))).alias("_p")).groupBy("_p").agg(F.min("_o").alias("_o"))
    return mine.join(best, "_p").groupBy(key).agg(F.min("_o").alias("_o")).select(key, F.col("_o.sponsor").alias("sponsor"))


def assign(registrants: DataFrame, key: str = "cik", name: str = "name", aliases: Mapping[str, str] | None = None) -> DataFrame:
    """(key, name, company_family, family_kind, sponsor_key, assignment_rule): every registrant in exactly one family.

    A vehicle belongs to its umbrella parent, else to the longest known entity
    prefix of its sponsor words, else to those words, else to its own stem.
    """
    named = registrants.where(F.trim(F.coalesce(F.col(name), F.lit(""))) != "").select(F.col(key).alias("k"), F.col(name).alias("n"), stem(F.col(name)).alias("s"), umbrella_parent(F.col(name)).alias("u"))
    base = named.join(canonical_spelling(named, "s"), "s", "left").withColumn("stem", F.coalesce("canonical", "s")).withColumn("spv", has_marker(F.col("s"))).drop("canonical")
    entities = base.where("not spv and stem <> ''")
    words = before_boundary(F.col("s"))
    if aliases:
        told = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
        words = F.coalesce(told[F.replace(words, F.lit(" "), F.lit(""))], words)
    vehicles = base.where("spv and stem <> ''").withColumn("c", words)
    found = longest_prefix(vehicles.where("c <> ''"), "k", "c", entities.select("stem").distinct(), "stem")
    both = vehicles.join(found, "k", "left")
    sponsor = F.when(F.col("u").isNotNull(), F.col("u")).when(F.col("sponsor").isNotNull(), F.col("sponsor")).when(F.col("c") != "", F.col("c")).otherwise(F.col("stem"))
    rule = F.when(F.col("u").isNotNull(), "umbrella").when(F.col("sponsor").isNotNull(), "sponsor_prefix").when(F.col("c") != "", "boundary_fallback").otherwise("stem_fallback")
    none = F.lit(None).cast("string")
    shape = lambda df, family, kind, sponsor_key, rule_: df.select(F.col("k").alias(key), F.col("n").alias(name), family.alias("company_family"), F.lit(kind).alias("family_kind"), sponsor_key.alias("sponsor_key"), rule_.alias("assignment_rule"))
    return (
        shape(both.withColumn("sk", sponsor).withColumn("ru", rule), F.concat(F.lit("spv:"), "sk"), "spv", F.col("sk"), F.col("ru"))
        .unionByName(shape(entities, F.concat(F.lit("entity:"), "stem"), "entity", none, F.lit("entity_name")))
        .unionByName(shape(base.where("stem = ''"), F.concat(F.lit("cik:"), F.col("k").cast("string")), "singleton", none, F.lit("no_identity")))
    )
