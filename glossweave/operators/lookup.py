"""Concepts by code and language."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class NotFound(LookupError):
    """No concept of that code."""


def normalise_language(language: str, languages: DataFrame) -> str:
    """Three letters as they are, two letters by the language table, anything else unchanged."""
    if len(language) == 3:
        return language
    row = languages.where(F.col("alpha2") == F.lit(language)).select("alpha3").first()
    return row[0] if row else language


def designations(terms: DataFrame, keys: list[str], order: str = "term_no") -> DataFrame:
    """The designation to show per key: the first preferred term by ``order``, else the first."""
    best = F.min_by("designation", F.struct(F.coalesce(F.col("normative_status") != "preferred", F.lit(True)), F.col(order)))
    return terms.groupBy(*keys).agg(best.alias("designation"))


def fetch_concept(concepts: DataFrame, code: str) -> dict:
    """The concept of a code; NotFound if there is none."""
    row = concepts.where(F.col("code") == F.lit(code)).first()
    if row is None:
        raise NotFound(code)
    return row.asDict(recursive=True)


def fetch_term(concepts: DataFrame, code: str, language: str, languages: DataFrame) -> dict | None:
    """One localization; None for a language the concept hasn't."""
    return fetch_concept(concepts, code)["localized"].get(normalise_language(language, languages))


def get(concepts: DataFrame, code: str, language: str, languages: DataFrame) -> str | None:
    """The designation to show; None for unknown codes and languages."""
    try:
        one = fetch_term(concepts, code, language, languages)
    except NotFound:
        return None
    terms = (one or {}).get("terms") or []
    chosen = next((t for t in terms if t["normative_status"] == "preferred"), terms[0] if terms else None)
    return chosen["designation"] if chosen else None


def name_bare_references(mentions: DataFrame, english: DataFrame) -> DataFrame:
    """Mentions ``(..., ref_code, shown)`` whose words are a bare code, named by the English designation where there is one."""
    names = english.select(F.col("code").alias("_code"), F.col("designation").alias("_name"))
    bare = F.col("shown").rlike(r"^\s*IEV\s*[0-9]{2,3}-[0-9]{2,3}-[0-9]{2,3}\s*$")
    return mentions.join(names, F.col("ref_code") == F.col("_code"), "left").withColumn("shown", F.when(bare, F.coalesce("_name", F.trim("shown"))).otherwise(F.trim("shown"))).drop("_code", "_name")
