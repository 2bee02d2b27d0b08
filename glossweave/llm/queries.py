"""Queries p1, p2, p6, p7 and p8; what SQL can't say is checked in tests/llm."""

from __future__ import annotations

from glossweave.llm import canonical_list, citation_words, lookalike, mixing, stuffing, tokens
from glossweave.session import table
from pyspark.sql import functions as F


def p1_found(spark, d):
    return lookalike.found(table(spark, d, "localized_concepts"), table(spark, d, "terms"))


def p1_classes(spark, d):
    """Each term and designation with its class, the spellings of it, and how many rows it is linked to."""
    return lookalike.all_classes(table(spark, d, "localized_concepts"), table(spark, d, "terms"))


def p2_found(spark, d):
    return canonical_list.found(table(spark, d, "iev_export"), table(spark, d, "publications"), citation_words.aliases(spark), citation_words.WORDING)


def p2_unmatched(spark, d):
    """Citations without an entry, why, and how often each was typed."""
    rows = canonical_list.resolve_citations(table(spark, d, "iev_export"), table(spark, d, "publications"), citation_words.aliases(spark), citation_words.WORDING)
    return rows.where("ref_id = 0").groupBy("value_text", "found_by").agg(F.count(F.lit(1)).alias("n_rows"))


def p6_ids(spark, d):
    return tokens.encode_texts(table(spark, d, "documents"), "doc_id", "text")


def p6_round_trip(spark, d):
    """Every text encoded and decoded again; SQL knows the digest it must have."""
    return tokens.round_trip(table(spark, d, "documents"), "doc_id", "text").drop("n_ids")


def p7_mix(spark, d):
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p7_shares(spark, d):
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def p8_found(spark, d):
    return stuffing.found(table(spark, d, "documents"))


def p8_scores(spark, d):
    return stuffing.page_scores(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_classes, p2_found, p2_unmatched, p6_ids, p6_round_trip, p7_mix, p7_shares, p8_found, p8_scores)}
ORACLE: dict[str, str] = {
    "p6_round_trip": "SELECT doc_id, md5(coalesce(text, '')) AS digest, true AS same FROM documents",
}
