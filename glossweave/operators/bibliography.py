"""The works that citations name, each once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossweave.functions.labels import anchor, reference_label, reference_type


def bibliography(citations: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """``id, reference, link, type`` of rows ``(_ord, pos, source, id)``, ordered by id.

    A work is its label, the first citation in row order decides its type and link; blank
    sources are skipped.  ``links`` (``reference, link``) is an optional table, joined once
    per work, not per citation.
    """
    label = reference_label(F.col("source"), F.col("id"))
    # blank sources are left out behind the aggregation: a filter before it would be pushed into the citation rules
    at = F.when(F.trim("source") != "", F.struct("_ord", "pos"))
    works = citations.withColumn("reference", label).groupBy("reference").agg(F.min_by("source", at).alias("_source"))
    works = works.where("_source is not null")
    if links is not None:
        works = works.join(links.select("reference", "link"), "reference", "left")
    else:
        works = works.withColumn("link", F.lit(None).cast("string"))
    return works.select(anchor(F.col("reference")).alias("id"), "reference", "link", reference_type(F.col("_source")).alias("type")).orderBy("id", "reference")
