"""Areas and their sections: dimensions, lookups, and the concepts made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossweave.functions.codes import DATASET_URN, area_code, area_uri, numeric_order, reference, section_code, section_uri


def dim_section(sections: DataFrame) -> DataFrame:
    """``section_code, section_title, area_code``."""
    return sections.select("section_code", "section_title", "area_code").where("section_code is not null")


def dim_area(sections: DataFrame) -> DataFrame:
    """``area_code, area_title``: an area's title is the one its first section names."""
    rows = sections.where("area_code is not null")
    return rows.groupBy("area_code").agg(F.min_by("area_title", F.struct(F.col("area_title").isNull(), "section_code")).alias("area_title"))


def with_titles(df: DataFrame, code: str, sections: DataFrame) -> DataFrame:
    """``df`` with ``area_title`` and ``section_title`` of a code column; null where there is none.

    Plain left joins on the two dimensions: Spark broadcasts them while their measured size
    allows it and sorts otherwise.
    """
    a = dim_area(sections).select(F.col("area_code").alias("_area"), "area_title")
    s = dim_section(sections).select(F.col("section_code").alias("_section"), "section_title")
    keyed = df.withColumns({"_a": area_code(F.col(code)), "_s": section_code(F.col(code))})
    return keyed.join(s, F.col("_s") == F.col("_section"), "left").join(a, F.col("_a") == F.col("_area"), "left").drop("_a", "_s", "_area", "_section")


def domain_title(df: DataFrame) -> DataFrame:
    """``df`` of ``with_titles`` with ``domain``: the section's title, else the area's."""
    return df.withColumn("domain", F.coalesce("section_title", "area_title"))


def find_area(sections: DataFrame, code) -> DataFrame:
    return dim_area(sections).where(F.col("area_code") == F.lit(str(code)))


def find_section(sections: DataFrame, code) -> DataFrame:
    return dim_section(sections).where(F.col("section_code") == F.lit(str(code)))


def sections_for(sections: DataFrame, area) -> DataFrame:
    return dim_section(sections).where(F.col("area_code") == F.lit(str(area)))


def area_for_section(sections: DataFrame, section) -> DataFrame:
    return find_section(sections, section).select("area_code").join(dim_area(sections), "area_code")


def _relation(kind: str, concept_id):
    return F.struct(F.lit(kind).alias("type"), F.struct(F.lit(DATASET_URN).alias("source"), concept_id.alias("id")).alias("ref"))


def hierarchy_concepts(sections: DataFrame) -> DataFrame:
    """A concept per area and per section: ``concept_id, kind, domains, tags, term, language, domain, related``.

    An area narrows to its sections (null without any); a section broadens to its area.
    """
    s, a = dim_section(sections), dim_area(sections)
    below = s.groupBy("area_code").agg(F.sort_array(F.collect_list(section_uri(F.col("section_code")))).alias("_below"))
    areas = a.join(below, "area_code", "left").select(
        area_uri(F.col("area_code")).alias("concept_id"),
        F.lit("area").alias("kind"),
        F.array(reference(area_uri(F.col("area_code")), "domain")).alias("domains"),
        F.array_compact(F.array("area_title")).alias("tags"),
        F.col("area_title").alias("term"),
        F.lit("eng").alias("language"),
        F.lit(None).cast("string").alias("domain"),
        F.transform("_below", lambda x: _relation("narrower", x)).alias("related"),
    )
    parts = s.join(a, "area_code").select(
        section_uri(F.col("section_code")).alias("concept_id"),
        F.lit("section").alias("kind"),
        F.array(reference(area_uri(F.col("area_code")), "domain"), reference(section_uri(F.col("section_code")), "section")).alias("domains"),
        F.array_compact(F.array("area_title", "section_title")).alias("tags"),
        F.col("section_title").alias("term"),
        F.lit("eng").alias("language"),
        F.col("area_title").alias("domain"),
        F.array(_relation("broader", area_uri(F.col("area_code")))).alias("related"),
    )
    return areas.unionByName(parts)


def section_tree(sections: DataFrame) -> DataFrame:
    """One row per area in numeric order with its sections in numeric order (null without any)."""
    entry = F.struct(numeric_order(F.col("section_code")).alias("_order"), F.col("section_code").alias("code"), F.col("section_title").alias("title"))
    below = dim_section(sections).groupBy("area_code").agg(F.array_sort(F.collect_list(entry)).alias("_sections"))
    tree = dim_area(sections).join(below, "area_code", "left")
    children = F.transform("_sections", lambda x: F.struct(x["code"].alias("code"), x["title"].alias("title")))
    return tree.withColumn("children", children).drop("_sections").orderBy(numeric_order(F.col("area_code")), "area_code")


def merge_areas(cached: DataFrame, fresh: DataFrame) -> DataFrame:
    """Areas of a refreshed list in its order; the sections that were already known win."""
    old = cached.select(F.col("area_code").alias("_code"), F.col("sections").alias("_sections"))
    return fresh.join(old, F.col("area_code") == F.col("_code"), "left").withColumn("sections", F.coalesce("_sections", "sections")).drop("_code", "_sections")
