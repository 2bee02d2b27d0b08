"""Concept codes: ``AAA-BB-CC`` is area, section and number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the source that domain references name.
DATASET_URN = "urn:iec:std:iec:60050"


def _parts(code: Column) -> Column:
    """Parts between dashes; trailing empty parts don't count."""
    return F.split(F.regexp_replace(code, "-+$", ""), "-", -1)


def area_code(code: Column) -> Column:
    return F.get(_parts(code), F.lit(0))


def section_code(code: Column) -> Column:
    """The first two parts; null for an area code."""
    parts = _parts(code)
    return F.when(F.size(parts) >= 2, F.concat_ws("-", F.get(parts, F.lit(0)), F.get(parts, F.lit(1))))


def concept_number(code: Column) -> Column:
    """The third part; null where there is none."""
    return F.get(_parts(code), F.lit(2))


def area_uri(area: Column) -> Column:
    return F.concat(F.lit("area-"), area)


def section_uri(section: Column) -> Column:
    return F.concat(F.lit("section-"), section)


def numeric_order(code: Column) -> Column:
    """Sort key of a code: its parts as integers, 0 where a part is no number."""
    return F.transform(F.split(code, "-", -1), lambda p: F.coalesce(F.try_to_number(F.regexp_extract(p, r"^\d{1,9}", 0), F.lit("999999999")).cast("int"), F.lit(0)))


def reference(concept_id: Column, ref_type: str) -> Column:
    return F.struct(concept_id.alias("concept_id"), F.lit(DATASET_URN).alias("source"), F.lit(ref_type).alias("ref_type"))


def domain_references(code: Column) -> Column:
    """The area reference and, for codes with a section, the section reference."""
    section = section_code(code)
    return F.array_compact(F.array(reference(area_uri(area_code(code)), "domain"), F.when(section.isNotNull(), reference(section_uri(section), "section"))))


def section_of(code: Column) -> Column:
    """Everything before the last dash; '' without one."""
    return F.regexp_extract(code, r"(?s)^(.*)-[^-]*$", 1)


def complete_date(c: Column) -> Column:
    """``YYYY[-MM[-DD]]`` as an ISO instant of UTC, missing parts 01; null and '' unchanged, an impossible date null."""
    parts = F.split(c, "-", -1)
    month, day = (F.coalesce(F.get(parts, F.lit(i)), F.lit("01")) for i in (1, 2))
    whole = F.try_to_timestamp(F.concat_ws("-", F.get(parts, F.lit(0)), month, day), F.lit("y-M-d"))
    return F.when(c == "", c).otherwise(F.date_format(whole, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
