"""The parsers as SQL functions of a session, and the page parser as a table function."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from glossweave.functions.text import decode_entities, nfc
from glossweave.markup import adoc, pages
from glossweave.parsers import attributes, clauses, definition, markers

FUNCTIONS = {
    "gw_nfc": nfc,
    "gw_decode_entities": decode_entities,
    "gw_attributes": attributes.attributes,
    "gw_markers": markers.markers,
    "gw_definition_parts": definition.definition_parts,
    "gw_clause": clauses.clause_of,
    "gw_content": adoc.content_of,
    "gw_markup": adoc.markup_of,
    "gw_formulas": adoc.formulas_of,
    "gw_page_entries": pages.page_entries,
}


class PageTable:
    """``SELECT * FROM gw_page(html, code)``: a row per language of a page."""

    def eval(self, html: str, code: str):
        for e in pages.parse_page(html, code or "") or ():
            yield e["language"], e["terms"], e["definition"]


class AreaLinks:
    """``SELECT * FROM gw_area_links(html)``: code and title of each part that a page links."""

    def eval(self, html: str):
        yield from pages.area_links(html)


class SectionCells:
    """``SELECT * FROM gw_section_cells(html)``: code and title of each section that a page lists."""

    def eval(self, html: str):
        yield from pages.section_cells(html)


def register(spark: SparkSession) -> None:
    for name, f in FUNCTIONS.items():
        spark.udf.register(name, f)
    spark.udtf.register("gw_page", udtf(PageTable, returnType="language string, terms array<string>, definition string"))
    spark.udtf.register("gw_area_links", udtf(AreaLinks, returnType="code string, title string"))
    spark.udtf.register("gw_section_cells", udtf(SectionCells, returnType="code string, title string"))
